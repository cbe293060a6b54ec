import numpy as np
import sentencepiece

from gridspan.llm import piece_lattice
from gridspan.llm.queries import tokenizer_file

from .conftest import ODD

MODEL = tokenizer_file("piece_bpe_32k.model")


def _all(lattice, text):
    """Scores of all segmentations."""
    if not text:
        return [0.0]
    out = []
    for k in range(1, min(16, len(text)) + 1):
        if text[:k] in lattice.piece:
            out += [lattice.piece[text[:k]][0] + s for s in _all(lattice, text[k:])]
    if text[0] not in lattice.piece:
        out += [lattice.spell + s for s in _all(lattice, text[1:])]
    return out


def test_n_best_equal_enumeration_and_round_trip():
    lattice, library = piece_lattice.Lattice(MODEL, 5), sentencepiece.SentencePieceProcessor(model_file=MODEL)
    for text in ("the cat", "abcdef", "  a  b", "é日本 x.\ny", "ing, tion", "aaaaaaa", "a\tb", "😀"):
        found = lattice.encode([text])[0]
        normal = piece_lattice.BLANK + text.replace(" ", piece_lattice.BLANK)
        assert normal == library.normalize(text)
        assert [s for s, _ in found] == sorted(_all(lattice, normal), reverse=True)[:5]
        assert len({i for _, i in found}) == len(found)
        for _, ids in found:
            assert lattice.decode(ids) == text == library.decode(np.frombuffer(ids, "<u4").tolist())


def test_query_on_odd_rows(spark, docs):
    got = piece_lattice.encode_pieces(docs(*ODD), MODEL, with_ids=True)
    rows = got.collect()
    assert len(rows) == len(ODD) and all(r["round_trip"] for r in rows)
    assert {r["n_pieces"] for r in rows if r["doc_id"] in (1, 2)} == {0}
    back = {r["doc_id"]: r["text"] for r in piece_lattice.decode_pieces(got, MODEL).collect()}
    assert back == {r[0]: r[1] or "" for r in ODD}
    assert piece_lattice.encode_pieces(docs(), MODEL).count() == 0


def test_search_equals_enumeration_for_every_n():
    for n in (1, 2, 3, 6):
        lattice = piece_lattice.Lattice(MODEL, n)
        for part in ("▁", "▁the", "▁ingshin", "aaaaaaa", "▁Über", "x一\U0001f9ffy", "▁mentment"):
            found = lattice.search(part)
            assert np.allclose([s for s, _ in found], sorted(_all(lattice, part), reverse=True)[:n])
            assert len({ids for _, ids in found}) == len(found)
