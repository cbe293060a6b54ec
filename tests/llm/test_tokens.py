import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from gridspan.llm import packing, token_counts, token_pieces
from gridspan.llm.queries import tokenizer_file

from .conftest import ODD

BYTE, WORD = tokenizer_file("byte_bpe_50k.json"), tokenizer_file("word_bpe_49k.json")
HARD = ["", " ", "a  b", "\n\nx", "don't  I'll it's\tx", "<|endoftext|> a <|endoftext|>b", "x<|endoftext|>\nü É ΣΑΣ İ ﬁ é ́x",
        "a\x1cb \x1f", "x y z", "١٢٣ 12 a1b2", "x" * 30_000, "日本語 😀", " lead", "trail ", "a\r\nb", "The THE the., the,",
        "<|ENDOFTEXT|>", "a b " * 30_000 + "\t" + "c d " * 10]


def test_counts_equal_the_library():
    library = Tokenizer.from_file(BYTE)
    assert token_counts.Counter(BYTE).counts(HARD) == [len(library.encode(t, add_special_tokens=False).ids) for t in HARD]


def test_ids_equal_the_library():
    library = Tokenizer.from_file(WORD)
    want = [np.array(library.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in HARD]
    assert packing.Encoder(WORD).ids(HARD) == want


def test_small_cache_gives_the_same():
    counter = token_counts.Counter(BYTE)
    counter.inner.limit = counter.first.limit = 3
    texts = ["a b c d e f", "f e d c b a", "a b c\nd e f g"] * 4
    assert counter.counts(texts) == [n for t in texts for n in token_counts.Counter(BYTE).counts([t])]


def test_safe_parts_join_to_the_text():
    text = "ab cd  ef\ngh " * 50
    parts = token_pieces.safe_parts(text, 20)
    assert "".join(parts) == text and len(parts) > 5
    assert all(p[0] == " " and p[1] not in " \n" for p in parts[1:])


def test_count_query_on_odd_rows(docs):
    got = token_counts.token_counts(docs(*ODD), BYTE).collect()
    assert len(got) == len(ODD)
    one = {r["doc_id"]: r for r in got}
    assert (one[1]["n_bytes"], one[1]["n_tokens"], one[1]["over_limit"]) == (0, 0, False)
    assert one[7]["over_limit"] and one[7]["n_bytes"] == 200_000
    assert token_counts.token_counts(docs(), BYTE).count() == 0


def test_packing_of_odd_rows(docs):
    library = Tokenizer.from_file(WORD)
    got = packing.pack_documents(docs(*ODD), WORD).collect()
    want = []
    for doc_id, text, *_ in ODD:
        ids = np.array(library.encode(text or "", add_special_tokens=False).ids + [1], "<u4")
        want += [(doc_id, k, 4096 * k, len(b), zlib.crc32(b.tobytes()))
                 for k, b in enumerate(np.split(ids, range(4096, len(ids), 4096)))]
    key = lambda r: (r[0] is None, r[0] or 0, r[1])
    assert sorted([(r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got], key=key) == sorted(want, key=key)
    by = {}
    for r in got:
        by.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for rows in by.values():
        at = 0
        for offset, length in sorted(rows):
            assert offset == at
            at += length
        assert at <= 4096
    assert packing.pack_documents(docs(), WORD).count() == 0


@pytest.mark.parametrize("rule", ["norm", "dot"])
def test_every_capacity_holds(rule):
    lengths = np.random.default_rng(1).integers(1, 90, 400)
    c = packing.Capacity(tokens=100, documents=3, attention=6000, weights=(1, 1, 1), rule=rule)
    bins, offsets = packing.best_fit(lengths, c)
    for b in range(bins.max() + 1):
        mine = lengths[bins == b]
        assert len(mine) and mine.sum() <= 100 and len(mine) <= 3
        assert (mine**2).sum() <= 6000 or len(mine) == 1


def test_best_fit_is_close_to_the_bound_and_groups_cost_little(spark):
    lengths = np.random.default_rng(2).lognormal(6, 1, 3000).astype(int) % 4096 + 1
    bins, _ = packing.best_fit(lengths, packing.Capacity())
    assert bins.max() + 1 <= 1.01 * lengths.sum() / 4096 + 1
    rows = spark.createDataFrame([(i, int(n)) for i, n in enumerate(lengths)], "doc_id long, length long")
    got = packing.pack(rows, group_sequences=50).toPandas()
    assert len(got) == 3000 and got.groupby("sequence_id").length.sum().max() <= 4096
    assert got.sequence_id.nunique() <= 1.05 * lengths.sum() / 4096 + 20
