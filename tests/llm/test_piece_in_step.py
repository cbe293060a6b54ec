import pytest

from gridspan.llm import piece_lattice
from gridspan.llm.common import documents
from gridspan.llm.queries import tokenizer_file

MODEL = tokenizer_file("piece_bpe_32k.model")
SMALL = "/root/testdata/sf0.001"
ODD_PARTS = ["▁", "▁the", "▁ingshin", "aaaaaaa", "▁Über", "x", "\U0001f9ff", "▁mentment", "the" * 40, "ing" * 21 + "a", "\x00"]


@pytest.mark.parametrize("n", [1, 2, 3, 6])
def test_parts_in_step_equal_parts_one_by_one(spark, n):
    lattice = piece_lattice.Lattice(MODEL, n)
    words = [piece_lattice.BLANK + w for r in documents(spark, SMALL).limit(20).collect() for w in (r["text"] or "").split()]
    parts = lattice.cut_all([*words, "日本語", "a\U0001f9ffb"])[0] + ODD_PARTS
    found = lattice.search_all(parts)
    assert [found.found(p) for p in range(len(parts))] == [lattice.search(p) for p in parts]


@pytest.mark.parametrize("dense", [0, piece_lattice.DENSE])
def test_words_are_cut_where_no_piece_holds_both_neighbours(dense, monkeypatch):
    monkeypatch.setattr(piece_lattice, "DENSE", dense)
    lattice, words = piece_lattice.Lattice(MODEL, 2), ["▁the", "▁日本語", "x\U0001f9ffy", "▁qzqxj", "a"]
    parts, part, at = lattice.cut_all(words)
    for k, w in enumerate(words):
        mine = [parts[p] for p in part[at[k]:at[k + 1]]]
        assert "".join(mine) == w
        whole = {w[i - 1:i + 1] for i in range(1, len(w))} - {a[-1] + b[0] for a, b in zip(mine, mine[1:])}
        assert whole <= lattice.inside and not lattice.inside & {a[-1] + b[0] for a, b in zip(mine, mine[1:])}


def test_ordinary_words_are_not_searched_one_by_one(monkeypatch):
    lattice, alone = piece_lattice.Lattice(MODEL, 3), []
    monkeypatch.setattr(lattice, "search", lambda p: alone.append(p) or piece_lattice.Lattice.search(lattice, p))
    assert len(lattice.encode(["the cat sat on the mat " * 50 + "\U0001f9ff"])[0]) == 3
    assert alone == ["\U0001f9ff"]
