import random
import re

import numpy as np
import pytest

from gridspan.llm import components, ngram_join
from gridspan.llm.common import documents

from .conftest import ODD

SMALL = "/root/testdata/sf0.001"


def _brute(rows, n, num, den):
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    sets = []
    for _, text, *_ in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(low))
        sets.append({tuple(w[i:i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else {tuple(w)} if w else set())
    root = list(range(len(rows)))
    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and root[i] != root[j] and den * len(a & b) >= num * len(a | b):
                old, new = max(root[i], root[j]), min(root[i], root[j])
                root = [new if r == old else r for r in root]
    out = []
    for i, (key, *_) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if root[j] == root[i] and rows[j][0] is not None]
        out.append((key, len(sets[i]), (min(ids) if ids else None) if sets[i] else key))
    return out


def _near(seed, many=120):
    random.seed(seed)
    base = [[f"w{random.randrange(400)}" for _ in range(random.choice([4, 12, 60, 150]))] for _ in range(6)]
    rows = []
    for i in range(many):
        w = list(random.choice(base))
        for _ in range(random.choice([0, 0, 1, 2, 5])):
            w[random.randrange(len(w))] = f"x{random.randrange(5)}"
        rows.append((i, (" ".join(w)).upper() if i % 9 == 0 else " ".join(w)))
    return rows


def _key(r):
    return (r[0] is None, r[0] or 0, r[1])


def _rows(df):
    return sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in df.collect()), key=_key)


@pytest.mark.parametrize("n, num", [(3, 90), (5, 80)])
def test_equals_all_pairs(docs, n, num):
    rows = _near(n)
    assert _rows(ngram_join.near_duplicates(docs(*rows), n, num, 100)) == sorted(_brute(rows, n, num, 100), key=_key)


def test_blocks_of_large_clusters_lose_no_link(docs, monkeypatch):
    monkeypatch.setattr(ngram_join, "BLOCK_SETS", 7)
    rows = _near(4)
    assert _rows(ngram_join.near_duplicates(docs(*rows))) == sorted(_brute(rows, 3, 90, 100), key=_key)


def test_odd_rows_and_empty_table(docs):
    assert _rows(ngram_join.near_duplicates(docs(*ODD))) == sorted(_brute(ODD, 3, 90, 100), key=_key)
    assert ngram_join.near_duplicates(docs()).count() == 0
    kept = ngram_join.drop_near_duplicates(docs(*ODD))
    assert kept.columns == docs().columns
    assert sorted(kept.collect(), key=lambda r: r["doc_id"] or 99)[0]["doc_id"] == 1


def test_whole_table_equals_all_pairs(spark):
    source = documents(spark, SMALL)
    rows = [(r["doc_id"], r["text"]) for r in source.collect()]
    assert _rows(ngram_join.near_duplicates(source)) == sorted(_brute(rows, 3, 90, 100), key=_key)
    found = _brute(rows, 5, 80, 100)
    assert {r["doc_id"] for r in ngram_join.drop_near_duplicates(source).collect()} == {r[0] for r in found if r[0] == r[2]}


def test_any_list_of_common_tokens_gives_the_same(docs, monkeypatch):
    monkeypatch.setattr(ngram_join, "_COMMON_SETS", 2)
    rows = _near(5)
    assert _rows(ngram_join.near_duplicates(docs(*rows), 3, 80, 100)) == sorted(_brute(rows, 3, 80, 100), key=_key)


def test_parts_outnumber_what_linked_sets_can_differ_in():
    for num in (60, 80, 90):
        parts = ngram_join.Parts(num, 100, 3000)
        for b in (5, 10, 11, 37, 150, 151, 1000, 3000):
            for a in range(-(-num * b // 100), b + 1):
                both = -(-num * (a + b) // (100 + num))
                k = parts.parts[parts.of(np.array([b]))[0]]
                assert k - (a + b - 2 * both) > parts.spare[parts.of(np.array([b]))[0]] or (k == 0 and a + b == 2 * both)


def test_components_of_a_path_and_a_star(spark):
    links = [(i, i + 1) for i in range(30)] + [(100, 100 + i) for i in range(1, 40)] + [(200, 200)]
    got = {r["node"]: r["root"] for r in components.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(1, 31)}, **{100 + i: 100 for i in range(1, 40)}}
