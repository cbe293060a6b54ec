import hashlib
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import types as T

from gridspan.llm import prefix_trie as pt

SCHEMA = T.StructType([T.StructField("conv_id", T.LongType()), T.StructField("turn", T.LongType()),
                       T.StructField("role", T.StringType()), T.StructField("text", T.StringType()),
                       T.StructField("depth", T.StringType()), T.StructField("key", T.StringType()),
                       T.StructField("chars", T.StringType()), T.StructField("conv", T.StringType())])
COLUMNS = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def table(spark, rows):
    return spark.createDataFrame([(*r, "w", "x", "y", "z") for r in rows], SCHEMA)


def plain(rows, rebuild=True):
    """The contract in plain Python, by walking every node's members."""
    own = defaultdict(list)
    for c, t, role, text in rows:
        if c is not None:
            r, x = role or "", text or ""
            digest = hashlib.sha256(f"{len(r)}:{r}:{x}".encode()).hexdigest()
            own[c].append(((t is not None, t or 0), digest, (r, x)))
    own = {c: [v[2] for v in sorted(turns)] for c, turns in own.items()}
    built = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        built[c] = tuple(own.get(c - c % 100, [])[:h] + turns[h:]) if rebuild else tuple(turns)
    nodes = defaultdict(list)
    for c, s in built.items():
        for d in range(len(s) + 1):
            nodes[s[:d]].append(c)
    kids = defaultdict(list)
    for s in nodes:
        if s:
            kids[s[:-1]].append(s)

    def below(s):
        out, todo = [], [s]
        while todo:
            out.append(todo.pop())
            todo += kids[out[-1]]
        return out
    got = []
    for s, members in list(nodes.items()):
        under = below(s)
        ends = ",".join(str(c) for c in sorted(members) if len(built[c]) == len(s))
        got.append((min(members), len(s), min(nodes[s[:-1]]) if s else None, len(members), len(kids[s]),
                    sum(not kids[u] for u in under), sum((len(nodes[u]) - 1) * len(u[-1][1]) for u in under if u),
                    hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(got, key=str)


def found(df):
    return sorted((tuple(r[c] for c in COLUMNS) for r in df.collect()), key=str)


def talks(n=130):
    """Shared openings, equal conversations, proper prefixes, forks, and ids of two periods."""
    rows = []
    for c in range(n):
        length = 1 + (c * 7) % 9 if c % 3 else 4
        for t in range(length):
            rows.append((c, t, "user" if t % 2 == 0 else "assistant", f"text {t} {c % 3 if t < 3 else c % 5} é"))
    return rows


@pytest.mark.parametrize("slab, listed", [(4096, 1000), (2, 3)])
def test_equals_walking_every_node(spark, monkeypatch, slab, listed):
    monkeypatch.setattr(pt, "SLAB", slab)
    monkeypatch.setattr(pt, "LISTED", listed)
    rows = talks()
    df = table(spark, rows)
    assert found(pt.prefix_trie(df)) == plain(rows)
    assert found(pt.prefix_trie(df, rebuild=False)) == plain(rows, rebuild=False)


def test_nulls_ties_repeats_and_long_texts(spark):
    long = "word " * 50_000
    rows = [(1, None, "user", "a"), (1, 0, None, "b"), (1, 0, None, "b"), (1, 0, "", None), (None, 0, "user", "lost"),
            (100, 0, "user", long), (100, 1, "", ""), (100, 2, "user", "c"), (101, 0, "user", long), (101, 1, None, None),
            (101, 2, "user", "c"), (-7, 0, "user", "a"), (207, 3, "x:1", "y"), (207, 4, "x", "1:y")]
    for rebuild in (True, False):
        assert found(pt.prefix_trie(table(spark, rows), rebuild=rebuild)) == plain(rows, rebuild)


def test_turnless_conversations_end_at_the_root(spark):
    bare = next(c for c in range(101, 200) if zlib.crc32(str(c).encode()) % 6 >= 1)
    rows = [(bare, 0, "user", "gone")]
    got = found(pt.prefix_trie(table(spark, rows)))
    assert got == plain(rows) == [(bare, 0, None, 1, 0, 1, 0, hashlib.sha256(str(bare).encode()).hexdigest())]


def test_one_conversation_may_hold_most_rows(spark, monkeypatch):
    monkeypatch.setattr(pt, "SLAB", 16)
    rows = [(1, t, "user", f"t{t}") for t in range(300)] + [(2, t, "user", f"t{t}") for t in range(40)]
    assert found(pt.prefix_trie(table(spark, rows), rebuild=False)) == plain(rows, False)


def test_texts_join_back_and_empty_table(spark):
    df = table(spark, talks(20))
    nodes = pt.prefix_trie(df, rebuild=False)
    named = nodes.join(pt.turn_texts(df), "last_digest", "left").collect()
    assert all((r["text"] is None) == (r["depth"] == 0) for r in named)
    assert all(r["text"].startswith(f"text {r['depth'] - 1} ") for r in named if r["depth"])
    assert pt.prefix_trie(table(spark, [])).count() == 0
