import numpy as np
import pyarrow as pa

from gridspan.llm import ngram_join

from .test_katz_disk import CLEANUP
from .test_ngram_join import _brute, _key, _near, _rows


def _batches(sig, h, size):
    return [pa.RecordBatch.from_arrays([pa.array(sig[i:i + size]), pa.array(h[i:i + size])], names=["sig", "set"])
            for i in range(0, len(sig), size)]


def _together(pairs, sets):
    forest = ngram_join.Forest(len(sets))
    place = {s: i for i, s in enumerate(sets)}
    for a, b in pairs:
        forest.join(place[a], place[b])
    return [forest.root(i) for i in range(len(sets))]


def test_parts_are_shuffled_once_and_sets_outside_clusters_not_at_all(spark, docs, monkeypatch):
    """Beyond ``BROADCAST_ROWS`` shared parts, all parts went through a second shuffle, which did not fit the disk at 6 GB."""
    monkeypatch.setattr(ngram_join, "BROADCAST_ROWS", 0)
    rows = _near(7) + [(1000 + i, " ".join(f"alone{i}x{j}" for j in range(40))) for i in range(300)]
    joined, kept, sized, stage = [], set(), ngram_join._sized, ngram_join.stage

    def noted(large, small, on):
        joined.append((on, large.count(), small.count()))
        return sized(large, small, on)

    def staged(df, label):
        kept.add(spark.conf.get(CLEANUP, None))
        return stage(df, label)

    monkeypatch.setattr(ngram_join, "_sized", noted)
    monkeypatch.setattr(ngram_join, "stage", staged)
    before = spark.conf.get(CLEANUP, None)
    assert _rows(ngram_join.near_duplicates(docs(*rows), 3, 80, 100)) == sorted(_brute(rows, 3, 80, 100), key=_key)
    (on, sent, clustered), = joined
    assert on == "set" and clustered <= 120 and sent < 2 * len(_near(7))
    assert kept == {"true"} and spark.conf.get(CLEANUP, None) == before


def test_a_part_is_sent_once_a_task_and_brings_the_same_sets_together(monkeypatch):
    random = np.random.default_rng(5)
    sig, h = random.integers(-50, 50, 900), random.integers(-300, 300, 900)
    sig[:200], h[:200] = 7, np.arange(1000, 1200)  # a part that many sets share
    sets = sorted(set(h.tolist()))
    want = _together([(a, b) for s in set(sig.tolist()) for m in [h[sig == s].tolist()] for a, b in zip(m, m[1:])], sets)
    for most, size in ((10 ** 6, 900), (100, 30), (1, 1)):
        monkeypatch.setattr(ngram_join, "_HELD", most)
        sent = list(ngram_join._once(iter(_batches(sig, h, size))))
        assert all((b.column("sig").to_numpy() == 7).sum() <= 1 for b in sent)
        rows = pa.Table.from_batches(sent).sort_by("sig")
        links = ngram_join._neighbours(iter(rows.combine_chunks().to_batches(max_chunksize=17)))
        pairs = [(r["a"], r["b"]) for b in links for r in b.to_pylist()]
        assert _together(pairs, sets) == want
    assert list(ngram_join._once(iter([]))) == [] and list(ngram_join._neighbours(iter([]))) == []


def test_marks_know_all_their_sets(spark, monkeypatch):
    h = np.random.default_rng(3).integers(-2 ** 63, 2 ** 63 - 1, 4000)
    mine, other = h[:2000], h[2000:]
    for most in (28, 16):
        monkeypatch.setattr(ngram_join, "MARKS", most)
        found = ngram_join.marks(spark.createDataFrame([(int(x),) for x in mine], "set long"), len(mine))
        assert ngram_join.marked(found, mine).all() and ngram_join.marked(found, other).mean() < 0.1
    none = ngram_join.marks(spark.createDataFrame([], "set long"), 0)
    assert not ngram_join.marked(none, h).any()
