import hashlib
import math

import numpy as np
import pytest
from pyspark.sql import types as T

from gridspan.llm import hilbert_clusters as hc

SCHEMA = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType())),
                       T.StructField("label", T.IntegerType()), T.StructField("x", T.StringType()),
                       T.StructField("ids", T.StringType()), T.StructField("cluster", T.StringType())])


def table(spark, rows):
    return spark.createDataFrame([(i, None if e is None else [None if v is None else float(v) for v in e], 1, "a", "b", "c")
                                  for i, e in rows], SCHEMA)


def plain(rows, k=8, rounds=10, seed=3, size=64):
    """The contract in plain Python."""
    kept = [(i, [math.floor(1024 * float(np.float32(v))) for v in e]) for i, e in rows
            if e is not None and len(e) == size and all(v is not None and math.isfinite(v) for v in e)]
    name = lambda i: hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()
    c = [x for _, x in sorted(kept, key=lambda r: (name(r[0]), r[1]))[:k]]

    def where(x):
        return min((sum((a - b) ** 2 for a, b in zip(x, y)), j) for j, y in enumerate(c))
    for _ in range(rounds):
        of = [where(x)[1] for _, x in kept]
        for j in range(len(c)):
            mine = [x for (_, x), o in zip(kept, of) if o == j]
            if mine:
                c[j] = [sum(v) // len(mine) for v in zip(*mine)]
    last = [(i, *where(x)) for i, x in kept]
    total = {j: sum(d for _, d, o in last if o == j) for j in range(len(c))}
    return sorted(((i, j, d, total[j], sum(total.values()), hashlib.sha256(",".join(map(str, c[j])).encode()).hexdigest())
                   for i, d, j in last), key=str)


def test_curve_visits_every_cell_in_steps_of_one():
    for d, bits in ((2, 3), (3, 2), (2, 1), (4, 2)):
        cells = np.stack(np.meshgrid(*[np.arange(1 << bits)] * d, indexing="ij"), -1).reshape(-1, d)
        codes = [bytes(c) for c in hc.hilbert_codes(cells, bits)]
        assert len(set(codes)) == len(cells)
        walk = cells[sorted(range(len(cells)), key=codes.__getitem__)]
        assert (np.abs(np.diff(walk, axis=0)).sum(1) == 1).all()


def test_boxes_never_lose_the_nearest_and_do_prune():
    rng, pruned = np.random.default_rng(1), 0
    for _ in range(200):
        c = rng.integers(-20, 20, (6, 3))
        x = rng.integers(-20, 20, 3) + rng.integers(0, 6, (30, 3))
        want = ((x[:, None] - c) ** 2).sum(2)
        got, away = hc.nearest(x.astype(np.int32), x.min(0), x.max(0), c)
        assert (got == want.argmin(1)).all() and (away == want.min(1)).all()
        pruned += 6 - hc.candidates(x.min(0), x.max(0), c).sum()
    assert pruned > 300


def test_large_components_are_exact():
    c = np.array([[2 ** 26, 0], [2 ** 26, 1]], np.int64)
    x = np.array([[-2 ** 26, 1], [-2 ** 26, 0]], np.int32)
    got, away = hc.nearest(x, x.min(0), x.max(0), c)
    assert got.tolist() == [1, 0] and away.tolist() == [2 ** 54, 2 ** 54]


@pytest.mark.parametrize("block", [1, 64])
def test_equals_plain_rounds(spark, block):
    rng = np.random.default_rng(2)
    middles = rng.normal(size=(4, 64))
    rows = [(int(i), (middles[i % 4] + rng.normal(size=64) * 0.2).tolist()) for i in range(150)]
    rows += [(200 + i, rows[0][1]) for i in range(60)]  # a third of the rows are equal
    got = hc.centroid_clusters(table(spark, rows), block=block).collect()
    assert sorted((tuple(r) for r in got), key=str) == plain(rows)


def test_odd_vectors_ties_repeats_and_names(spark):
    one = [0.0] * 63
    rows = [(1, None), (2, []), (3, one), (4, [None] + one), (5, [math.nan] + one), (6, [math.inf] + one),
            (7, [1.0] + one), (7, [1.0] + one), (7, [-1.0] + one), (None, [0.0] + one), (9, [0.5] + one), (10, one + [0, 0])]
    got = hc.centroid_clusters(table(spark, rows)).collect()
    assert sorted((tuple(r) for r in got), key=str) == plain(rows) and len(got) == 5
    with pytest.raises(ValueError, match="131072"):
        hc.centroid_clusters(table(spark, [(1, [2.0 ** 17] + one)]))


def test_empty_table(spark):
    got = hc.centroid_clusters(table(spark, []))
    assert got.count() == 0 and got.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
