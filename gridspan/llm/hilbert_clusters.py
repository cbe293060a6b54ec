"""Exact k-means over zone maps along a Hilbert curve.

Vectors are turned into integers, ordered along a Hilbert curve and cut into blocks, each with the least and
largest value of every component.  A block's box tells which centroids can be nearest to any of its
vectors; only those are compared, exactly and in whole arrays.  The blocks are written once; a
round reads them, adds up per task and cluster, and sends one sum a cluster and component to the driver.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stage

#: Integer components are floor(SCALE * x).
SCALE = 1024
#: Components of at least this size would let a squared distance leave 64 bits.
LARGEST = 2.0 ** 17
#: Bits of the Hilbert curve per component.
BITS = 4
#: Vectors a block.
BLOCK = 64


def hilbert_codes(cells: np.ndarray, bits: int) -> np.ndarray:
    """Place of each row of small integers on the Hilbert curve of its dimension, as big-endian bytes.

    Bits are untangled from the highest plane down: where a component has the plane's bit, the lower bits of
    the first component are inverted, else they are exchanged with its own.  What is left is a Gray code.
    """
    x = np.array(cells, np.int64).T.copy()
    d, n = x.shape
    for plane in (1 << b for b in range(bits - 1, 0, -1)):
        low = plane - 1
        for row in x:
            has = (row & plane) != 0
            swap = np.where(has, 0, (x[0] ^ row) & low)
            x[0] ^= np.where(has, low, swap)
            row ^= swap
    x = np.bitwise_xor.accumulate(x, axis=0)
    turn = np.zeros(n, np.int64)
    for plane in (1 << b for b in range(bits - 1, 0, -1)):
        turn ^= np.where(x[-1] & plane, plane - 1, 0)
    x ^= turn
    planes = (x[None] >> np.arange(bits - 1, -1, -1)[:, None, None]) & 1
    return np.packbits(planes.reshape(bits * d, n).T.astype(np.uint8), axis=1)


def _matrix(lists: pa.Array, size: int) -> np.ndarray:
    return np.asarray(lists.flatten(), np.float64).reshape(-1, size)


def whole_vectors(vectors: DataFrame, column: str, key: str, size: int) -> DataFrame:
    """(vec_id, x): the vectors of ``size`` components, none of them null, infinite or not a number."""
    x = F.col(column).cast("array<double>")
    fit = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    return (vectors.filter((F.size(F.col(column)) == size) & fit)
            .select(F.col(key).cast("long").alias("vec_id"), x.alias("x")))


def hilbert_blocks(rows: DataFrame, size: int, block: int = BLOCK, bits: int = BITS) -> DataFrame:
    """Blocks of ``(vec_id, x)``: ids, their integer components, and the box, as bytes of 32-bit integers.

    Rows are range-partitioned by their place on the curve, equal places by a hash of the id, so any
    number of equal vectors spreads over many tasks.  A component of 2**17 or more is an error.
    """
    low, high = rows.agg(F.min(F.array_min("x")), F.max(F.array_max("x"))).first()
    if low is None:
        low = high = 0.0
    if max(-low, high) >= LARGEST:
        raise ValueError(f"components must be below {LARGEST:.0f} in size, found {low} to {high}")
    step = (high - low) / (1 << bits) or 1.0

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch.column("x"), size)
            cells = np.clip(((x - low) / step).astype(np.int64), 0, (1 << bits) - 1)
            codes, whole = hilbert_codes(cells, bits), np.floor(SCALE * x).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), pa.array([c.tobytes() for c in codes], pa.binary()),
                 pa.array([w.tobytes() for w in whole], pa.binary())], names=["vec_id", "place", "whole"])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def made(ids: list, raw: list[bytes]) -> pa.RecordBatch:
            x = np.frombuffer(b"".join(raw), np.int32).reshape(-1, size)
            return pa.RecordBatch.from_arrays(
                [pa.array([ids], pa.list_(pa.int64())), pa.array([x.tobytes()], pa.binary()),
                 pa.array([x.min(0).tobytes()], pa.binary()), pa.array([x.max(0).tobytes()], pa.binary())],
                names=["ids", "whole", "low", "high"])

        ids, raw = [], []
        for batch in batches:
            ids += batch.column("vec_id").to_pylist()
            raw += batch.column("whole").to_pylist()
            while len(ids) >= block:
                yield made(ids[:block], raw[:block])
                ids, raw = ids[block:], raw[block:]
        if ids:
            yield made(ids, raw)

    places = stage(rows.mapInArrow(coded, "vec_id long, place binary, whole binary"), "hilbert-places")
    order = [F.col("place"), F.xxhash64("vec_id", "whole")]
    ranged = places.repartitionByRange(*order).sortWithinPartitions(*order)
    return stage(ranged.mapInArrow(cut, "ids array<long>, whole binary, low binary, high binary"), "hilbert-blocks")


def candidates(low: np.ndarray, high: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Which centroids can be nearest to a vector of the box; of centroids always equally near, the first.

    The squared distance to centroid j less that to centroid i is linear in the vector, so its least value over the
    box is met at a corner and is exact.  Where it is above zero, j is never nearest.
    """
    low, high, c = low.astype(np.int64), high.astype(np.int64), centroids
    slope = 2 * (c[:, None] - c[None])
    square = (c * c).sum(1)
    least = np.minimum(slope * low, slope * high).sum(2) + square[None] - square[:, None]
    earlier = np.arange(len(c))[:, None] < np.arange(len(c))
    return ~((least > 0) | ((least == 0) & earlier)).any(0)


def nearest(x: np.ndarray, low: np.ndarray, high: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nearest centroid (ties: the first) and its squared distance for each vector of a block, exactly."""
    number = np.flatnonzero(candidates(low, high, centroids))
    c = centroids[number]
    top = max(int(np.abs(c).max()), abs(int(low.min())), abs(int(high.max())))
    # In floats the sums are exact below 2**53, and the product is a fast one.
    kind = np.float64 if 4 * x.shape[1] * top * top < 2 ** 53 else np.int64
    a, b = x.astype(kind), c.astype(kind)
    away = (a * a).sum(1)[:, None] - 2 * (a @ b.T) + (b * b).sum(1)
    best = away.argmin(1)
    return number[best], away[np.arange(len(x)), best].astype(np.int64)


def _blocks(batches: Iterator[pa.RecordBatch], size: int):
    for batch in batches:
        for ids, whole, low, high in zip(*(batch.column(i) for i in range(4))):
            yield (ids.values, *(np.frombuffer(v.as_buffer(), np.int32) for v in (whole, low, high)))


def _sums(blocks: DataFrame, centroids: np.ndarray) -> dict[int, tuple[int, int, list[int]]]:
    """cluster: vectors, squared distances, component sums; ``k * (size + 2)`` numbers reach the driver."""
    k, size = centroids.shape

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((k, size + 2), np.int64)
        for _, whole, low, high in _blocks(batches, size):
            x = whole.reshape(-1, size)
            cluster, away = nearest(x, low, high, centroids)
            for j in np.unique(cluster):
                mine = cluster == j
                total[j, 0] += mine.sum()
                total[j, 1] += away[mine].sum()
                total[j, 2:] += x[mine].sum(0, dtype=np.int64)
        met = np.flatnonzero(total[:, 0])
        yield pa.RecordBatch.from_arrays([pa.array(met.astype(np.int32)), pa.array(list(total[met]), pa.list_(pa.int64()))],
                                         names=["cluster", "sums"])

    parts = blocks.select("ids", "whole", "low", "high").mapInArrow(add, "cluster int, sums array<long>")
    rows = (parts.select("cluster", F.posexplode("sums").alias("at", "value"))
            .groupBy("cluster", "at").agg(F.sum(F.col("value").cast("decimal(38,0)")).alias("value")).collect())
    found: dict[int, list[int]] = {}
    for r in rows:
        found.setdefault(r["cluster"], [0] * (size + 2))[r["at"]] = int(r["value"])
    return {j: (v[0], v[1], v[2:]) for j, v in found.items()}


def refine(blocks: DataFrame, centroids: np.ndarray, rounds: int) -> np.ndarray:
    """Centroids after so many rounds of assignment and floored means; empty clusters keep theirs."""
    for _ in range(rounds):
        after = centroids.copy()
        for j, (n, _, sums) in _sums(blocks, centroids).items():
            after[j] = [s // n for s in sums]
        if (after == centroids).all():
            break
        centroids = after
    return centroids


def assign(blocks: DataFrame, centroids: np.ndarray) -> DataFrame:
    """(vec_id, cluster, distance) of every vector of the blocks."""
    size = centroids.shape[1]

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, whole, low, high in _blocks(batches, size):
            cluster, away = nearest(whole.reshape(-1, size), low, high, centroids)
            yield pa.RecordBatch.from_arrays([ids.cast(pa.int64()), pa.array(cluster.astype(np.int32)), pa.array(away)],
                                             names=["vec_id", "cluster", "distance"])

    return blocks.select("ids", "whole", "low", "high").mapInArrow(find, "vec_id long, cluster int, distance long")


def first_centroids(rows: DataFrame, k: int, seed: int) -> np.ndarray:
    """The ``k`` vectors whose ``seed:vec_id`` has the smallest SHA-256, in that order; ties by components."""
    name = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
    first = rows.orderBy(name, "x").limit(k).select("x").collect()
    return np.array([[int(np.floor(SCALE * v)) for v in r["x"]] for r in first], np.int64)


def _lookup(values: dict, column: Column) -> Column:
    return F.create_map(*[F.lit(v) for pair in sorted(values.items()) for v in pair])[column]


def centroid_clusters(vectors: DataFrame, column: str = "embedding", key: str = "vec_id", size: int = 64, k: int = 8,
                      rounds: int = 10, seed: int = 3, block: int = BLOCK) -> DataFrame:
    """One row per kept vector: vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256.

    Vectors of another length, null ones and those with a null or non-finite component are left out.
    Ties go to the smaller centroid.  Rows that repeat an id count each time; a null id is hashed as empty.
    With fewer than ``k`` vectors there are as many clusters as vectors; without any the result is
    empty.  Other columns are not read.  Components of 2**17 and more are an error, as their
    squared distances would not fit a long.
    """
    rows = whole_vectors(vectors, column, key, size)
    start = first_centroids(rows, k, seed)
    if not len(start):
        return rows.sparkSession.createDataFrame([], "vec_id long, cluster int, distance long, cluster_inertia long, "
                                                     "inertia long, centroid_sha256 string")
    blocks = hilbert_blocks(rows, size, block)
    centroids = refine(blocks, start, rounds)
    inertia = {j: away for j, (_, away, _) in _sums(blocks, centroids).items()}
    names = {j: hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for j, c in enumerate(centroids.tolist())}
    return assign(blocks, centroids).select(
        "vec_id", "cluster", "distance", _lookup(inertia, F.col("cluster")).cast("long").alias("cluster_inertia"),
        F.lit(sum(inertia.values())).cast("long").alias("inertia"),
        _lookup(names, F.col("cluster")).alias("centroid_sha256"))
