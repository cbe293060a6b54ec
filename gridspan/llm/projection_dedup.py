"""Embedding near-duplicates by counting collisions of one-dimensional projections.

Vectors so close to one pivot that all of them must link with each other form a ball, which stands for them all, so
a dense group costs one comparison a vector.  Balls are then sorted along many random projections.  One bare projection
hardly tells near from far in many dimensions, so each sorts within the cells of a few others.  Two balls
collide where one comes into the window around the other; pairs that collide in a calibrated number of
projections are verified: by the angle of their pivots and radii, by each vector's angle to the other pivot
where that leaves it open, and by the vectors' own cosine where that is open as well.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from statistics import NormalDist

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import mixed, stage
from .components import components

#: Room for rounding in comparisons of angles, in radians.
SLACK = 1e-6
_normal = NormalDist()


def same_cell(width: float, away: float) -> float:
    """Chance that two vectors ``away`` apart fall into one randomly shifted cell of a Gaussian projection."""
    r = width / away
    return 1 - 2 * _normal.cdf(-r) - 2 / (math.sqrt(2 * math.pi) * r) * (1 - math.exp(-r * r / 2))


def within(window: float, away: float) -> float:
    """Chance that two vectors ``away`` apart project to at most ``window`` from each other."""
    return 2 * _normal.cdf(window / away) - 1


@dataclass(frozen=True)
class Projections:
    """``tables`` sorted projections, each within cells of ``deep`` others; a pair needs ``count`` collisions."""

    width: float
    window: float
    deep: int
    tables: int
    count: int
    seed: int = 13

    def directions(self, table: int, size: int) -> tuple[np.ndarray, np.ndarray]:
        rng = np.random.default_rng([self.seed, table, size])
        return rng.standard_normal((size, self.deep + 1)), rng.uniform(0, self.width, self.deep)

    def places(self, x: np.ndarray, table: int) -> tuple[np.ndarray, np.ndarray]:
        """Cell (hashed) and place along the sorted projection of each row of ``x``."""
        towards, shift = self.directions(table, x.shape[1])
        at = x @ towards
        cell = np.floor((at[:, :-1] + shift) / self.width).astype(np.int64).astype(np.uint64)
        name = np.full(len(x), mixed(np.array([table + 1], np.uint64))[0])
        for column in cell.T:
            name = mixed(name * np.uint64(0x9E3779B97F4A7C15) + column)
        return name, at[:, -1]


def calibrated(cosine: float, rows: int, recall: float = 0.99, count: int = 2, crowd: float = 0.5, deep: int = 10
               ) -> Projections:
    """Projections that find a pair of exactly ``cosine`` with chance ``recall``; closer pairs have more.

    Cells are made of at least ``deep`` projections, and of so many that unrelated vectors of a group of ``rows``
    collide with at most ``crowd`` others each.  Cells are four and windows two and a half times as wide as
    such a pair's distance.
    """
    near, far = math.sqrt(2 - 2 * cosine), math.sqrt(2)
    width, window = 4 * near, 2.5 * near
    while rows * same_cell(width, far) ** deep * within(window, far) > crowd:
        deep += 1
    hit, tables = same_cell(width, near) ** deep * within(window, near), count

    def found(n: int) -> float:
        return 1 - sum(math.comb(n, i) * hit ** i * (1 - hit) ** (n - i) for i in range(count))

    while found(tables) < recall:
        tables += 1
    return Projections(width, window, deep, tables, count)


def _by_size(lists: pa.Array):
    """(rows, matrix) for each length among the lists."""
    lengths = np.asarray(lists.value_lengths(), np.int64)
    ends, values = np.cumsum(lengths), np.asarray(lists.flatten(), np.float64)
    for n in np.unique(lengths):
        rows = np.flatnonzero(lengths == n)
        yield rows, values[(ends[rows] - n)[:, None] + np.arange(n)]


def _dots(a: pa.Array, b: pa.Array) -> pa.Array:
    if not len(a):
        return pa.array([], pa.float64())
    lengths = np.asarray(a.value_lengths(), np.int64)
    products = np.asarray(a.flatten(), np.float64) * np.asarray(b.flatten(), np.float64)
    return pa.array(np.add.reduceat(products, np.cumsum(lengths) - lengths))


def cosine(a: Column | str, b: Column | str) -> Column:
    """Of unit vectors of the same length, row by row."""
    def dots(x: pa.Array, y: pa.Array) -> pa.Array:
        return _dots(x, y)
    return F.arrow_udf(dots, "double")(a, b)


def cell_of(unit: Column, plan: Projections, table: int) -> Column:
    def find(lists: pa.Array) -> pa.Array:
        out = np.zeros(len(lists), np.uint64)
        for rows, x in _by_size(lists):
            out[rows] = plan.places(x, table)[0]
        return pa.array(out.astype(np.int64))
    return F.arrow_udf(find, "long")(unit)


def _angle(cosines: Column) -> Column:
    return F.acos(F.least(F.lit(1.0), F.greatest(F.lit(-1.0), cosines)))


def whole(values: Column) -> Column:
    """Whether a vector has a direction: components, all of them finite, and not all zero."""
    x = F.transform(values, lambda v: v.cast("double"))
    return F.coalesce((F.size(values) > 0) & F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
                      & F.exists(x, lambda v: v != 0), F.lit(False))


def unit(values: Column) -> Column:
    """The vector at length one in double precision, safe for very large and very small components."""
    def scale(lists: pa.Array) -> pa.Array:
        x, lengths = np.asarray(lists.flatten(), np.float64), np.asarray(lists.value_lengths(), np.int64)
        if len(lengths):
            heads = np.cumsum(lengths) - lengths
            x = x / np.repeat(np.maximum.reduceat(np.abs(x), heads), lengths)
            x = x / np.repeat(np.sqrt(np.add.reduceat(x * x, heads)), lengths)
        return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(lengths)]), pa.int32()), pa.array(x))
    return F.arrow_udf(scale, "array<double>")(values)


def balls_of(points: DataFrame, plan: Projections, cosine_limit: float, rounds: int = 4) -> DataFrame:
    """The points with ``ball``, a pivot's id, and ``pivot``, its vector, no further than half the linking angle away.

    In each round points meet in the cells of a table of their own and move to the smallest pivot known there, if it
    is near enough.  So a dense group gathers at few pivots; only minima are gathered per cell.
    """
    near = math.cos(math.acos(cosine_limit) / 2 - SLACK)
    now = points.withColumns({"ball": F.col("point"), "pivot": F.col("unit")})
    for r in range(rounds):
        now = stage(now.withColumn("cell", cell_of(F.col("unit"), plan, plan.tables + r)), "balls")
        best = now.groupBy("label", "size", "cell").agg(F.min(F.struct("ball", "pivot")).alias("best"),
                                                        F.count_distinct("ball").alias("balls")).filter("balls > 1")
        met = now.join(stage(best, "ball-cells"), ["label", "size", "cell"], "left")
        closer = F.when(F.col("best.ball") < F.col("ball"), F.col("best.pivot"))
        moves = F.coalesce(cosine(F.coalesce(closer, F.col("pivot")), F.col("unit")) >= near, F.lit(False)) & closer.isNotNull()
        now = met.withColumn("moves", moves).select(
            *points.columns, F.when(F.col("moves"), F.col("best.ball")).otherwise(F.col("ball")).alias("ball"),
            F.when(F.col("moves"), F.col("best.pivot")).otherwise(F.col("pivot")).alias("pivot"))
    return stage(now.withColumn("near", cosine("unit", "pivot")), "balls")


def colliding(points: DataFrame, plan: Projections) -> DataFrame:
    """(a, b), a < b: balls whose windows meet in at least ``plan.count`` projections.

    A table's row is a ball in a cell with the least and largest place of its vectors there.
    """
    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ball, group = (np.asarray(batch.column(n), np.int64) for n in ("ball", "group"))
            for rows, x in _by_size(batch.column("unit")):
                for table in range(plan.tables):
                    cell, place = plan.places(x, table)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(mixed(cell + group[rows].astype(np.uint64)).astype(np.int64)), pa.array(ball[rows]),
                         pa.array(place)], names=["cell", "ball", "place"])

    rows = (points.select("ball", F.xxhash64("label", "size").alias("group"), "unit")
            .mapInArrow(places, "cell long, ball long, place double"))
    spans = stage(rows.groupBy("cell", "ball").agg(F.min("place").alias("low"), F.max("place").alias("high")), "spans")
    a = spans.select("cell", F.col("ball").alias("a"), F.col("low").alias("a_low"), F.col("high").alias("a_high"))
    b = spans.select("cell", F.col("ball").alias("b"), F.col("low").alias("b_low"), F.col("high").alias("b_high"))
    meets = ((F.col("a") < F.col("b")) & (F.col("a_low") <= F.col("b_high") + plan.window)
             & (F.col("b_low") <= F.col("a_high") + plan.window))
    pairs = a.join(b, "cell").filter(meets).groupBy("a", "b").agg(F.count("*").alias("n"))
    return stage(pairs.filter(F.col("n") >= plan.count).select("a", "b"), "ball-pairs")


def _links(points: DataFrame, balls: DataFrame, pairs: DataFrame, limit: float) -> tuple[DataFrame, DataFrame]:
    """(a, b) of linked balls with ``point``, null where all of a link with all of b, and ``n``, the linked copies.

    Rows come in both directions; ``n`` is what a point, or every point of ball a, gains.
    """
    theta = math.acos(limit)
    side = lambda n: balls.select(*[F.col(c).alias(f"{n}_{c}") for c in balls.columns])
    met = (pairs.join(side("a"), F.col("a") == F.col("a_ball")).join(side("b"), F.col("b") == F.col("b_ball"))
           .filter("a_label = b_label AND a_size = b_size"))
    met = met.withColumn("angle", _angle(cosine("a_pivot", "b_pivot")))
    reach = F.col("a_reach") + F.col("b_reach")
    met = met.withColumn("all", F.col("angle") + reach <= theta - SLACK).filter(F.col("angle") - reach <= theta + SLACK)
    met = stage(met.select("a", "b", "all", "a_weight", "b_weight"), "ball-verdicts")
    both = met.select("a", "b", "all", F.col("b_weight").alias("n")).unionByName(
        met.select(F.col("b").alias("a"), F.col("a").alias("b"), "all", F.col("a_weight").alias("n")))
    sure = both.filter("all").select("a", "b", F.lit(None).cast("long").alias("point"), "n")
    # Each point of one ball against the other ball as a whole.
    other = balls.select(F.col("ball").alias("b"), "pivot", "reach")
    own = points.select(F.col("ball").alias("a"), "point", "unit")
    seen = both.filter("NOT all").join(own, "a").join(other, "b")
    seen = seen.withColumn("angle", _angle(cosine("unit", "pivot"))).filter(F.col("angle") - F.col("reach") <= theta + SLACK)
    seen = seen.withColumn("sure", F.col("angle") + F.col("reach") <= theta - SLACK)
    seen = stage(seen.select("a", "b", "point", "unit", "n", "sure"), "point-verdicts")
    part = seen.filter("sure").select("a", "b", "point", "n")
    # Points near the rim: against the vectors of the other ball.
    theirs = points.select(F.col("ball").alias("b"), F.col("unit").alias("theirs"), "copies")
    rim = (seen.filter("NOT sure").select("a", "b", "point", "unit").join(theirs, "b")
           .filter(cosine("unit", "theirs") >= limit).groupBy("a", "b", "point").agg(F.sum("copies").alias("n")))
    found = stage(sure.unionByName(part).unionByName(rim), "ball-links")
    return found, found.select("a", "b").distinct()


def near_vectors(vectors: DataFrame, column: str = "embedding", key: str = "vec_id", label: str = "label",
                 limit: float = 0.93, recall: float = 0.99) -> DataFrame:
    """One row per vector: vec_id, n_links, component_id, kept.

    Vectors link when their labels are equal and not null, they are equally long, and their cosine in
    double precision is at least ``limit``.  Null, zero and non-finite vectors, and those without a
    label, link with nothing: no links, their own component, kept.  Equal vectors link with each other whether or not
    their ids repeat.  A null id comes after all others, so it names a component only where there is no
    other id.  An empty table gives an empty result.  Other columns are not read.
    """
    rows = stage(vectors.select(F.monotonically_increasing_id().alias("row"), F.col(key).cast("long").alias("vec_id"),
                                F.col(label).alias("label"), F.col(column).alias("e")), "vectors")
    fit = F.col("label").isNotNull() & whole(F.col("e"))
    copies = stage(rows.filter(fit).groupBy("label", "e").agg(F.min("row").alias("point"), F.min("vec_id").alias("least"),
                                                              F.count("*").alias("copies")), "copies")
    points = copies.select("point", "least", "copies", "label", F.size("e").alias("size"), unit(F.col("e")).alias("unit"))
    most = copies.groupBy("label", F.size("e")).count().agg(F.max("count")).first()[0] or 1
    plan = calibrated(limit, most, recall)
    points = balls_of(points, plan, limit)
    alone = F.count("*") == 1
    balls = stage(points.groupBy("ball").agg(
        F.first("label").alias("label"), F.first("size").alias("size"),
        F.when(alone, F.first("unit")).otherwise(F.first("pivot")).alias("pivot"),
        F.when(alone, F.lit(0.0)).otherwise(_angle(F.min("near")) + SLACK / 8).alias("reach"),
        F.sum("copies").alias("weight"), F.min("least").alias("least")), "ball-sums")
    links, edges = _links(points, balls, colliding(points, plan), limit)
    roots = components(edges)
    named = stage(balls.join(roots, balls["ball"] == roots["node"], "left")
                  .select("ball", "weight", "least", F.coalesce("root", "ball").alias("root")), "ball-roots")
    names = named.groupBy("root").agg(F.min("least").alias("component"))
    shared = links.filter("point IS NULL").groupBy(F.col("a").alias("ball")).agg(F.sum("n").alias("shared"))
    of_ball = stage(named.join(names, "root").join(shared, "ball", "left").select(
        "ball", "component", (F.col("weight") - 1 + F.coalesce("shared", F.lit(0))).alias("inside")), "ball-results")
    own = stage(links.filter("point IS NOT NULL").groupBy("point").agg(F.sum("n").alias("own")), "point-links")
    verdict = stage(points.select("point", "ball").join(own, "point", "left").join(of_ball, "ball").select(
        "point", "component", (F.col("inside") + F.coalesce("own", F.lit(0))).alias("n")), "point-results")
    of_copy = copies.select("label", "e", "point").join(verdict, "point").drop("point")
    good = rows.filter(fit).join(stage(of_copy, "copy-results"), ["label", "e"]).select(
        "vec_id", F.col("n").cast("long").alias("n_links"), F.col("component").alias("component_id"))
    odd = rows.filter(~fit).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return good.unionByName(odd).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
