"""Exact quantiles of groups of any size.

The built-in exact ``percentile`` keeps all distinct values of a group in one buffer.  Here an open interval around
each wanted rank is narrowed, pass by pass: a mergeable sketch proposes two values of the data, one
aggregation counts exactly what lies below, at, between and above them, and the interval becomes the part that
holds the rank.  A poor proposal only narrows less; no count is ever guessed.  Once an interval holds few
values they are looked at one by one.  No pass keeps more than that of a group, and none orders its rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .lineage import staged
from .slabs import rejoin

#: Values of an interval that are looked at one by one.
FEW = 4096
#: Points of a sketch; a pass leaves about three of so many parts of an interval.
POINTS = 256


def _inside(low: str, high: str) -> str:
    """The value where it lies strictly between the bounds; a null bound is none."""
    return f"CASE WHEN ({low} IS NULL OR _v > {low}) AND ({high} IS NULL OR _v < {high}) THEN _v END"


def _points(value: str, accuracy: int) -> str:
    marks = ", ".join(repr(k / POINTS) for k in range(POINTS + 1))
    return f"percentile_approx({value}, array({marks}), {accuracy})"


def _interval(name: str, rank: str, below: str, m: str, lo: str, hi: str, q: str, found: str) -> str:
    """An open interval: the wanted rank, how many values lie before it and in it, its bounds, a sketch of it."""
    return (f"named_struct('rank', {rank}, 'below', CAST({below} AS BIGINT), 'm', CAST({m} AS BIGINT), 'lo', CAST({lo} AS DOUBLE), "
            f"'hi', CAST({hi} AS DOUBLE), 'q', CAST({q} AS ARRAY<DOUBLE>), 'found', CAST({found} AS DOUBLE))" + name)


def exact_quantiles(df: DataFrame, keys: Sequence[str], value: str, probs: dict[str, float],
                    accuracy: int = 2000, few: int = FEW) -> DataFrame:
    """One row per key with a column per entry of ``probs`` and the group size ``n``.

    Values between two neighbouring ones are interpolated linearly.  NULL values do not count; a group without
    any other has no row; a NULL key is a group.
    """
    group = list(keys) or ["_all"]
    data = df if keys else df.withColumn("_all", F.lit(0))
    data = data.select(*group, F.col(value).cast("double").alias("_v")).filter("_v is not null")
    position = {f"_{i}": f"(n - 1) * {float(p)!r}D" for i, p in enumerate(probs.values())}
    names = [f"{i}{end}" for i in position for end in ("low", "high")]
    first = data.groupBy(*group).agg(F.expr("count(_v) AS n"), F.expr(f"{_points('_v', accuracy)} AS _q"))
    state = staged(first.select(*group, "n", *[
        F.expr(_interval(f" AS {i}{end}", f"{turn}({pos})", "0", "n", "NULL", "NULL", "_q", "NULL"))
        for i, pos in position.items() for end, turn in (("low", "floor"), ("high", "ceil"))]), "quantile-intervals")
    wide = " OR ".join(f"({e}.found IS NULL AND {e}.m > {few})" for e in names)
    settled = []
    while True:
        settled.append(state.filter(f"NOT ({wide})"))
        state = state.filter(wide)
        if state.isEmpty():
            break
        state = staged(_narrowed(data, state, group, names, accuracy, few), "quantile-intervals")
    done = reduce(DataFrame.unionByName, settled)
    bounds = done.select(*group, *[F.expr(f"named_struct('open', {e}.found IS NULL, 'lo', {e}.lo, 'hi', {e}.hi) AS {e}")
                                   for e in names])
    lists = rejoin(data, bounds, group, "inner").groupBy(*group).agg(*[
        F.expr(f"sort_array(collect_list(CASE WHEN {e}.open THEN {_inside(f'{e}.lo', f'{e}.hi')} END)) AS {e}_list") for e in names])
    full = rejoin(done, lists, group, "inner").select(*group, "n", *[
        F.expr(f"coalesce({e}.found, get({e}_list, CAST({e}.rank - {e}.below AS INT))) AS {e}") for e in names])
    return full.select(*keys, "n", *[F.expr(f"{i}low + ({i}high - {i}low) * ({pos} - floor({pos}))").alias(name)
                                     for name, (i, pos) in zip(probs, position.items())])


def _narrowed(data: DataFrame, state: DataFrame, group: Sequence[str], names: Sequence[str], accuracy: int,
              few: int) -> DataFrame:
    """One pass: every interval that is still wide becomes the part of it that holds its rank."""
    def bound(e: str, side: str) -> str:
        """A sketched value just under or over the rank; the interval's own bound where there is no sketch of it."""
        own, step = ("lo", -1) if side == "a" else ("hi", 2)
        place = f"CAST(floor(({e}.rank - {e}.below) / {e}.m * {POINTS}) AS INT) + {step}"
        return f"CASE WHEN {e}.q IS NULL THEN {e}.{own} ELSE get({e}.q, greatest(0, least({POINTS}, {place}))) END AS {e}_{side}"

    probes = state.select(*group, *[F.expr(bound(e, side)) for e in names for side in "ab"])
    counts = rejoin(data, probes, group, "inner").groupBy(*group).agg(*[F.expr(x) for e in names for x in (
        f"first({e}_a) AS {e}_a", f"first({e}_b) AS {e}_b", f"count_if(_v < {e}_a) AS {e}_lt",
        f"count_if(_v <= {e}_a) AS {e}_mid", f"count({_inside(f'{e}_a', f'{e}_b')}) AS {e}_in",
        f"count_if(_v = {e}_b AND {e}_b <> coalesce({e}_a, {e}_b - 1)) AS {e}_end",
        f"{_points(_inside(f'{e}_a', f'{e}_b'), accuracy)} AS {e}_q")])

    def after(e: str) -> str:
        end = f"({e}_mid + {e}_in)"
        same = f"{e}.rank"
        parts = [
            (f"{e}.found IS NOT NULL OR {e}.m <= {few}", _interval("", same, f"{e}.below", f"{e}.m", f"{e}.lo", f"{e}.hi", f"{e}.q", f"{e}.found")),
            (f"{e}.rank < {e}_lt", _interval("", same, f"{e}.below", f"{e}_lt - {e}.below", f"{e}.lo", f"{e}_a", "NULL", "NULL")),
            (f"{e}.rank < {e}_mid", _interval("", same, f"{e}.below", f"{e}.m", f"{e}.lo", f"{e}.hi", "NULL", f"{e}_a")),
            (f"{e}.rank < {end}", _interval("", same, f"{e}_mid", f"{e}_in", f"{e}_a", f"{e}_b", f"{e}_q", "NULL")),
            (f"{e}.rank < {end} + {e}_end", _interval("", same, f"{e}.below", f"{e}.m", f"{e}.lo", f"{e}.hi", "NULL", f"{e}_b"))]
        rest = _interval("", same, f"{end} + {e}_end", f"{e}.below + {e}.m - {end} - {e}_end", f"{e}_b", f"{e}.hi", "NULL", "NULL")
        return "CASE " + " ".join(f"WHEN {c} THEN {x}" for c, x in parts) + f" ELSE {rest} END AS {e}"

    return rejoin(state, counts, group, "inner").select(*group, "n", *[F.expr(after(e)) for e in names])
