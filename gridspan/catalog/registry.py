"""Named queries and their SQL twins.

A query is ``(spark, folder) -> DataFrame`` over the tables in ``folder``; its twin is a
SQL text over views of the same tables.  ``doubles`` names the columns that are rounded on
both sides, because floating sums depend on the order of addition.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import pin_utc

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None, doubles: str = "", digits: int = 4):
    """Register a query; with ``sql`` it is value-checked, else only its rows are counted."""
    columns = doubles.split()
    # Moves values off exact halves, where engines may round either way.
    off = 3.3e-4 * 10 ** -digits

    def register(fn: Query) -> Query:
        @wraps(fn)
        def run(spark: SparkSession, folder: str) -> DataFrame:
            df = fn(pin_utc(spark), folder)
            return df.select(*[
                (F.round(F.col(f"`{c}`").cast("double") + F.lit(off), digits) + F.lit(0.0)).alias(c)
                if c in columns else F.col(f"`{c}`") for c in df.columns])

        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")
        QUERIES[name] = run
        if sql is not None:
            cut = ", ".join(f'round(CAST("{c}" AS DOUBLE) + {off!r}, {digits}) + 0.0 AS "{c}"' for c in columns)
            ORACLES[name] = f"SELECT * REPLACE ({cut}) FROM ({sql}) AS q" if cut else sql
        return run
    return register


def with_(*parts: str, body: str) -> str:
    """A SELECT over common table expressions."""
    return "WITH " + ", ".join(parts) + " " + body
