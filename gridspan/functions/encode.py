"""Categorical codes, one-hot columns and token binning."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..plans.coding import dense_codes


class TooManyCategories(ValueError):
    """One column per category was asked for on a column with too many categories."""


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def clean_code(value: str | Column, suffix: str | None = None) -> Column:
    """Lower-cased, trimmed text without an optional suffix pattern."""
    value = _col(value)
    if suffix:
        value = F.regexp_replace(value, suffix, "")
    return F.lower(F.trim(value))


def to_number(value: str | Column) -> Column:
    """Number from text; NULL when the text is none."""
    return _col(value).try_cast("double")


def name_map(value: str | Column, mapping: dict[str, int], unknown: int | None = None) -> Column:
    """Lookup in a small fixed mapping."""
    pairs = [F.lit(x) for kv in mapping.items() for x in kv]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), _col(value)),
                      F.lit(unknown).cast("int"))


def categories(df: DataFrame, *columns: str, limit: int | None = None) -> dict[str, list[str]]:
    """Sorted distinct values (as text) of columns meant for a wide layout, in one job.

    They become columns of a plan, so they reach the driver; a caller who does not know the width
    may give a ``limit``, and a column with more values is refused.  For wide columns use
    :func:`sparse_one_hot`, whose width does not enter the plan.
    """
    pairs = df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("c"), F.col(c).cast("string").alias("v")) for c in columns])).alias("p"))
    pairs = pairs.select("p.c", "p.v").filter("v is not null").distinct()
    rows = (pairs if limit is None else pairs.limit(limit * len(columns) + 1)).collect()
    found = {c: sorted(r["v"] for r in rows if r["c"] == c) for c in columns}
    if limit is None:
        return found
    large = [c for c, values in found.items() if len(values) > limit]
    if large or len(rows) > limit * len(columns):
        raise TooManyCategories(f"more than {limit} categories in {large or list(columns)}")
    return found


def one_hot(df: DataFrame, columns: dict[str, Sequence]) -> DataFrame:
    """Replace each column by one 0/1 column per listed category (``<column>_<value>``)."""
    rest = [c for c in df.columns if c not in columns]
    hot = [F.coalesce((F.col(c).cast("string") == F.lit(str(v))).cast("int"), F.lit(0)).alias(f"{c}_{v}")
           for c, values in columns.items() for v in values]
    return df.select(*rest, *hot)


def undo_one_hot(df: DataFrame, column: str, drop: bool = True) -> DataFrame:
    """Category with the largest indicator among ``<column>_*``; the first one on a tie."""
    prefix = f"{column}_"
    hot = [c for c in df.columns if c.startswith(prefix)]
    scored = F.array(*[F.struct(F.col(f"`{c}`").cast("double").alias("w"),
                                F.lit(-i).alias("first"),
                                F.lit(c[len(prefix):]).alias("value"))
                       for i, c in enumerate(hot)])
    out = df.withColumn(column, F.array_max(scored)["value"])
    return out.drop(*hot) if drop else out


def fit_vocabulary(df: DataFrame, column: str, start: int = 1) -> DataFrame:
    """Sorted distinct values of the fit frame with codes from ``start``."""
    return dense_codes(df, column, "code", start)


def apply_vocabulary(df: DataFrame, vocabulary: DataFrame, column: str, code: str,
                     unknown: int = 0) -> DataFrame:
    """Code every row; values outside the vocabulary get ``unknown``."""
    renamed = vocabulary.select(F.col(column), F.col("code").alias(code))
    joined = df.join(renamed, column, "left")
    return joined.select(*df.columns, F.coalesce(code, F.lit(unknown)).cast("long").alias(code))


def sparse_one_hot(df: DataFrame, categorical: Sequence[str], dense: Sequence[str],
                   output: str = "features"):
    """Fitted stages that put sparse one-hot vectors and dense columns into one vector."""
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler

    indexed = [f"{c}__ix" for c in categorical]
    encoded = [f"{c}__hot" for c in categorical]
    stages = []
    if categorical:
        stages += [StringIndexer(inputCols=list(categorical), outputCols=indexed,
                                 handleInvalid="keep", stringOrderType="alphabetAsc"),
                   OneHotEncoder(inputCols=indexed, outputCols=encoded, dropLast=True,
                                 handleInvalid="keep")]
    stages.append(VectorAssembler(inputCols=encoded + list(dense), outputCol=output,
                                  handleInvalid="keep"))
    return Pipeline(stages=stages).fit(df)


def vector_entries(vector: str | Column) -> tuple[Column, Column, Column]:
    """Size, stored places and their values of an ML vector, sparse or dense; places left out hold zero.

    Unlike ``vector_to_array`` this makes no element per place, so the cost of a row does not grow with the width.
    """
    u = F.unwrap_udt(_col(vector))
    size = F.coalesce(u["size"], F.size(u["values"]))
    return size, F.coalesce(u["indices"], F.sequence(F.lit(0), size - 1)), u["values"]


def bin_token(scaled: str | Column, low: float, high: float, bins: int,
              first_token: int = 0) -> Column:
    """Uniform bin of a scaled value as a token id; values outside go to the end bins."""
    return (F.least(F.greatest(F.width_bucket(_col(scaled), F.lit(low), F.lit(high), F.lit(bins)),
                               F.lit(1)), F.lit(bins)) - 1 + first_token).cast("long")
