"""Exact dedup with a heavy-hitter split, in DataFrame functions only.

A Misra-Gries pass (``freqItems``) over the digests gives at most ``1 / support`` candidates.  Their
exact counts come from one aggregation with map-side combine; those that hold at least ``support`` of
all rows are the verified winners, at most ``1 / support`` rows of about 100 bytes, and are broadcast, so
their copies are decided where they are read.  All other digests have fewer rows than that and
are shuffled by digest.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import SPACES, packed, stage

SUPPORT = 0.001


def normalised(text: Column) -> Column:
    """Null as empty, every run of white space as one space."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), SPACES, " ")


def digest(text: Column) -> Column:
    return F.sha2(normalised(text), 256)


def _order(key: Column, row: Column) -> Column:
    """Smallest known id first, then by row."""
    return F.struct(key.isNull().alias("unknown"), key.alias("id"), row.alias("row"))


def heavy_winners(digests: DataFrame, support: float = SUPPORT) -> DataFrame:
    """Verified frequent digests of ``(row_id, id, digest)``: digest, winner, heavy_size."""
    rows = digests.count()
    found = (digests.select(F.xxhash64("digest").alias("key")).freqItems(["key"], support)
             .select(F.explode("key_freqItems").alias("key")))
    counts = (digests.withColumn("key", F.xxhash64("digest"))
              .join(F.broadcast(found), "key", "left_semi")
              .groupBy("digest").agg(F.count("*").alias("heavy_size"),
                                     F.min(_order(F.col("id"), F.col("row_id"))).alias("winner")))
    return stage(counts.filter(F.col("heavy_size") >= max(2, support * rows)), "heavy-digests")


def _digests(docs: DataFrame, text: str, key: str) -> DataFrame:
    return stage(docs.select(F.monotonically_increasing_id().alias("row_id"), F.col(key).alias("id"),
                             digest(F.col(text)).alias("digest")), "digests")


def exact_duplicates(docs: DataFrame, text: str = "text", key: str = "doc_id",
                     support: float = SUPPORT) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when they are after white space is normalised; null is the empty text, and all empty
    texts form one group.  The row with the smallest id stays; a null id comes after
    all others, and of rows that repeat an id with the same text exactly one stays.  An empty
    table gives an empty result.
    """
    rows = _digests(docs, text, key)
    heavy = F.broadcast(heavy_winners(rows, support))
    hot = rows.join(heavy, "digest").select("row_id", "id", "digest", "heavy_size", "winner")
    group = Window.partitionBy("digest")
    rest = (rows.join(heavy, "digest", "left_anti")
            .select("row_id", "id", "digest", F.count("*").over(group).alias("heavy_size"),
                    F.min(_order(F.col("id"), F.col("row_id"))).over(group).alias("winner")))
    return hot.unionByName(rest).select(
        F.col("id").alias("doc_id"), F.col("winner.id").alias("keep_id"),
        F.col("heavy_size").alias("group_size"), (F.col("row_id") == F.col("winner.row")).alias("kept"),
        F.col("digest").alias("text_sha256"))


def drop_exact_copies(docs: DataFrame, text: str = "text", key: str = "doc_id",
                      support: float = SUPPORT) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns.

    Copies of heavy digests go before the shuffle; of the others each digest's first row stays.
    Rules for nulls, ties and repeats as in :func:`exact_duplicates`.
    """
    heavy = F.broadcast(heavy_winners(_digests(docs, text, key), support)
                        .select("digest", F.col("winner.id").alias("winner_id"), F.lit(True).alias("heavy")))
    rows = packed(docs, id=F.col(key), digest=digest(F.col(text)))
    left = (rows.join(heavy, "digest", "left")
            .filter(F.col("heavy").isNull() | F.col("id").eqNullSafe(F.col("winner_id"))))
    first = Window.partitionBy("digest").orderBy(F.col("id").asc_nulls_last())
    return left.withColumn("rank", F.row_number().over(first)).filter("rank = 1").select("row.*")
