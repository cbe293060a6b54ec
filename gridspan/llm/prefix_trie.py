"""Prefix trie of conversations by whole-sequence collapse.

Equal conversations become one weighted sequence, named by its smallest member, with the list of its
members as its ends.  Sequences that are proper prefixes of others are found by an anti-join; the rest are
the leaves.  Every sequence then gives one row per prefix, and nodes are sums of these rows.

A node belongs to its smallest member's sequence, so along a sequence the nodes it owns are the last ones.
What lies below a node is therefore a running sum over what its sequence owns, plus the whole owned sum of
every sequence that leaves it further down: one number per sequence and prefix, never a pair of nodes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stage

#: Rows of one conversation that a window takes at a time.
SLAB = 4096
#: Members of a sequence that are joined to one piece of text at a time.
LISTED = 1000


def plain_turns(turns: DataFrame, key: str, turn: str, role: str, text: str) -> DataFrame:
    """(conv, at, digest, chars) of every turn that has a conversation; null role and text are empty."""
    who, what = F.coalesce(F.col(role).cast("string"), F.lit("")), F.coalesce(F.col(text).cast("string"), F.lit(""))
    return turns.filter(F.col(key).isNotNull()).select(
        F.col(key).cast("long").alias("conv"), F.col(turn).alias("at"),
        F.sha2(F.concat_ws(":", F.length(who), who, what), 256).alias("digest"),
        F.length(what).cast("long").alias("chars"))


def numbered(turns: DataFrame) -> DataFrame:
    """The turns with ``rank`` from 1 in their conversation: by turn, null first, equal turns by digest.

    Turns are range-partitioned, so a conversation of any length spreads over tasks; a rank is the place in its
    part plus the sizes of the parts before (one row per conversation and part).
    """
    order = [F.col("at").asc_nulls_first(), F.col("digest"), F.col("row")]
    rows = stage(turns.withColumn("row", F.monotonically_increasing_id()), "trie-turns")
    parts = stage(rows.repartitionByRange("conv", *order).withColumn("part", F.spark_partition_id()), "trie-parts")
    before = Window.partitionBy("conv").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = (parts.groupBy("conv", "part").agg(F.count("*").alias("n"))
             .select("conv", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before")))
    inside = Window.partitionBy("conv", "part").orderBy(*order)
    return (parts.join(sizes, ["conv", "part"])
            .select("conv", "digest", "chars", (F.row_number().over(inside) + F.col("before")).alias("rank")))


def running(rows: DataFrame, group: str, at: str, sums: dict[str, str], down: bool = False) -> DataFrame:
    """``rows`` with sums (new name: column) from the first row of the group, or down from the last one, by ``at``.

    ``at`` counts rows of the group.  Slabs of them are summed first; a window sees one slab, or one row per slab.
    """
    slab = F.floor(F.col(at) / SLAB)
    rows = rows.withColumn("slab", slab)
    order = F.col("slab").desc() if down else F.col("slab").asc()
    before = Window.partitionBy(group).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    carry = (rows.groupBy(group, "slab").agg(*[F.sum(c).alias(f"{n}_in") for n, c in sums.items()])
             .select(group, "slab", *[F.coalesce(F.sum(f"{n}_in").over(before), F.lit(0)).alias(f"{n}_in") for n in sums]))
    inside = (Window.partitionBy(group, "slab").orderBy(F.col(at).desc() if down else F.col(at).asc())
              .rowsBetween(Window.unboundedPreceding, 0))
    out = rows.join(carry, [group, "slab"])
    return out.select(*[c for c in rows.columns if c != "slab"],
                      *[(F.sum(c).over(inside) + F.col(f"{n}_in")).alias(n) for n, c in sums.items()])


def opened_alike(turns: DataFrame, period: int = 100, most: int = 6) -> DataFrame:
    """(conv, depth, digest, chars): every conversation with the opening of its period's first one.

    Conversation c takes the first ``h = crc32(c) % most`` turns of c - c % period, all if it has fewer, then its
    own turns after its first h.  An opening reaches ``period`` conversations at most.
    """
    turns = stage(turns, "trie-ranked")
    base, h = F.col("conv") - F.col("conv") % period, F.crc32(F.col("conv").cast("string")) % most
    heads = turns.filter((F.col("conv") % period == 0) & (F.col("rank") < most)).select(
        F.col("conv").alias("base"), "rank", "digest", "chars")
    every = turns.groupBy("conv").agg(F.lit(1).alias("one")).select("conv", base.alias("base"), h.alias("h"))
    taken = every.join(heads, "base").filter("rank <= h").select("conv", F.col("rank").alias("depth"), "digest", "chars")
    have = stage(heads.groupBy("base").agg(F.max("rank").alias("have")), "trie-openings")
    own = (turns.select("*", base.alias("base"), h.alias("h")).filter("rank > h").join(have, "base", "left")
           .select("conv", (F.col("rank") - F.col("h") + F.least("h", F.coalesce("have", F.lit(0)))).alias("depth"),
                   "digest", "chars"))
    roots = every.select("conv", F.lit(0).alias("depth"), F.lit(None).cast("string").alias("digest"),
                         F.lit(0).cast("long").alias("chars"))
    return taken.unionByName(own).unionByName(roots)


def with_roots(turns: DataFrame) -> DataFrame:
    """(conv, depth, digest, chars) of ranked turns as they are, each conversation with its textless root."""
    roots = turns.groupBy("conv").agg(F.lit(0).cast("long").alias("chars"))
    return turns.select("conv", F.col("rank").alias("depth"), "digest", "chars").unionByName(
        roots.select("conv", F.lit(0).alias("depth"), F.lit(None).cast("string").alias("digest"), "chars"))


def _prefixes(rebuilt: DataFrame) -> DataFrame:
    """Every row with ``key``, the name of the conversation up to it: its depth and two sums of hashes of (depth, turn).

    The sums are 60 bits of a SHA-256 each, so 120 bits name a prefix among those of its depth.
    """
    mark = F.sha2(F.concat_ws(":", "depth", "digest"), 256)
    part = lambda start: F.when(F.col("depth") > 0, F.conv(F.substring("mark", start, 15), 16, 10).cast("decimal(38,0)")
                                ).otherwise(F.lit(0).cast("decimal(38,0)"))
    marked = rebuilt.withColumn("mark", mark).withColumn("a", part(1)).withColumn("b", part(17)).drop("mark")
    summed = running(marked, "conv", "depth", {"x": "a", "y": "b"})
    return summed.select("conv", "depth", "digest", "chars", F.md5(F.concat_ws(":", "depth", "x", "y")).alias("key"))


def end_lists(ends: DataFrame) -> DataFrame:
    """(key, ends_sha256): hash of the ids that end at ``key``, ascending, comma-joined.

    Ids are range-partitioned with their key and joined to pieces of ``LISTED`` where they lie; a key's hash then
    takes its pieces one after the other, so only a piece is in memory.
    """
    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, ids, out = None, [], []

        def flush():
            if ids:
                out.append((key, ids[0], ",".join(map(str, ids))))

        def made():
            return pa.RecordBatch.from_arrays([pa.array([o[0] for o in out], pa.string()),
                                               pa.array([o[1] for o in out], pa.int64()),
                                               pa.array([o[2] for o in out], pa.string())], names=["key", "first", "ids"])

        for batch in batches:
            for k, c in zip(batch.column("key").to_pylist(), batch.column("conv").to_pylist()):
                if k != key or len(ids) >= LISTED:
                    flush()
                    key, ids = k, []
                ids.append(c)
            yield made()
            out = []
        flush()
        yield made()

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state, out = None, None, []

        def made():
            return pa.RecordBatch.from_arrays([pa.array([o[0] for o in out], pa.string()),
                                               pa.array([o[1] for o in out], pa.string())], names=["key", "ends_sha256"])

        for batch in batches:
            for k, text in zip(batch.column("key").to_pylist(), batch.column("ids").to_pylist()):
                if k != key:
                    if key is not None:
                        out.append((key, state.hexdigest()))
                    key, state = k, hashlib.sha256(text.encode())
                else:
                    state.update(b"," + text.encode())
            yield made()
            out = []
        if key is not None:
            out.append((key, state.hexdigest()))
        yield made()

    listed = (ends.select("key", "conv").repartitionByRange("key", "conv").sortWithinPartitions("key", "conv")
              .mapInArrow(pieces, "key string, first long, ids string"))
    return (listed.repartition("key").sortWithinPartitions("key", "first").select("key", "ids")
            .mapInArrow(hashed, "key string, ends_sha256 string"))


def trie(rebuilt: DataFrame) -> DataFrame:
    """The nodes of ``(conv, depth, digest, chars)``, each conversation with its root row of depth 0.

    conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256, and
    last_digest, the digest of the node's last turn (see :func:`turn_texts`).
    """
    rows = stage(_prefixes(rebuilt), "trie-prefixes")
    last = F.max(F.struct("depth", "key")).alias("last")
    ends = stage(rows.groupBy("conv").agg(last).select("conv", "last.*"), "trie-ends")
    sequences = stage(ends.groupBy("key").agg(F.min("conv").alias("conv"), F.count("*").alias("weight"),
                                              F.max("depth").alias("length")), "trie-sequences")
    paths = stage(rows.join(sequences.select("conv", "weight", "length"), "conv"), "trie-paths")
    leaves = sequences.join(paths.filter("depth < length").select("key").distinct(), "key", "left_anti").select(
        "conv", F.lit(1).alias("leaf"))
    nodes = (paths.join(stage(leaves, "trie-leaves"), "conv", "left").groupBy("key")
             .agg(F.min("conv").alias("conv"), F.min("depth").alias("depth"), F.sum("weight").alias("n_convs"),
                  F.coalesce(F.sum("leaf"), F.lit(0)).alias("n_leaves"), F.max("chars").alias("chars"),
                  F.max("digest").alias("last_digest")))
    nodes = stage(nodes.withColumn("saving", (F.col("n_convs") - 1) * F.col("chars")), "trie-nodes")
    # Where each sequence leaves the one it hangs on, and all that it owns.
    owned = stage(nodes.groupBy("conv").agg(F.min("depth").alias("from"), F.max("depth").alias("to"),
                                            F.sum("saving").alias("all")), "trie-owned")
    before = stage(paths.join(owned, "conv").filter(F.col("depth") < F.col("from")), "trie-shared")
    hung = before.groupBy("key").agg(F.sum("all").alias("hung"),
                                     F.sum((F.col("depth") == F.col("from") - 1).cast("long")).alias("branches"))
    parents = (before.filter(F.col("depth") == F.col("from") - 1).select(F.col("conv").alias("child"), "key")
               .join(nodes.select("key", F.col("conv").alias("parent")), "key"))
    spans = stage(owned.join(parents, F.col("conv") == F.col("child"), "left").select("conv", "from", "to", "parent"),
                  "trie-spans")
    below = running(nodes, "conv", "depth", {"mine": "saving"}, down=True)
    whole = (below.join(spans, "conv").join(hung, "key", "left").join(end_lists(ends), "key", "left"))
    zero = F.lit(0).cast("long")
    parent = F.when(F.col("depth") == F.col("from"), F.col("parent")).otherwise(F.col("conv"))
    return whole.select(
        F.col("conv").alias("conv_id"), F.col("depth").cast("long"), parent.cast("long").alias("parent_conv_id"),
        F.col("n_convs").cast("long"),
        (F.coalesce("branches", zero) + (F.col("depth") < F.col("to")).cast("long")).alias("n_children"),
        F.col("n_leaves").cast("long"), (F.col("mine") + F.coalesce("hung", zero)).cast("long").alias("saved_tokens"),
        F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"), "last_digest")


def turn_texts(turns: DataFrame, role: str = "role", text: str = "text", key: str = "conv_id") -> DataFrame:
    """(last_digest, role, text), once for each different turn, to be joined to the nodes."""
    who, what = F.coalesce(F.col(role).cast("string"), F.lit("")), F.coalesce(F.col(text).cast("string"), F.lit(""))
    return (turns.filter(F.col(key).isNotNull())
            .select(F.sha2(F.concat_ws(":", F.length(who), who, what), 256).alias("last_digest"),
                    who.alias("role"), what.alias("text"))
            .groupBy("last_digest").agg(F.first("role").alias("role"), F.first("text").alias("text")))


def prefix_trie(turns: DataFrame, key: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
                rebuild: bool = True) -> DataFrame:
    """One row per node of the trie of the conversations, see :func:`trie`.

    With ``rebuild`` conversations first get shared openings (:func:`opened_alike`).  Turns without a conversation are
    left out; a null turn number comes first; equal turn numbers are ordered by the turn's digest, and
    repeated rows are turns of their own.  Null role or text is the empty one.  A conversation that is left without
    turns ends at the root.  An empty table has no nodes, not even a root.  Other columns are not read.
    """
    ranked = numbered(plain_turns(turns, key, turn, role, text))
    return trie(opened_alike(ranked) if rebuild else with_roots(ranked))
