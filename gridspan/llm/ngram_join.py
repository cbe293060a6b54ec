"""N-gram Jaccard join by a token-group matrix, exact.

1. A document's set is its distinct word shingles, as 64-bit hashes; equal sets are one set from here on.
2. The tokens of a set are dealt by hash into more parts than two linked sets can differ in, so linked
   sets share a part.  Sets that share a part, directly or over others, form a cluster; only sets of one
   cluster can be linked.  The number of parts depends on the size class alone, and parts are whole
   subsets, so a passage that many documents share does not bring them together.  Each task sends a part
   once, and the sets that share one in a task by links; the parts are then sorted, so the sets of a part
   are neighbours, and neither copied to the executors nor shuffled again, however many parts are shared.
3. In a cluster, sets are ordered by size into groups.  The token-group matrix holds each group's token
   union.  The overlap of a query set with a union bounds its overlap with every member; only groups
   whose bound reaches the threshold are opened, and those whose members already hang together with
   the query are not.  Clusters beyond a memory bound are cut into blocks, and pairs of blocks are
   worked on apart, so no task holds more than the bound.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Words, mixed, release, shuffles_dropped, stage, text_slices
from .components import components

GROUP = 64
#: Bounds of one task: sets and tokens of a cluster or of a block.
BLOCK_SETS = 2048
BLOCK_TOKENS = 2_000_000
#: A side is broadcast up to this many rows of one hash.
BROADCAST_ROWS = 2_000_000
#: Tokens called common are at most this many, in at least ``_COMMON_SETS`` sets.
COMMON = 1_000_000
_COMMON_SETS = 10
_RATIO = 1.45
_MORE = 1.3
_SEEN = 1_000_000
#: Parts that a task holds before it sends them.
_HELD = 1_000_000
#: Bits of the map that says which sets are in clusters, at most; a wrong yes costs time only.
MARKS = 28
_CHUNK = 4


def text_sets(texts: pa.Array, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start of each document, sorted distinct tokens, hash of each set)."""
    words = Words(texts)
    doc, token = words.shingles(n)
    order = np.lexsort((token, doc))
    doc, token = doc[order], token[order]
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (token[1:] != token[:-1])
    doc, token = doc[new], token[new]
    start = np.searchsorted(doc, np.arange(words.n_docs + 1))
    value = np.zeros(words.n_docs, np.uint64)
    np.add.at(value, doc, mixed(token + np.uint64(0x51ED)))
    return start, token, mixed(value + np.diff(start).astype(np.uint64)).view(np.int64)


class Parts:
    """How many parts the sets of each size class are dealt into."""

    def __init__(self, num: int, den: int, largest: int):
        lows, highs, low = [], [], 1
        while low <= largest * den // num + 1:
            high = max(low, int(low * _RATIO))
            lows.append(low)
            highs.append(high)
            low = high + 1
        self.lows = np.array(lows)
        differ = (den - num) * 2 * np.array(highs) // (den + num)
        #: Linked sets have ``spare + 1`` equal parts at least.
        self.parts = np.where(differ > 0, np.ceil(_MORE * differ).astype(np.int64) + 2, 0)
        self.spare = np.maximum(self.parts - differ - 1, 0)
        self.num, self.den = num, den

    def of(self, sizes: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.lows, sizes, "right") - 1

    def signatures(self, start: np.ndarray, token: np.ndarray, common: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(document, signature) rows: a pair at the threshold meets in the class of its larger set."""
        sizes = np.diff(start)
        where = np.searchsorted(common, token)
        rare = np.append(common, np.uint64(0))[where] != token if len(common) else np.ones(len(token), bool)
        rare |= where == len(common)
        own = self.of(np.maximum(sizes, 1))
        last = self.of(np.maximum(sizes * self.den // self.num, 1))
        docs, values = [], []
        doc_of = np.repeat(np.arange(len(sizes)), sizes)
        for step in range(int((last - own).max()) + 1 if len(own) else 0):
            level = own + step
            parts = np.where((level <= last) & (sizes > 0), self.parts[np.minimum(level, len(self.parts) - 1)], 0)
            if not parts.sum():
                continue
            base = np.concatenate([[0], np.cumsum(parts)])
            use = parts[doc_of] > 0
            d, t = doc_of[use], token[use]
            at = base[d] + (mixed(t) >> np.uint64(20)).astype(np.int64) % parts[d]
            total, met = np.zeros(base[-1], np.uint64), np.bincount(at, minlength=base[-1])
            np.add.at(total, at, mixed(t ^ np.uint64(0xA5A5)))
            owner = np.repeat(np.arange(len(sizes)), parts)
            place = np.arange(base[-1]) - base[owner]
            salt = mixed((level[owner].astype(np.uint64) << np.uint64(32)) | place.astype(np.uint64))
            strong = np.bincount(at, rare[use], base[-1]) > 0
            spare = self.spare[np.minimum(level, len(self.parts) - 1)]
            weak = np.bincount(owner[~strong], minlength=len(sizes)) > spare
            used = (met > 0) & (strong | weak[owner])
            docs.append(owner[used])
            values.append(mixed(total[used] + salt[used]))
            # All equal parts of two sets can be empty only if each has that many empty parts.
            hollow = np.flatnonzero((np.bincount(owner[met == 0], minlength=len(sizes)) > spare) & (parts > 0))
            docs.append(hollow)
            values.append(mixed(level[hollow].astype(np.uint64) + np.uint64(1 << 50)))
        if not docs:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        return np.concatenate(docs), np.concatenate(values).view(np.int64)


def _sets(rows: DataFrame, n: int) -> DataFrame:
    """id, n_shingles and set hash of each row."""
    kind = rows.schema["id"].dataType.simpleString()

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        for batch in batches:
            for part in text_slices(batch, "text", 2_000_000):
                start, _, h = text_sets(part.column("text"), n)
                yield pa.RecordBatch.from_arrays([part.column("id"), pa.array(np.diff(start)), pa.array(h)],
                                                 names=["id", "n_shingles", "set"])

    return rows.mapInArrow(made, f"id {kind}, n_shingles long, set long")


def _per_set(rows: DataFrame, n: int, schema: str, make, gather=lambda batches: batches) -> DataFrame:
    """Rows that ``make(start, token, hash)`` gives for sets that the task has not met lately; ``gather`` gets a task's batches."""
    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        seen: set[int] = set()
        for batch in batches:
            for part in text_slices(batch, "text", 2_000_000):
                start, token, h = text_sets(part.column("text"), n)
                fresh = []
                for i, value in enumerate(h.tolist()):
                    if start[i + 1] > start[i] and value not in seen:
                        seen.add(value)
                        fresh.append(i)
                if len(seen) > _SEEN:
                    seen.clear()
                fresh = np.array(fresh, np.int64)
                sizes = np.diff(start)[fresh]
                keep = np.zeros(len(h), bool)
                keep[fresh] = True
                token = token[np.repeat(keep, np.diff(start))]
                yield make(np.concatenate([[0], np.cumsum(sizes)]), token, h[fresh])

    return rows.select("text").mapInArrow(lambda batches: gather(made(batches)), schema)


def _once(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(sig, set) rows that connect the same sets: each signature once, and for other sets that have it a link.

    A link of two sets is a signature that only they have.  So a signature has a row per task, however many sets share it.
    """
    def sent():
        sig, h = (np.concatenate(x) for x in zip(*held))
        by = np.argsort(sig)
        new = np.ones(len(sig), bool)
        new[1:] = sig[by[1:]] != sig[by[:-1]]
        lead = np.empty_like(h)
        lead[by] = h[by[new]][np.cumsum(new) - 1]
        away = np.flatnonzero(h != lead)
        link, at = np.unique(mixed(mixed(h[away].view(np.uint64)) + lead[away].view(np.uint64)), return_index=True)
        link, away, first = link.view(np.int64), away[at], np.sort(by[new])  # as they came, those of a set together
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate([sig[first], link, link])),
                                           pa.array(np.concatenate([h[first], h[away], lead[away]]))], names=["sig", "set"])

    held, size = [], 0
    for batch in batches:
        held.append([x.to_numpy() for x in batch.columns])
        size += len(batch)
        if size > _HELD:
            yield sent()
            held, size = [], 0
    if size:
        yield sent()


def _neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links (a, b) of the sets of each signature with one of them, from rows sorted by signature."""
    sig, lead = None, 0
    for batch in batches:
        if not len(batch):
            continue
        sigs, h = (x.to_numpy() for x in batch.columns)
        new = np.ones(len(sigs), bool)
        new[1:] = sigs[1:] != sigs[:-1]
        new[0] = sigs[0] != sig
        first = np.concatenate([[lead], h[new]])[np.cumsum(new)]
        sig, lead = sigs[-1], first[-1]
        away = h != first
        yield pa.RecordBatch.from_arrays([pa.array(h[away]), pa.array(first[away])], names=["a", "b"])


def marks(sets: DataFrame, n: int) -> np.ndarray:
    """Packed bits at the leading bits of the hashes ``set``, of which there are ``n``; made in parts, on the executors."""
    bits = int(np.clip(int(64 * n).bit_length(), 16, MARKS))

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            at = batch.column("set").to_numpy().view(np.uint64) >> np.uint64(64 - bits)
            chunk = (at >> np.uint64(bits - _CHUNK)).astype(np.int64)
            for c in np.unique(chunk).tolist():
                mine = held.setdefault(c, np.zeros(1 << (bits - _CHUNK), bool))
                mine[(at[chunk == c] & np.uint64((1 << (bits - _CHUNK)) - 1)).astype(np.int64)] = True
        for c, mine in held.items():
            yield pa.RecordBatch.from_arrays([pa.array([c]), pa.array([np.packbits(mine).tobytes()])], names=["chunk", "marks"])

    out = np.zeros((1 << _CHUNK, 1 << (bits - _CHUNK - 3)), np.uint8)
    for r in (sets.select("set").repartition(1 << _CHUNK, F.shiftrightunsigned("set", 64 - _CHUNK))
              .mapInArrow(made, "chunk long, marks binary").collect()):
        out[r["chunk"]] = np.frombuffer(r["marks"], np.uint8)
    return out.reshape(-1)


def marked(marks_: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Whether the bit of each hash is set."""
    at = h.view(np.uint64) >> np.uint64(64 - (len(marks_) * 8).bit_length() + 1)
    return marks_[at >> np.uint64(3)] >> (np.uint8(7) - (at & np.uint64(7)).astype(np.uint8)) & np.uint8(1) > 0


def common_tokens(rows: DataFrame, n: int) -> np.ndarray:
    """Tokens that some task met in two sets and that are in many sets over all tasks, the most frequent first
    up to ``COMMON``.  Which tokens these are bears on speed only."""
    def often(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        held, size, seen = [], 0, set()

        def counted():
            names, met = np.unique(np.concatenate(held), return_counts=True)
            return pa.RecordBatch.from_arrays([pa.array(names[met > 1].view(np.int64)), pa.array(met[met > 1])], names=["token", "n"])

        for batch in batches:
            for part in text_slices(batch, "text", 2_000_000):
                start, token, h = text_sets(part.column("text"), n)
                fresh = np.zeros(len(h), bool)
                for i, value in enumerate(h.tolist()):
                    fresh[i] = value not in seen
                    seen.add(value)
                if len(seen) > _SEEN:
                    seen.clear()
                held.append(token[np.repeat(fresh, np.diff(start))])
                size += len(held[-1])
                if size > 4_000_000:
                    yield counted()
                    held, size = [], 0
        if held:
            yield counted()

    found = (rows.select("text").mapInArrow(often, "token long, n long").groupBy("token").agg(F.sum("n").alias("n"))
             .filter(F.col("n") >= _COMMON_SETS).orderBy(F.desc("n"), "token").limit(COMMON))
    return np.sort(found.select("token").toPandas()["token"].to_numpy(np.int64).view(np.uint64))


class Forest:
    """Union-find over small integers."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def root(self, i: int) -> int:
        while self.up[i] != i:
            self.up[i] = i = self.up[self.up[i]]
        return i

    def join(self, i: int, j: int) -> None:
        i, j = self.root(i), self.root(j)
        self.up[max(i, j)] = min(i, j)


def linked(sets: list[np.ndarray], num: int, den: int, side: np.ndarray | None = None) -> Forest:
    """Who hangs together at ``den * intersection >= num * union``.

    ``side`` marks the two blocks of a pair; then only pairs across are looked at.
    """
    m = len(sets)
    sizes = np.array([len(s) for s in sets])
    flat, forest = np.concatenate(sets), Forest(m)
    names, local, met = np.unique(flat, return_inverse=True, return_counts=True)
    shared = np.flatnonzero(met > 1)
    index = np.full(len(names), -1)
    index[shared] = np.arange(len(shared))
    local = index[local]
    cut = np.concatenate([[0], np.cumsum(sizes)])
    order = np.argsort(sizes, kind="stable")
    if side is not None:
        order = order[np.argsort(side[order], kind="stable")]
    groups = [order[i:i + GROUP] for i in range(0, m, GROUP)]

    def matrix(group: np.ndarray) -> np.ndarray:
        x = np.zeros((len(group), len(shared)), np.float32)
        for r, i in enumerate(group):
            mine = local[cut[i]:cut[i + 1]]
            x[r, mine[mine >= 0]] = 1
        return x

    for q, queries in enumerate(groups):
        x = matrix(queries)
        for other in groups[q:]:
            if sizes[queries].max() * den < num * sizes[other].min() or sizes[other].max() * den < num * sizes[queries].min():
                continue
            if side is not None and (side[queries] == side[queries[0]]).all() and (side[other] == side[queries[0]]).all():
                continue
            roots = {forest.root(i) for i in queries.tolist()} | {forest.root(i) for i in other.tolist()}
            if len(roots) == 1:
                continue
            y = x if other is queries else matrix(other)
            bound = x @ (y.max(0) if len(y) else np.zeros(len(shared), np.float32))
            open_ = np.flatnonzero(bound * den >= num * sizes[queries] - 0.5)
            if not len(open_):
                continue
            both = np.rint(x[open_] @ y.T).astype(np.int64)
            union = sizes[queries][open_][:, None] + sizes[other][None, :] - both
            for r, c in zip(*np.nonzero(den * both >= num * union)):
                i, j = int(queries[open_[r]]), int(other[c])
                if i != j:
                    forest.join(i, j)
    return forest


def _links(num: int, den: int):
    def work(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("set").drop_duplicates("set")
        names = part["set"].to_numpy()
        sets = [np.frombuffer(t, np.uint64) for t in part["tokens"]]
        side = part["block"].to_numpy()
        forest = linked(sets, num, den, side if (side != side[0]).any() else None)
        roots = np.array([forest.root(i) for i in range(len(names))])
        away = roots != np.arange(len(names))
        return pd.DataFrame({"a": names[away], "b": names[roots[away]]})
    return work


def near_duplicates(docs: DataFrame, n: int = 3, num: int = 90, den: int = 100, text: str = "text",
                    key: str = "doc_id") -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, set_hash.

    Sets are of distinct runs of ``n`` words, A-Z lower-cased; a shorter text is one run; without
    words the set is empty and linked with nothing (its component is its own id).  Two documents
    link when ``den * intersection >= num * union``; the component is the least id reachable.
    Null texts are empty; null ids take the component of their set, which is null only if all of
    its members' are; repeated rows give repeated rows; an empty table gives an empty result.
    """
    rows = docs.select(F.col(key).alias("id"), F.col(text).alias("text"))
    with shuffles_dropped(docs.sparkSession):
        sets = stage(_sets(rows, n), "sets")
        distinct = stage(sets.filter("n_shingles > 0").groupBy("set").agg(
            F.min("id").alias("least"), F.max("n_shingles").alias("n")), "distinct-sets")
        largest = distinct.agg(F.max("n")).first()[0] or 1
        parts, common = Parts(num, den, largest), docs.sparkSession.sparkContext.broadcast(common_tokens(rows, n))

        def signatures(start, token, h):
            doc, value = parts.signatures(start, token, common.value)
            return pa.RecordBatch.from_arrays([pa.array(value), pa.array(h[doc])], names=["sig", "set"])

        signed = _per_set(rows, n, "sig long, set long", signatures, _once)
        found = components(signed.repartition("sig").sortWithinPartitions("sig").mapInArrow(_neighbours, "a long, b long"))
        members = found.select(F.col("node").alias("set"), F.col("root").alias("cluster")).unionByName(
            found.select(F.col("root").alias("set"), F.col("root").alias("cluster")).distinct())
        members = stage(members.join(distinct.select("set", "n"), "set"), "members")
        blocks = members.groupBy("cluster").agg(F.count("*").alias("m"), F.sum("n").alias("t")).select("cluster", F.when(
            (F.col("m") <= 2 * BLOCK_SETS) & (F.col("t") <= 2 * BLOCK_TOKENS), 1).otherwise(F.greatest(
                F.ceil(F.col("m") / BLOCK_SETS), F.ceil(F.col("t") / BLOCK_TOKENS)) + 1).cast("int").alias("blocks"))
        dealt = stage(members.join(blocks, "cluster").select(
            "set", "cluster", "blocks", F.pmod(F.xxhash64("set"), "blocks").cast("int").alias("block")), "dealt")

        clustered = docs.sparkSession.sparkContext.broadcast(marks(dealt, dealt.count()))

        def tokens(start, token, h):
            mine, sizes = marked(clustered.value, h), np.diff(start)
            token, h = token[np.repeat(mine, sizes)], h[mine]
            start = np.concatenate([[0], np.cumsum(sizes[mine])])
            at = np.concatenate([[0], start[1:] * 8]).astype(np.int64)
            data = pa.Array.from_buffers(pa.large_binary(), len(h), [None, pa.py_buffer(at), pa.py_buffer(token)])
            return pa.RecordBatch.from_arrays([pa.array(h), data.cast(pa.binary())], names=["set", "tokens"])

        held = _sized(_per_set(rows, n, "set long, tokens binary", tokens), dealt, "set")
        pairs = held.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
            "cluster", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"),
            "block", "set", "tokens")
        links = pairs.groupBy("cluster", "low", "high").applyInPandas(_links(num, den), "a long, b long")
        root = components(links).select(F.col("node").alias("set"), "root")
        whole = distinct.join(root, "set", "left").withColumn("root", F.coalesce("root", "set"))
        ids = whole.groupBy("root").agg(F.min("least").alias("component_id"))
        of_set = stage(whole.select("set", "root").join(ids, "root").select("set", "component_id"), "components")
    return sets.join(of_set, "set", "left").select(
        F.col("id").alias("doc_id"), "n_shingles",
        F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("id")).alias("component_id"),
        F.col("set").alias("set_hash"))


def _sized(large: DataFrame, small: DataFrame, on: str) -> DataFrame:
    """Join with a written table, copied to the executors only while it is known to be small."""
    return large.join(F.broadcast(small) if small.count() <= BROADCAST_ROWS else small, on)


def drop_near_duplicates(docs: DataFrame, n: int = 5, num: int = 80, den: int = 100, text: str = "text",
                         key: str = "doc_id") -> DataFrame:
    """The rows of ``docs`` with one row of each component, that of the least id, and all their columns.

    Rows are decided one by one: they are numbered, and named by (id, number).  So of rows that repeat an id, with the same
    text or with others, one stays in each component; a null id comes after all others.  Rows without words all stay.
    Column names cannot clash, as the row travels as one value.
    """
    name = F.struct(F.col(key).isNull().alias("unknown"), F.col(key).alias("id"),
                    F.monotonically_increasing_id().alias("number"))
    rows = stage(docs.select(F.struct("*").alias("row"), name.alias("name")), "numbered")
    found = near_duplicates(rows.select("name", F.col("row").getField(text).alias("text")), n, num, den, "text", "name")
    with shuffles_dropped(docs.sparkSession):
        gone = stage(found.filter("component_id <> doc_id").select(F.col("doc_id.number").alias("number")), "near-copies")
    small = gone.count() <= BROADCAST_ROWS
    left = rows.select("row", F.col("name.number").alias("number"))
    return left.join(F.broadcast(gone) if small else gone, "number", "left_anti").select("row.*")
