"""Helpers shared by the corpus operators: tables, stages, and word hashes over Arrow buffers."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Hashable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.lineage import new_path

#: The six white-space characters of the contracts, \x20 and \x09-\x0D.
SPACE_CHARS = " \t\n\x0b\x0c\r"
SPACES = r"[\x20\x09-\x0D]+"


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/documents.parquet")


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back, which cuts the lineage."""
    path = new_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Shuffle files go when the query that wrote them ends, not when the driver next collects garbage.

    All that is read later is staged.
    """
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def packed(docs: DataFrame, **columns: Column) -> DataFrame:
    """The whole row as ``row`` beside named helper columns, so that no name can clash."""
    return docs.select(F.struct("*").alias("row"), *[c.alias(n) for n, c in columns.items()])


def in_fold(key: Column, parts: int, fold: int) -> Column:
    """Whether crc32 of the key as text leaves ``fold``; a missing key counts as not in it."""
    return F.coalesce(F.crc32(key.cast("string")) % parts == fold, F.lit(False))


_kept: dict[Hashable, object] = {}


def release() -> None:
    """Drop what this Python worker keeps for other operators and give free memory back to the system."""
    _kept.clear()
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def kept(name: Hashable, make: Callable[[], object]):
    """``make()``, kept by this Python worker for later tasks under ``name``; what it kept under another name goes."""
    if name not in _kept:
        release()
        _kept[name] = make()
    return _kept[name]


def mixed(h: np.ndarray) -> np.ndarray:
    """Scramble 64-bit values."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


_BASE = np.uint64(0x9E3779B97F4A7C15)
_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[[9, 10, 11, 12, 13, 32]] = True
#: Everything in ASCII that is neither a letter nor a digit.
_IS_MARK = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])
_BYTE = mixed((np.arange(256, dtype=np.uint64) + np.uint64(1)) * _BASE)
_LOWER_BYTE = _BYTE.copy()
_LOWER_BYTE[65:91] = _BYTE[97:123]
_powers = np.ones(1, np.uint64)


def _power_table(n: int) -> np.ndarray:
    global _powers
    if len(_powers) < n:
        size = max(n, 2 * len(_powers), 256)
        _powers = np.concatenate([[np.uint64(1)], np.multiply.accumulate(np.full(size - 1, _BASE))])
    return _powers


def text_slices(batch: pa.RecordBatch, column: str, limit: int = 8_000_000) -> Iterator[pa.RecordBatch]:
    """Slices of the batch with at most ``limit`` bytes of text each; a longer text is alone."""
    sizes = np.asarray(pc.fill_null(pc.binary_length(batch.column(column)), 0), np.int64)
    ends, start, n = np.cumsum(sizes), 0, len(sizes)
    while start < n:
        before = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, before + limit, "right")))
        yield batch.slice(start, stop - start)
        start = stop


def utf8(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The texts' bytes end to end, and each text's start in them; null is empty."""
    texts = pc.fill_null(texts, "").cast(pa.large_string())
    if not len(texts):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = texts.buffers()
    at = np.frombuffer(offsets, np.int64)[texts.offset:texts.offset + len(texts) + 1]
    raw = np.frombuffer(data, np.uint8)[at[0]:at[-1]] if data is not None else np.zeros(0, np.uint8)
    return raw, at - at[0]


class Words:
    """The words of some texts: 64-bit hashes in order, and where they stand.

    Words end at white space; with ``marks`` at every other ASCII mark as well.
    """

    def __init__(self, texts: pa.Array, lower: bool = True, prefix: int = 0, marks: bool = False):
        raw, at = utf8(texts)
        self.bytes, self.at, self.n_docs = raw, at, len(at) - 1
        space = (_IS_MARK if marks else _IS_SPACE)[raw]
        word = ~space
        before = np.concatenate([[True], space[:-1]]) if len(raw) else space.copy()
        edges = at[:-1][at[:-1] < len(raw)]
        before[edges] = True
        self.start = np.flatnonzero(word & before)
        after = np.concatenate([space[1:], [True]]) if len(raw) else space.copy()
        after[edges[edges > 0] - 1] = True
        self.length = np.flatnonzero(word & after) + 1 - self.start
        self.doc = np.searchsorted(at, self.start, "right") - 1
        self.per_doc = np.bincount(self.doc, minlength=self.n_docs)
        self.first = np.concatenate([[0], np.cumsum(self.per_doc)])
        table = _LOWER_BYTE if lower else _BYTE
        self.hash = self._hashes(raw, word, table)
        #: Hashes of the first ``prefix`` bytes of words that are longer than that.
        self.prefix = None
        if prefix:
            long = self.length > prefix
            at_ = self.start[long, None] + np.arange(prefix)
            self.prefix = mixed((table[raw[at_]] * _power_table(prefix)[:prefix]).sum(1, dtype=np.uint64)
                                + np.uint64(1 << 40))
            self.prefix_doc = self.doc[long]

    def _hashes(self, raw, word, table):
        if not len(self.start):
            return np.zeros(0, np.uint64)
        heads = np.cumsum(self.length) - self.length
        inside = np.arange(int(self.length.sum())) - np.repeat(heads, self.length)
        values = table[raw[word]] * _power_table(int(self.length.max()))[inside]
        return mixed(np.add.reduceat(values, heads) + self.length.astype(np.uint64))

    def shingles(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """(document, hash) of every run of ``n`` words; a shorter text gives its whole run."""
        h, total = self.hash, len(self.hash)
        weights = mixed((np.arange(n, dtype=np.uint64) + np.uint64(77)) * _BASE) | np.uint64(1)
        runs = max(0, total - n + 1)
        value = np.zeros(runs, np.uint64)
        for j in range(n):
            value += h[j:j + runs] * weights[j]
        whole = self.doc[:runs] == self.doc[n - 1:n - 1 + runs] if runs else np.zeros(0, bool)
        docs, values = self.doc[:runs][whole], mixed(value[whole] + np.uint64(n))
        few = np.flatnonzero((self.per_doc > 0) & (self.per_doc < n))
        if len(few):
            short = np.array([sum((int(h[self.first[d] + j]) * int(weights[j])
                                   for j in range(self.per_doc[d])), int(self.per_doc[d])) & (2**64 - 1)
                              for d in few], np.uint64)
            docs, values = np.concatenate([docs, few]), np.concatenate([values, mixed(short)])
        return docs, values


def keep_rows(docs: DataFrame, text: str, verdict, *extra: Column) -> DataFrame:
    """The rows of ``docs``, whole, for which ``verdict()(texts, *extra)`` is true.

    ``verdict()`` is called once per task and gives a function of Arrow arrays.  Nothing is shuffled.
    """
    n, at = len(docs.columns), docs.columns.index(text)
    names = [f"keep_rows_{i}" for i in range(n + len(extra))]
    rows = docs.select(*[F.col(f"`{c}`") for c in docs.columns], *extra).toDF(*names)

    def judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        judge = verdict()
        for batch in batches:
            for part in text_slices(batch, names[at], 1_000_000):
                mask = judge(part.column(at), *part.columns[n:])
                yield pa.RecordBatch.from_arrays(part.columns[:n], names=names[:n]).filter(pa.array(mask))

    return rows.mapInArrow(judged, rows.select(*names[:n]).schema).toDF(*docs.columns)
