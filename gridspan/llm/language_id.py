"""Language identification by rank-order profiles of character n-grams.

A language's profile is the ranking of its most frequent n-grams (one to three letters, blanks mark
word edges) over all its training texts.  A text is ranked in the same way, and the language with the
least out-of-place distance wins.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import in_fold, text_slices

PROFILE = 300
UNKNOWN = "und"
_letters: np.ndarray | None = None


def _is_letter() -> np.ndarray:
    global _letters
    if _letters is None:
        _letters = np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)
    return _letters


def code_points(text: str) -> np.ndarray:
    """Lower-cased letters of the text; each run of other characters, and each end, is one 0."""
    raw = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    c = np.zeros(len(raw) + 2, np.int64)
    c[1:-1] = np.where(_is_letter()[raw], raw, 0)
    keep = np.ones(len(c), bool)
    keep[1:] = (c[1:] != 0) | (c[:-1] != 0)
    return c[keep]


def grams(c: np.ndarray) -> np.ndarray:
    """Codes of all n-grams of up to three characters with at least one letter and no inner blank.

    A character takes 21 bits, the last one lowest, so codes of different lengths differ except that
    a leading blank would vanish; bit 62 marks pairs and bit 61 triples.
    """
    one = c[c > 0]
    a, b = c[:-1], c[1:]
    pair = ((a << 21) | b | (1 << 62))[(a > 0) | (b > 0)]
    x, y, z = c[:-2], c[1:-1], c[2:]
    triple = (((x & 0x7FFFF) << 42) | (y << 21) | z | (1 << 61))[y > 0]
    return np.concatenate([one, pair, triple])


def top(codes: np.ndarray, counts: np.ndarray, k: int) -> np.ndarray:
    """The ``k`` most frequent codes; ties by code."""
    return codes[np.lexsort((codes, -counts))[:k]]


class Profiles:
    def __init__(self, ranked: dict[str, list[int]], size: int):
        self.size, self.languages = size, sorted(ranked)
        codes = np.unique(np.concatenate([np.array(ranked[g], np.int64) for g in self.languages])
                          if self.languages else np.zeros(0, np.int64))
        self.codes = codes
        self.rank = np.full((len(self.languages), len(codes) + 1), -1, np.int64)
        for i, g in enumerate(self.languages):
            self.rank[i, np.searchsorted(codes, np.array(ranked[g], np.int64))] = np.arange(len(ranked[g]))

    def predict(self, text: str | None) -> tuple[str, float]:
        """Language and score: 1 less the distance as a share of the largest possible one."""
        c = code_points(text or "")
        if not (c > 0).any() or not self.languages:
            return UNKNOWN, 0.0
        mine = top(*np.unique(grams(c), return_counts=True), self.size)
        at = np.searchsorted(self.codes, mine)
        at[at == len(self.codes)] = 0
        at = np.where(self.codes[at] == mine, at, len(self.codes))
        theirs = self.rank[:, at]
        away = np.where(theirs < 0, self.size, np.abs(theirs - np.arange(len(mine))))
        distance = away.sum(1)
        best = int(np.argmin(distance))
        return self.languages[best], float(1 - distance[best] / (self.size * len(mine)))


def learn(docs: DataFrame, text: str, language: str, size: int = PROFILE) -> Profiles:
    """Profiles from all rows of ``docs`` with a text and a language.

    Counts are added up per slice of texts first, then by (language, n-gram) on the cluster.  The
    driver receives ``size`` codes per language.
    """
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch, "text"):
                by: dict[str, list[np.ndarray]] = {}
                for t, g in zip(part.column("text").to_pylist(), part.column("language").to_pylist()):
                    by.setdefault(g, []).append(np.unique(grams(code_points(t)), return_counts=True))
                for g, found in by.items():
                    codes, inverse = np.unique(np.concatenate([f[0] for f in found]), return_inverse=True)
                    total = np.bincount(inverse, np.concatenate([f[1] for f in found]), len(codes))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([g] * len(codes), pa.string()), pa.array(codes),
                         pa.array(total.astype(np.int64))], names=["language", "code", "n"])

    rows = docs.select(F.col(text).alias("text"), F.col(language).cast("string").alias("language")).dropna()
    counts = (rows.mapInArrow(count, "language string, code long, n long")
              .groupBy("language", "code").agg(F.sum("n").alias("n")))
    order = Window.partitionBy("language").orderBy(F.desc("n"), "code")
    best = counts.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= size)
    ranked: dict[str, list[int]] = {}
    for row in sorted(best.select("language", "rank", "code").collect()):
        ranked.setdefault(row["language"], []).append(row["code"])
    return Profiles(ranked, size)


def identify(docs: DataFrame, profiles: Profiles, *keep: Column, text: str = "text") -> DataFrame:
    """The kept columns with lang_pred and score for each row."""
    rows = docs.select(*keep, F.col(text).alias("lid_text"))
    names = [n for n in rows.columns if n != "lid_text"]
    schema = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in rows.schema if f.name != "lid_text")

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch, "lid_text"):
                found = [profiles.predict(t) for t in part.column("lid_text").to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column(n) for n in names] + [pa.array([f[0] for f in found], pa.string()),
                                                       pa.array([f[1] for f in found], pa.float64())],
                    names=names + ["lang_pred", "score"])

    return rows.mapInArrow(predict, schema + "lang_pred string, score double")


def language_id(docs: DataFrame, text: str = "text", language: str = "lang", key: str = "doc_id",
                parts: int = 3, fold: int = 1, size: int = PROFILE) -> DataFrame:
    """One row per document: doc_id, held_out, lang_pred, score.

    Learns from rows outside the fold with a text and a language; a null id is outside the fold.
    A null text, or one without a letter, gives ``und`` and 0.  When nothing can be learned all rows
    give that.  Ties between languages go to the first by name.  Repeated rows count each
    time; other columns are not read; an empty table gives an empty result.
    """
    held = in_fold(F.col(key), parts, fold)
    profiles = learn(docs.filter(~held), text, language, size)
    return identify(docs, profiles, F.col(key).alias("doc_id"), held.alias("held_out"), text=text)


