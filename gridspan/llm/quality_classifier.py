"""Quality classifier: document evidence under priors of host and path, by empirical Bayes.

A logistic model of a dozen measures of the text is fitted to all labelled rows by Newton steps whose sums
are made on the cluster.  Its margin, less that of the global rate, is the evidence of the text.  The
prior is the good rate of the document's site: labelled rows are counted by host and by path within
the host; host rates are shrunk to the global rate and path rates to their host's, each with a
weight fitted by moments, so that sparse sites say little.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Words, in_fold, keep_rows, packed, release, stage, text_slices

MEASURES = 12
STEPS = 8
RIDGE = 1.0
_SYMBOL = np.zeros(256, bool)
_SYMBOL[[ord(c) for c in "#*$%&|<>"]] = True


def text_measures(texts: pa.Array) -> np.ndarray:
    """One row of bounded measures per text; the last one is constant."""
    words = Words(texts)
    raw, at, n = words.bytes, words.at, words.n_docs
    size = np.maximum(1, np.diff(at)).astype(float)
    count = np.maximum(1, words.per_doc).astype(float)

    def share(mask: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(mask)])
        return (total[at[1:]] - total[at[:-1]]) / size

    def per_word(mask: np.ndarray) -> np.ndarray:
        return np.bincount(words.doc[mask], minlength=n) / count

    same = np.zeros(len(words.hash), bool)
    if len(same) > 1:
        same[1:] = (words.hash[1:] == words.hash[:-1]) & (words.doc[1:] == words.doc[:-1])
    order = np.lexsort((words.hash, words.doc))
    h, d = words.hash[order], words.doc[order]
    again = np.zeros(len(h), bool)
    if len(h) > 1:
        again[1:] = (h[1:] == h[:-1]) & (d[1:] == d[:-1])
    repeats = np.bincount(d[again], minlength=n) / count
    first = raw[words.start] if len(words.start) else np.zeros(0, np.uint8)
    length = np.bincount(words.doc, words.length, n) / count
    return np.stack([
        np.minimum(1.0, np.log1p(words.per_doc) / 10), (words.per_doc < 20).astype(float),
        np.minimum(1.0, length / 20), share(_SYMBOL[raw]), share((raw >= 65) & (raw <= 90)),
        share(raw == ord("!")), share((raw >= 48) & (raw <= 57)), per_word(same), repeats,
        per_word(first == ord("|")), np.minimum(1.0, share(raw == 10) * 20), np.ones(n)], 1)


def measured(docs: DataFrame, host: Column, path: Column, text: str, key: str) -> DataFrame:
    """id, host, path and the measures of each text."""
    rows = docs.select(F.col(key).alias("id"), host.cast("string").alias("host"),
                       path.cast("string").alias("path"), F.col(text).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        for batch in batches:
            for part in text_slices(batch, "text", 1_000_000):
                x = text_measures(part.column("text"))
                yield pa.RecordBatch.from_arrays(
                    part.columns[:3] + [pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), MEASURES)
                                        .cast(pa.list_(pa.float64()))], names=["id", "host", "path", "x"])

    return rows.mapInArrow(measure, f"id {kind}, host string, path string, x array<double>")


def fit_weights(rows: DataFrame) -> np.ndarray:
    """Logistic weights for ``(x, y)`` rows by damped Newton steps; zeros when there are none."""
    size = MEASURES * MEASURES + MEASURES

    def sums_at(w: np.ndarray):
        def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros(size)
            for batch in batches:
                x = np.asarray(batch.column("x").flatten(), float).reshape(-1, MEASURES)
                y = np.asarray(batch.column("y"), float)
                p = 1 / (1 + np.exp(-np.clip(x @ w, -40, 40)))
                total[:-MEASURES] += (x.T @ (x * (p * (1 - p))[:, None])).ravel()
                total[-MEASURES:] += x.T @ (y - p)
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(size)), pa.array(total)], names=["i", "v"])
        return sums

    w, ridge = np.zeros(MEASURES), RIDGE * np.eye(MEASURES)
    for _ in range(STEPS):
        found = rows.mapInArrow(sums_at(w), "i long, v double").groupBy("i").agg(F.sum("v").alias("v")).collect()
        if not found:
            return w
        total = np.zeros(size)
        for r in found:
            total[r["i"]] = r["v"]
        step = np.linalg.solve(total[:-MEASURES].reshape(MEASURES, MEASURES) + ridge,
                               total[-MEASURES:] - RIDGE * w)
        w = w + np.clip(step, -25, 25)
        if np.abs(step).max() < 1e-6:
            break
    return w


def _weight(mean_product: float, spread: float) -> float:
    return min(1e6, max(1.0, mean_product / max(spread, 1e-9) - 1.0))


def site_rates(known: DataFrame) -> tuple[float, DataFrame, DataFrame]:
    """The global good rate, the rate of each host, and of each (host, path), shrunk.

    The weight of a level solves ``variance between sites = m (1 - m) / (weight + 1)`` with the
    binomial part taken off the observed spread about the level above.
    """
    paths = stage(known.filter(F.col("host").isNotNull()).groupBy("host", "path")
                  .agg(F.count("*").alias("n"), F.sum("y").alias("g")), "sites")
    whole = known.agg(F.count("*").alias("n"), F.sum("y").alias("g")).first()
    m = ((whole["g"] or 0.0) + 1.0) / (whole["n"] + 2.0)
    hosts = paths.groupBy("host").agg(F.sum("n").alias("n"), F.sum("g").alias("g"))

    def fitted(sites: DataFrame, above: Column) -> float:
        n, rate = F.col("n"), F.col("g") / F.col("n")
        r = sites.agg(F.sum(n).alias("n"), F.sum(n * (rate - above) ** 2).alias("s"),
                      F.sum(above * (1 - above)).alias("b"), F.sum(n * above * (1 - above)).alias("p")).first()
        if not r["n"]:
            return 1.0
        return _weight(r["p"] / r["n"], (r["s"] - r["b"]) / r["n"])

    s = fitted(hosts, F.lit(m))
    hosts = stage(hosts.select("host", ((F.col("g") + s * m) / (F.col("n") + s)).alias("host_rate")), "host-rates")
    inside = paths.filter(F.col("path").isNotNull()).join(hosts, "host")
    s = fitted(inside, F.col("host_rate"))
    return m, hosts, inside.select("host", "path", ((F.col("g") + s * F.col("host_rate"))
                                                    / (F.col("n") + s)).alias("path_rate"))


def _logit(p: Column) -> Column:
    q = F.least(F.greatest(p, F.lit(1e-6)), F.lit(1 - 1e-6))
    return F.log(q / (1 - q))


def _learn(docs, labels, host, path, text, key, parts, fold):
    rows = stage(measured(docs, host, path, text, key), "measured")
    known = (labels.filter(F.col(key).isNotNull() & F.col("quality").isNotNull() & ~in_fold(F.col(key), parts, fold))
             .groupBy(F.col(key).alias("id")).agg(F.max("quality").cast("double").alias("y")))
    known = stage(rows.join(known, "id"), "known")
    return rows, fit_weights(known.select("x", "y")), *site_rates(known)


def classify(docs: DataFrame, labels: DataFrame, host: Column | None = None, path: Column | None = None,
             text: str = "text", key: str = "doc_id", parts: int = 5, fold: int = 0) -> DataFrame:
    """One row per document: doc_id, held_out, p_text, p_site, score, kept (score of 0.5 or more).

    ``host`` and ``path`` default to the source and, within it, the language section.  Labels are learned
    from rows outside the fold only; of several labels of a key the largest holds.  A null or empty text is
    measured as such; a null host has the global rate, a null or new path its host's.  Repeated rows
    and null ids are scored row by row; an empty table gives an empty result; without labels all
    evidence is even.
    """
    host, path = F.col("source") if host is None else host, F.col("lang") if path is None else path
    rows, w, m, hosts, paths = _learn(docs, labels, host, path, text, key, parts, fold)
    margin = sum((F.col("x")[i] * float(w[i]) for i in range(MEASURES)), F.lit(0.0))
    site = F.coalesce("path_rate", "host_rate", F.lit(m))
    scored = rows.join(hosts, "host", "left").join(paths, ["host", "path"], "left").select(
        F.col("id").alias("doc_id"), in_fold(F.col("id"), parts, fold).alias("held_out"),
        (1 / (1 + F.exp(-margin))).alias("p_text"), site.alias("p_site"),
        (1 / (1 + F.exp(-(margin + _logit(site) - _logit(F.lit(m)))))).alias("score"))
    return scored.withColumn("kept", F.col("score") >= 0.5)


def drop_bad(docs: DataFrame, labels: DataFrame, host: str = "source", path: str = "lang",
             text: str = "text", key: str = "doc_id", parts: int = 5, fold: int = 0) -> DataFrame:
    """The rows of ``docs`` that :func:`classify` keeps, with all their columns.

    Column names cannot clash, as the row travels as one value.
    """
    _, w, m, hosts, paths = _learn(docs, labels, F.col(host), F.col(path), text, key, parts, fold)
    logit_m = _logit(F.lit(m))
    own = paths.join(hosts, "host", "left").select(
        F.col("host").alias("own_host"), "path", (_logit(F.coalesce("path_rate", "host_rate")) - logit_m).alias("own"))
    above = hosts.select("host", (_logit(F.col("host_rate")) - logit_m).alias("above"))
    rows = packed(docs, host=F.col(host).cast("string"), path=F.col(path).cast("string"))
    rows = (rows.join(own.select(F.col("own_host").alias("host"), "path", "own"), ["host", "path"], "left")
            .join(above, "host", "left"))
    plain = [F.col("row").getField(c).alias(f"c{i}") for i, c in enumerate(docs.columns)]
    whole = rows.select(*plain, F.coalesce("own", "above", F.lit(0.0)).alias("prior"))

    def verdict():
        return lambda texts, site: text_measures(texts) @ w + np.asarray(site, float) >= 0

    at = f"c{docs.columns.index(text)}"
    return keep_rows(whole, at, verdict, F.col("prior")).drop("prior").toDF(*docs.columns)
