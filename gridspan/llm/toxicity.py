"""Toxicity by a second-order factorization machine over hashed terms.

Terms are the words of a text and the first bytes of longer words, hashed to ``2 ** BITS`` places.  The
machine has a weight and a short vector per term; the score of a text is the logistic of the
weights of its distinct terms and of the products of all pairs of their vectors, so that a pair (an
insult with the mention of a group) can weigh more than its parts.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Words, in_fold, keep_rows, mixed, release, stage, text_slices

BITS = 20
PREFIX = 4
SLICE_BYTES = 1_000_000


@dataclass(frozen=True)
class Fit:
    """Parameters of the fit.  ``rows`` bounds the labelled rows that the fit reads.

    Of the terms met in ``least`` of them or more, the ``terms`` that say most about the label
    (by mutual information) are given a weight and a vector.
    """

    rows: int = 20_000
    least: int = 5
    terms: int = 512
    factors: int = 4
    epochs: int = 12
    rate: float = 0.1
    decay: float = 2e-4


def terms(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (document, place) pairs, in order; words end at ASCII marks, so case and stops say nothing."""
    words = Words(texts, prefix=PREFIX, marks=True)
    shift = np.uint64(64 - BITS)
    places = np.concatenate([words.hash >> shift, mixed(words.prefix) >> shift]).astype(np.int64)
    docs = np.concatenate([words.doc, words.prefix_doc]).astype(np.int64)
    pairs = np.unique((docs << BITS) | places)
    return pairs >> BITS, pairs & ((1 << BITS) - 1)


class Machine:
    """Places that count, their weights and their vectors."""

    def __init__(self, places, bias, weight, vectors):
        self.places, self.bias = np.asarray(places, np.int64), float(bias)
        self.weight, self.vectors = np.asarray(weight), np.asarray(vectors)
        self.index = np.full(1 << BITS, -1, np.int32)
        self.index[self.places] = np.arange(len(self.places))

    def margins(self, docs: np.ndarray, places: np.ndarray, n: int) -> np.ndarray:
        at = self.index[places]
        docs, at = docs[at >= 0], at[at >= 0]
        total = self.bias + np.bincount(docs, self.weight[at], n)
        for f in range(self.vectors.shape[1]):
            v = self.vectors[at, f]
            total += 0.5 * (np.bincount(docs, v, n) ** 2 - np.bincount(docs, v * v, n))
        return total

    def scores(self, texts: pa.Array) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.margins(*terms(texts), len(texts)), -40, 40)))


def _information(met: np.ndarray, told: np.ndarray, n: int, positive: float) -> np.ndarray:
    """Mutual information (times n) of having a term and having the label."""
    total = np.zeros(len(met))
    for joint, term, label in ((told, met, positive), (met - told, met, n - positive),
                               (positive - told, n - met, positive),
                               (n - met - positive + told, n - met, n - positive)):
        joint = np.maximum(joint, 0.0)
        with np.errstate(divide="ignore", invalid="ignore"):
            total += np.where(joint > 0, joint * np.log(joint * n / (term * float(label))), 0.0)
    return total


def train(rows: list[np.ndarray], label: np.ndarray, fit: Fit) -> Machine:
    """Logistic loss by adaptive gradient steps over small batches, in a fixed order.

    The places that count are chosen first, see :class:`Fit`.  The bias starts at the label rate and is
    learned too, so a text without any of the places is not as likely toxic as the average one.
    """
    n = len(rows)
    rate = float(np.clip(label.mean() if n else 0.0, 1e-3, 1 - 1e-3))
    flat = np.concatenate(rows) if n else np.zeros(0, np.int64)
    met = np.bincount(flat, minlength=1 << BITS)
    places = np.flatnonzero(met >= fit.least)
    sizes = np.array([len(r) for r in rows], np.int64)
    told = np.bincount(flat, np.repeat(label, sizes), 1 << BITS)[places]
    places = np.sort(places[np.argsort(-_information(met[places], told, n, label.sum()), kind="stable")[:fit.terms]])
    index = np.full(1 << BITS, -1, np.int64)
    index[places] = np.arange(len(places))
    rows = [index[r][index[r] >= 0] for r in rows]
    draw = np.random.default_rng(7)
    bias, weight = np.log(rate / (1 - rate)), np.zeros(len(places))
    vectors = draw.normal(0, 0.01, (len(places), fit.factors))
    seen_b = 1e-6
    seen_w, seen_v = np.full(len(places), 1e-6), np.full((len(places), fit.factors), 1e-6)
    for _ in range(fit.epochs):
        order = draw.permutation(n)
        for lo in range(0, n, 64):
            batch = order[lo:lo + 64]
            sizes = np.array([len(rows[i]) for i in batch])
            at, doc = np.concatenate([rows[i] for i in batch]), np.repeat(np.arange(len(batch)), sizes)
            v = vectors[at]
            sums = np.stack([np.bincount(doc, v[:, f], len(batch)) for f in range(fit.factors)], 1)
            squares = np.bincount(doc, (v * v).sum(1), len(batch))
            margin = bias + np.bincount(doc, weight[at], len(batch)) + 0.5 * ((sums**2).sum(1) - squares)
            wrong = 1 / (1 + np.exp(-np.clip(margin, -40, 40))) - label[batch]
            g = wrong.mean()
            seen_b += g * g
            bias -= 0.3 * fit.rate * g / np.sqrt(seen_b)
            used, where = np.unique(at, return_inverse=True)
            g = np.bincount(where, wrong[doc], len(used)) / len(batch) + fit.decay * weight[used]
            seen_w[used] += g * g
            weight[used] -= fit.rate * g / np.sqrt(seen_w[used])
            for f in range(fit.factors):
                gv = wrong[doc] * (sums[doc, f] - v[:, f])
                gv = np.bincount(where, gv, len(used)) / len(batch) + fit.decay * vectors[used, f]
                seen_v[used, f] += gv * gv
                vectors[used, f] -= 0.3 * fit.rate * gv / np.sqrt(seen_v[used, f])
    return Machine(places, bias, weight, vectors)


def fit_machine(docs: DataFrame, labels: DataFrame, text: str = "text", key: str = "doc_id",
                label: str = "toxic", parts: int = 5, fold: int = 0, fit: Fit = Fit()) -> Machine:
    """Fit on at most ``fit.rows`` labelled documents outside the fold, those of smallest key hash.

    Terms are made where the texts are; one task fits the bounded sample; the driver receives only
    the fitted places.  Rows with a null key or label teach nothing; where a key has several labels, the
    largest holds.  Without any row the score of every text is the smallest allowed rate.
    """
    known = (labels.filter(F.col(key).isNotNull() & F.col(label).isNotNull() & ~in_fold(F.col(key), parts, fold))
             .groupBy(F.col(key).alias("id")).agg(F.max(label).cast("double").alias("label"))
             .orderBy(F.xxhash64("id"), "id").limit(fit.rows))
    sample = F.broadcast(stage(known, "labelled"))
    rows = docs.select(F.col(key).alias("id"), F.col(text).alias("text")).join(sample, "id")

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        for batch in batches:
            for part in text_slices(batch, "text", SLICE_BYTES):
                doc, place = terms(part.column("text"))
                cut = np.searchsorted(doc, np.arange(len(part) + 1))
                yield pa.RecordBatch.from_arrays(
                    [part.column("id"), part.column("label"),
                     pa.ListArray.from_arrays(pa.array(cut, pa.int32()), pa.array(place, pa.int32()))],
                    names=["id", "label", "places"])

    def fitted(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("id").drop_duplicates("id")
        machine = train([np.asarray(p, np.int64) for p in part["places"]], part["label"].to_numpy(), fit)
        return pd.DataFrame({"bias": [machine.bias], "places": [machine.places.astype("<i4").tobytes()],
                             "weight": [machine.weight.astype("<f8").tobytes()],
                             "vectors": [machine.vectors.astype("<f8").tobytes()]})

    kind = docs.schema[key].dataType.simpleString()
    model = (rows.mapInArrow(hashed, f"id {kind}, label double, places array<int>").withColumn("one", F.lit(1)).groupBy("one")
             .applyInPandas(fitted, "bias double, places binary, weight binary, vectors binary")).collect()
    if not model:
        return train([], np.zeros(0), fit)
    m = model[0]
    return Machine(np.frombuffer(m["places"], "<i4"), m["bias"], np.frombuffer(m["weight"], "<f8"),
                   np.frombuffer(m["vectors"], "<f8").reshape(-1, fit.factors))


def score(docs: DataFrame, machine: Machine, *keep, text: str = "text") -> DataFrame:
    """The kept columns with ``score`` for each row."""
    rows = docs.select(*keep, F.col(text).alias("fm_text"))
    names = [n for n in rows.columns if n != "fm_text"]
    schema = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in rows.schema if f.name != "fm_text")
    places, bias, weight, vectors = machine.places, machine.bias, machine.weight, machine.vectors

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        model = Machine(places, bias, weight, vectors)
        for batch in batches:
            for part in text_slices(batch, "fm_text", SLICE_BYTES):
                yield pa.RecordBatch.from_arrays(
                    [part.column(n) for n in names] + [pa.array(model.scores(part.column("fm_text")))],
                    names=names + ["score"])

    return rows.mapInArrow(scored, schema + "score double")


def toxicity(docs: DataFrame, labels: DataFrame, text: str = "text", key: str = "doc_id",
             parts: int = 5, fold: int = 0, fit: Fit = Fit()) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted.

    Empty and null texts have the score of no terms at all.  Repeated rows and null ids are scored
    row by row (a null id is in no fold); other columns are not read; an empty table gives an
    empty result.
    """
    machine = fit_machine(docs, labels, text, key, "toxic", parts, fold, fit)
    held = in_fold(F.col(key), parts, fold)
    return score(docs, machine, F.col(key).alias("doc_id"), held.alias("held_out"), text=text).withColumn(
        "predicted", F.when(F.col("score") >= 0.5, 1).otherwise(0))


def drop_toxic(docs: DataFrame, labels: DataFrame, text: str = "text", key: str = "doc_id",
               fit: Fit = Fit(), limit: float = 0.5) -> DataFrame:
    """The rows of ``docs`` whose score is below ``limit``, with all their columns."""
    machine = fit_machine(docs, labels, text, key, fit=fit)
    places, bias, weight, vectors = machine.places, machine.bias, machine.weight, machine.vectors

    def verdict():
        model = Machine(places, bias, weight, vectors)
        return lambda texts: model.scores(texts) < limit

    return keep_rows(docs, text, verdict)
