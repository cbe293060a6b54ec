"""Filtering stages with column names that clash with helpers, and with ids that repeat."""

import pytest
from pyspark.sql import functions as F

from gridspan.llm import exact_dedup, ngram_join, quality_classifier, toxicity

HELPERS = ["site_host", "site_path", "site_prior", "host_host", "host_prior", "site_prior_of_row", "host", "path", "row", "own",
           "above", "prior", "gone_id", "number", "name", "set", "set_hash", "component_id", "c0", "c1", "keep_rows_0", "x", "y",
           "margin", "rank", "winner_id", "heavy", "a.b"]
WORDS = "one two three four five six seven eight nine ten eleven twelve thirteen".split()


def wide(docs, *rows):
    df = docs(*rows)
    for c in HELPERS:
        df = df.withColumn(c, F.lit(f"keeps {c}"))
    return df


@pytest.mark.parametrize("stage", ["bad", "near", "exact", "toxic"])
def test_names_of_helpers_are_free(docs, labels, stage):
    rows = [(i, " ".join([*WORDS, f"word{i}", *WORDS[i % 5:]]), "en", f"h{i % 3}") for i in range(40)]
    source = wide(docs, *rows, rows[0], (None, None, None, None))
    got = {"bad": lambda: quality_classifier.drop_bad(source, labels("quality", *[(i, int(i % 4 > 0)) for i in range(40)])),
           "near": lambda: ngram_join.drop_near_duplicates(source), "exact": lambda: exact_dedup.drop_exact_copies(source),
           "toxic": lambda: toxicity.drop_toxic(source, labels("toxic", *[(i, int(i % 4 == 0)) for i in range(40)]))}[stage]()
    assert got.columns == source.columns
    kept = got.collect()
    assert kept and all(r[c] == f"keeps {c}" for r in kept for c in HELPERS)


def test_verdicts_fall_on_rows_not_on_ids(docs):
    text = " ".join(WORDS * 3)
    other = "quite another text that shares no run of words with any of those above it at all"
    rows = [(1, text + " end"), (5, text), (5, other), (5, other), (None, text), (7, other + " more of it here now"), (8, ""), (8, "")]
    got = sorted((r["doc_id"], r["text"]) for r in ngram_join.drop_near_duplicates(docs(*rows)).collect())
    assert got == [(1, text + " end"), (5, other), (8, ""), (8, "")] or got == [
        (1, text + " end"), (5, other), (7, other + " more of it here now"), (8, ""), (8, "")]
    assert sum(t == other for _, t in got) == 1


def test_scores_of_rows_equal_the_filter(docs, labels):
    rows = [(i, " ".join(WORDS * (1 + i % 7)) + ("#$% " * (i % 5)), "en" if i % 2 else None, f"h{i % 4}" if i % 9 else None)
            for i in range(60)]
    source, mark = docs(*rows), labels("quality", *[(i, int(i % 5 > 1)) for i in range(60)])
    kept = {r["doc_id"] for r in quality_classifier.classify(source, mark).filter("kept").collect()}
    assert {r["doc_id"] for r in quality_classifier.drop_bad(source, mark).collect()} == kept
