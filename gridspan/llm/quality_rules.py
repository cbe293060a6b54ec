"""Quality rules per document and per host, in DataFrame functions only.

Each document is measured by itself.  For each rule the failures are summed by host, with map-side
combine; a host's failure rate is shrunk by a beta prior that is fitted to all hosts by moments, and a
host whose shrunk rate is over the limit for any rule takes its documents with it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACE_CHARS, SPACES, stage

#: Fixed value of the contract: characters that count as symbols.
SYMBOLS = "#*$%&|<>"
WINDOW = 8
HOST_LIMIT = 0.5


def let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def words(text: Column) -> Column:
    """Words between white space; null has none."""
    bare = F.btrim(F.coalesce(text, F.lit("")), F.lit(SPACE_CHARS))
    return F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, SPACES))


def _covered(windows: Column, size: int) -> Column:
    """Words inside windows whose hash occurs twice or more."""
    rows = F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

    def twice(s):
        return F.filter(s, lambda x, j: F.coalesce(F.get(s, j - 1)["h"] == x["h"], F.lit(False))
                        | F.coalesce(F.get(s, j + 1)["h"] == x["h"], F.lit(False)))

    at = F.sort_array(F.transform(let(rows, twice), lambda x: x["i"]))
    start = F.struct(F.lit(0).cast("long").alias("n"), F.lit(-size).cast("int").alias("p"))
    return F.aggregate(at, start, lambda a, i: F.struct(
        (a["n"] + F.least(F.lit(size), i - a["p"])).cast("long").alias("n"), i.cast("int").alias("p")),
        lambda a: a["n"])


def repeated_words(word_array: Column, size: int = WINDOW) -> Column:
    """How many words stand in a window of ``size`` words that occurs at least twice."""
    def of_hashes(h):
        windows = F.transform(F.sequence(F.lit(1), F.size(h) - (size - 1)),
                              lambda i: F.xxhash64(F.slice(h, i, size)))
        return F.when(F.size(h) < 2, F.lit(0).cast("long")).when(
            F.size(h) < size, F.lit(0).cast("long")).otherwise(let(windows, lambda w: F.when(
                F.size(F.array_distinct(w)) == F.size(w), F.lit(0).cast("long"))
                .otherwise(_covered(w, size))))

    return let(F.transform(word_array, lambda w: F.xxhash64(w)), of_hashes)


def repeated_lines(text: Column) -> Column:
    """Lines with a word that equal an earlier line."""
    lines = F.filter(F.split(F.coalesce(text, F.lit("")), "\n"),
                     lambda x: F.btrim(x, F.lit(SPACE_CHARS)) != "")
    return let(F.transform(lines, lambda x: F.xxhash64(x)),
               lambda h: (F.size(h) - F.size(F.array_distinct(h))).cast("long"))


def measures(docs: DataFrame, text: str = "text", key: str = "doc_id", host: str = "source") -> DataFrame:
    """doc_id, host and the base measures of each whole text."""
    body = F.coalesce(F.col(text), F.lit(""))
    counts = let(words(body), lambda w: F.struct(F.size(w).cast("long").alias("n_words"),
                                                repeated_words(w).alias("n_repeat_words")))
    return docs.select(
        F.col(key).alias("doc_id"), F.col(host).alias("host"), counts.alias("w"),
        F.length(F.translate(body, SPACE_CHARS, "")).cast("long").alias("word_chars"),
        (F.length(body) - F.length(F.translate(body, SYMBOLS, ""))).cast("long").alias("n_symbols"),
        repeated_lines(body).alias("n_dup_lines"),
    ).select("doc_id", "host", "w.n_words", "word_chars", "n_symbols", "n_dup_lines", "w.n_repeat_words")


def base_rules() -> dict[str, Column]:
    n, r = F.col("n_words"), F.col("n_repeat_words")
    return {"short": n < 20, "repeats": 100 * r > 30 * n, "symbols": 10 * F.col("n_symbols") > 5 * n}


def host_rates(measured: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """host, n_docs and per rule the failure rate shrunk to the prior of that rule.

    The prior's mean m is the rate over all documents with a host; its weight s solves
    ``variance between hosts = m (1 - m) / (s + 1)``, with the binomial part taken off the
    observed variance, and is kept in 1 to 1e6.
    """
    hosts = stage(measured.filter(F.col("host").isNotNull()).groupBy("host").agg(
        F.count("*").alias("n_docs"),
        *[F.count(F.when(c, 1)).alias(f"f_{r}") for r, c in rules.items()]), "hosts")
    n = F.col("n_docs")
    means = hosts.agg(F.sum(n).alias("n"), F.count("*").alias("hosts"),
                      *[F.sum(f"f_{r}").alias(f"f_{r}") for r in rules]).first()
    docs = float(means["n"] or 1)
    mean = {r: (means[f"f_{r}"] or 0) / docs for r in rules}
    spread = hosts.agg(*[(F.sum(n * F.pow(F.col(f"f_{r}") / n - mean[r], 2)) / docs).alias(r)
                         for r in rules]).first()
    out = []
    for r in rules:
        m = mean[r]
        between = (spread[r] or 0.0) - m * (1 - m) * means["hosts"] / docs
        s = min(1e6, max(1.0, m * (1 - m) / max(between, 1e-9) - 1.0))
        out.append(((F.col(f"f_{r}") + F.lit(m * s)) / (n + F.lit(s))).alias(f"rate_{r}"))
    return hosts.select("host", "n_docs", *out)


def quality_rules(docs: DataFrame, text: str = "text", key: str = "doc_id", host: str = "source",
                  host_limit: float = HOST_LIMIT) -> DataFrame:
    """doc_id, the measures, base_failed, host_rejected and kept.

    A null text has no words and fails.  A null host is no host: such documents add to no rate
    and stand by their own measures.  Repeated rows are judged and counted one by one.  An empty
    table gives an empty result.
    """
    rules = base_rules()
    measured = stage(measures(docs, text, key, host), "measures")
    rates = host_rates(measured, rules)
    bad = rates.select("host", F.greatest(*[F.col(f"rate_{r}") for r in rules], F.lit(0.0))
                       .alias("worst")).filter(F.col("worst") > host_limit)
    failed = rules["short"] | rules["repeats"]
    return measured.join(bad, "host", "left").select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        failed.alias("base_failed"), F.col("worst").isNotNull().alias("host_rejected"),
        (~failed & F.col("worst").isNull()).alias("kept"))
