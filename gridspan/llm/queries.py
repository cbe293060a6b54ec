"""The corpus operators as queries over the test tables, with SQL twins where SQL has the words."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from . import (exact_dedup, hilbert_clusters, katz, language_id, ngram_join, packing, piece_lattice, prefix_trie,
               projection_dedup, quality_classifier, quality_rules, token_counts, toxicity)
from .common import documents

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def tokenizer_file(name: str) -> str:
    """A public vocabulary file; the same place on every machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


def _query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql:
            ORACLES[name] = sql
        return fn
    return register


_SHA = r"""
WITH d AS (SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS h
           FROM documents)
SELECT doc_id, min(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       doc_id = min(doc_id) OVER g AS kept, h AS text_sha256
FROM d WINDOW g AS (PARTITION BY h)"""


@_query("op1_exact_dedup", _SHA)
def op1(spark: SparkSession, folder: str) -> DataFrame:
    return exact_dedup.exact_duplicates(documents(spark, folder))


_RULES = r"""
WITH base AS (SELECT row_number() OVER () AS r, doc_id, source, coalesce(text, '') AS t FROM documents),
words AS (SELECT r, list_filter(regexp_split_to_array(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM base),
spot AS (SELECT r, len(w) AS n, w, unnest(range(1, len(w) - 6)) AS p FROM words WHERE len(w) >= 8),
win AS (SELECT r, p, n, count(*) OVER (PARTITION BY r, array_to_string(w[p:p + 7], ' ')) AS c FROM spot),
hit AS (SELECT DISTINCT r, p + k AS q FROM win, range(0, 8) AS s(k) WHERE c > 1),
rep AS (SELECT r, count(*) AS n_repeat_words FROM hit GROUP BY r),
line AS (SELECT r, unnest(string_split(t, chr(10))) AS x FROM base),
dup AS (SELECT r, count(*) - count(DISTINCT x) AS n_dup_lines FROM line
        WHERE regexp_matches(x, '[^\x20\x09-\x0D]') GROUP BY r),
m AS (SELECT doc_id, source, len(w)::BIGINT AS n_words,
             length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g'))::BIGINT AS word_chars,
             (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
             coalesce(n_dup_lines, 0)::BIGINT AS n_dup_lines,
             coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words
      FROM base JOIN words USING (r) LEFT JOIN rep USING (r) LEFT JOIN dup USING (r)),
f AS (SELECT *, n_words < 20 AS f1, 100 * n_repeat_words > 30 * n_words AS f2,
             10 * n_symbols > 5 * n_words AS f3 FROM m),
host AS (SELECT source, rule, count(*) AS n, count(*) FILTER (failed) AS k
         FROM (SELECT source, unnest([1, 2, 3]) AS rule, unnest([f1, f2, f3]) AS failed FROM f
               WHERE source IS NOT NULL) GROUP BY ALL),
mean AS (SELECT rule, sum(k) / sum(n) AS m, sum(n) AS total, count(*) AS hosts FROM host GROUP BY rule),
prior AS (SELECT rule, any_value(m) AS m,
                 sum(n * (k / n - m) ** 2) / any_value(total)
                   - any_value(m * (1 - m) * hosts / total) AS v
          FROM host JOIN mean USING (rule) GROUP BY rule),
weight AS (SELECT rule, m, least(1e6, greatest(1.0, m * (1 - m) / greatest(v, 1e-9) - 1)) AS s FROM prior),
bad AS (SELECT DISTINCT source FROM host JOIN weight USING (rule) WHERE (k + m * s) / (n + s) > 0.5)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, f1 OR f2 AS base_failed,
       bad.source IS NOT NULL AS host_rejected, NOT (f1 OR f2) AND bad.source IS NULL AS kept
FROM f LEFT JOIN bad USING (source)"""


@_query("op7_quality_rules", _RULES)
def op7(spark: SparkSession, folder: str) -> DataFrame:
    return quality_rules.quality_rules(documents(spark, folder))


@_query("op3_best_fit_packing")
def op3(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack_documents(documents(spark, folder), tokenizer_file("word_bpe_49k.json"))


@_query("op4_token_counts")
def op4(spark: SparkSession, folder: str) -> DataFrame:
    return token_counts.token_counts(documents(spark, folder), tokenizer_file("byte_bpe_50k.json"))


@_query("op6_language_id")
def op6(spark: SparkSession, folder: str) -> DataFrame:
    return language_id.language_id(documents(spark, folder))


def labels(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/labels.parquet")


@_query("op9_toxicity")
def op9(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.toxicity(documents(spark, folder), labels(spark, folder))


@_query("op10_quality_classifier")
def op10(spark: SparkSession, folder: str) -> DataFrame:
    return quality_classifier.classify(documents(spark, folder), labels(spark, folder))


@_query("op2_ngram_jaccard_join")
def op2(spark: SparkSession, folder: str) -> DataFrame:
    return ngram_join.near_duplicates(documents(spark, folder))


@_query("op8_katz_scores")
def op8(spark: SparkSession, folder: str) -> DataFrame:
    return katz.katz_scores(documents(spark, folder), order=3)


@_query("op5_piece_lattice")
def op5(spark: SparkSession, folder: str) -> DataFrame:
    return piece_lattice.encode_pieces(documents(spark, folder), tokenizer_file("piece_bpe_32k.model"))


def _lloyd(rounds: int = 10) -> str:
    """The rounds of op11 one after the other, each an assignment and the floored means of its clusters."""
    parts = [r"""e AS MATERIALIZED (SELECT vec_id, list_transform(embedding, lambda v: floor(1024 * v::DOUBLE)::BIGINT) AS x
      FROM embeddings WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda v: isfinite(v::DOUBLE))) = 64),
c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY h, x) - 1 AS j, x AS c FROM (
      SELECT x, sha256('3:' || vec_id) AS h FROM e ORDER BY h, x LIMIT 8))"""]
    for r in range(rounds + 1):
        parts.append(f"""a{r} AS MATERIALIZED (SELECT vec_id, x, d[1] AS distance, d[2] AS j FROM (
      SELECT vec_id, x, min([list_sum(list_transform(list_zip(x, c), lambda p: (p[1] - p[2]) * (p[1] - p[2])))::BIGINT, j])
             AS d FROM e, c{r} GROUP BY vec_id, x))""")
        if r < rounds:
            parts.append(f"""c{r + 1} AS MATERIALIZED (SELECT c{r}.j, coalesce(m.c, c{r}.c) AS c FROM c{r} LEFT JOIN (
      SELECT j, list(s ORDER BY i) AS c FROM (SELECT j, i, floor(sum(x[i])::DOUBLE / count(*))::BIGINT AS s
      FROM a{r}, range(1, 65) AS t(i) GROUP BY j, i) GROUP BY j) AS m USING (j))""")
    return "WITH " + ",\n".join(parts) + f"""
SELECT vec_id, j::INTEGER AS cluster, distance, (sum(distance) OVER (PARTITION BY j))::BIGINT AS cluster_inertia,
       (sum(distance) OVER ())::BIGINT AS inertia, sha256(array_to_string(c, ',')) AS centroid_sha256
FROM a{rounds} JOIN c{rounds} USING (j)"""


def embeddings(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/embeddings.parquet")


@_query("op11_centroid_clusters", _lloyd())
def op11(spark: SparkSession, folder: str) -> DataFrame:
    return hilbert_clusters.centroid_clusters(embeddings(spark, folder))


_TRIE = r"""
WITH t AS (SELECT conv_id AS c, sha256(length(r) || ':' || r || ':' || x) AS g, length(x) AS n,
                  row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST,
                                     sha256(length(r) || ':' || r || ':' || x)) AS k
           FROM (SELECT conv_id, turn, coalesce(role, '') AS r, coalesce(text, '') AS x FROM conversations
                 WHERE conv_id IS NOT NULL)),
sizes AS (SELECT g, any_value(n) AS n FROM t GROUP BY g),
own AS (SELECT c, list(g ORDER BY k) AS gs FROM t GROUP BY c),
-- crc32 of the id's digits, a bit at a time: numbers of at least 0 are bytes, the eight -1 after each are its bits
crc AS (SELECT *, xor(list_reduce(list_concat([4294967295::BIGINT], flatten(list_transform(
            string_split(c::VARCHAR, ''), lambda d: [ord(d)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))),
            lambda a, b: CASE WHEN b >= 0 THEN xor(a, b) ELSE xor(a >> 1, (a & 1) * 3988292384) END),
            4294967295) % 6 AS h FROM own),
built AS (SELECT crc.c, list_concat(coalesce(list_slice(head.gs, 1, h), []), list_slice(crc.gs, h + 1, len(crc.gs))) AS p
          FROM crc LEFT JOIN own AS head ON head.c = crc.c - crc.c % 100),
step AS (SELECT c, len(p) AS l, d, list_slice(p, 1, d) AS q FROM (SELECT c, p, unnest(range(0, len(p) + 1)) AS d FROM built)),
node AS (SELECT array_to_string(q, ',') AS q, any_value(d) AS d, array_to_string(list_slice(any_value(q), 1, any_value(d) - 1), ',') AS up,
                any_value(q)[-1] AS g, min(c) AS c, count(*) AS n,
                sha256(coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (l = d), '')) AS ends
         FROM step GROUP BY step.q),
kids AS (SELECT up AS q, count(*) AS k FROM node WHERE d > 0 GROUP BY up),
full_ AS (SELECT node.*, coalesce(k, 0) AS k, (node.n - 1) * coalesce(sizes.n, 0) AS save
          FROM node LEFT JOIN kids USING (q) LEFT JOIN sizes USING (g)),
sub AS (SELECT a.q, count(*) FILTER (b.k = 0) AS leaves, sum(b.save) AS saved
        FROM full_ a JOIN full_ b ON b.d >= a.d AND starts_with(b.q, a.q) GROUP BY a.q)
SELECT f.c AS conv_id, f.d AS depth, up.c AS parent_conv_id, f.n AS n_convs, f.k AS n_children, leaves AS n_leaves,
       saved::BIGINT AS saved_tokens, f.ends AS ends_sha256
FROM full_ f JOIN sub USING (q) LEFT JOIN node up ON f.d > 0 AND up.q = f.up"""


@_query("op12_prefix_trie", _TRIE)
def op12(spark: SparkSession, folder: str) -> DataFrame:
    return prefix_trie.prefix_trie(spark.read.parquet(f"{folder}/conversations.parquet")).drop("last_digest")


_NEAR_VECTORS = """
WITH RECURSIVE v AS (SELECT vec_id, label, list_transform(embedding, lambda x: x::DOUBLE) AS e FROM embeddings),
ok AS (SELECT * FROM v WHERE label IS NOT NULL AND len(e) > 0
       AND len(list_filter(e, lambda x: isfinite(x))) = len(e) AND len(list_filter(e, lambda x: x <> 0)) > 0),
link AS MATERIALIZED (SELECT a.vec_id AS a, b.vec_id AS b FROM ok a JOIN ok b ON a.label = b.label AND len(a.e) = len(b.e)
         AND a.vec_id <> b.vec_id WHERE list_cosine_similarity(a.e, b.e) >= 0.93),
reach(a, b) AS (SELECT a, b FROM link UNION SELECT reach.a, link.b FROM reach JOIN link ON reach.b = link.a),
root AS (SELECT a, min(b) AS r FROM reach GROUP BY a), n AS (SELECT a, count(*) AS n FROM link GROUP BY a)
SELECT vec_id, coalesce(n, 0) AS n_links, least(vec_id, coalesce(r, vec_id)) AS component_id,
       vec_id <= coalesce(r, vec_id) AS kept
FROM v LEFT JOIN root ON root.a = vec_id LEFT JOIN n ON n.a = vec_id"""


@_query("op13_projection_dedup", _NEAR_VECTORS)
def op13(spark: SparkSession, folder: str) -> DataFrame:
    return projection_dedup.near_vectors(embeddings(spark, folder))
