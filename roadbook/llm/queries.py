"""The registered queries of the operators: each whole intended table, the contract's columns."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadbook.llm import (
    cap_filters, html_text, lexical_search, mixing, pseudo_likelihood, sentencepiece_codec, simhash, token_counts, toxicity,
    training_order, url_filters, vector_codes, voronoi_topk,
)
from roadbook.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}
PIECES = public_tokenizers.path("piece_bpe_32k.model")


def query(build: Query) -> Query:
    QUERIES[build.__name__] = build
    return build


@query
def op1_sentencepiece(spark, sf_dir):
    coded = sentencepiece_codec.encode_decode(table(spark, sf_dir, "documents"), sentencepiece_codec.read_model(PIECES))
    return piece_digests(coded)


def piece_digests(coded: DataFrame, *more: str) -> DataFrame:
    return coded.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"), *more)


@query
def op2_cap_filters(spark, sf_dir):
    found = cap_filters.near_vectors(table(spark, sf_dir, "embeddings"))
    return found.withColumn("kept", F.col("vec_id") == F.col("component_id"))


@query
def op3_simhash(spark, sf_dir):
    named = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return named.select("doc_id", simhash.as_hex().alias("fingerprint"), "component_id")


@query
def op4_pseudo_likelihood(spark, sf_dir):
    return pseudo_likelihood.score_corpus(table(spark, sf_dir, "documents"))


@query
def op5_token_counts(spark, sf_dir):
    vocabulary = token_counts.word_pieces(sentencepiece_codec.read_model(PIECES))
    return token_counts.token_counts(table(spark, sf_dir, "documents"), *vocabulary)


@query
def op6_voronoi_topk(spark, sf_dir):
    return voronoi_topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


ORACLE_SQL["op6_voronoi_topk"] = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::double)::bigint) AS x FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id,
    list_sum(list_transform(generate_series(1, len(q.x)), lambda i: q.x[i] * c.x[i]))::bigint AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id AND len(q.x) = len(c.x)),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::int AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5"""


@query
def op7_mixing(spark, sf_dir):
    placed = mixing.queue(table(spark, sf_dir, "documents"))
    return placed.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("turns")).alias("taken"))


ORACLE_SQL["op7_mixing"] = mixing.sql()


@query
def op8_training_order(spark, sf_dir):
    model = sentencepiece_codec.read_model(PIECES)
    return training_order.through_shards(table(spark, sf_dir, "documents"), model).withColumnRenamed("id", "doc_id")


@query
def op9_toxicity(spark, sf_dir):
    documents = table(spark, sf_dir, "documents")
    chain, _ = toxicity.train(documents, table(spark, sf_dir, "labels"), toxicity.categories())
    return toxicity.score(documents, chain).withColumnRenamed("is_toxic", "toxic")


@query
def op10_html_text(spark, sf_dir):
    found = html_text.main_text(table(spark, sf_dir, "pages"))
    return found.select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))


@query
def op11_lexical_search(spark, sf_dir):
    index = lexical_search.build_index(table(spark, sf_dir, "documents"))
    return lexical_search.search(index, table(spark, sf_dir, "benchmark")).withColumnRenamed("query_id", "item_id")


_TERMS = r"""regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                       '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"""

ORACLE_SQL["op11_lexical_search"] = f"""
WITH d AS (SELECT doc_id, unnest({_TERMS}) AS term FROM documents),
q AS (SELECT item_id, term, count(*) AS times FROM (SELECT item_id, unnest({_TERMS}) AS term FROM benchmark) GROUP BY ALL),
p AS (SELECT doc_id, term, count(*) AS tf FROM d GROUP BY ALL),
n AS (SELECT doc_id, sum(tf)::bigint AS n FROM p GROUP BY ALL),
s AS (SELECT count(*)::bigint AS docs, sum(n)::bigint AS terms FROM n),
m AS (SELECT doc_id, 25 + (75 * n * docs) // terms AS m FROM n, s),
w AS (SELECT term, floor(1000 * ln((2 * docs + 2) / (2 * count(*) + 1)::double))::bigint AS w FROM p, s GROUP BY term, docs),
r AS (SELECT item_id, doc_id, sum(times * w * ((1000000000 * tf) // (1000 * tf + 8 * m)))::bigint AS score
      FROM q JOIN w USING (term) JOIN p USING (term) JOIN m USING (doc_id) GROUP BY ALL)
SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::int AS rank, doc_id, score
FROM r WHERE score > 0 QUALIFY row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) <= 10"""


@query
def op12_vector_codes(spark, sf_dir):
    coded, books = vector_codes.encode(table(spark, sf_dir, "embeddings"), keep=("label",))
    return vector_codes.with_group_error(coded, "label", "label_error").select(
        "vec_id", F.lower(F.hex("code")).alias("code"), "error", "label_error",
        F.lit(vector_codes.digest(books)).alias("codebooks_sha256"))


def _codes_sql() -> str:
    """Every part against every entry; for vectors of 64 components, as the tables hold them."""
    nearest = lambda books: f"""(SELECT vec_id, label, p, any_value(x) AS x, min(64 * (
        (x[1] - y[1]) ** 2 + (x[2] - y[2]) ** 2 + (x[3] - y[3]) ** 2 + (x[4] - y[4]) ** 2)::bigint + entry) AS best
        FROM parts JOIN {books} USING (p) GROUP BY vec_id, label, p)"""  # noqa: E731
    means = ", ".join(f"floor(sum(x[{i}])::double / count(*))::bigint" for i in range(1, 5))
    moved = lambda books: f"""(SELECT b.p, b.entry, coalesce(a.y, b.y) AS y FROM {books} b LEFT JOIN (
        SELECT p, best % 64 AS entry, [{means}] AS y FROM {nearest(books)} GROUP BY ALL) a ON a.p = b.p AND a.entry = b.entry)"""  # noqa: E731
    return f"""
WITH v AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: floor(256 * x::double)::bigint) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
parts AS MATERIALIZED (SELECT vec_id, label, p::int AS p, v[4 * p + 1:4 * p + 4] AS x FROM v, range(16) t(p)),
b0 AS MATERIALIZED (
  SELECT p, entry, x AS y FROM (SELECT *, row_number() OVER (PARTITION BY p ORDER BY vec_id) - 1 AS entry FROM parts) WHERE entry < 64),
b1 AS MATERIALIZED {moved("b0")},
b2 AS MATERIALIZED {moved("b1")},
c AS (
  SELECT vec_id, label, string_agg(printf('%02x', best % 64), '' ORDER BY p) AS code, sum(best // 64)::bigint AS error
  FROM {nearest("b2")} GROUP BY vec_id, label)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::bigint AS label_error,
  (SELECT sha256(string_agg(y[i]::varchar, ',' ORDER BY p, entry, i)) FROM b2, range(1, 5) t(i)) AS codebooks_sha256
FROM c"""


ORACLE_SQL["op12_vector_codes"] = _codes_sql()

# The rules that the query judges by.
URL_RULES = (
    url_filters.Rule("block", "net"),
    url_filters.Rule("allow", "example.net", "/en/"),
    url_filters.Rule("block", "example.com", "/de/"),
    url_filters.Rule("allow", "org", "/fr/"),
)


@query
def op13_url_filters(spark, sf_dir):
    return url_filters.judge(table(spark, sf_dir, "pages"), URL_RULES)


# Canonical links as templates write them, whole urls in double quotes; the tests hold the rest against a plain version.
ORACLE_SQL["op13_url_filters"] = r"""
WITH RECURSIVE rules(host, path, verdict) AS (
  VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')),
split AS (
  SELECT page_id, html, regexp_replace(url, '#.*', '') AS node,
    CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) END AS rest FROM pages),
u AS (
  SELECT page_id, node, html,
    coalesce(translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
    coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path FROM split),
links AS (
  SELECT node AS a, regexp_extract(html, '<link rel="canonical" href="([^"#]*://[^"#]*)', 1) AS b FROM u WHERE html LIKE '%rel="canonical"%'),
edges AS (SELECT a, b FROM links WHERE b <> '' AND a <> b UNION SELECT b, a FROM links WHERE b <> '' AND a <> b),
named AS (
  SELECT node, host, path FROM u
  UNION SELECT b, regexp_extract(b, '://([^/?#]*)', 1), regexp_extract(b, '://[^/?#]*([^?#]*)', 1) FROM edges),
fit AS (
  SELECT DISTINCT n.host, n.path, arg_max(r.host || r.path, length(r.host || r.path)) AS rule, arg_max(verdict, length(r.host || r.path)) AS verdict
  FROM (SELECT DISTINCT host, path FROM named) n JOIN rules r
    ON (n.host = r.host OR n.host LIKE '%.' || r.host) AND starts_with(n.path, r.path) GROUP BY n.host, n.path),
reached(node) AS (
  SELECT DISTINCT node FROM named JOIN fit USING (host, path) WHERE verdict = 'block'
  UNION SELECT b FROM reached JOIN edges ON node = a)
SELECT page_id, u.host, u.path, rule, coalesce(verdict, CASE WHEN u.node IN (SELECT node FROM reached) THEN 'block' ELSE 'allow' END) AS verdict
FROM u LEFT JOIN fit ON u.host = fit.host AND u.path = fit.path"""
