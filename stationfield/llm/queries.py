"""The operators as queries over the given tables, with their SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stationfield.llm import (
    alignment, exact_dedup, exact_search, neighbours, ngram_join, packing, pieces, quality, secret_scan, sharding, substring_dedup,
    url_filter, whitening,
)
from stationfield.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


@query
def op8_exact_dedup(spark: SparkSession, d: str) -> DataFrame:
    return exact_dedup.copies(table(spark, d, "documents"))


ORACLE["op8_exact_dedup"] = r"""
WITH t AS (
  SELECT doc_id, length(coalesce(text, '')) AS n,
         sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', '', 'g')) AS sha
  FROM documents
)
SELECT doc_id,
       first_value(doc_id) OVER (PARTITION BY sha ORDER BY n DESC, doc_id) AS keep_id,
       count(*) OVER (PARTITION BY sha) AS group_size,
       row_number() OVER (PARTITION BY sha ORDER BY n DESC, doc_id) = 1 AS kept,
       sha AS text_sha256
FROM t
"""


@query
def op2_sharding(spark: SparkSession, d: str) -> DataFrame:
    return sharding.assignment(table(spark, d, "documents"))


@query
def op5_secret_scan(spark: SparkSession, d: str) -> DataFrame:
    return secret_scan.digest(table(spark, d, "documents"))


@query
def op7_packing(spark: SparkSession, d: str) -> DataFrame:
    return packing.pack(table(spark, d, "documents"))


@query
def op10_quality(spark: SparkSession, d: str) -> DataFrame:
    return quality.digest(table(spark, d, "documents"), table(spark, d, "labels"))


@query
def op3_url_filter(spark: SparkSession, d: str) -> DataFrame:
    """Pages as captures of one year, the day derived from the id, against entries derived from them."""
    pages = table(spark, d, "pages").select(
        F.col("page_id").alias("id"), "url", F.expr("cast(pmod(page_id * 7919, 365) AS int)").alias("day")
    )
    listed = url_filter.intervals(url_filter.derived_entries(pages))
    return url_filter.as_of(pages, listed).select(
        F.col("id").alias("page_id"), "url", "day", "host", "n_rules", "rule", "blocked"
    )


ORACLE["op3_url_filter"] = r"""
WITH c AS (
  SELECT page_id, url, CAST(((page_id * 7919) % 365 + 365) % 365 AS INT) AS day,
         lower(regexp_extract(coalesce(url, ''), '^[A-Za-z][A-Za-z0-9+.-]*://([^/:?#]+)', 1)) AS host,
         regexp_extract(coalesce(url, ''), '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]+/([^/?#]+)', 1) AS seg
  FROM pages
), l AS (SELECT *, string_split(host, '.') AS labels FROM c WHERE host <> ''),
k AS (
  SELECT DISTINCT page_id, url, day, key FROM (
    SELECT page_id, url, day, 'd:' || array_to_string(labels[i:], '.') AS key
    FROM (SELECT *, unnest(range(1, greatest(len(labels), 2))) AS i FROM l)
    UNION ALL SELECT page_id, url, day, 'p:' || host || '/' || seg FROM l WHERE seg <> '')
), h AS (SELECT key, md5(key) AS m FROM (SELECT DISTINCT key FROM k)),
b AS (
  SELECT key, CAST('0x' || m[1:2] AS INT) AS b0, CAST('0x' || m[3:4] AS INT) AS b1, CAST('0x' || m[5:6] AS INT) AS b2,
         CAST('0x' || m[7:8] AS INT) AS b3, CAST('0x' || m[9:10] AS INT) AS b4, CAST('0x' || m[11:12] AS INT) AS b5
  FROM h
), v AS (
  SELECT key, b1 AS from_day, CASE WHEN b4 % 2 = 0 THEN b1 + 20 + b2 % 60 ELSE 1000000 END AS to_day FROM b WHERE b0 % 4 = 0
  UNION ALL
  SELECT key, b1 + 30 + b2 % 60 + b3 % 60, 1000000 FROM b WHERE b0 % 4 = 0 AND b4 % 2 = 0 AND b5 % 2 = 0
), hit AS (SELECT k.page_id, k.url, k.day, k.key FROM k JOIN v ON k.key = v.key AND k.day >= v.from_day AND k.day < v.to_day),
best AS (
  SELECT page_id, url, day, count(*) AS n_rules, max_by(key, lpad(CAST(length(key) AS VARCHAR), 6, '0') || key) AS rule
  FROM hit GROUP BY ALL
)
SELECT c.page_id, c.url, c.day, c.host, coalesce(n_rules, 0) AS n_rules, rule, n_rules IS NOT NULL AS blocked
FROM c LEFT JOIN best ON c.page_id IS NOT DISTINCT FROM best.page_id AND c.url IS NOT DISTINCT FROM best.url AND c.day IS NOT DISTINCT FROM best.day
"""


@query
def op9_ngram_join(spark: SparkSession, d: str) -> DataFrame:
    return ngram_join.classes(table(spark, d, "documents"))


@query
def op4_substring_dedup(spark: SparkSession, d: str) -> DataFrame:
    return substring_dedup.without_repeats(table(spark, d, "documents"), with_text=False)


@query
def op1_pieces(spark: SparkSession, d: str) -> DataFrame:
    return pieces.round_trip(table(spark, d, "documents"))


@query
def op6_neighbours(spark: SparkSession, d: str) -> DataFrame:
    return neighbours.nearest(table(spark, d, "embeddings"), lambda vec_id: vec_id % 100 == 0)


@query
def op11_alignment(spark: SparkSession, d: str) -> DataFrame:
    return alignment.digest(table(spark, d, "documents"))


@query
def op12_whitening(spark: SparkSession, d: str) -> DataFrame:
    return whitening.whiten(table(spark, d, "embeddings"))


@query
def op13_exact_search(spark: SparkSession, d: str) -> DataFrame:
    return exact_search.nearest(table(spark, d, "embeddings"), lambda vec_id: vec_id % 50 == 0)


ORACLE["op13_exact_search"] = """
WITH e AS (
  SELECT DISTINCT vec_id, [floor(CAST(c AS DOUBLE) * 256.0E0) FOR c IN embedding] AS x FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0 AND len([1 FOR c IN embedding IF c IS NULL OR NOT isfinite(c)]) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.x, c.x) AS BIGINT) AS score
  FROM e q JOIN e c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0
)
SELECT query_id, rank, vec_id, score FROM (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INT) AS rank FROM s
) WHERE rank <= 5
"""
