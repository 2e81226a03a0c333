"""How the given tables stand in for crawled data, in both engines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.scale import new_path
from siltstone.sources.lake import read_bronze, write_bronze

from .registry import table

# Characters that count as whitespace, written for each dialect.
WS = r"[\t-\r\x1c-\x20\x{85}\p{Z}]"
TOKEN = r"[\p{L}\p{N}_]+"

BRONZE_SQL = """
bronze AS (
  SELECT base || lang || '::' || doc_id AS chunk_id,
         base || lang AS source_url,
         CASE WHEN doc_id % 11 = 0 THEN 'Skip to content ' || text ELSE text END AS content,
         CAST(1704067200 + (doc_id * 977) % 259200 AS DOUBLE) + 0.5 AS ingested_at,
         lang AS language,
         CASE WHEN source = 'src0' THEN 'github_com_' ELSE 'news_example_com_' END || lang AS source,
         doc_id
  FROM (SELECT *, CASE WHEN source = 'src0' THEN 'https://github.com/' ELSE 'https://news.example.com/' END AS base
        FROM documents)
)"""

DEDUPED_SQL = (
    BRONZE_SQL
    + """,
hashed AS (SELECT *, sha256(content) AS content_hash FROM bronze),
deduped AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY source, content_hash ORDER BY ingested_at, chunk_id) AS rn FROM hashed
  ) WHERE rn = 1
),
timed AS (
  SELECT *, make_timestamp(CAST(trunc(ingested_at) AS BIGINT) * 1000000) AS ingested_ts FROM deduped
),
bucketed AS (
  SELECT *, CAST(date_trunc('day', ingested_ts) AS TIMESTAMP) AS ingest_day,
         CAST(date_trunc('hour', ingested_ts) AS TIMESTAMP) AS ingest_hour FROM timed
),
classified AS (
  SELECT *, CASE WHEN contains(content, 'Skip to content') THEN 'listing'
                 WHEN contains(content, 'By ') AND length(content) > 2000 THEN 'article_like'
                 WHEN contains(source, 'github') THEN 'code'
                 WHEN length(content) < 1000 THEN 'short'
                 ELSE 'unknown' END AS content_type FROM bucketed
)"""
)


def bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The bronze table as the documents imply it, with `source` and `doc_id`."""
    d = table(spark, sf_dir, "documents")
    first = F.col("source") == "src0"
    base = F.when(first, F.lit("https://github.com/")).otherwise(F.lit("https://news.example.com/"))
    site = F.when(first, F.lit("github_com_")).otherwise(F.lit("news_example_com_"))
    return d.select(
        F.concat(base, "lang", F.lit("::"), "doc_id").alias("chunk_id"),
        F.concat(base, "lang").alias("source_url"),
        F.when(F.col("doc_id") % 11 == 0, F.concat(F.lit("Skip to content "), "text"))
        .otherwise(F.col("text"))
        .alias("content"),
        (F.lit(1704067200) + (F.col("doc_id") * 977) % 259200 + F.lit(0.5).cast("double")).cast("double").alias("ingested_at"),
        F.col("lang").alias("language"),
        F.concat(site, "lang").alias("source"),
        "doc_id",
    )


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`bronze` in the write schema (required fields made non-null)."""
    b = bronze(spark, sf_dir)
    return b.select(
        *[F.coalesce(c, F.lit("")).alias(c) for c in ("chunk_id", "source_url", "content")],
        F.coalesce("ingested_at", F.lit(0.0)).alias("ingested_at"),
        F.coalesce("language", F.lit("en")).alias("language"),
        F.lit(None).cast("array<float>").alias("embedding"),
    )


def written_lake(spark: SparkSession, sf_dir: str) -> tuple[str, int]:
    """Write the bronze records to a fresh lake; returns its root and the row count."""
    root = new_path(spark, "lake") + "/bronze"
    return root, write_bronze(records(spark, sf_dir), root, layout="url")


def lake(spark: SparkSession, sf_dir: str, **options) -> DataFrame:
    return read_bronze(spark, written_lake(spark, sf_dir)[0], **options)


def text_time(*columns: str):
    """Timestamps as text, so both engines print them alike."""
    return [F.date_format(c, "yyyy-MM-dd HH:mm:ss").alias(c) for c in columns]


def sql_time(*columns: str) -> str:
    return ", ".join(f"strftime({c}, '%Y-%m-%d %H:%M:%S') AS {c}" for c in columns)
