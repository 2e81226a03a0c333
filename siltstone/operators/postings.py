"""Stored postings: BM25 that reads its terms' buckets and never a text."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import tokens
from ..scale import text_parts
from .ranking import query_terms

BUCKETS = 256
# Files a bucket may be written as, so that a frequent term is no single task.
SPLITS = 8


def _bucket(term: Column | str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(term), F.lit(buckets)).cast("int")


def build_postings(df: DataFrame, path: str, key: str = "doc_id", text: str = "content", buckets: int = BUCKETS) -> None:
    """Write the index of `df` below `path`: postings by term bucket, lengths, and one row of statistics.

    `key` must tell documents apart. A posting carries its document's length, so scoring needs
    no join; inside a bucket terms are sorted, so a file's row groups can be skipped by term.
    """
    words = tokens(F.lower(F.coalesce(F.col(text), F.lit(""))))
    counts_of = [F.col(key).alias("key"), F.size(words).alias("length"), words.alias("_words")]
    counted = df.select(*counts_of)
    # The texts, not their words, are brought together by key; their terms are counted where they then lie.
    parts = max(text_parts(df, text), int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    tf = df.repartition(parts, key).select(*counts_of).select("key", "length", F.explode("_words").alias("term")).groupBy("key", "length", "term").agg(F.count(F.lit(1)).alias("tf"))
    placed = tf.withColumn("bucket", _bucket("term", buckets)).repartition(
        min(buckets * SPLITS, max(buckets, parts)), "bucket", F.pmod(F.xxhash64("key"), F.lit(SPLITS))
    )
    placed.sortWithinPartitions("bucket", "term", "key").write.mode("overwrite").partitionBy("bucket").parquet(f"{path}/postings")
    spark = df.sparkSession
    counted.select("key", "length").write.mode("overwrite").parquet(f"{path}/lengths")
    spark.read.parquet(f"{path}/lengths").agg(
        F.count(F.lit(1)).alias("n"), F.avg("length").alias("avgdl"), F.lit(buckets).alias("buckets")
    ).coalesce(1).write.mode("overwrite").parquet(f"{path}/statistics")


def stored_bm25(spark: SparkSession, path: str, query: str | Sequence[str], k1: float = 1.5, b: float = 0.75) -> DataFrame:
    """(key, score) of the documents that hold a term of the query; the others score 0."""
    terms = query_terms(query)
    if not terms:
        raise ValueError("the query has no words")
    stats = spark.read.parquet(f"{path}/statistics").first()  # one row
    # Bucket numbers of the query's few terms, in Spark's own hash.
    wanted = spark.createDataFrame([(t,) for t in terms], "term string").select(_bucket("term", stats["buckets"]).alias("b"))
    numbers = sorted({r["b"] for r in wanted.collect()})
    postings = spark.read.parquet(f"{path}/postings").where(F.col("bucket").isin(numbers) & F.col("term").isin(terms))
    # One row per term of the query.
    seen = F.broadcast(postings.groupBy("term").agg(F.count(F.lit(1)).cast("double").alias("df")))
    idf = F.ln(F.lit(1.0) + (F.lit(float(stats["n"])) - F.col("df") + F.lit(0.5)) / (F.col("df") + F.lit(0.5)))
    norm = F.lit(k1) * (F.lit(1.0 - b) + F.lit(b) * F.col("length") / F.lit(float(stats["avgdl"] or 1.0)))
    part = idf * F.col("tf") * F.lit(k1 + 1.0) / (F.col("tf") + norm)
    return postings.join(seen, "term").groupBy("key").agg(F.sum(part).alias("score"))


def stored_top_k(spark: SparkSession, path: str, query: str | Sequence[str], k: int = 5, **options) -> DataFrame:
    """(key, score): the `k` most relevant documents; ties go to the smaller key.

    Documents without any of the terms fill up the list, as in `top_k`.
    """
    best = stored_bm25(spark, path, query, **options).orderBy(F.desc(F.round("score", 9)), "key").limit(k)
    lacking = k - best.count()
    if lacking > 0:
        others = spark.read.parquet(f"{path}/lengths").select("key").join(best.select("key"), "key", "left_anti")
        best = best.unionByName(others.orderBy("key").limit(lacking).withColumn("score", F.lit(0.0)))
    return best.orderBy(F.desc(F.round("score", 9)), "key")
