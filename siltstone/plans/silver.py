"""Bronze to silver (A12, A34-A39, A50, A51): one function per layer."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

# (label, condition), first match wins; "unknown" otherwise.  Matching is case-sensitive.
Rule = tuple[str, Column]


def content_rules(variant: str = "v2") -> list[Rule]:
    """The built-in content types; "v1" is the older list, without code."""
    content, size = F.col("content"), F.length("content")
    listing = ("listing", F.contains(content, F.lit("Skip to content")))
    article = ("article_like", F.contains(content, F.lit("By ")) & (size > 2000))
    code = ("code", F.contains(F.col("source"), F.lit("github")))
    short = ("short", size < 1000)
    if variant == "v1":
        return [listing, article, short]
    if variant == "v2":
        return [listing, article, code, short]
    raise ValueError("variant must be 'v1' or 'v2'")


def hashed(df: DataFrame) -> DataFrame:
    return df.withColumn("content_hash", F.sha2("content", 256))


def deduped(df: DataFrame, placed_by: Sequence[str] = ()) -> DataFrame:
    """The earliest record per (source, content_hash); ties go to the smaller chunk id.

    `row_number = 1` lets Spark drop later copies in every map task before the
    shuffle, so boilerplate that fills a third of the lake still reaches one
    reducer only once per task. `placed_by` are functions of source and content_hash by which
    `df` was repartitioned: then nothing is shuffled again.
    """
    first = W.partitionBy(*placed_by, "source", "content_hash").orderBy("ingested_at", "chunk_id")
    return df.withColumn("rn", F.row_number().over(first)).where(F.col("rn") == 1)


def time_buckets(df: DataFrame) -> DataFrame:
    """Timestamp, day and hour of `ingested_at` (epoch seconds, fraction cut off)."""
    stamped = df.withColumn("ingested_ts", F.timestamp_seconds(F.col("ingested_at").cast("bigint")))
    return stamped.withColumn("ingest_day", F.date_trunc("day", "ingested_ts")).withColumn(
        "ingest_hour", F.date_trunc("hour", "ingested_ts")
    )


def classified(df: DataFrame, variant: str = "v2", rules: Sequence[Rule] | None = None) -> DataFrame:
    label = F.lit("unknown")
    for name, condition in reversed(list(rules if rules is not None else content_rules(variant))):
        label = F.when(condition, F.lit(name)).otherwise(label)
    return df.withColumn("content_type", label)


def pieces(df: DataFrame, prefix: int = 500) -> DataFrame:
    return df.withColumn("prefix_hash", F.sha2(F.substring("content", 1, prefix), 256))


def silver(df: DataFrame, variant: str = "v2") -> DataFrame:
    """All silver columns."""
    return (
        df.transform(hashed).transform(deduped).transform(time_buckets).transform(classified, variant).transform(pieces)
    )


def vertical(df: DataFrame, width: int = 800) -> DataFrame:
    """One text per record for reading: header lines, then head, middle and tail."""
    content, size = F.col("content"), F.length("content")

    def headed(name: str, value: Column) -> Column:
        return F.concat(F.lit(f"{name}: "), value.cast("string"))

    def cut(start: Column) -> Column:
        return F.substring(content, start, F.lit(width))

    record = F.concat_ws(
        "\n",
        headed("SOURCE", F.col("source")),
        headed("TYPE", F.col("content_type")),
        headed("INGEST_DAY", F.col("ingest_day")),
        headed("LEN", size),
        F.lit(""),
        F.lit("----- HEAD -----"),
        cut(F.lit(1)),
        F.lit(""),
        F.lit("----- MID -----"),
        cut((size / 2).cast("int")),
        F.lit(""),
        F.lit("----- TAIL -----"),
        cut(F.greatest(size - width, F.lit(1))),
    )
    return df.withColumn("record", record)


def silver_sql(spark: SparkSession, view: str = "bronze_df") -> None:
    """Register every silver layer over `view` for the SQL user.

    Views: bronze_hashed, bronze_deduped, s1_time_partitioned, s1_classified,
    s1_pieces, inspect_vertical.  Nothing runs until a view is queried.
    """
    steps = [
        ("bronze_hashed", hashed),
        ("bronze_deduped", deduped),
        ("s1_time_partitioned", time_buckets),
        ("s1_classified", classified),
        ("s1_pieces", pieces),
        ("inspect_vertical", lambda d: vertical(d).select("record")),
    ]
    df = spark.table(view)
    for name, step in steps:
        df = df.transform(step)
        df.createOrReplaceTempView(name)


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n"))


def sample(df: DataFrame, n: int = 5, order: str = "chunk_id") -> DataFrame:
    """The first `n` records in a fixed order."""
    return df.orderBy(order).limit(n)
