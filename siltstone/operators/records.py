"""Chunk messages to bronze records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import strip
from ..functions.vectors import normalise_embedding
from ..scale import running_sum
from ..schema import BRONZE, enforce


def refused_records(df: DataFrame, now: Column | float) -> DataFrame:
    """The messages `to_bronze_record` cannot make a record of, as they are, with an `error`."""
    stamp = F.lit(float(now)) if isinstance(now, (int, float)) else now
    error = F.when(F.col("source_url").isNull(), "missing source_url").when(stamp.isNull(), "missing time")
    return df.withColumn("error", error).where(F.col("error").isNotNull())


def to_bronze_record(df: DataFrame, now: Column | float) -> DataFrame:
    """Bring chunk messages to the bronze schema.

    Messages without a source URL or a time have no record: `refused_records` has them.

    Content is stripped, language defaults to "en", `ingested_at` is stamped
    with `now` (a parameter: there is no hidden clock), and a missing chunk id
    becomes `{source_url}_{now}`.
    """
    stamp = (F.lit(float(now)) if isinstance(now, (int, float)) else now).cast("double")
    # Plain decimal text: the double itself would print in scientific notation.
    digits = F.regexp_replace(stamp.cast("decimal(20,6)").cast("string"), "0+$", "")
    stamp_text = F.regexp_replace(digits, r"\.$", ".0")
    given = F.when(F.col("chunk_id") != "", F.col("chunk_id")) if "chunk_id" in df.columns else F.lit(None)
    language = F.col("language") if "language" in df.columns else F.lit(None).cast("string")
    embedding = normalise_embedding("embedding") if "embedding" in df.columns else F.lit(None).cast("array<float>")
    rows = df.where(F.col("source_url").isNotNull() & stamp.isNotNull()).select(
        # coalesce with a literal makes the required fields provably non-null.
        F.coalesce(given, F.concat(F.col("source_url"), F.lit("_"), stamp_text), F.lit("")).alias("chunk_id"),
        F.coalesce(F.col("source_url"), F.lit("")).alias("source_url"),
        F.coalesce(strip("content"), F.lit("")).alias("content"),
        F.coalesce(stamp, F.lit(0.0)).alias("ingested_at"),
        F.coalesce(language, F.lit("en")).alias("language"),
        embedding.alias("embedding"),
    )
    return enforce(rows, BRONZE)


def group_flush(df: DataFrame, key: str = "source_url", order: str = "offset", min_group: int = 1) -> DataFrame:
    """Mark the rows a group buffer of `min_group` records would have written (`ready`).

    A buffer is written and emptied each time it is full, so of `n` records of a
    key the first `n - n mod min_group` in arrival order are ready.
    """
    if min_group <= 1:
        return df.withColumn("ready", F.lit(True))
    counted = running_sum(df.withColumn("_one", F.lit(1)), "_one", order, by=[key], before="_seen", total="_size")
    full = F.col("_size") - F.pmod(F.col("_size"), F.lit(min_group))
    return counted.withColumn("ready", F.col("_seen") < full).drop("_one", "_seen", "_size")
