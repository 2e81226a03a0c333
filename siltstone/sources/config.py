"""Active configurations and seed tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..scale import broadcast_if_small


def read_configs(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Rows of JSON array files with `pos`, their place in the file (`file`)."""
    text = spark.read.text(path, wholetext=True).withColumn("file", F.col("_metadata.file_path"))
    items = F.from_json("value", T.ArrayType(schema))
    return text.select("file", F.posexplode(items).alias("pos", "config")).select("file", "pos", "config.*")


def active_config(df: DataFrame, by: Sequence[str] = (), order: str = "pos") -> DataFrame:
    """The last row whose `active` is exactly true, per `by` group.

    Without groups a missing active row is an error when the result is used;
    with groups it is the value `status = 'none active'`.
    """
    fields = [c for c in df.columns if c not in by]
    chosen = F.max_by(F.struct(*fields), F.when(F.col("active"), F.col(order)))
    if by:
        picked = df.groupBy(*by).agg(chosen.alias("_c"))
        status = F.when(F.col("_c").isNull(), F.lit("none active")).otherwise(F.lit("ok"))
        return picked.select(*by, status.alias("status"), *[F.col(f"_c.{f}").alias(f) for f in fields])
    picked = df.agg(chosen.alias("_c"))
    checked = F.coalesce(F.col("_c.active"), F.raise_error(F.lit("No active configuration found")).cast("boolean"))
    return picked.select(
        *[checked.alias("active") if f == "active" else F.col(f"_c.{f}").alias(f) for f in fields]
    )


def read_seeds(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """A seed file as three tables: (language, url), included and excluded languages."""
    raw = spark.read.text(path, wholetext=True)
    lists = raw.select(F.explode(F.from_json("value", "map<string,array<string>>")).alias("language", "urls"))
    own = F.col("language").isin("include", "exclude")
    seeds = lists.where(~own).select("language", F.explode("urls").alias("url"))
    named = lambda k: lists.where(F.col("language") == k).select(F.explode("urls").alias("language"))
    return seeds, named("include"), named("exclude")


def seed_urls(seeds: DataFrame, include: DataFrame, exclude: DataFrame) -> DataFrame:
    """Seeds (language, url) whose language is included and not excluded."""
    allowed = include.select("language").distinct().join(exclude.select("language"), "language", "left_anti")
    return seeds.join(broadcast_if_small(allowed, 10_000), "language", "left_semi")
