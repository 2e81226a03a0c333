"""Bronze lake and knowledge-base files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.urls import authority, target_dir
from ..schema import BRONZE, enforce, relaxed


def source_of(file_path: Column) -> Column:
    """First path element below `bronze/`, with or without the `site=` prefix; a batch's own directory is skipped."""
    return F.regexp_extract(file_path, r"bronze/(?:batch=[^/]+/)?(?:site=)?([^/]+)/", 1)


def read_bronze(
    spark: SparkSession,
    path: str,
    with_partitions: bool = False,
    corrupt_column: str | None = None,
) -> DataFrame:
    """Scan bronze JSON lines with the explicit schema, plus `source`.

    The schema saves the inference pass and keeps `embedding`, which the JSON
    writer drops while it is NULL.  `with_partitions` keeps `ingested_date` (and
    `site`) as columns a filter can prune on; without it any directory layout is
    read.  A line that cannot be parsed fails the read, unless `corrupt_column` names
    the column that shows such lines; none is ever read as a record of NULLs.
    """
    reader = spark.read if with_partitions else spark.read.option("recursiveFileLookup", "true")
    schema = relaxed(BRONZE)
    if not corrupt_column:
        df = reader.option("mode", "FAILFAST").schema(schema).json(path)
        return df.withColumn("source", source_of(F.col("_metadata.file_path")))
    # Lines are parsed as a column: the JSON reader refuses queries that need the
    # corrupt lines alone, such as counting them.
    lines = reader.text(path).withColumn("source", source_of(F.col("_metadata.file_path")))
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": corrupt_column}
    wide = T.StructType([*schema.fields, T.StructField(corrupt_column, T.StringType())])
    parsed = lines.where(F.trim("value") != "").withColumn("value", F.from_json("value", wide, options))
    partitions = [c for c in lines.columns if c not in ("value", "source")]
    return parsed.select(*[F.col(f"value.{n}").alias(n) for n in wide.names], *partitions, "source")


def with_ingested_date(df: DataFrame) -> DataFrame:
    return df.withColumn("ingested_date", F.from_unixtime(F.col("ingested_at").cast("bigint"), "yyyy-MM-dd"))


def with_site(df: DataFrame, layout: str = "authority") -> DataFrame:
    """`site` directory per row: from the whole URL, or from its authority only.

    `layout="authority"` keeps the number of directories at the number of hosts.
    """
    if layout == "url":
        return df.withColumn("site", target_dir("source_url"))
    if layout == "authority":
        return df.withColumn("site", F.translate(authority("source_url"), "/:.", "___"))
    raise ValueError("layout must be 'url' or 'authority'")


def write_bronze(df: DataFrame, root: str, batch: int | None = None, layout: str = "authority") -> int:
    """Append records as JSON below `root` by site and day; returns the rows written.

    The rows are counted while they are written.  The rebalance hint gives one
    file per directory where possible and splits a site that holds much of the
    data.  With `batch` the records get a directory of their own, which a replay of
    the same batch replaces whole: also records that the replay no longer has, or
    has under another day, are gone, and an empty replay leaves it empty.  Use a
    root either with batches or without.
    """
    rows = with_site(with_ingested_date(enforce(df, BRONZE)), layout)
    written = Observation()
    counted = rows.hint("rebalance", F.col("site"), F.col("ingested_date")).observe(
        written, F.count(F.lit(1)).alias("rows")
    )
    writer = counted.write.partitionBy("site", "ingested_date")
    if batch is None:
        writer.mode("append").json(root)
    else:
        # Static: the batch's directory and all below it, whatever the session says.
        writer.mode("overwrite").option("partitionOverwriteMode", "static").json(f"{root}/batch={batch}")
    return written.get["rows"]


def file_inventory(spark: SparkSession, path: str) -> DataFrame:
    """Files and bytes per source directory; file contents are never read."""
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .load(path)
        .select("path", "length", "modificationTime")
    )
    return (
        files.groupBy(source_of(F.col("path")).alias("source"))
        .agg(
            F.count(F.lit(1)).alias("n_files"),
            F.sum("length").alias("bytes"),
            F.max("modificationTime").alias("last_modified"),
        )
    )


def export_kb(df: DataFrame, path: str) -> None:
    """Write a knowledge base as JSON lines; NULL fields are kept."""
    df.write.option("ignoreNullFields", "false").json(path)


def import_kb(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(relaxed(schema)).option("mode", "FAILFAST").json(path)
