"""Silver kept up to date by delta (A35-A39): bronze batches in any order, touched buckets only.

The de-duplicated records are stored in hash buckets of (source, content_hash), and every
bucket in versions, one per batch that touched it. A batch is reduced to its own earliest
copies, meets the newest versions of its buckets, and writes those buckets anew: an
earlier copy that arrives late replaces the kept one. The layers behind the
de-duplication are row-local and are added when silver is read.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .silver import classified, deduped, hashed, pieces, time_buckets

BUCKETS = 256


def _stored(spark: SparkSession, root: str) -> DataFrame | None:
    try:
        # A later batch may add columns that earlier versions lack.
        return spark.read.option("mergeSchema", "true").parquet(root)
    except AnalysisException as missing:
        if missing.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return None


def _newest(stored: DataFrame, before: int | None) -> DataFrame:
    """The newest version of every bucket; only partition values are read to find them."""
    versions = stored if before is None else stored.where(F.col("batch") < before)
    # At most one row per bucket.
    last = versions.groupBy("bucket").agg(F.max("batch").alias("batch"))
    return versions.join(F.broadcast(last), ["bucket", "batch"])


def apply_batch(spark: SparkSession, delta: DataFrame, root: str, batch: int, buckets: int = BUCKETS) -> list[int]:
    """Fold a bronze batch into the table at `root`; returns the buckets written, at most `buckets`.

    Batches are numbered in the order they are applied. A batch that is applied again replaces its own
    versions, and sees those of the batches before it only. `buckets` must stay as it is
    for one table.
    """
    rows = deduped(hashed(delta)).drop("rn")
    fresh = rows.withColumn("bucket", F.pmod(F.xxhash64("source", "content_hash"), F.lit(buckets)).cast("int")).persist()
    try:
        touched = sorted(r["bucket"] for r in fresh.select("bucket").distinct().collect())
        rows, stored = fresh, _stored(spark, root)
        if stored is not None:
            kept = _newest(stored.where(F.col("bucket").isin(touched)), batch)
            rows = rows.unionByName(kept.drop("batch"), allowMissingColumns=True)
        # Moved once, by bucket: copies meet where the bucket is written.
        rows = rows.repartition(max(1, min(len(touched), 4096)), "bucket")
        rows = deduped(rows, ["bucket"]).drop("rn").withColumn("batch", F.lit(batch))
        # One writer per bucket; only this batch's folders are replaced.
        writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy("bucket", "batch").parquet(root)
    finally:
        fresh.unpersist()
    return touched


def current(spark: SparkSession, root: str) -> DataFrame:
    """The de-duplicated records as of the last batch."""
    stored = _stored(spark, root)
    if stored is None:
        raise ValueError(f"no batch was applied to {root}")
    return _newest(stored, None).drop("bucket", "batch")


def silver_now(spark: SparkSession, root: str, variant: str = "v2") -> DataFrame:
    """All silver columns of the records as of the last batch."""
    return current(spark, root).withColumn("rn", F.lit(1)).transform(time_buckets).transform(classified, variant).transform(pieces)
