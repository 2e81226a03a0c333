"""The visited table of a discovery stream: one folder per micro-batch, and an index of the older ones.

A lookup reads the folders written since the index was made, and of the index only the
partitions that the looked-up URLs hash to. The number of partitions grows with the table,
so a partition stays near `per_bucket` URLs and what a micro-batch reads does not
grow with the table: at most its own URLs' partitions and `compact_every` small folders.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

PER_BUCKET = 1_000_000
URLS = "url string"
_INDEX = "url string, bucket int"
_STATE = "generation int, buckets int, upto bigint"


@dataclass(frozen=True)
class Generation:
    """An index over the micro-batches up to `upto`, cut into `buckets` by URL hash."""

    number: int = 0
    buckets: int = 0
    upto: int = -1


def bucket_of(url: Column | str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(url), F.lit(buckets)).cast("int")


class Visited:
    """`path`/batch=n holds what micro-batch n of one stream visited; `path`.index holds the index.

    Micro-batches are numbered from 0 without gaps, as Structured Streaming numbers them
    for one checkpoint.
    """

    def __init__(self, spark: SparkSession, path: str, per_bucket: int = PER_BUCKET) -> None:
        self.spark, self.path, self.per_bucket = spark, path.rstrip("/"), per_bucket
        self.index, self.state = f"{self.path}.index", f"{self.path}.index-state"

    def current(self) -> Generation:
        """The newest finished index; without one, lookups read the folders of all micro-batches."""
        try:
            rows = self.spark.read.schema(_STATE).parquet(self.state)
        except AnalysisException as missing:
            if missing.getCondition() != "PATH_NOT_FOUND":
                raise
            return Generation()
        # One row per compaction.
        newest = rows.agg(F.max_by(F.struct("generation", "buckets", "upto"), "generation").alias("g")).first()["g"]
        return Generation(*newest) if newest else Generation()

    def _folders(self, after: int, before: int) -> DataFrame:
        folders = [f"{self.path}/batch={n}" for n in range(after + 1, before)]
        if not folders:
            return self.spark.createDataFrame([], URLS)
        return self.spark.read.schema(URLS).parquet(*folders)

    def _indexed(self, now: Generation) -> DataFrame:
        return self.spark.read.schema(_INDEX).parquet(f"{self.index}/generation={now.number}")

    def among(self, urls: DataFrame, batch: int) -> DataFrame:
        """Those of `urls` (one column, url) that micro-batches before `batch` visited.

        The buckets that `urls` hash to, numbers no more than the index has partitions, select the
        partitions to read; `urls` should be persisted or cheap, since it is read twice.
        """
        now = self.current()
        recent = urls.join(self._folders(now.upto, batch), "url", "left_semi")
        if not now.buckets:
            return recent
        asked = urls.withColumn("bucket", bucket_of("url", now.buckets))
        touched = sorted(r["bucket"] for r in asked.where("url is not null").select("bucket").distinct().collect())
        older = self._indexed(now)
        if len(touched) < now.buckets:
            older = older.where(F.col("bucket").isin(touched))
        return recent.unionByName(older.join(asked, ["bucket", "url"], "left_semi").select("url"))

    def compact(self, before: int) -> Generation:
        """Make a new index over all micro-batches before `before`; returns it.

        The index is written whole before the row that names it, so a stopped job leaves
        the old one in use and the next run writes the same folder again. Replaced
        indexes and indexed folders are no longer read and may be archived.
        """
        now = self.current()
        if before - 1 <= now.upto:
            return now
        urls = self._folders(now.upto, before)
        if now.buckets:
            urls = urls.unionByName(self._indexed(now).select("url"))
        count = urls.count()
        buckets = 1 << max(0, -(-count // self.per_bucket) - 1).bit_length()
        new = Generation(now.number + 1, buckets, before - 1)
        # Each bucket is written by one task, so it is one file.
        placed = urls.withColumn("bucket", bucket_of("url", buckets)).repartition(min(buckets, 4096), "bucket")
        placed.sortWithinPartitions("bucket", "url").write.mode("overwrite").partitionBy("bucket").parquet(f"{self.index}/generation={new.number}")
        self._name(new)
        return new

    def _name(self, new: Generation) -> None:
        self.spark.createDataFrame([(new.number, new.buckets, new.upto)], _STATE).coalesce(1).write.mode("append").parquet(self.state)

    def compact_if_due(self, batch: int, every: int | None) -> None:
        if every and batch - 1 - self.current().upto >= every:
            self.compact(batch)

    def urls(self, before: int) -> DataFrame:
        """All URLs visited by micro-batches before `before`."""
        now = self.current()
        recent = self._folders(now.upto, before)
        return recent.unionByName(self._indexed(now).select("url")) if now.buckets else recent
