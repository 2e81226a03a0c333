"""Counts by event time with a watermark, and a table of what came too late.

`window_counts` is Spark's own stateful form, which drops late rows without a trace. `count_windows`
gives every row a place: a row is late if its window had ended at the watermark, the latest
event time of all earlier micro-batches less `delay`, and then goes to the late table; every
other row is counted. What a micro-batch adds to a window is one stored row per window and
group, so counts are sums of few rows, a replay replaces its own rows, and no state
store is needed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

_MARK = "latest timestamp"


def window_counts(stream: DataFrame, ts: str, by: list[str], width: str = "1 hour", delay: str = "2 hours") -> DataFrame:
    """(window_start, `by`, n) of a stream, each window once when the watermark has passed its end."""
    counted = stream.withWatermark(ts, delay).groupBy(F.window(ts, width), *by).agg(F.count(F.lit(1)).alias("n"))
    return counted.select(F.col("window.start").alias("window_start"), *by, "n")


def count_windows(
    spark: SparkSession,
    source: DataFrame,
    ts: str,
    by: list[str],
    path: str,
    checkpoint: str,
    width: str = "1 hour",
    delay: str = "2 hours",
    drain: bool = True,
) -> StreamingQuery:
    """Micro-batches to three tables below `path`, a folder each: `counts`, `late` and `marks`.

    `counts`: window_start, window_end, the `by` columns, n. `late`: the late rows as they
    came, also rows without an event time. `marks`: the latest event time so far.
    """

    def step(batch: DataFrame, batch_id: int) -> None:
        before = None
        if batch_id:
            before = batch.sparkSession.read.schema(_MARK).parquet(f"{path}/marks/batch={batch_id - 1}").first()["latest"]
        latest = F.lit(before).cast("timestamp")
        mark = latest - F.expr(f"INTERVAL {delay}")

        def replace(rows: DataFrame, name: str) -> None:
            rows.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(f"{path}/{name}/batch={batch_id}")

        held = batch.persist()
        # A window has no place for rows without an event time.
        at = F.col(ts).cast("timestamp")
        placed = held.withColumn("_at", at).withColumn("_window", F.window("_at", width)).drop("_at")
        past = F.coalesce(F.col("_window.end") <= mark, F.lit(False))
        groups = [F.col("_window.start").alias("window_start"), F.col("_window.end").alias("window_end"), *by]
        try:
            replace(placed.where(~past).groupBy(*groups).agg(F.count(F.lit(1)).alias("n")), "counts")
            replace(placed.where(past).drop("_window").unionByName(held.where(F.col(ts).isNull())), "late")
            # Last, so that a micro-batch with a mark is whole.
            replace(held.agg(F.greatest(F.max(at), latest).alias("latest")), "marks")
        finally:
            held.unpersist()

    writer = source.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if drain else writer).start()


def counted(spark: SparkSession, path: str, by: list[str], delay: str = "2 hours") -> DataFrame:
    """(window_start, `by`, n, closed) over all micro-batches; a closed window gets no more rows."""
    marks = spark.read.parquet(f"{path}/marks").agg(F.max("latest").alias("m"))
    closed = F.col("window_end") <= marks.scalar() - F.expr(f"INTERVAL {delay}")
    rows = spark.read.parquet(f"{path}/counts").groupBy("window_start", "window_end", *by).agg(F.sum("n").alias("n"))
    return rows.select("window_start", *by, "n", F.coalesce(closed, F.lit(False)).alias("closed"))


def late_rows(spark: SparkSession, path: str) -> DataFrame:
    """The late rows of all micro-batches, with the number of theirs."""
    return spark.read.parquet(f"{path}/late")
