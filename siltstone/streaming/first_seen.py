"""First-seen URLs by keyed state, with corrections.

For every URL the state holds its earliest message by (timestamp, partition, offset). The first
message emits a row; one that is earlier but arrives later emits a corrected row, so the
last row of a URL is always its earliest message, whatever the order of arrival.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from ..schema import DISCOVERY
from ..sources.topics import decode

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
PROVIDER = "spark.sql.streaming.stateStore.providerClass"

_SEEN = "url string, language string, timestamp timestamp, partition int, offset bigint, corrected boolean"


class Earliest(StatefulProcessor):
    """Keeps the place (microseconds, partition, offset) of each URL's earliest message."""

    def __init__(self, ttl_ms: int | None) -> None:
        self.ttl_ms = ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.place = handle.getValueState("place", "at bigint, partition int, offset bigint", self.ttl_ms)

    def handleInputRows(self, key: tuple, rows: Iterator[Row], timers) -> Iterator[Row]:
        first = min(rows, key=lambda r: (r["at"], r["partition"], r["offset"]))
        place = (first["at"], first["partition"], first["offset"])
        known = tuple(self.place.get()) if self.place.exists() else None
        if known is None or place < known:
            self.place.update(place)
            yield Row(
                url=key[0], language=first["language"], timestamp=first["timestamp"], partition=first["partition"],
                offset=first["offset"], corrected=known is not None,
            )

    def close(self) -> None:
        pass


def earliest_messages(messages: DataFrame, ttl_ms: int | None = None) -> DataFrame:
    """A stream of (url, language, timestamp, partition, offset) to first-seen rows and their corrections.

    `ttl_ms` forgets a URL that was neither new nor corrected for that long (processing time);
    without it the state, on disk in RocksDB, grows with the number of URLs. Repeats of a
    URL inside a micro-batch reach its group one by one and are folded there without
    being held. A message without a time comes after all others.
    """
    spark = messages.sparkSession
    if "RocksDB" not in spark.conf.get(PROVIDER, ""):
        raise ValueError(f"set {PROVIDER} to {ROCKSDB}")
    last = F.lit((1 << 63) - 1)
    placed = messages.withColumn("at", F.coalesce(F.unix_micros("timestamp"), last))
    return placed.groupBy("url").transformWithState(
        statefulProcessor=Earliest(ttl_ms),
        outputStructType=_SEEN,
        outputMode="Append",
        timeMode="ProcessingTime" if ttl_ms else "None",
    )


def first_seen_job(
    spark: SparkSession, source: DataFrame, path: str, checkpoint: str, ttl_ms: int | None = None, drain: bool = True
) -> StreamingQuery:
    """Discovery messages to a table of emissions, one folder per micro-batch; a replayed batch replaces its folder.

    `drain` works off the backlog and stops. With `ttl_ms` that is one micro-batch: state that
    expires by the clock makes Spark plan batches without data for ever.
    """
    good, _ = decode(source, DISCOVERY, required=("url",))
    messages = good.select(
        F.col("data.url").alias("url"), F.coalesce("data.language", F.lit("en")).alias("language"), "timestamp", "partition", "offset"
    )
    spark.createDataFrame([], f"{_SEEN}, batch bigint").write.mode("ignore").partitionBy("batch").parquet(path)

    def step(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(f"{path}/batch={batch_id}")

    writer = earliest_messages(messages, ttl_ms).writeStream.outputMode("append").foreachBatch(step).option("checkpointLocation", checkpoint)
    if drain:
        writer = writer.trigger(once=True) if ttl_ms else writer.trigger(availableNow=True)
    return writer.start()


def settled(emissions: DataFrame) -> DataFrame:
    """One row per URL: its earliest message so far, and how often it was corrected."""
    best = F.min_by(F.struct("language", "timestamp", "partition", "offset"), F.struct(F.col("timestamp").isNull(), "timestamp", "partition", "offset"))
    return emissions.groupBy("url").agg(best.alias("m"), F.count_if("corrected").alias("corrections")).select("url", "m.*", "corrections")
