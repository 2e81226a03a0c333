"""Discovery and ingestion streams.

Each micro-batch owns a directory (`batch=`) of each table it writes, and a replay
replaces it whole, also by nothing, so at-least-once delivery leaves every record
once.  Times come from the batch's messages, so a replay writes the same records.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener
from pyspark.sql.streaming.readwriter import DataStreamWriter

from ..operators.frontier import first_seen
from ..operators.gate import Policy, ask_and_gate, keyword_filter, relevance_gate
from ..operators.records import to_bronze_record
from ..schema import BRONZE, DISCOVERY, relaxed
from ..sources.lake import write_bronze
from ..plans.crawl import VISITED_TOPIC, visited_messages
from ..sources.topics import decode, replace_messages
from ..sources.visited import PER_BUCKET, Visited

IDLE_POLLS = 10

_VISITED = "url string, batch bigint"
_WORK = "url string, language string, batch bigint"


class IdleMonitor(StreamingQueryListener):
    """Calls `on_quiet(query id)` after `limit` idle events in a row."""

    def __init__(self, on_quiet: Callable[[str], None], limit: int = IDLE_POLLS) -> None:
        self.on_quiet, self.limit, self.idle = on_quiet, limit, {}

    def onQueryStarted(self, event) -> None:
        self.idle[str(event.id)] = 0

    def onQueryProgress(self, event) -> None:
        self.idle[str(event.progress.id)] = 0

    def onQueryIdle(self, event) -> None:
        name = str(event.id)
        self.idle[name] = self.idle.get(name, 0) + 1
        if self.idle[name] == self.limit:
            self.on_quiet(name)

    def onQueryTerminated(self, event) -> None:
        self.idle.pop(str(event.id), None)


class RunCounters(StreamingQueryListener):
    """Adds up what running topic queries observe, by query id: the records read so far."""

    def __init__(self) -> None:
        self.records: dict[str, int] = {}

    def onQueryStarted(self, event) -> None:
        self.records.setdefault(str(event.id), 0)

    def onQueryProgress(self, event) -> None:
        seen = event.progress.observedMetrics.get("topic")
        if seen is not None:
            name = str(event.progress.id)
            self.records[name] = self.records.get(name, 0) + seen["records"]

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass


def run_counters(spark: SparkSession, path: str) -> DataFrame:
    """One row over all micro-batches of a discovery job's `counters_path`.

    `records`, `dead`, `discovered` are exact; `visited` is the number of distinct URLs by a
    mergeable sketch, within 2 % (one sketch of some kilobytes per micro-batch).
    """
    union = F.hll_sketch_estimate(F.hll_union_agg("urls"))
    return spark.read.parquet(path).agg(
        F.sum("records").alias("records"), F.sum("dead").alias("dead"), F.sum("discovered").alias("discovered"), union.alias("visited")
    )


def _run(stream: DataFrame, step: Callable[[DataFrame, int], None], checkpoint: str, drain: bool) -> StreamingQuery:
    counted = stream.observe("topic", F.count(F.lit(1)).alias("records"))

    def once(batch: DataFrame, batch_id: int) -> None:
        # Several writes follow; the source is read for the first of them only.
        held = batch.persist()
        try:
            step(held, batch_id)
        finally:
            held.unpersist()

    writer: DataStreamWriter = counted.writeStream.foreachBatch(once).option("checkpointLocation", checkpoint)
    # availableNow stops by itself once the backlog known at the start is worked off.
    return (writer.trigger(availableNow=True) if drain else writer).start()


def _ensure(spark: SparkSession, path: str, schema: str) -> None:
    spark.createDataFrame([], schema).write.mode("ignore").partitionBy("batch").parquet(path)


def _replace_batch(df: DataFrame, path: str, batch: int) -> None:
    df.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(f"{path}/batch={batch}")


def _messages(good: DataFrame) -> DataFrame:
    return good.select(
        F.col("data.url").alias("url"),
        F.coalesce("data.language", F.lit("en")).alias("language"),
        "timestamp", "partition", "offset",
    )


def discovery(
    spark: SparkSession,
    source: DataFrame,
    visited_path: str,
    work_path: str,
    checkpoint: str,
    dead_path: str,
    drain: bool = True,
    compact_every: int | None = 100,
    messages_path: str | None = None,
    per_bucket: int = PER_BUCKET,
    counters_path: str | None = None,
) -> StreamingQuery:
    """Messages to first-seen URLs: a work list (url, language) and the visited table.

    The earliest message of a URL wins by (timestamp, partition, offset).  Of the
    visited table only what this micro-batch's URLs may be in is read (`Visited`); its
    index is made anew every `compact_every` micro-batches, from those that are
    committed.  `messages_path` also gets a visited message for every new URL, as a
    file topic with a folder per micro-batch, and `counters_path` a row of its counts
    (`run_counters` adds them up).
    """
    _ensure(spark, visited_path, _VISITED)
    _ensure(spark, work_path, _WORK)

    def step(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        visited = Visited(session, visited_path, per_bucket)
        visited.compact_if_due(batch_id, compact_every)
        good, dead = decode(batch, DISCOVERY, required=("url",))
        fresh = first_seen(_messages(good)).persist()
        try:
            seen = visited.among(fresh.select("url"), batch_id)
            _replace_batch(fresh.join(seen, "url", "left_anti").select("url", "language"), work_path, batch_id)
        finally:
            fresh.unpersist()
        # The visited table is fed from what was written, so both always agree.
        done = session.read.schema(_WORK.replace(", batch bigint", "")).parquet(f"{work_path}/batch={batch_id}")
        _replace_batch(done.select("url"), visited_path, batch_id)
        if messages_path is not None:
            replace_messages(visited_messages(done), messages_path, VISITED_TOPIC, batch_id)
        if counters_path is not None:
            one = F.count(F.lit(1))
            row = _messages(good).agg(
                batch.agg(one).scalar().alias("records"), dead.agg(one).scalar().alias("dead"),
                done.agg(one).scalar().alias("discovered"), F.hll_sketch_agg("url").alias("urls"),
            )
            _replace_batch(row, counters_path, batch_id)
        _replace_batch(dead.select("topic", "partition", "offset", "value", "error"), dead_path, batch_id)

    return _run(source, step, checkpoint, drain)


def first_seen_stream(source: DataFrame, within: str | None = None) -> DataFrame:
    """First-seen URLs by Spark's keyed state instead of a table.

    Which duplicate survives inside one micro-batch is not promised, so this
    form is for jobs that need the URL only.  `within` forgets URLs that were
    not repeated for that long (watermark); without it state grows with the
    number of URLs.
    """
    good, _ = decode(source, DISCOVERY, required=("url",))
    rows = _messages(good)
    if within is None:
        return rows.dropDuplicates(["url"])
    return rows.withWatermark("timestamp", within).dropDuplicatesWithinWatermark(["url"])


def ingest(
    spark: SparkSession,
    source: DataFrame,
    root: str,
    policy: Policy,
    checkpoint: str,
    dead_path: str,
    verdicts: DataFrame | None = None,
    scorer: Callable[[pd.Series], Sequence[str]] | None = None,
    now: Column | float | None = None,
    verdict_key: str = "chunk_id",
    layout: str = "authority",
    drain: bool = True,
) -> StreamingQuery:
    """Chunk messages to bronze: decode, keyword policy, verdict, record, write.

    The cheap filter runs before the verdict.  Verdicts come from a table or a
    `scorer`; without either every survivor passes.  `now` defaults to the latest
    timestamp of the micro-batch's messages.  What cannot be decoded goes to
    `dead_path`, and so does a micro-batch of which no message has a time.
    """
    if verdicts is not None and scorer is not None:
        raise ValueError("give verdicts or scorer, not both")
    def step(batch: DataFrame, batch_id: int) -> None:
        stamp = now
        if stamp is None:
            stamp = batch.agg((F.unix_micros(F.max("timestamp")) / F.lit(1e6)).alias("t")).first()["t"]
        good, dead = decode(batch, relaxed(BRONZE), required=("source_url",))
        if stamp is None:
            timeless = good.withColumn("error", F.lit("no message has a time"))
            dead, good, stamp = dead.unionByName(timeless, allowMissingColumns=True), good.where(F.lit(False)), 0.0
        chunks = good.select("data.*").withColumn("content", F.coalesce("content", F.lit("")))
        if scorer is not None:
            passed = ask_and_gate(chunks, scorer, policy)
        else:
            passed = keyword_filter(chunks, policy)
            if verdicts is not None:
                passed = relevance_gate(passed, verdicts, key=verdict_key)
        write_bronze(to_bronze_record(passed, stamp), root, batch=batch_id, layout=layout)
        _replace_batch(dead.select("topic", "partition", "offset", "value", "error"), dead_path, batch_id)

    return _run(source, step, checkpoint, drain)
