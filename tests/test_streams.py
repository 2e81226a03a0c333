"""Streams: replay, first seen, dead letters, state form, Kafka options."""

import json

import pytest
from pyspark.sql import functions as F

from siltstone.operators.gate import Policy
from siltstone.schema import DISCOVERY, TOPIC
from siltstone.sources import topics
from siltstone.sources.lake import read_bronze
from siltstone.streaming import jobs


def send(spark, path, rows, topic="discovery_queue"):
    """rows of (offset, value); the timestamp follows the offset."""
    df = spark.createDataFrame(rows, "offset long, value string").select(
        F.lit(topic).alias("topic"), F.lit(0).alias("partition"), "offset",
        F.timestamp_seconds(F.col("offset")).alias("timestamp"), F.lit(None).cast("string").alias("key"), "value",
    )
    topics.write_topic(df.coalesce(1), "json", path)


def discover(spark, base, **options):
    source = topics.read_topic(spark, "json", f"{base}/topics", ["discovery_queue"], stream=True, max_per_trigger=1)
    jobs.discovery(
        spark, source, f"{base}/visited", f"{base}/work", f"{base}/checkpoint", f"{base}/dead", **options
    ).awaitTermination()
    return sorted((r.url, r.language) for r in spark.read.parquet(f"{base}/work").collect())


def message(url, language=None):
    return json.dumps({"url": url, **({"language": language} if language else {})})


def test_first_message_wins_across_runs(spark, tmp_path):
    base = str(tmp_path)
    send(spark, f"{base}/topics", [(3, message("a", "sk")), (1, message("a", "he")), (2, message("b"))])
    assert discover(spark, base) == [("a", "he"), ("b", "en")]
    send(spark, f"{base}/topics", [(4, message("a", "ar")), (5, message("c", "ar")), (6, "{bad"), (7, None), (8, "{}")])
    assert discover(spark, base) == [("a", "he"), ("b", "en"), ("c", "ar")]
    assert discover(spark, base) == [("a", "he"), ("b", "en"), ("c", "ar")]
    dead = {r.offset: r.error for r in spark.read.parquet(f"{base}/dead").collect()}
    assert dead == {6: "invalid json", 7: "empty payload", 8: "missing url"}


def test_replayed_batch_after_a_crash_between_the_sinks(spark, tmp_path, monkeypatch):
    base = str(tmp_path)
    send(spark, f"{base}/topics", [(1, message("a", "he"))])
    assert discover(spark, base) == [("a", "he")]
    send(spark, f"{base}/topics", [(2, message("a", "sk")), (3, message("b", "sk"))])
    write = jobs._replace_batch

    def crash(df, path, batch):
        if path.endswith("/visited"):
            raise RuntimeError("executor lost")
        write(df, path, batch)

    monkeypatch.setattr(jobs, "_replace_batch", crash)
    with pytest.raises(Exception, match="executor lost"):
        discover(spark, base)
    monkeypatch.setattr(jobs, "_replace_batch", write)
    assert discover(spark, base) == [("a", "he"), ("b", "sk")]
    assert sorted(r.url for r in spark.read.parquet(f"{base}/visited").collect()) == ["a", "b"]


def test_replayed_batch_after_a_full_write(spark, tmp_path):
    """The sinks were written but the commit was lost: the batch runs again."""
    base = str(tmp_path)
    send(spark, f"{base}/topics", [(1, message("a", "he")), (2, message("b"))])
    discover(spark, base)
    commits = tmp_path / "checkpoint" / "commits"
    for f in list(commits.iterdir()):
        f.unlink()
    assert discover(spark, base) == [("a", "he"), ("b", "en")]


def test_state_form(spark, tmp_path):
    base = str(tmp_path)
    send(spark, f"{base}/topics", [(1, message("a")), (2, message("a")), (3, message("b")), (4, "{bad")])

    def run(within=None):
        source = topics.read_topic(spark, "json", f"{base}/topics", ["discovery_queue"], stream=True)
        urls = jobs.first_seen_stream(source, within).select("url")
        name = "watermark" if within else "plain"
        query = urls.writeStream.format("parquet").option("path", f"{base}/{name}").option(
            "checkpointLocation", f"{base}/{name}-ck").trigger(availableNow=True).start()
        query.awaitTermination()
        return sorted(r.url for r in spark.read.parquet(f"{base}/{name}").collect())

    assert run() == ["a", "b"]
    assert run("1 day") == ["a", "b"]
    send(spark, f"{base}/topics", [(5, message("b")), (6, message("c"))])
    assert run() == ["a", "b", "c"]


def chunk(i, content, **more):
    return json.dumps({"chunk_id": f"u::{i}", "source_url": "http://u.org/x", "content": content, "ingested_at": 1.0, **more})


def test_ingest_with_scorer(spark, tmp_path):
    base = str(tmp_path)
    rows = [
        (0, chunk(0, " good yes ", language="sk")), (1, chunk(1, "good no")), (2, chunk(2, "other yes")), (3, "{bad"),
        (4, json.dumps({"content": "good yes"})), (5, chunk(5, "good boom", embedding=[1.0, 2.0])),
    ]
    send(spark, f"{base}/topics", rows, "relevant_chunks")

    def scorer(prompts):
        if prompts.str.contains("boom").any():
            raise RuntimeError("down")
        return ["RELEVANT" if "yes" in p else "NOT RELEVANT" for p in prompts]

    source = topics.read_topic(spark, "json", f"{base}/topics", ["relevant_chunks"], stream=True)
    jobs.ingest(
        spark, source, f"{base}/bronze", Policy("p", "d", ["GOOD"]), f"{base}/ck", scorer=scorer, dead_path=f"{base}/dead"
    ).awaitTermination()
    got = {r.chunk_id: (r.content, r.language, r.embedding, r.ingested_at, r.source) for r in read_bronze(spark, f"{base}/bronze").collect()}
    assert got == {
        "u::0": ("good yes", "sk", None, 5.0, "u_org"),
        "u::5": ("good boom", "en", [1.0, 2.0], 5.0, "u_org"),
    }
    assert {r.error for r in spark.read.parquet(f"{base}/dead").collect()} == {"invalid json", "missing source_url"}


def test_idle_monitor():
    class Event:
        def __init__(self):
            self.id = "q"
            self.progress = self

    quiet = []
    monitor = jobs.IdleMonitor(quiet.append, limit=3)
    monitor.onQueryStarted(Event())
    for _ in range(2):
        monitor.onQueryIdle(Event())
    monitor.onQueryProgress(Event())
    for _ in range(4):
        monitor.onQueryIdle(Event())
    assert quiet == ["q"]


def test_listeners_on_a_running_query(spark, tmp_path):
    """A query without a drain works its backlog off, goes quiet and is stopped; the counters saw every record."""
    import threading

    base, quiet = str(tmp_path), threading.Event()
    send(spark, f"{base}/topics", [(1, message("a")), (2, message("b")), (3, "{bad")])
    session = spark.newSession()
    session.conf.set("spark.sql.streaming.noDataProgressEventInterval", "200")
    monitor, seen = jobs.IdleMonitor(lambda name: quiet.set(), limit=2), jobs.RunCounters()
    for listener in (monitor, seen):
        session.streams.addListener(listener)
    source = topics.read_topic(session, "json", f"{base}/topics", ["discovery_queue"], stream=True)
    query = jobs.discovery(
        session, source, f"{base}/visited", f"{base}/work", f"{base}/checkpoint", f"{base}/dead", drain=False, counters_path=f"{base}/counters"
    )
    try:
        assert quiet.wait(60)
    finally:
        query.stop()
        for listener in (monitor, seen):
            session.streams.removeListener(listener)
    assert seen.records[str(query.id)] == 3
    row = jobs.run_counters(spark, f"{base}/counters").first()
    assert (row.records, row.dead, row.discovered, row.visited) == (3, 1, 2, 2)


class Reader:
    """Records the options a Kafka source would get; the connector is not on this class path."""

    def __init__(self, df):
        self.df, self.seen = df, {}

    def format(self, name):
        self.seen["format"] = name
        return self

    def option(self, key, value):
        self.seen[key] = value
        return self

    def options(self, **more):
        self.seen.update(more)
        return self

    def load(self):
        return self.df


class Session:
    def __init__(self, df):
        self.read = self.readStream = Reader(df)


def test_kafka_options(spark):
    empty = spark.createDataFrame([], TOPIC)
    session = Session(empty)
    out = topics.read_topic(session, "kafka", "h:1", ["a", "b"], stream=True, max_per_trigger=5)
    assert session.read.seen == {
        "format": "kafka", "kafka.bootstrap.servers": "h:1", "subscribe": "a,b", "startingOffsets": "earliest",
        "maxOffsetsPerTrigger": 5,
    }
    assert out.columns == TOPIC.names
    session = Session(empty)
    topics.read_topic(session, "kafka", "h:1", ["a"], options={"startingOffsetsByTimestamp": "{}", "endingOffsets": "latest"})
    assert "startingOffsets" not in session.read.seen and session.read.seen["endingOffsets"] == "latest"
    with pytest.raises(ValueError):
        topics.read_topic(spark, "csv", "x", ["a"])


def test_decode_and_offsets(frame):
    rows = [('{"url":"u","language":"sk"}',), ("[1]",), ("5",), ('"x"',), ("",), (None,), ('{"language":"sk"}',), ('{"url":null}',)]
    good, dead = topics.decode(frame(rows, "value string"), DISCOVERY, required=("url",))
    assert [(r.data.url, r.data.language) for r in good.collect()] == [("u", "sk")]
    assert dead.count() == len(rows) - 1
    df = frame([("t", 0, 5), ("t", 0, 9), ("t", 1, 2)], "topic string, partition int, offset long")
    assert {(r.partition, r.next_offset) for r in topics.next_offsets(df).collect()} == {(0, 10), (1, 3)}
