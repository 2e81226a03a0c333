"""Keyed first-seen state, event-time counts and silver by delta."""

import datetime as dt
import itertools
import json

import pytest
from pyspark.sql import functions as F

from siltstone.plans import silver, silver_delta
from siltstone.sources import topics
from siltstone.streaming import event_time, first_seen, jobs


def send(spark, path, rows):
    """rows of (seconds or None, partition, offset, value), one file per call."""
    df = spark.createDataFrame(rows, "at long, partition int, offset long, value string").select(
        F.lit("discovery_queue").alias("topic"), "partition", "offset", F.timestamp_seconds("at").alias("timestamp"),
        F.lit(None).cast("string").alias("key"), "value",
    )
    topics.write_topic(df.coalesce(1), "json", path)


def message(url, language):
    return json.dumps({"url": url, "language": language})


@pytest.fixture
def state(spark):
    session = spark.newSession()
    session.conf.set(first_seen.PROVIDER, first_seen.ROCKSDB)
    return session


def run(session, base, ttl_ms=None):
    source = topics.read_topic(session, "json", f"{base}/topics", ["discovery_queue"], stream=True)
    first_seen.first_seen_job(session, source, f"{base}/seen", f"{base}/checkpoint", ttl_ms).awaitTermination()
    rows = session.read.parquet(f"{base}/seen").orderBy("batch", "url").collect()
    return [(r.batch, r.url, r.language, r.offset, r.corrected) for r in rows]


def test_corrections_and_restored_state(spark, state, tmp_path):
    base = str(tmp_path)
    send(spark, f"{base}/topics", [(50, 0, 9, message("a", "x")), (50, 0, 3, message("a", "w")), (60, 1, 1, message("b", "x")), (1, 0, 0, "{bad")])
    assert run(state, base) == [(0, "a", "w", 3, False), (0, "b", "x", 1, False)]
    # Later, equal and earlier messages; ties go by partition, then offset; no time comes last.
    send(spark, f"{base}/topics", [(70, 0, 1, message("a", "no")), (60, 0, 9, message("b", "y")), (None, 0, 1, message("c", "n"))])
    assert run(state, base)[2:] == [(1, "b", "y", 9, True), (1, "c", "n", 1, False)]
    send(spark, f"{base}/topics", [(50, 0, 3, message("a", "w")), (10, 0, 99, message("c", "t"))])
    assert run(state, base)[4:] == [(2, "c", "t", 99, True)]
    final = {r.url: (r.language, r.offset, r.corrections) for r in first_seen.settled(state.read.parquet(f"{base}/seen")).collect()}
    assert final == {"a": ("w", 3, 0), "b": ("y", 9, 1), "c": ("t", 99, 1)}


def test_state_is_forgotten_after_its_time(spark, state, tmp_path):
    base = str(tmp_path)
    send(spark, f"{base}/topics", [(50, 0, 1, message("a", "x"))])
    assert len(run(state, base, ttl_ms=1)) == 1
    send(spark, f"{base}/topics", [(60, 0, 2, message("a", "y"))])
    assert run(state, base, ttl_ms=1)[1:] == [(1, "a", "y", 2, False)]


def test_state_needs_its_store(spark, tmp_path):
    rows = spark.readStream.format("rate").load().select(
        F.lit("u").alias("url"), F.lit("en").alias("language"), "timestamp", F.lit(0).alias("partition"), F.lit(1).alias("offset")
    )
    with pytest.raises(ValueError, match="RocksDB"):
        first_seen.earliest_messages(rows)


EPOCH = dt.datetime(2024, 1, 1)


def events(spark, path, hours):
    rows = [(k, None if h is None else EPOCH + dt.timedelta(hours=h)) for k, h in hours]
    spark.createDataFrame(rows, "kind string, ts timestamp").coalesce(1).write.mode("append").parquet(path)


def count(spark, base):
    source = spark.readStream.schema("kind string, ts timestamp").parquet(f"{base}/in")
    event_time.count_windows(spark, source, "ts", ["kind"], f"{base}/out", f"{base}/checkpoint").awaitTermination()
    counts = {
        (int((r.window_start - EPOCH).total_seconds() // 3600), r.kind): (r.n, r.closed)
        for r in event_time.counted(spark, f"{base}/out", ["kind"]).collect()
    }
    return counts, event_time.late_rows(spark, f"{base}/out").count()


def test_late_rows_have_a_place(spark, tmp_path):
    base = str(tmp_path)
    # The first micro-batch has no watermark: nothing of it is late.
    events(spark, f"{base}/in", [("a", 0.5), ("a", 0.6), ("b", 5.0)])
    assert count(spark, base) == ({(0, "a"): (2, True), (5, "b"): (1, False)}, 0)
    # Watermark 3:00. The window from 2:00 has ended, that from 3:00 has not; a row without a time is late.
    events(spark, f"{base}/in", [("a", 2.99), ("a", 3.0), ("b", 5.5), (None, 4.0), ("a", None)])
    want = {(0, "a"): (2, True), (3, "a"): (1, False), (4, None): (1, False), (5, "b"): (2, False)}
    assert count(spark, base) == (want, 2)
    # The watermark never goes back, also over a micro-batch without any time.
    events(spark, f"{base}/in", [("a", None)])
    assert count(spark, base) == (want, 3)
    events(spark, f"{base}/in", [("a", 2.0), ("a", 100.0)])
    counts, late = count(spark, base)
    assert late == 4 and counts[(100, "a")] == (1, False) and all(closed for k, (_, closed) in counts.items() if k[0] < 90)


def test_own_window_form(spark, tmp_path):
    base = str(tmp_path)
    events(spark, f"{base}/in", [("a", 0.5), ("a", 0.6), ("b", 5.0)])
    stream = spark.readStream.schema("kind string, ts timestamp").parquet(f"{base}/in")
    for _ in range(2):
        event_time.window_counts(stream, "ts", ["kind"]).writeStream.format("parquet").outputMode("append").option(
            "path", f"{base}/out").option("checkpointLocation", f"{base}/ck").trigger(availableNow=True).start().awaitTermination()
        events(spark, f"{base}/in", [("z", 50.0)])
    closed = {(r.kind, r.n) for r in spark.read.parquet(f"{base}/out").collect()}
    assert ("a", 2) in closed and all(k != "z" for k, _ in closed)


RECORDS = "chunk_id string, source_url string, content string, ingested_at double, language string, source string"


def record(i, content, at, source="s"):
    return (f"c{i}", "u", content, float(at), "en", source)


BATCHES = [
    [record(1, "x", 30), record(2, "y", 10), record(3, "x", 30)],
    [record(0, "x", 30), record(4, "x", 20), record(5, "z", 5), record(6, "x", 40, "t")],
    [record(7, "y", 90), record(8, "w" * 1200, 1), record(9, "", 2), record(2, "y", 10)],
]


@pytest.mark.parametrize("order", list(itertools.permutations(range(3))))
def test_batches_in_any_order_give_silver_over_all(spark, tmp_path, order):
    frames = [spark.createDataFrame(b, RECORDS) for b in BATCHES]
    for number, k in enumerate(order):
        silver_delta.apply_batch(spark, frames[k], str(tmp_path / "silver"), number, buckets=4)
    got = silver_delta.silver_now(spark, str(tmp_path / "silver"))
    want = silver.silver(frames[0].unionByName(frames[1]).unionByName(frames[2]))
    assert sorted(map(tuple, got.select(*want.columns).collect())) == sorted(map(tuple, want.collect()))


def test_only_touched_buckets_are_written_and_replays_replace(spark, tmp_path):
    root = str(tmp_path / "silver")
    frames = [spark.createDataFrame(b, RECORDS) for b in BATCHES]
    with pytest.raises(ValueError):
        silver_delta.current(spark, root)
    first = silver_delta.apply_batch(spark, frames[0].unionByName(frames[2]), root, 0, buckets=64)
    touched = silver_delta.apply_batch(spark, frames[1], root, 1, buckets=64)
    folders = {(int(p.parent.name[7:]), int(p.name[6:])) for p in (tmp_path / "silver").glob("bucket=*/batch=*")}
    assert folders == {(b, 0) for b in first} | {(b, 1) for b in touched} and len(touched) < len({*first, *touched})
    before = sorted(map(tuple, silver_delta.silver_now(spark, root).collect()))
    assert silver_delta.apply_batch(spark, frames[1], root, 1, buckets=64) == touched
    assert sorted(map(tuple, silver_delta.silver_now(spark, root).collect())) == before
    assert silver_delta.apply_batch(spark, frames[1].where(F.lit(False)), root, 2, buckets=64) == []
    assert sorted(map(tuple, silver_delta.silver_now(spark, root).collect())) == before


def test_a_batch_without_a_time_is_refused(spark, tmp_path):
    from siltstone.operators.gate import Policy

    base = str(tmp_path)
    value = json.dumps({"chunk_id": "u::1", "source_url": "u", "content": "good", "ingested_at": 1.0})
    df = spark.createDataFrame([("relevant_chunks", 0, 1, None, value)], "topic string, partition int, offset long, key string, value string")
    topics.write_topic(df.withColumn("timestamp", F.lit(None).cast("timestamp")), "json", f"{base}/topics")
    source = topics.read_topic(spark, "json", f"{base}/topics", ["relevant_chunks"], stream=True)
    jobs.ingest(spark, source, f"{base}/bronze", Policy("p", "d", ["good"]), f"{base}/ck", dead_path=f"{base}/dead").awaitTermination()
    assert [r.error for r in spark.read.parquet(f"{base}/dead").collect()] == ["no message has a time"]
    assert not list((tmp_path / "bronze").rglob("*.json"))


def test_a_payload_is_parsed_once(spark):
    df = spark.createDataFrame([("1", '{"url":"u"}')], "key string, value string")
    from siltstone.schema import DISCOVERY

    for side in topics.decode(df, DISCOVERY, required=("url",)):
        plan = side._jdf.queryExecution().optimizedPlan().toString()
        assert plan.lower().count("from_json") + plan.count("JsonToStructs") == 1


def test_silver_rows_placed_by_bucket_are_not_shuffled_again(frame):
    rows = [("a", "x", "s1", 2.0), ("b", "x", "s1", 1.0), ("c", "x", "s2", 3.0), ("d", "y", "s1", 4.0), ("e", None, "s1", 5.0), ("f", None, "s1", 6.0)]
    df = silver.hashed(frame(rows, "chunk_id string, content string, source string, ingested_at double"))
    placed = df.withColumn("bucket", F.pmod(F.xxhash64("source", "content_hash"), F.lit(4)).cast("int")).repartition(3, "bucket")
    kept = silver.deduped(placed, ["bucket"])
    assert kept._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1
    assert sorted(r["chunk_id"] for r in kept.collect()) == ["b", "c", "d", "e"]
