"""The visited table: bytes read per micro-batch, answers before and after compaction, stopped jobs."""

import pytest
from pyspark.sql import functions as F

from siltstone.sources.visited import Generation, Visited, bucket_of

ROWS = 400


def urls(spark, first, count):
    return spark.range(first, first + count).select(F.concat(F.lit("https://h.org/"), F.col("id").cast("string")).alias("url"))


def write(spark, path, first, count):
    """Micro-batches first .. first + count - 1 of ROWS URLs each, in one job."""
    rows = spark.range(first * ROWS, (first + count) * ROWS).select(
        F.concat(F.lit("https://h.org/"), F.col("id").cast("string")).alias("url"), F.expr(f"id div {ROWS}").alias("batch")
    )
    rows.repartition(4, "batch").write.mode("append").partitionBy("batch").parquet(path)


def bytes_read(spark, run):
    stats = spark._jvm.org.apache.hadoop.fs.FileSystem.getAllStatistics
    total = lambda: sum(s.getBytesRead() for s in stats())
    before = total()
    result = run()
    return result, total() - before


def test_bytes_read_stay_constant_over_200_batches(spark, tmp_path):
    visited = Visited(spark, f"{tmp_path}/visited", per_bucket=500)
    read = {}
    for end in range(20, 201, 20):
        write(spark, visited.path, end - 20, 20)
        visited.compact_if_due(end, 20)
        assert visited.current().upto == end - 1
        # Ten URLs that were visited, the oldest among them, and ten that were not.
        asked = urls(spark, 0, 5).unionByName(urls(spark, end * ROWS - 5, 15)).persist()
        found, read[end] = bytes_read(spark, lambda: sorted(r.url for r in visited.among(asked, end).collect()))
        want = {*range(5), *range(end * ROWS - 5, end * ROWS)}
        assert found == sorted(f"https://h.org/{i}" for i in want)
    assert visited.current().buckets == 256
    assert read[200] < 1.6 * read[60]
    # Unpruned, the lookup would read the whole index.
    whole = bytes_read(spark, lambda: visited.urls(200).select(F.max("url")).collect())[1]
    assert read[200] < 0.35 * whole


def test_partitions_are_pruned_by_the_urls_asked_for(spark, tmp_path):
    visited = Visited(spark, f"{tmp_path}/visited", per_bucket=100)
    write(spark, visited.path, 0, 3)
    assert visited.compact(3).buckets == 16
    asked = urls(spark, 0, 3)
    want = sorted({r.b for r in asked.select(bucket_of("url", 16).alias("b")).collect()})
    plan = visited.among(asked, 3)._jdf.queryExecution().executedPlan().toString()
    assert f"PartitionFilters: [bucket#" in plan and f"IN ({','.join(map(str, want))})" in plan
    assert visited.among(asked, 3).count() == 3


def test_same_answers_before_and_after_and_with_newer_batches(spark, tmp_path):
    visited = Visited(spark, f"{tmp_path}/visited", per_bucket=300)
    write(spark, visited.path, 0, 4)
    asked = urls(spark, 3 * ROWS - 100, 3 * ROWS)

    def answers(batch):
        return sorted(r.url for r in visited.among(asked, batch).collect())

    before = {b: answers(b) for b in (3, 4)}
    assert len(before[4]) == ROWS + 100 and len(before[3]) == 100
    assert visited.compact(3) == Generation(1, 4, 2)
    assert {b: answers(b) for b in (3, 4)} == before
    assert visited.compact(3) == Generation(1, 4, 2)  # nothing new
    assert visited.compact(4).number == 2 and answers(4) == before[4]
    assert sorted(r.url for r in visited.urls(4).collect()) == sorted(r.url for r in urls(spark, 0, 4 * ROWS).collect())


def test_a_compaction_that_stops_leaves_the_old_index(spark, tmp_path, monkeypatch):
    visited = Visited(spark, f"{tmp_path}/visited", per_bucket=300)
    write(spark, visited.path, 0, 2)
    visited.compact(1)

    def stop(new):
        raise RuntimeError("driver lost")

    monkeypatch.setattr(visited, "_name", stop)
    with pytest.raises(RuntimeError):
        visited.compact(2)
    monkeypatch.undo()
    assert visited.current().upto == 0
    assert visited.among(urls(spark, 0, 2 * ROWS), 2).count() == 2 * ROWS
    assert visited.compact(2).upto == 1
    assert visited.among(urls(spark, 0, 2 * ROWS), 2).count() == 2 * ROWS


def test_empty_batches_and_buckets(spark, tmp_path):
    visited = Visited(spark, f"{tmp_path}/visited")
    assert visited.among(urls(spark, 0, 3), 0).isEmpty() and visited.current() == Generation()
    urls(spark, 0, 0).write.parquet(f"{visited.path}/batch=0")
    assert visited.compact(1).buckets == 1
    assert visited.among(urls(spark, 0, 3), 1).isEmpty()
    spread = urls(spark, 0, 1000).select(bucket_of("url", 8).alias("b")).distinct().count()
    assert spread == 8
