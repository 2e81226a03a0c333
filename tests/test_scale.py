"""Prefix sums, salted joins, scratch tables."""

import random

import pytest
from pyspark.sql import functions as F

from siltstone import scale
from siltstone.operators.records import group_flush


def test_running_sum(frame):
    rng = random.Random(1)
    rows = [(g, o, rng.randrange(10)) for g in ("a", None, "b") for o in rng.sample(range(500), 60)]
    got = scale.running_sum(frame(rows, "g string, o int, v int"), "v", "o", by=["g"], width=7).collect()
    assert len(got) == len(rows)
    for r in got:
        same = [x for x in rows if x[0] == r.g]
        assert r.before == sum(x[2] for x in same if x[1] < r.o)
        assert r.total == sum(x[2] for x in same)


def test_running_sum_without_groups(frame):
    rows = [(o, 1) for o in range(-50, 200)]
    got = scale.running_sum(frame(rows, "o int, v int"), "v", "o", width=16).collect()
    assert all(r.before == r.o + 50 and r.total == 250 for r in got)


@pytest.mark.parametrize("counts", [None, "n"])
@pytest.mark.parametrize("hot_keys, hot_rows", [(2, 1), (1000, 5), (1000, 10**6)])
@pytest.mark.parametrize("how", ["inner", "left"])
def test_skew_join(frame, how, hot_keys, hot_rows, counts, monkeypatch):
    monkeypatch.setattr(scale, "HOT_KEYS", hot_keys)
    monkeypatch.setattr(scale, "HOT_ROWS", hot_rows)
    rows = [(i, "hot" if i % 3 == 0 else f"k{i % 50}") for i in range(600)] + [(1000, None), (1001, "absent")]
    left = frame(rows, "i int, k string")
    right = frame([("hot", 1, 200), *[(f"k{i}", i + 2, 8) for i in range(50)], ("unused", 99, 0)], "k string, v int, n int")
    joined = scale.skew_join(left, right, "k", ["i"], how, counts=counts).select("i", "k", "v", "n")
    order = lambda df: sorted(df.collect(), key=lambda r: r.i)
    assert order(joined) == order(left.join(right, "k", how).select("i", "k", "v", "n"))


def test_cut_lineage_and_shared_dir(spark, frame):
    df = frame([(1, "a"), (2, None)], "i int, s string")
    cut = scale.cut_lineage(df.withColumn("j", F.col("i") * 2))
    assert sorted(map(tuple, cut.collect())) == [(1, "a", 2), (2, None, 4)]
    assert "Scan parquet" in cut._jdf.queryExecution().toString() or "FileScan parquet" in cut._jdf.queryExecution().toString()


class _Conf:
    def __init__(self, values):
        self.values = values

    def get(self, key, default=None):
        return self.values.get(key, default)


class _Session:
    def __init__(self, **values):
        self.conf = _Conf({k.replace("_", "."): v for k, v in values.items()})


def test_shared_dir_follows_the_cluster():
    assert scale.shared_dir(_Session(spark_master="yarn", **{"spark.checkpoint.dir": "hdfs:///ck/"})) == "hdfs:///ck"
    with pytest.raises(ValueError):
        scale.shared_dir(_Session(spark_master="yarn"))


def test_broadcast_only_below_the_bound(frame):
    df = frame([(i,) for i in range(10)], "i int")
    hinted = lambda d: "broadcast" in d._jdf.queryExecution().logical().toString()
    assert hinted(scale.broadcast_if_small(df, 10)) and not hinted(scale.broadcast_if_small(df, 9))


@pytest.mark.parametrize("n, ready", [(1, 0), (4, 0), (5, 5), (9, 5), (10, 10), (12, 10)])
def test_group_buffer(frame, n, ready):
    df = frame([("k", i) for i in range(n)], "source_url string, offset int")
    rows = group_flush(df, min_group=5).collect()
    assert {r.offset for r in rows if r.ready} == set(range(ready))
    assert group_flush(df).where("ready").count() == n


def test_spread_text_bounds_a_task(spark):
    rows = spark.range(200).coalesce(1).select("id", F.concat(F.lit("x" * 95), F.lpad(F.col("id").cast("string"), 5, "0")).alias("t"))
    dealt = scale.spread_text(rows, "t", 1000)
    sizes = [r["n"] for r in dealt.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
    assert dealt.rdd.getNumPartitions() == 20 and max(sizes) < 40
    assert sorted(map(tuple, dealt.collect())) == sorted(map(tuple, rows.collect()))
    assert scale.spread_text(rows, "t", 100_000) is rows


@pytest.mark.parametrize("hot_rows", [1, 5, 10_000])
def test_lookup_join_equals_a_join(frame, monkeypatch, hot_rows):
    monkeypatch.setattr(scale, "HOT_ROWS", hot_rows)
    monkeypatch.setattr(scale, "HOT_KEYS", 3)
    keys = ["a"] * 30 + ["b"] * 7 + ["c", "d", "e", "\x000", None, "only left"]
    left = frame(list(enumerate(keys)), "i int, k string")
    right = frame([("a", 30, 1), ("b", 7, None), ("c", 1, 3), ("d", 1, 4), ("e", 1, 5), ("\x000", 1, 6), (None, 1, 7), ("only right", 1, 8)], "k string, n int, v int")
    got = scale.lookup_join(left, right, "k", ["i"], "n").select("i", "k", "n", "v").collect()
    assert sorted(map(str, got)) == sorted(map(str, left.join(right, "k").select("i", "k", "n", "v").collect()))
