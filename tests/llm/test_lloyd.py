"""Exact Lloyd rounds against plain integers, and the defined cases of the docstring."""

import hashlib
import math
import random

import pytest
from pyspark.sql import functions as F

from siltstone.llm import lloyd

SCHEMA = "vec_id long, embedding array<double>, cluster int, shard int, tile string"


def brute(rows, k=8, rounds=10, scale=1024):
    points = sorted(
        ((hashlib.sha256(f"3:{i}".encode()).hexdigest() if i is not None else "~", tuple(math.floor(scale * x) for x in v)), i) for i, v in rows
    )
    points = [(i, v) for (_, v), i in points]
    centroids = [v for _, v in points[:k]]

    def near(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), n) for n, c in enumerate(centroids))

    for _ in range(rounds):
        groups = {}
        for _, v in points:
            groups.setdefault(near(v)[1], []).append(v)
        centroids = [tuple(sum(x) // len(groups[n]) for x in zip(*groups[n])) if n in groups else c for n, c in enumerate(centroids)]
    found = [(i, *near(v)) for i, v in points]
    total = {n: sum(d for _, d, m in found if m == n) for _, _, n in found}
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return sorted(((i, n, d, total[n], sum(total.values()), sha[n]) for i, d, n in found), key=str)


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def made(rng, n, dims=64):
    heart = [[rng.gauss(0, 1) for _ in range(dims)] for _ in range(3)]
    # A third of all rows lies in one spot.
    return [(i, [x + rng.gauss(0, 0.01 if i % 3 == 0 else 0.7) for x in heart[0 if i % 3 == 0 else i % 2 + 1]]) for i in range(n)]


@pytest.mark.parametrize("chunk", [7, 4096])
def test_rounds_equal_plain_integers(spark, chunk):
    rows = made(random.Random(4), 90)
    df = spark.createDataFrame([(i, v, 1, 2, "t") for i, v in rows], SCHEMA)
    assert got(lloyd.cluster(df, chunk=chunk, rounds=3)) == brute(rows, rounds=3)


def test_vectors_left_out_repeats_ties_and_large_numbers(spark):
    rng = random.Random(9)
    rows = made(rng, 12)
    rows += [rows[0], rows[0], (5, rows[1][1]), (None, [0.5] * 64), (40, [100000.0, -100000.0] * 32), (41, [-1e-9] * 64)]
    odd = [
        (50, None), (51, []), (52, [1.0] * 63), (53, [1.0] * 65), (54, [None] + [1.0] * 63), (55, [float("nan")] + [1.0] * 63),
        (56, [float("inf")] + [1.0] * 63), (57, [1e300] + [0.0] * 63), (None, None),
    ]
    df = spark.createDataFrame([(i, v, None, 0, None) for i, v in rows + odd], SCHEMA)
    assert got(lloyd.cluster(df, rounds=2)) == brute(rows, rounds=2)
    few = spark.createDataFrame([(i, v, 0, 0, "") for i, v in rows[:3]], SCHEMA)
    assert got(lloyd.cluster(few, rounds=1)) == brute(rows[:3], rounds=1)
    for none in (df.where(F.lit(False)), df.where("vec_id >= 50")):
        out = lloyd.cluster(none)
        assert out.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"] and out.isEmpty()


def test_other_shapes(spark):
    rows = made(random.Random(2), 40, dims=5)
    df = spark.createDataFrame([(f"v{i}", v) for i, v in rows], "name string, x array<double>")
    out = lloyd.cluster(df, "name", "x", k=3, dims=5, rounds=2, shards=2, chunk=8)
    assert got(out) == brute([(f"v{i}", v) for i, v in rows], k=3, rounds=2)


def test_vectors_are_not_shuffled_again(spark):
    rows = made(random.Random(3), 40)
    points = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    test, ints = lloyd.fixed_point("embedding", 64, 1024)
    tiles = lloyd.Tiles(points.select(F.col("vec_id").alias("id"), ints.alias("ints")), 64, 4, 8)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        back = tiles.rows().select("chunk", "shard").distinct().withColumn("near", F.lit(1))
        plan = tiles.rows().select("chunk", "shard", "tile").join(back, ["chunk", "shard"])._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan.replace("AdaptiveSparkPlan", "")
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        tiles.forget()
