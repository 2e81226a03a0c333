"""Building blocks that keep a job bounded when data grows or keys are hot."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Sequence
from functools import lru_cache, reduce
from operator import and_

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

# At most this many keys are salted, and only those with this many rows or more.
HOT_KEYS = 1000
HOT_ROWS = 100_000
SALTS = 32
# Bytes of text a task explodes into words or word triples that are combined in memory.
TASK_CHARS = 1 << 23


@lru_cache(maxsize=1)
def _local_dir() -> str:
    return tempfile.mkdtemp(prefix="siltstone-")


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach: `spark.checkpoint.dir`.

    Only a local-mode session (tests) may go without the setting; then one
    temporary folder per process is used.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    return _local_dir()


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame, name: str = "step") -> DataFrame:
    """Write `df` as a parquet table in the shared folder and read it back.

    One pass, columnar, and it outlives a lost executor.
    """
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def spread(df: DataFrame, key: str) -> DataFrame:
    """Use every core on an input of a few files that cannot be split.

    A table with at least one partition per core, as any large one, is returned
    as it is and not shuffled.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores, key)


def text_parts(df: DataFrame, text: str, chars: int | None = None) -> int:
    """Tasks that hold about `chars` (`TASK_CHARS`) bytes of `text` each; one pass over that column."""
    total = df.agg(F.sum(F.octet_length(text).cast("long")).alias("n")).first()["n"] or 0
    return max(1, -(-total // (chars or TASK_CHARS)))


def spread_text(df: DataFrame, text: str, chars: int | None = None) -> DataFrame:
    """Deal rows of text over so many tasks that what one task combines by word fits its memory.

    A map task that combines exploded words of hundreds of megabytes spills them all, in
    the volume of the shuffle itself; moving the texts costs a small part of that. A table
    in enough partitions is returned as it is.
    """
    parts = text_parts(df, text, chars)
    if df.rdd.getNumPartitions() >= parts:
        return df
    # Copies of a text, or of a key, are dealt over all tasks too.
    return df.withColumn("_dealt", F.monotonically_increasing_id()).repartition(parts, "_dealt").drop("_dealt")


def broadcast_if_small(df: DataFrame, max_rows: int = 100_000) -> DataFrame:
    """Hint a broadcast only after the row bound has been checked."""
    return F.broadcast(df) if df.limit(max_rows + 1).count() <= max_rows else df


def running_sum(
    df: DataFrame,
    value: str,
    order: str,
    by: Sequence[str] = (),
    before: str = "before",
    total: str = "total",
    width: int = 1 << 20,
) -> DataFrame:
    """Add the sum of `value` over earlier rows, and the group total.

    `order` is an integer that is unique inside a group.  A plain window would
    sort a whole group in one task; here a group is cut into order ranges of
    `width`, so a task sees at most `width` rows plus one partial per range.
    """
    ranged = df.withColumn("_range", F.floor(F.col(order) / F.lit(width)))
    partial = ranged.groupBy(*by, "_range").agg(F.sum(value).alias("_part"))
    group = W.partitionBy(*by) if by else W.partitionBy(F.lit(0))
    earlier = group.orderBy("_range").rowsBetween(W.unboundedPreceding, -1)
    offsets = partial.select(
        *[F.col(k).alias(f"_by_{k}") for k in by],
        F.col("_range").alias("_offset_range"),
        F.coalesce(F.sum("_part").over(earlier), F.lit(0)).alias("_offset"),
        F.sum("_part").over(group).alias(total),
    )
    match = reduce(
        and_,
        [ranged[k].eqNullSafe(offsets[f"_by_{k}"]) for k in by],
        ranged["_range"].eqNullSafe(offsets["_offset_range"]),
    )
    inside = W.partitionBy(*by, "_range").orderBy(order).rowsBetween(W.unboundedPreceding, -1)
    return (
        ranged.join(offsets, match)
        .withColumn(before, F.col("_offset") + F.coalesce(F.sum(value).over(inside), F.lit(0)))
        .drop("_range", "_offset", "_offset_range", *[f"_by_{k}" for k in by])
    )


def skew_join(
    left: DataFrame,
    right: DataFrame,
    key: str,
    spread: Sequence[str],
    how: str = "inner",
    salts: int = SALTS,
    counts: str | None = None,
    broadcast_rows: int = 0,
) -> DataFrame:
    """Equi-join where a few keys may own much of `left`; `right` is unique by `key`.

    The most frequent keys are salted by a hash of `spread`, and `right` rows
    are copied for them only.  The salt is a pure function of the row, so a
    recomputed task agrees with the first attempt.  Frequent keys come from one
    pass with a mergeable sketch, which finds every key above a small share of
    the rows; or, without that pass, from `counts`, a column of `right` that
    already holds the rows per key.

    Both sides may be large and exploded rows are easily taken for few, so a
    sort-merge join, which spills, is asked for rather than a broadcast; only a
    `right` counted to hold at most `broadcast_rows` rows is broadcast.
    """
    if broadcast_rows and right.limit(broadcast_rows + 1).count() <= broadcast_rows:
        return left.join(F.broadcast(right), key, how)
    if counts:
        # HOT_KEYS rows at most, so it may be broadcast.
        found = F.broadcast(
            right.where(F.col(key).isNotNull() & (F.col(counts) >= HOT_ROWS))
            .orderBy(F.desc(counts), key)
            .limit(HOT_KEYS)
            .select(F.col(key), F.lit(True).alias("_hot"))
        )

        def flag(df: DataFrame) -> DataFrame:
            return df.join(found, key, "left")
    else:
        sketch = f"approx_top_k(`{key}`, {HOT_KEYS}, {10 * HOT_KEYS})"
        top = left.agg(F.expr(sketch).alias("top")).first()["top"] or []
        hot = [t["item"] for t in top if t["item"] is not None and t["count"] >= HOT_ROWS]
        if not hot:
            return left.join(right.hint("merge"), key, how)

        def flag(df: DataFrame) -> DataFrame:
            return df.withColumn("_hot", F.col(key).isin(hot))

    salt = F.when(F.col("_hot"), F.pmod(F.xxhash64(*spread), F.lit(salts)).cast("int")).otherwise(F.lit(0))
    copies = F.explode(F.sequence(F.lit(0), F.when(F.col("_hot"), F.lit(salts - 1)).otherwise(F.lit(0))))
    salted = flag(left).withColumn("_salt", salt).drop("_hot")
    copied = flag(right).withColumn("_salt", copies).drop("_hot")
    return salted.join(copied.hint("merge"), [key, "_salt"], how).drop("_salt")


def lookup_join(left: DataFrame, right: DataFrame, key: str, spread: Sequence[str], counts: str) -> DataFrame:
    """Inner equi-join on a string with a large lookup table, unique by `key`; its `counts` are the rows of `left` per key.

    The rows of `right` for the most frequent keys are broadcast, and the rows of `left` that find
    theirs there are dealt over all tasks by a hash of `spread`. So neither side is copied,
    and a `right` that lies by `key`, as an aggregation leaves it, is not shuffled again.
    """
    rest = [c for c in right.columns if c != key]
    # HOT_KEYS rows at most, so it may be broadcast.
    frequent = right.where(F.col(key).isNotNull() & (F.col(counts) >= HOT_ROWS)).orderBy(F.desc(counts), key).limit(HOT_KEYS)
    hot = F.broadcast(frequent.select(F.col(key).alias("_hot_key"), F.struct(*rest).alias("_hot")))
    placed = left.join(hot, left[key] == hot["_hot_key"], "left")
    # A dealt row that meets another key's row all the same keeps that of `_hot`.
    dealt = F.concat(F.lit("\0"), F.pmod(F.xxhash64(*spread), F.lit(HOT_KEYS)).cast("string"))
    placed = placed.withColumn("_place", F.when(F.col("_hot_key").isNull(), F.col(key)).otherwise(dealt)).drop(key)
    others = right.select(F.col(key).alias("_place"), F.struct(*rest).alias("_row"))
    met = placed.join(others.hint("merge"), "_place", "left").withColumn("_row", F.coalesce("_hot", "_row"))
    met = met.withColumn(key, F.coalesce("_hot_key", "_place"))
    return met.where(F.col("_row").isNotNull()).select(*left.columns, "_row.*")


class SaltedEdges:
    """A table kept on disk bucketed by (key, salt), to be joined many times on `key`.

    It is shuffled once, when it is written; a join shuffles only the other,
    smaller side, copied once per salt.  The salt comes from `spread`, so a key
    that owns much of the table is still split over `salts` buckets.
    """

    def __init__(self, df: DataFrame, key: str, spread: str, salts: int = SALTS) -> None:
        self.spark, self.key, self.salts = df.sparkSession, key, salts
        self.name = f"siltstone_{uuid.uuid4().hex}"
        buckets = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        salted = df.withColumn("_salt", F.pmod(F.xxhash64(spread), F.lit(salts)).cast("int"))
        # One writer per bucket, so that each bucket is one file.
        salted.repartition(buckets, key, "_salt").write.bucketBy(buckets, key, "_salt").option(
            "path", new_path(self.spark, "edges")
        ).saveAsTable(self.name, format="parquet")

    def join(self, keys: DataFrame) -> DataFrame:
        """Rows whose key is in `keys`, a table of that one column."""
        copies = keys.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(self.salts - 1))))
        return self.spark.table(self.name).join(copies, [self.key, "_salt"]).drop("_salt")

    def forget(self) -> None:
        """Drop the name; the files stay with the other scratch tables."""
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")
