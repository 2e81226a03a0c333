"""Visited filter and crawl counters."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def first_seen(df: DataFrame, key: str = "url") -> DataFrame:
    """The earliest message per URL by (timestamp, partition, offset).

    `min_by` is combined in the map tasks, so a URL sent a million times costs
    one row per task in the shuffle.
    """
    others = [c for c in df.columns if c != key]
    first = F.min_by(F.struct(*others), F.struct("timestamp", "partition", "offset"))
    return df.groupBy(key).agg(first.alias("_first")).select(key, *[F.col(f"_first.{c}").alias(c) for c in others])


def unvisited(df: DataFrame, visited: DataFrame, key: str = "url") -> DataFrame:
    """First messages of URLs that are not in `visited`.

    Repeats go first: what is joined is one row per URL, already partitioned by it.
    """
    return first_seen(df, key).join(visited.select(key), key, "left_anti")


def counters(df: DataFrame, url: str = "url", status: str = "status") -> DataFrame:
    """One row from a discovery log: distinct URLs `visited`, URLs whose crawl was
    started (`discovered`, once each) and crawls that succeeded (`processed`)."""
    per_url = df.groupBy(url).agg(F.count_if(F.col(status) == "processed").alias("_done"))
    return per_url.agg(
        F.count(F.lit(1)).alias("visited"),
        F.count(F.lit(1)).alias("discovered"),
        F.count_if(F.col("_done") > 0).alias("processed"),
    )


def session_summary(df: DataFrame, seed: str = "seed", url: str = "url") -> DataFrame:
    """Pages and chunks per crawl session."""
    return df.groupBy(seed).agg(F.countDistinct(url).alias("pages"), F.count(F.lit(1)).alias("chunks"))
