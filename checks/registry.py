"""Name -> (Spark query, oracle SQL)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from siltstone.scale import spread

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def check(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query; without SQL only its rows are checked."""

    def add(query: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = query
        if sql is not None:
            ORACLE[name] = sql
        return query

    return add


# Tables of long text, whose rows are worth spreading over all cores.
TEXT_TABLES = {"documents": "doc_id", "pages": "page_id", "conversations": "conv_id"}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return spread(df, TEXT_TABLES[name]) if name in TEXT_TABLES else df
