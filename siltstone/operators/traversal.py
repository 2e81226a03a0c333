"""Breadth-first and best-first frontiers over a link table."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..scale import SaltedEdges, cut_lineage

Predicate = Callable[[Column], Column]


def _found(edges: SaltedEdges, frontier: DataFrame, depth: int, allowed: Predicate | None) -> DataFrame:
    """Targets of the frontier, each with its smallest parent."""
    step = edges.join(frontier.select(F.col("url").alias("src")))
    if allowed is not None:
        step = step.where(allowed(F.col("dst")))
    # A page everyone links to is combined map-side before the shuffle.
    return step.groupBy(F.col("dst").alias("url")).agg(F.min("src").alias("parent")).withColumn("depth", F.lit(depth))


def _walk(
    edges: DataFrame,
    seeds: DataFrame,
    max_depth: int,
    allowed: Predicate | None,
    narrow: Callable[[DataFrame, int], DataFrame],
    budget: int | None,
) -> DataFrame:
    """One job per level; each level is written once and read by the next.

    The levels are disjoint, so the tables written add up to the answer.  The
    links are shuffled once, however many levels there are.
    """
    links = SaltedEdges(edges.select("src", "dst").where(F.col("src") != F.col("dst")).distinct(), "src", "dst")
    try:
        return _levels(links, seeds, edges.schema["src"].dataType, max_depth, allowed, narrow, budget)
    finally:
        links.forget()


def _levels(
    links: SaltedEdges,
    seeds: DataFrame,
    id_type: T.DataType,
    max_depth: int,
    allowed: Predicate | None,
    narrow: Callable[[DataFrame, int], DataFrame],
    budget: int | None,
) -> DataFrame:
    start = seeds.select("url").distinct().select(
        "url", F.lit(None).cast(id_type).alias("parent"), F.lit(0).alias("depth")
    )
    levels: list[DataFrame] = []
    left = budget
    level = start
    for depth in range(max_depth + 1):
        if depth:
            visited = reduce(DataFrame.unionByName, [d.select("url") for d in levels])
            level = _found(links, levels[-1], depth, allowed).join(visited, "url", "left_anti")
            level = narrow(level, depth)
        if left is not None:
            level = level.orderBy("url").limit(left)
        level = cut_lineage(level.select("url", "depth", "parent"), "level")
        size = level.count()
        if not size:
            break
        levels.append(level)
        if left is not None:
            left -= size
            if left <= 0:
                break
    return reduce(DataFrame.unionByName, levels) if levels else start.select("url", "depth", "parent")


def bfs(
    edges: DataFrame,
    seeds: DataFrame,
    max_depth: int,
    max_pages: int | None = None,
    allowed: Predicate | None = None,
) -> DataFrame:
    """(url, depth, parent) reached from `seeds(url)` over `edges(src, dst)`.

    `allowed` judges discovered URLs; seeds are not judged.  A URL keeps its
    first depth and its smallest parent.  `max_pages` takes levels in order and
    the last one in URL order.
    """
    return _walk(edges, seeds, max_depth, allowed, lambda level, _: level, max_pages)


def best_first(
    edges: DataFrame,
    seeds: DataFrame,
    scorer: Predicate,
    beam: int,
    max_depth: int,
    allowed: Predicate | None = None,
) -> DataFrame:
    """(url, depth, parent): per level only the `beam` best new URLs go on.

    `scorer` maps the URL column to a score; ties go to the smaller URL.
    """

    def best(level: DataFrame, _: int) -> DataFrame:
        return level.orderBy(F.desc(F.round(scorer(F.col("url")), 9)), "url").limit(beam)

    return _walk(edges, seeds, max_depth, allowed, best, None)


def traversal_stats(df: DataFrame, status: str = "status", depth: str = "depth") -> DataFrame:
    """One row: URLs processed, failed and skipped, and the deepest level seen."""
    state = F.col(status)
    return df.agg(
        F.count_if(state == "processed").alias("processed"),
        F.count_if(state == "failed").alias("failed"),
        F.count_if(state == "skipped").alias("skipped"),
        F.max(depth).alias("max_depth"),
    )
