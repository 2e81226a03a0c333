"""Choosing the links that close gaps: greedy maximum coverage over gap vectors."""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..scale import cut_lineage
from .vectors import EPSILON, _unit, _usable

TILE_ROWS = 8192
# Rows of a tile that are multiplied at a time.
STEP_ROWS = 1024
# Links whose gain is counted anew in the first small job of a choice; each further one counts twice as many, up to MOST.
ROUND = 64
MOST = 1024


class Covers:
    """Which links cover which gaps, by a question that is asked when needed: the pairs are never stored.

    A link covers a gap when their vectors are within cosine distance `max_dist`. Gaps are the
    question put to all links: tiles of both meet, and a task sees one pair of tiles.
    """

    def __init__(self, links: DataFrame, gaps: DataFrame, max_dist: float, link: str = "link_id", gap: str = "gap_id", vec: str = "vector") -> None:
        self.least = 1.0 - max_dist - EPSILON
        self.links = cut_lineage(links.where(_usable(vec)).select(F.col(link).alias("link"), F.col(vec).alias("vec")).dropDuplicates(["link"]), "links")
        self.gaps = cut_lineage(gaps.where(_usable(vec)).select(F.col(gap).alias("gap"), F.col(vec).alias("vec")).dropDuplicates(["gap"]), "gaps")

    def _tiles(self, links: DataFrame, gaps: DataFrame, answer: Callable, schema: T.StructType) -> DataFrame:
        """`answer(links, gaps, near)` for the rows of every pair of tiles, a step of links at a time."""
        a, b = (max(1, -(-rows.count() // TILE_ROWS)) for rows in (links, gaps))
        placed = links.select(
            F.pmod(F.xxhash64("link"), F.lit(a)).cast("int").alias("a"), F.explode(F.sequence(F.lit(0), F.lit(b - 1))).alias("b"), "link", F.col("vec").alias("lv")
        )
        asked = gaps.select(
            F.explode(F.sequence(F.lit(0), F.lit(a - 1))).alias("a"), F.pmod(F.xxhash64("gap"), F.lit(b)).cast("int").alias("b"), "gap", F.col("vec").alias("gv")
        )
        least = self.least

        def run(one: pd.DataFrame, other: pd.DataFrame) -> pd.DataFrame:
            out = [pd.DataFrame(columns=schema.names)]
            if len(one) and len(other):
                left, right = _unit(one["lv"]), _unit(other["gv"])
                names, asked_of = one["link"].to_numpy(), other["gap"].to_numpy()
                for i in range(0, len(left), STEP_ROWS):
                    out.append(answer(names[i : i + STEP_ROWS], asked_of, left[i : i + STEP_ROWS] @ right.T >= least))
            return pd.concat(out[1:] or out, ignore_index=True)

        return placed.groupBy("a", "b").cogroup(asked.groupBy("a", "b")).applyInPandas(run, schema)

    def pairs(self, links: Sequence | None = None) -> DataFrame:
        """(link, gap), of some links or of all."""

        def both(names: np.ndarray, asked: np.ndarray, near: np.ndarray) -> pd.DataFrame:
            i, j = np.nonzero(near)
            return pd.DataFrame({"link": names[i], "gap": asked[j]})

        some = self.links if links is None else self.links.where(F.col("link").isin(list(links)))
        return self._tiles(some, self.gaps, both, T.StructType([self.links.schema["link"], self.gaps.schema["gap"]]))

    def gains(self, links: Sequence | None, closed: DataFrame) -> DataFrame:
        """(link, n): how many gaps not in `closed` a link covers, of some links or of all; links without one may lack."""

        def sums(names: np.ndarray, asked: np.ndarray, near: np.ndarray) -> pd.DataFrame:
            return pd.DataFrame({"link": names, "n": near.sum(axis=1)})

        some = self.links if links is None else self.links.where(F.col("link").isin(list(links)))
        still = cut_lineage(self.gaps.join(closed, "gap", "left_anti"), "open")
        counted = self._tiles(some, still, sums, T.StructType([self.links.schema["link"], T.StructField("n", T.LongType())]))
        return counted.groupBy("link").agg(F.sum("n").alias("n")).where("n > 0")

    def no_gap(self) -> DataFrame:
        return self.gaps.select("gap").limit(0)


class _Listed(Covers):
    """The same from a table of pairs (link, gap)."""

    def __init__(self, pairs: DataFrame) -> None:
        self.listed = cut_lineage(pairs.select("link", "gap").distinct(), "covers")

    def pairs(self, links: Sequence | None = None) -> DataFrame:
        return self.listed if links is None else self.listed.where(F.col("link").isin(list(links)))

    def gains(self, links: Sequence | None, closed: DataFrame) -> DataFrame:
        return self.pairs(links).join(closed, "gap", "left_anti").groupBy("link").agg(F.count(F.lit(1)).alias("n"))

    def no_gap(self) -> DataFrame:
        return self.listed.select("gap").limit(0)


def covers(
    links: DataFrame, gaps: DataFrame, max_dist: float, link: str = "link_id", gap: str = "gap_id", vec: str = "vector"
) -> DataFrame:
    """(link, gap) where the link's vector is within cosine distance `max_dist` of the gap's; see `Covers`."""
    return Covers(links, gaps, max_dist, link, gap, vec).pairs()


def gap_filling_links(covered_by: DataFrame | Covers, k: int) -> DataFrame:
    """(rank, link, gain): `k` links, each the one that covers most gaps still open; ties go to the smaller link.

    `covered_by`: a table (link, gap), or `Covers`, whose pairs need no place however many they are.
    What a link gains only shrinks, so an old count bounds it: each choice counts anew,
    some at a time, the links whose bound may still win, and all links at once where that does not decide.
    The driver holds those few counts and the choices; the gaps that are closed stay in a table.
    """
    source = covered_by if isinstance(covered_by, Covers) else _Listed(covered_by)
    closed = source.no_gap()
    bounds = cut_lineage(source.gains(None, closed), "bounds")
    spark = bounds.sparkSession
    known: dict = {}
    chosen: list[tuple] = []
    while len(chosen) < k:
        fresh: dict = {}
        size = ROUND
        while True:
            best = min(((-n, link) for link, n in fresh.items()), default=(0, None))
            unknown = bounds.where(~F.col("link").isin([*known, *[c[1] for c in chosen]])).orderBy(F.desc("n"), "link").limit(size).collect()
            stale = [(-n, link) for link, n in known.items() if link not in fresh] + [(-r["n"], r["link"]) for r in unknown]
            ahead = sorted(x for x in stale if best[1] is None or x < best)[:size]
            if not ahead:
                break
            if size > MOST:
                bounds, known, fresh = cut_lineage(source.gains(None, closed), "bounds"), {}, {}
                first = bounds.where(~F.col("link").isin([c[1] for c in chosen])).orderBy(F.desc("n"), "link").limit(1).collect()
                best = (-first[0]["n"], first[0]["link"]) if first else (0, None)
                break
            some = [link for _, link in ahead]
            found = {r["link"]: r["n"] for r in source.gains(some, closed).collect()}
            for link in some:
                known[link] = fresh[link] = found.get(link, 0)
            size *= 2
        if best[1] is None or best[0] == 0:
            break
        chosen.append((len(chosen) + 1, best[1], -best[0]))
        known.pop(best[1], None)
        if len(chosen) < k:
            closed = cut_lineage(closed.unionByName(source.pairs([best[1]]).select("gap")).distinct(), "closed")
    kinds = T.StructType([T.StructField("rank", T.IntegerType()), bounds.schema["link"], T.StructField("gain", T.LongType())])
    return spark.createDataFrame(chosen, kinds)
