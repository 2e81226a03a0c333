"""Greedy coverage against a plain greedy."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from siltstone.operators import gap_links


def greedy(pairs, k):
    sets, out = {}, []
    for link, gap in pairs:
        sets.setdefault(link, set()).add(gap)
    closed = set()
    while len(out) < k:
        link, gain = min(((x, len(s - closed)) for x, s in sets.items() if x not in [o[1] for o in out]), key=lambda x: (-x[1], x[0]), default=(None, 0))
        if not gain:
            break
        out.append((len(out) + 1, link, gain))
        closed |= sets[link]
    return out


@pytest.mark.parametrize("size", [3, 64])
def test_choices_equal_a_plain_greedy(spark, monkeypatch, size):
    monkeypatch.setattr(gap_links, "ROUND", size)
    rng = random.Random(size)
    pairs = [(link, gap) for link in range(30) for gap in rng.sample(range(60), rng.randint(1, 12))]
    pairs += [(100, g) for g in range(20)] + pairs[:5]
    df = spark.createDataFrame(pairs, "link long, gap long")
    assert [tuple(r) for r in gap_links.gap_filling_links(df, 5).orderBy("rank").collect()] == greedy(pairs, 5)
    few = df.where("link < 2")
    assert [tuple(r) for r in gap_links.gap_filling_links(few, 9).collect()] == greedy([p for p in pairs if p[0] < 2], 9)
    assert gap_links.gap_filling_links(df.where(F.lit(False)), 3).isEmpty()


def test_covers_equals_all_cosines(spark, monkeypatch):
    monkeypatch.setattr(gap_links, "TILE_ROWS", 7)
    rng = np.random.default_rng(2)
    x, y = rng.normal(size=(25, 6)), rng.normal(size=(18, 6))
    links = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)] + [(90, None), (91, [0.0] * 6)], "link_id long, vector array<double>")
    gaps = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(y)] + [(90, None)], "gap_id long, vector array<double>")
    got = {tuple(r) for r in gap_links.covers(links, gaps, 0.6).collect()}
    unit = lambda m: m / np.linalg.norm(m, axis=1, keepdims=True)
    assert got == {(i, j) for i, j in zip(*np.nonzero(unit(x) @ unit(y).T >= 0.4))}


@pytest.mark.parametrize("most", [1, 1024])
def test_choices_store_no_pairs(spark, monkeypatch, most):
    monkeypatch.setattr(gap_links, "TILE_ROWS", 16)
    monkeypatch.setattr(gap_links, "STEP_ROWS", 5)
    monkeypatch.setattr(gap_links, "ROUND", 2)
    monkeypatch.setattr(gap_links, "MOST", most)
    written = {}
    monkeypatch.setattr(gap_links, "cut_lineage", lambda df, name, cut=gap_links.cut_lineage: written.setdefault((name, len(written)), cut(df, name)))
    rng = np.random.default_rng(3)
    x, y = rng.normal(size=(60, 4)), rng.normal(size=(50, 4))
    links = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)] + [(90, None)], "link_id long, vector array<double>")
    gaps = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(y)], "gap_id long, vector array<double>")
    unit = lambda m: m / np.linalg.norm(m, axis=1, keepdims=True)
    pairs = list(zip(*(a.tolist() for a in np.nonzero(unit(x) @ unit(y).T >= 0.4))))
    got = gap_links.gap_filling_links(gap_links.Covers(links, gaps, 0.6), 9)
    assert [tuple(r) for r in got.orderBy("rank").collect()] == greedy(pairs, 9)
    assert len(pairs) > 60 and all(df.count() <= 60 for df in written.values())
