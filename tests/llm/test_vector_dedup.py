"""Links and components against all cosines, and the defined cases of the docstring."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from siltstone.llm import vector_dedup

SCHEMA = "vec_id long, embedding array<double>, label int, node string, root string"


def brute(rows, cosine=0.95):
    def fine(v):
        return bool(v) and all(x is not None and math.isfinite(x) for x in v) and any(v)

    def cos(a, b):
        a, b = (np.array(x) / max(map(abs, x)) for x in (a, b))
        return float(a @ b / np.linalg.norm(a) / np.linalg.norm(b))

    n = len(rows)
    near = [[] for _ in range(n)]
    for i in range(n):
        for j in range(i):
            a, b = rows[i][1], rows[j][1]
            if fine(a) and fine(b) and len(a) == len(b) and cos(a, b) >= cosine:
                near[i].append(j)
                near[j].append(i)
    out, root = [], {}
    for i in range(n):
        if i in root:
            continue
        group, todo = {i}, [i]
        while todo:
            for j in near[todo.pop()]:
                if j not in group:
                    group.add(j)
                    todo.append(j)
        least = min((rows[j][0] for j in group if rows[j][0] is not None), default=None)
        root |= {j: least for j in group}
    for i, (vec_id, _) in enumerate(rows):
        out.append((vec_id, len(near[i]), root[i], vec_id == root[i]))
    return sorted(out, key=str)


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 1, "n", "r") for i, v in rows], SCHEMA)


def made(rng, n, dims=64):
    """Random vectors; a third are near one of them, at cosines around the threshold, and some chains of near copies."""
    rows = [[rng.gauss(0, 1) for _ in range(dims)] for _ in range(n)]
    for k in range(n // 3):
        spread = rng.choice((0.1, 0.25, 0.33, 0.4))
        rows[k] = [x + rng.gauss(0, spread) for x in rows[n - 1]]
    for k in range(n // 3, n // 2):
        rows[k] = [x + rng.gauss(0, 0.3) for x in rows[k - 1 if k % 4 else n - 2]]
    ids = list(range(n))
    rng.shuffle(ids)
    return list(zip(ids, rows))


@pytest.mark.parametrize("lists, block", [(1, 4096), (9, 4096), (9, 16)])
def test_links_and_components_equal_all_cosines(spark, lists, block):
    rows = made(random.Random(lists), 240)
    out = got(vector_dedup.near_duplicates(frame(spark, rows), lists=lists, block=block, sample=100))
    assert out == brute(rows) and any(r[1] for r in out)


def test_odd_vectors_repeats_and_lengths(spark):
    rng = random.Random(6)
    rows = made(rng, 30)
    rows += [rows[0], rows[0], (900, rows[1][1]), (None, rows[0][1]), (None, [9.0] * 64)]
    rows += [(901, [2.0 * x for x in rows[2][1]]), (902, [1e300 * x for x in rows[2][1]]), (903, [1e-300 * x for x in rows[2][1]])]
    rows += [(500, None), (501, []), (502, [0.0] * 64), (503, [None, *[1.0] * 63]), (504, [math.nan, *[1.0] * 63]), (505, [math.inf, *[1.0] * 63])]
    rows += [(None, None), (None, [0.0])]
    rows += [(600 + i, [1.0, 0.01 * i, 0.0]) for i in range(5)] + [(700, [-3.0]), (701, [5.0]), (702, [0.1])]
    df = frame(spark, rows)
    want = brute(rows)
    # A null id in a component without another id is its own representative.
    want = sorted(((i, n, c, i == c if i is not None else c is None) for i, n, c, _ in want), key=str)
    assert got(vector_dedup.near_duplicates(df, lists=4)) == want
    # Lengths that the sample lacks are one list.
    assert got(vector_dedup.near_duplicates(df, lists=4, sample=2)) == want
    none = vector_dedup.near_duplicates(df.where(F.lit(False)))
    assert none.columns == ["vec_id", "n_links", "component_id", "kept"] and none.isEmpty()


def test_candidates_are_few_and_narrow_reach_keeps_recall():
    """The index on its own: share of pairs reranked, and recall of fewer probes."""
    rng = np.random.default_rng(8)
    x = rng.normal(size=(1500, 64))
    x[:400] = x[1499] + rng.normal(size=(400, 64)) * 0.3
    x[400:700] = x[700:1000] + rng.normal(size=(300, 64)) * 0.28
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    all_links = (np.triu(x @ x.T, 1) >= 0.95).sum()
    model = vector_dedup.fit(x[rng.permutation(1500)], 16)

    def run(reach):
        home, probes, codes, miss = model.encode(x, reach * math.sqrt(0.1) / 2)
        import pandas as pd

        rows = pd.DataFrame(
            {"node": range(1500), "weight": 1, "home": home, "probes": probes, "codes": [c.tobytes() for c in codes], "miss": miss, "unit": [r.tobytes() for r in x]}
        )
        links = reranked = 0
        for k in range(len(model.centroids)):
            asks = rows[[k in p for p in probes]]
            found, n = vector_dedup.links_in_block(asks, rows[home == k], k, model, 0.95, step=64)
            links, reranked = links + found["links"].sum(), reranked + n
        return links / 2, reranked

    links, reranked = run(1.0)
    assert links == all_links and reranked < 0.1 * 1500 * 1499 / 2
    assert run(0.4)[0] >= 0.95 * all_links


def test_spanning_labels():
    rng = random.Random(1)
    for _ in range(20):
        n = rng.randint(1, 40)
        links = [(rng.randrange(n), rng.randrange(n)) for _ in range(rng.randint(0, 40))]
        want = list(range(n))
        for _ in range(n):
            for a, b in links:
                want[a] = want[b] = min(want[a], want[b])
        a, b = np.array([x[0] for x in links], int), np.array([x[1] for x in links], int)
        assert vector_dedup.spanning(a, b, n).tolist() == want
