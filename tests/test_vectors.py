"""Vector operators against brute force, with tiny tiles so every path is taken."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from siltstone.operators import components, vectors as V


def cloud(seed, n, dim=8):
    """Clusters of different density, exact copies, opposite and zero vectors."""
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(6, dim))
    spread = np.array([0.0, 0.01, 0.02, 0.1, 0.3, 1.0])
    which = rng.choice(6, size=n, p=[0.1, 0.35, 0.15, 0.15, 0.15, 0.1])
    points = (centres[which] + rng.normal(size=(n, dim)) * spread[which][:, None]).astype(np.float32)
    points[::17] *= -1
    points[5] = 0
    return points


def table(spark, points):
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(points)]
    rows += [(len(points), None), (len(points) + 1, [float("nan")] * points.shape[1])]
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>")


def similarities(points):
    p = points.astype(np.float64)
    n = np.linalg.norm(p, axis=1)
    with np.errstate(all="ignore"):
        return (p / n[:, None]) @ (p / n[:, None]).T


def components_of(hits):
    label = np.arange(len(hits))
    while True:
        new = np.array([label[np.nonzero(h)[0]].min() if h.any() else l for h, l in zip(hits, label)])
        if (new == label).all():
            return label
        label = new


@pytest.fixture(params=[(7, 32), (64, 1000), (1000, 10)], ids=["tiny", "middle", "one"])
def tiles(request, monkeypatch):
    tile_rows, pivots = request.param
    monkeypatch.setattr(V, "TILE_ROWS", tile_rows)
    monkeypatch.setattr(V, "MAX_PIVOTS", pivots)


@pytest.mark.parametrize("threshold", [0.9, 0.995])
def test_dedup(spark, tiles, threshold):
    points = cloud(3, 220)
    hits = np.nan_to_num(similarities(points), nan=-1) >= threshold - 1e-9
    want = {i for i in range(len(points)) if not hits[i, :i].any()} | {220, 221}
    got = [r.vec_id for r in V.dedup(table(spark, points), threshold).collect()]
    assert sorted(got) == sorted(want)


@pytest.mark.parametrize("max_dist", [0.002, 0.05])
def test_clusters(spark, tiles, max_dist):
    points = cloud(4, 200)
    hits = np.nan_to_num(similarities(points), nan=-1) >= 1 - max_dist - 1e-9
    want = {i: int(l) for i, l in enumerate(components_of(hits)) if i != 5}
    got = {r.vec_id: r.cluster for r in V.similarity_labels(table(spark, points), max_dist).collect()}
    assert got == want


def test_core_members_are_not_compared(spark, monkeypatch):
    """A dense third of the table: core tiles of one cell never meet each other."""
    monkeypatch.setattr(V, "TILE_ROWS", 10)
    monkeypatch.setattr(V, "MAX_PIVOTS", 1)
    rng = np.random.default_rng(0)
    points = (np.ones((100, 4)) + rng.normal(size=(100, 4)) * 1e-4).astype(np.float32)
    dense = V._distinct(table(spark, points), "vec_id", "embedding")
    placed = V._placed(dense, V._pivots(dense, 100), 0.1)
    assert placed.where("core").count() == 100
    pairs = V._tile_pairs(V._tiled(placed, 10)).select("a", "b").distinct().collect()
    assert all(r.a == r.b for r in pairs) and len(pairs) > 5


@pytest.mark.parametrize("limit", [1024, 4])
def test_top_k(spark, monkeypatch, limit):
    monkeypatch.setattr(V, "MAX_QUERIES", limit)
    monkeypatch.setattr(V, "TILE_ROWS", 50)
    points = cloud(5, 180)
    queries = cloud(6, 9)
    q = table(spark, queries).select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("vector"))
    got = {}
    for r in V.top_k_similar(table(spark, points), q, 7).collect():
        got.setdefault(r.query_id, {})[r["rank"]] = r.vec_id
    p, w = points.astype(np.float64), queries.astype(np.float64)
    for i in range(9):
        if i == 5:
            assert i not in got
            continue
        ids = np.array([j for j in range(180) if j != 5])
        s = np.round((p[ids] @ w[i]) / (np.linalg.norm(p[ids], axis=1) * np.linalg.norm(w[i])), 9)
        want = ids[np.lexsort((ids, -s))][:7]
        assert [got[i][k] for k in range(1, 8)] == list(want)


def test_clusters_filters(spark):
    points = np.array([[1, 0], [1, 0.01], [0, 1], [0.01, 1], [0, 1.02], [-1, 0]], dtype=np.float32)
    df = table(spark, points).withColumn("text", F.when(F.col("vec_id") < 2, "a b c d").otherwise("x"))
    sizes = lambda **o: {(r.cluster, r.size, r.n_words) for r in V.clusters(df, 0.01, text="text", **o).collect()}
    assert sizes() == {(0, 2, 8), (2, 3, 3), (5, 1, 1)}
    assert sizes(min_words=2) == {(0, 2, 8), (2, 3, 3)}
    assert sizes(top_k=1) == {(2, 3, 3)}
    assert sizes(query=[1.0, 0.0], sim_threshold=0.5) == {(0, 2, 8)}


@pytest.mark.parametrize("edges", [
    [(i, i + 1) for i in range(40)],  # a path
    [(0, i) for i in range(1, 40)] + [(100, 101)],  # a hub
    [(i, (i * 7 + 3) % 60) for i in range(60)],
    [(5, 5)],
])
def test_connected_components(spark, edges):
    got = {r.id: r.component for r in components.connected_components(spark.createDataFrame(edges, "src long, dst long")).collect()}
    label = {v: v for e in edges if e[0] != e[1] for v in e}
    for _ in label:
        for a, b in edges:
            if a != b:
                label[a] = label[b] = min(label[a], label[b])
    assert got == label


@pytest.mark.parametrize("tile_rows", [8, 4096])
def test_bands_find_nearly_all_and_nothing_else(spark, monkeypatch, tile_rows):
    monkeypatch.setattr(V, "TILE_ROWS", tile_rows)
    points = cloud(4, 260, dim=24)
    similar = np.nan_to_num(similarities(points), nan=-1)
    hits = similar >= 0.95 - 1e-9
    exact = {i for i in range(len(points)) if not hits[i, :i].any()} | {260, 261}
    got = {r.vec_id for r in V.dedup(table(spark, points), 0.95, method="bands", recall=0.97).collect()}
    assert got >= exact and len(got - exact) <= 0.05 * (262 - len(exact)) + 1
    labels = {r.vec_id: r.cluster for r in V.similarity_labels(table(spark, points), 0.05, method="bands", recall=0.97).collect()}
    want = components_of(hits)
    assert all(want[i] == want[c] for i, c in labels.items())
    assert sum(labels[i] == want[i] for i in labels) >= 0.95 * len(labels)


def test_bands_for_a_threshold():
    for threshold in (0.5, 0.8, 0.95, 0.999):
        bands, bits = V.bands_for(threshold, 0.95)
        agree = 1 - np.arccos(threshold) / np.pi
        assert bands <= V.MAX_BANDS and 1 - (1 - agree**bits) ** bands >= 0.95
    with pytest.raises(ValueError):
        V.bands_for(-1.0, 0.95)


def test_bands_with_no_rows_and_other_methods(spark):
    none = table(spark, cloud(1, 20)).where(F.lit(False))
    assert V.dedup(none, 0.9, method="bands").isEmpty() and V.similarity_labels(none, 0.1, method="bands").isEmpty()
    with pytest.raises(ValueError):
        V.dedup(none, 0.9, method="other")


def test_packed_vectors_are_the_same_vectors():
    m = np.array([[0.5, 0.25, 3.0], [0.1, 0.2, 1e300], [1e-320, 1.0, 0.0]])
    packed = V._packed(m)
    assert [v[:1] for v in packed] == [b"f", b"d", b"d"]
    assert (V._directions(packed) == m / np.linalg.norm(m, axis=1, keepdims=True)).all()


def test_small_buckets_share_a_comparison(spark, monkeypatch):
    """Pairs of near copies, of two lengths: far fewer answers than buckets, and the same clusters."""
    rng = np.random.default_rng(4)
    rows = []
    for i in range(60):
        v = rng.normal(size=8 if i % 3 else 5)
        rows += [(i, v.tolist()), (1000 + i, (v * 2).tolist())]
    answers = spark.sparkContext.accumulator(0)
    seen = spark.sparkContext.accumulator(0)
    real = V._directions

    def counted(values):
        answers.add(1)
        seen.add(len(values))
        return real(values)

    monkeypatch.setattr(V, "_directions", counted)
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {tuple(r) for r in V.similarity_labels(df, 0.001, method="bands").collect()}
    assert got == {(i, i) for i in range(60)} | {(1000 + i, i) for i in range(60)}
    assert answers.value * 20 < seen.value
