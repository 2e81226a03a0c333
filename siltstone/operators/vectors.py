"""Neighbours, near duplicates and clusters of vectors.

All answers are exact.  The angle between vectors is a metric, so a few pivots
split the table into cells: a vector lives in the cell of its nearest pivot and
visits another cell only where its angle to that pivot exceeds its nearest one
by no more than twice the search angle - elsewhere it cannot meet anyone.  Cells
are cut into tiles of bounded size, and a task compares one pair of tiles with a
matrix product.  Tasks never emit the pairs they find, only what the answer
needs: at most one row per vector of the two tiles.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

from ..functions.text import words
from ..functions.vectors import cosine, norm
from ..scale import cut_lineage, skew_join
from .components import connected_components

TILE_ROWS = 16384
# Rows of a tile that are multiplied at a time, and rows of a bucket or a batch that meet at once.
STEP_ROWS = 1024
BUCKET_ROWS = 4096
SHARED_ROWS = 128
MAX_PIVOTS = 4096
MAX_QUERIES = 1024
# Rows placed at a time: bounds the matrix of angles to all pivots.
PLACE_ROWS = 1024
# Float noise: similarities this close to a threshold count as reaching it.
EPSILON = 1e-9
# Bands at most, and bits of a band at most.
MAX_BANDS = 64
MAX_BITS = 24
# Slack on angles, on the safe side wherever a comparison may be skipped.
SLACK = 1e-6


def _unit(values: pd.Series) -> np.ndarray:
    m = np.array(values.tolist(), dtype=np.float64)
    return m / np.linalg.norm(m, axis=1, keepdims=True)


def _packed(m: np.ndarray) -> np.ndarray:
    """Every row as bytes, in single precision where that loses nothing: vectors travel and wait like this."""
    with np.errstate(over="ignore"):
        short = m.astype(np.float32)
    out = np.empty(len(m), dtype=object)
    for i, exact in enumerate((short == m).all(axis=1)):
        out[i] = b"f" + short[i].tobytes() if exact else b"d" + m[i].tobytes()
    return out


def _directions(values: np.ndarray) -> np.ndarray:
    """The packed vectors at unit length."""
    m = np.array([np.frombuffer(v, np.float32 if v[:1] == b"f" else np.float64, offset=1) for v in values], dtype=np.float64)
    return m / np.linalg.norm(m, axis=1, keepdims=True)


def _angles(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(a @ b.T, -1.0, 1.0))


def _usable(vec: str) -> Column:
    """Has a direction: not null, not zero, only finite numbers."""
    n = norm(vec)
    return F.coalesce((n > 0) & (n < F.lit(float("inf"))), F.lit(False))


def _distinct(df: DataFrame, key: str, vec: str) -> DataFrame:
    """One row per vector value, `id` its smallest key.  Copies collapse map-side."""
    usable = df.where(_usable(vec))
    return usable.groupBy(_positive_zero(vec).alias("vec")).agg(F.min(key).alias("id"))


def _positive_zero(vec: str) -> Column:
    """Doubles without negative zeros, so that equal vectors also print alike."""
    return F.transform(F.col(vec), lambda x: x.cast("double") + F.lit(0.0))


def _pivots(points: DataFrame, n: int) -> np.ndarray:
    """A bounded, repeatable choice of vectors: those of the smallest id hashes."""
    count = max(1, min(MAX_PIVOTS, math.ceil(n / TILE_ROWS)))
    rows = points.orderBy(F.xxhash64("id"), "id").limit(count).collect()
    return _unit(pd.Series([r["vec"] for r in rows]))


def _placed(points: DataFrame, pivots: np.ndarray, angle: float) -> DataFrame:
    """(id, vec, cell, home, core): home cell once, and every cell to visit.

    Only cells numbered below the home cell are visited: one of two cells is
    enough for a pair.  `core` marks members within half the search angle of
    their pivot, who are all neighbours of one another.
    """
    id_type = points.schema["id"].dataType
    schema = T.StructType(
        [
            T.StructField("id", id_type),
            T.StructField("vec", T.BinaryType()),
            T.StructField("cell", T.IntegerType()),
            T.StructField("home", T.BooleanType()),
            T.StructField("core", T.BooleanType()),
        ]
    )

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in (b[i : i + PLACE_ROWS] for b in batches for i in range(0, len(b), PLACE_ROWS)):
            raw = np.array(batch["vec"].tolist(), dtype=np.float64)
            angles = _angles(raw / np.linalg.norm(raw, axis=1, keepdims=True), pivots)
            own = angles.argmin(axis=1)
            nearest = angles[np.arange(len(own)), own]
            reach = angles <= (nearest + 2 * angle + SLACK)[:, None]
            reach &= np.arange(len(pivots))[None, :] <= own[:, None]
            row, cell = np.nonzero(reach)
            home = own[row] == cell
            yield pd.DataFrame(
                {
                    "id": batch["id"].to_numpy()[row],
                    "vec": _packed(raw)[row],
                    "cell": cell.astype(np.int32),
                    "home": home,
                    "core": home & (nearest[row] <= angle / 2 - SLACK),
                }
            )

    return points.mapInPandas(run, schema)


def _tiled(placed: DataFrame, tile_rows: int) -> DataFrame:
    """Add the tile of each row and the tile counts of its cell.

    Home rows are cut into core tiles 0…c-1 and others c…h-1; visitors into
    0…v-1.  The hash of the id decides, so a crowded cell is spread evenly.
    """
    sizes = placed.groupBy("cell").agg(
        F.count_if(F.col("core")).alias("cores"),
        F.count_if(F.col("home") & ~F.col("core")).alias("others"),
        F.count_if(~F.col("home")).alias("visitors"),
    )
    def tiles(c: str) -> Column:
        return F.ceil(F.col(c) / F.lit(tile_rows)).cast("int")

    # One row per cell, and there are at most MAX_PIVOTS cells.
    counts = F.broadcast(
        sizes.select(
            F.col("cell"), tiles("cores").alias("nc"), tiles("others").alias("no"), tiles("visitors").alias("nv")
        )
    )
    spot = F.xxhash64("id")
    tile = (
        F.when(F.col("core"), F.pmod(spot, F.greatest("nc", F.lit(1))))
        .when(F.col("home"), F.col("nc") + F.pmod(spot, F.greatest("no", F.lit(1))))
        .otherwise(F.pmod(spot, F.greatest("nv", F.lit(1))))
    )
    return placed.join(counts, "cell").withColumn("tile", tile.cast("int"))


def _upto(n: Column) -> Column:
    """0 … n-1, empty for 0."""
    return F.filter(F.sequence(F.lit(0), F.greatest(n, F.lit(1)) - 1), lambda i: i < n)


def _tile_pairs(tiled: DataFrame) -> DataFrame:
    """Copy each row to every tile pair it takes part in: (cell, a, b, guest, side).

    Home tile `a` meets home tiles b ≥ a and all visitor tiles.  Two different
    core tiles are skipped: their members are known neighbours.
    """
    nh = F.col("nc") + F.col("no")
    t = F.col("tile")

    def skip(i: Column) -> Column:
        return (i < F.col("nc")) & (t < F.col("nc")) & (i != t)

    def pair(a: Column, b: Column, guest: bool, side: int) -> Column:
        return F.struct(
            a.cast("int").alias("a"), b.cast("int").alias("b"), F.lit(guest).alias("guest"), F.lit(side).alias("side")
        )

    as_left = F.transform(F.filter(_upto(nh), lambda i: (i >= t) & ~skip(i)), lambda i: pair(t, i, False, 0))
    as_right = F.transform(F.filter(_upto(nh), lambda i: (i < t) & ~skip(i)), lambda i: pair(i, t, False, 1))
    host = F.transform(_upto(F.col("nv")), lambda i: pair(t, i, True, 0))
    guest = F.transform(_upto(nh), lambda i: pair(i, t, True, 1))
    pairs = F.when(F.col("home"), F.concat(as_left, as_right, host)).otherwise(guest)
    return tiled.select("id", "vec", "cell", F.inline(pairs))


Answer = Callable[[np.ndarray, np.ndarray, np.ndarray], pd.DataFrame]


def _compare(points: DataFrame, threshold: float, answer: Answer, schema, method: str, recall: float) -> tuple[DataFrame, DataFrame]:
    """Run `answer(left ids, right ids, hits)` on every pair of tiles that may hold neighbours.

    Also returns the placed table, for what is known without a comparison.
    """
    if method == "bands":
        return _compare_bands(points, threshold, answer, schema, recall)
    if method != "exact":
        raise ValueError("method must be 'exact' or 'bands'")
    angle = math.acos(max(-1.0, min(1.0, threshold)))
    placed = cut_lineage(_placed(points, _pivots(points, points.count()), angle), "cells")
    pairs = _tile_pairs(_tiled(placed, TILE_ROWS))
    return pairs.groupBy("cell", "a", "b", "guest").applyInPandas(_pair_of_tiles(threshold, answer, schema), schema), placed


def _pair_of_tiles(threshold: float, answer: Answer, schema) -> Callable[[pd.DataFrame], pd.DataFrame]:
    def run(group: pd.DataFrame) -> pd.DataFrame:
        left = group[group["side"] == 0]
        right = group[group["side"] == 1]
        a, b, guest = group["a"].iloc[0], group["b"].iloc[0], group["guest"].iloc[0]
        if a == b and not guest:
            right = left
        if not len(left) or not len(right):
            return pd.DataFrame(columns=schema.names)
        lv, rv = _directions(left["vec"].to_numpy()), _directions(right["vec"].to_numpy())
        ids, others = left["id"].to_numpy(), right["id"].to_numpy()
        # A step of rows at a time, so that memory holds no square of a tile.
        steps = range(0, len(ids), STEP_ROWS)
        parts = [answer(ids[i : i + STEP_ROWS], others, lv[i : i + STEP_ROWS] @ rv.T >= threshold - EPSILON) for i in steps]
        return pd.concat(parts, ignore_index=True).drop_duplicates()

    return run


def bands_for(threshold: float, recall: float) -> tuple[int, int]:
    """(bands, bits): the longest bands of which `MAX_BANDS` or fewer reach the recall at the threshold."""
    agree = 1 - math.acos(max(-1.0, min(1.0, threshold))) / math.pi
    for bits in range(MAX_BITS, 0, -1):
        whole = agree**bits
        if whole < 1e-6:
            continue
        bands = 1 if whole >= recall else math.ceil(math.log(1 - recall) / math.log(1 - whole))
        if bands <= MAX_BANDS:
            return bands, bits
    raise ValueError(f"{MAX_BANDS} bands cannot reach a recall of {recall} at {threshold}: use method='exact'")


def _banded(points: DataFrame, bands: int, bits: int) -> DataFrame:
    """(id, vec, cell): every vector, packed, once per band; `cell` is the band's bits, its number and the vector's length."""
    schema = T.StructType(
        [points.schema["id"], T.StructField("vec", T.BinaryType()), T.StructField("cell", T.LongType())]
    )

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in (b[i : i + PLACE_ROWS] for b in batches for i in range(0, len(b), PLACE_ROWS)):
            for dims, part in batch.groupby(batch["vec"].map(len)):
                raw = np.array(part["vec"].tolist(), dtype=np.float64)
                unit = raw / np.linalg.norm(raw, axis=1, keepdims=True)
                # The same planes in every task, by seed.
                planes = np.random.default_rng(dims).normal(size=(dims, bands * bits))
                signs = (unit @ planes > 0).reshape(len(unit), bands, bits)
                cell = signs @ (1 << np.arange(bits, dtype=np.int64)) + (np.arange(bands) << bits)
                cell += dims << (bits + MAX_BANDS.bit_length())
                yield pd.DataFrame(
                    {"id": np.repeat(part["id"].to_numpy(), bands), "vec": np.repeat(_packed(raw), bands), "cell": cell.ravel()}
                )

    return points.mapInPandas(run, schema)


def _compare_bands(points: DataFrame, threshold: float, answer: Answer, schema, recall: float) -> tuple[DataFrame, DataFrame]:
    """The same by buckets. Small buckets share groups of about a tile; larger ones are cut into tiles."""
    bands, bits = bands_for(threshold, recall)
    shift = bits + MAX_BANDS.bit_length()
    placed = cut_lineage(_banded(points, bands, bits), "bands")
    sizes = placed.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    # Only what meets somebody is moved; the sizes are as many as buckets, so the join is Spark's to choose.
    shared = cut_lineage(placed.join(sizes, "cell"), "buckets")
    tile_rows = min(TILE_ROWS, BUCKET_ROWS)
    half = tile_rows // 2
    few = shared.where(F.col("n") <= half)
    groups = few.count() // tile_rows + 1

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("cell", kind="stable")
        ids, cells, packed = rows["id"].to_numpy(), rows["cell"].to_numpy(), rows["vec"].to_numpy()
        found = [pd.DataFrame(columns=schema.names)]
        ends = np.append(np.flatnonzero(np.diff(cells)) + 1, len(cells))
        start = 0
        for k, end in enumerate(ends):
            # Neighbouring small buckets of one length of vectors are compared in one go.
            more = k + 1 < len(ends) and ends[k + 1] - start <= SHARED_ROWS and cells[start] >> shift == cells[end] >> shift
            if more:
                continue
            unit, own = _directions(packed[start:end]), cells[start:end]
            hits = (unit @ unit.T >= threshold - EPSILON) & (own[:, None] == own[None, :])
            some = np.flatnonzero(hits.sum(axis=1) > 1)
            if len(some):
                found.append(answer(ids[start:end][some], ids[start:end][some], hits[np.ix_(some, some)]))
            start = end
        return pd.concat(found[1:] or found, ignore_index=True)

    small = few.withColumn("_group", F.pmod(F.xxhash64("cell"), F.lit(groups))).groupBy("_group").applyInPandas(run, schema)
    no = F.lit(False)
    tiled = shared.where(F.col("n") > half).select(
        "id", "vec", "cell", F.lit(True).alias("home"), no.alias("core"), F.lit(0).alias("nc"), F.lit(0).alias("nv"),
        F.ceil(F.col("n") / F.lit(half)).cast("int").alias("no"),
    )
    tiled = tiled.withColumn("tile", F.pmod(F.xxhash64("id"), F.col("no")).cast("int"))
    large = _tile_pairs(tiled).groupBy("cell", "a", "b", "guest").applyInPandas(_pair_of_tiles(threshold, answer, schema), schema)
    return small.unionByName(large), placed.select("id", "cell", no.alias("core"))


def _core_first(placed: DataFrame) -> DataFrame:
    """(id, first): each core member with the smallest id of its core."""
    cores = placed.where("core").select("cell", "id")
    # One row per cell, at most MAX_PIVOTS.
    first = F.broadcast(cores.groupBy("cell").agg(F.min("id").alias("first")))
    return cores.join(first, "cell").select("id", "first")


def dedup(
    df: DataFrame, threshold: float, key: str = "vec_id", vec: str = "embedding", method: str = "exact", recall: float = 0.95
) -> DataFrame:
    """Drop a vector when one of smaller key has cosine ≥ `threshold` to it.

    Vectors without length have no direction and stay. `method="bands"` finds a pair at the
    threshold with probability `recall`, nearer ones more often, and no pair below it.
    """
    points = cut_lineage(_distinct(df, key, vec), "points")
    schema = T.StructType([points.schema["id"]])

    def later(left: np.ndarray, right: np.ndarray, hits: np.ndarray) -> pd.DataFrame:
        smaller = left[:, None] < right[None, :]
        larger = left[:, None] > right[None, :]
        ids = np.concatenate([right[(hits & smaller).any(axis=0)], left[(hits & larger).any(axis=1)]])
        return pd.DataFrame({"id": np.unique(ids)})

    found, placed = _compare(points, threshold, later, schema, method, recall)
    core = _core_first(placed).where(F.col("id") != F.col("first")).select("id")
    near = found.unionByName(core).distinct()
    kept = points.select("id").join(near, "id", "left_anti")
    # Later copies of a value are neighbours of its first holder.
    alone = df.where(_usable(vec)).join(kept.withColumnRenamed("id", key), key, "left_semi")
    return alone.unionByName(df.where(~_usable(vec)))


def similarity_labels(
    df: DataFrame, max_dist: float, key: str = "vec_id", vec: str = "embedding", method: str = "exact", recall: float = 0.95
) -> DataFrame:
    """(key, cluster): single-linkage clusters cut at cosine distance `max_dist`.

    A cluster is a connected component of the graph distance ≤ `max_dist`, named
    by its smallest key.  A pair of tiles reports a star per component it sees.
    """
    rows = df.where(_usable(vec)).select(key, _positive_zero(vec).alias("vec"))
    points = cut_lineage(_distinct(df, key, vec), "points")
    id_field = points.schema["id"]
    schema = T.StructType([T.StructField("src", id_field.dataType), T.StructField("dst", id_field.dataType)])

    def stars(left: np.ndarray, right: np.ndarray, hits: np.ndarray) -> pd.DataFrame:
        # Every row and column joins one frontier, so the work is one pass over `hits`.
        seen_left, seen_right = np.zeros(len(left), bool), np.zeros(len(right), bool)
        src, dst = [], []
        for start in np.nonzero(hits.any(axis=1))[0]:
            if seen_left[start]:
                continue
            seen_left[start] = True
            front, members = np.array([start]), [left[[start]]]
            while len(front):
                cols = np.nonzero(hits[front].any(axis=0) & ~seen_right)[0]
                seen_right[cols] = True
                front = np.nonzero(hits[:, cols].any(axis=1) & ~seen_left)[0]
                seen_left[front] = True
                members += [right[cols], left[front]]
            ids = np.unique(np.concatenate(members))
            src.append(ids[1:])
            dst.append(np.repeat(ids[:1], len(ids) - 1))
        if not src:
            return pd.DataFrame(columns=schema.names)
        return pd.DataFrame({"src": np.concatenate(src), "dst": np.concatenate(dst)})

    found, placed = _compare(points, 1.0 - max_dist, stars, schema, method, recall)
    core = _core_first(placed).where(F.col("id") != F.col("first")).select(F.col("id").alias("src"), F.col("first").alias("dst"))
    labels = connected_components(found.unionByName(core))
    named = points.join(labels, "id", "left").select("vec", F.coalesce("component", "id").alias("cluster"))
    # Back to every copy; a value shared by many rows is salted.
    def keyed(d: DataFrame) -> DataFrame:
        return d.withColumn("_value", F.sha2(F.col("vec").cast("string"), 256)).drop("vec")

    return skew_join(keyed(rows), keyed(named), "_value", spread=[key]).select(key, "cluster")


def clusters(
    df: DataFrame,
    max_dist: float,
    min_words: int = 0,
    top_k: int | None = None,
    query: list[float] | None = None,
    sim_threshold: float = 0.0,
    key: str = "vec_id",
    vec: str = "embedding",
    text: str | None = None,
    method: str = "exact",
    recall: float = 0.95,
) -> DataFrame:
    """(key, cluster, size, n_words): semantic clusters, filtered by words, largest first.

    With `query` only vectors at least `sim_threshold` similar to it take part.
    `top_k` keeps that many clusters; ties go to the smaller cluster key.
    """
    rows = df
    if query is not None:
        direction = F.array(*[F.lit(float(x)) for x in query])
        rows = rows.where(cosine(vec, direction) >= sim_threshold)
    n_words = F.size(words(text)) if text else F.lit(0)
    labels = cut_lineage(
        similarity_labels(rows, max_dist, key, vec, method, recall).join(rows.select(key, n_words.cast("long").alias("_words")), key),
        "clusters",
    )
    sizes = (
        labels.groupBy("cluster")
        .agg(F.count(F.lit(1)).alias("size"), F.sum("_words").alias("n_words"))
        .where(F.col("n_words") >= min_words)
    )
    if top_k is not None:
        sizes = sizes.orderBy(F.desc("size"), "cluster").limit(top_k)
    return skew_join(labels.drop("_words"), sizes, "cluster", spread=[key]).select(key, "cluster", "size", "n_words")


# --- nearest neighbours of given vectors ------------------------------------------------


def _best(sims: np.ndarray, ids: np.ndarray, queries: np.ndarray, k: int) -> pd.DataFrame:
    """The `k` best rows per query: rounded similarity first, then the smaller id."""
    sims = np.round(sims, 9)
    out = []
    for i, q in enumerate(queries):
        row = sims[i]
        # Everything that ties with the k-th best is still in the running.
        near = np.nonzero(row >= np.partition(row, -k)[-k])[0] if len(row) > k else np.arange(len(row))
        order = near[np.lexsort((ids[near], -row[near]))][:k]
        out.append(pd.DataFrame({"query_id": q, "id": ids[order], "similarity": row[order]}))
    return pd.concat(out, ignore_index=True)


def top_k_similar(
    df: DataFrame,
    queries: DataFrame,
    k: int = 5,
    key: str = "vec_id",
    vec: str = "embedding",
    query_key: str = "query_id",
    query_vec: str = "vector",
) -> DataFrame:
    """(query_id, key, similarity, rank): the `k` nearest rows of every query vector.

    Up to MAX_QUERIES queries travel with the tasks and the table is scanned in
    place; each batch gives up all but its `k` best.  More queries are tiled
    against the table, so neither side has to fit anywhere whole.
    """
    points = df.where(_usable(vec)).select(F.col(key).alias("id"), F.col(vec).cast("array<double>").alias("vec"))
    asked = queries.where(_usable(query_vec)).select(
        F.col(query_key).alias("query_id"), F.col(query_vec).cast("array<double>").alias("vec")
    )
    schema = T.StructType(
        [asked.schema["query_id"], points.schema["id"], T.StructField("similarity", T.DoubleType())]
    )
    n_queries = asked.limit(MAX_QUERIES + 1).count()
    if n_queries == 0:
        best = points.sparkSession.createDataFrame([], schema)
    elif n_queries <= MAX_QUERIES:
        held = asked.orderBy("query_id").limit(MAX_QUERIES).collect()
        names = np.array([r["query_id"] for r in held])
        matrix = _unit(pd.Series([r["vec"] for r in held]))

        def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in (b[i : i + BUCKET_ROWS] for b in batches for i in range(0, len(b), BUCKET_ROWS)):
                yield _best(matrix @ _unit(batch["vec"]).T, batch["id"].to_numpy(), names, k)

        best = points.mapInPandas(scan, schema)
    else:
        best = _tiled_best(points, asked, k, schema)
    rank = F.row_number().over(W.partitionBy("query_id").orderBy(F.desc("similarity"), "id"))
    ranked = best.withColumn("rank", rank).where(F.col("rank") <= k)
    return ranked.select(F.col("query_id").alias(query_key), F.col("id").alias(key), "similarity", "rank")


def _tiled_best(points: DataFrame, asked: DataFrame, k: int, schema: T.StructType) -> DataFrame:
    n_points = max(1, math.ceil(points.count() / min(TILE_ROWS, BUCKET_ROWS)))
    n_asked = max(1, math.ceil(asked.count() / MAX_QUERIES))

    def tiles(n: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    left = asked.withColumn("qt", F.pmod(F.xxhash64("query_id"), F.lit(n_asked))).withColumn("pt", tiles(n_points))
    right = points.withColumn("pt", F.pmod(F.xxhash64("id"), F.lit(n_points))).withColumn("qt", tiles(n_asked))

    def run(q: pd.DataFrame, p: pd.DataFrame) -> pd.DataFrame:
        if not len(q) or not len(p):
            return pd.DataFrame(columns=schema.names)
        return _best(_unit(q["vec"]) @ _unit(p["vec"]).T, p["id"].to_numpy(), q["query_id"].to_numpy(), k)

    keys = [F.col("pt").cast("long"), F.col("qt").cast("long")]
    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(run, schema)


def gaps(
    df: DataFrame,
    queries: DataFrame,
    key: str = "vec_id",
    vec: str = "embedding",
    query_key: str = "query_id",
    query_vec: str = "vector",
) -> DataFrame:
    """(query_id, distance): how far each query vector is from the nearest row."""
    nearest = top_k_similar(df, queries, 1, key, vec, query_key, query_vec)
    return nearest.select(query_key, (F.lit(1.0) - F.col("similarity")).alias("distance"))
