"""Near-duplicate vectors by product quantisation: inverted lists, table-lookup distances, exact cosines.

1. Equal vectors fall together first, with their number as weight.
2. A coarse quantiser (`lists` centroids) and, on its residuals, one codebook per
   subspace are fitted on a bounded sample: the `sample` vectors with the smallest
   hashes. Every vector is indexed: home list, one byte code per subspace, and
   the length of what the code misses.
3. A vector probes every list whose cell comes within half of e of it, where e is the
   distance of unit vectors at the threshold. Of two vectors closer than e in
   different cells, one lies within e / 2 of the plane between the two centroids, so
   at least one of them probes the other's list: no link is lost. `reach`
   below 1 narrows this to a share of e / 2: fewer probes, and a recall to measure.
4. Inside a list the asymmetric distance of a query to a code is a sum of table
   entries. A member stays a candidate unless that distance exceeds e by more
   than the length its code misses (triangle inequality), so this too loses nothing.
   Candidates are reranked by the cosine in double precision.
5. Lists are compared in blocks of about `block` members and `block` queries, so a list
   that holds a third of all vectors is many tasks. A block returns at most one row
   per vector: its links, and one spanning edge. Components are a distributed union-find.

Comparisons inside a crowded list are quadratic in that list's distinct vectors, as
exact numbers of links need; pairs are counted where they are found and never leave a task.

Defined cases: null, empty and zero vectors and those with a null or non-finite
component link with nothing and are components of their own; vectors of different
lengths do not link; a length missing in the sample is one list; repeated rows are
vectors of their own and link with each other; a null id is never a component's id unless
all ids in it are null; other columns are not read; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import components, cut_lineage, table

COSINE = 0.95
SAMPLE = 8192
SUBSPACES, CODES = 8, 256
BLOCK = 4096
# Queries whose distances to a block are held at a time.
STEP = 256
KEY = ["_k1", "_k2"]


@dataclass
class Quantiser:
    """Coarse centroids [lists, dims], and a codebook [codes, width] for each slice of the dimensions."""

    centroids: np.ndarray
    slices: list[slice]
    books: list[np.ndarray]

    def encode(self, x: np.ndarray, near: float) -> tuple[np.ndarray, list[np.ndarray], np.ndarray, np.ndarray]:
        """(home, probes, codes, miss) of unit vectors; `near`: how close a cell must come to be probed."""
        c = self.centroids
        d = (x * x).sum(1)[:, None] - 2 * (x @ c.T) + (c * c).sum(1)
        home = d.argmin(1)
        apart = np.sqrt(np.maximum(((c[:, None] - c[None]) ** 2).sum(2), 0)) if len(c) <= 64 else np.stack([np.linalg.norm(c - r, axis=1) for r in c])
        depth = (d - d[np.arange(len(x)), home][:, None]) / (2 * np.maximum(apart[home], 1e-12))
        probes = depth <= near + 1e-9
        probes[np.arange(len(x)), home] = True
        rest, codes = x - c[home], np.zeros((len(x), len(self.books)), np.uint8)
        for s, (at, book) in enumerate(zip(self.slices, self.books, strict=True)):
            codes[:, s] = _closest(rest[:, at], book)
            rest[:, at] -= book[codes[:, s]]
        return home, [np.flatnonzero(p) for p in probes], codes, np.sqrt((rest * rest).sum(1))

    def tables(self, x: np.ndarray, home: int) -> list[np.ndarray]:
        """For each subspace [queries, codes]: squared distances of the queries to list `home`'s codes."""
        rest = x - self.centroids[home]
        out = []
        for at, book in zip(self.slices, self.books, strict=True):
            r = rest[:, at]
            out.append(((r * r).sum(1)[:, None] - 2 * (r @ book.T) + (book * book).sum(1)).astype(np.float32))
        return out


def _closest(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    return ((c * c).sum(1) - 2 * (x @ c.T)).argmin(1)


def _kmeans(x: np.ndarray, k: int, rounds: int = 8) -> np.ndarray:
    c = np.unique(x[:k], axis=0)
    for _ in range(rounds):
        near = _closest(x, c)
        n = np.bincount(near, minlength=len(c))
        sums = np.stack([np.bincount(near, weights=col, minlength=len(c)) for col in x.T], axis=1)
        c = np.where(n[:, None] > 0, sums / np.maximum(n, 1)[:, None], c)
    return np.unique(c, axis=0)


def fit(x: np.ndarray, lists: int, subspaces: int = SUBSPACES, codes: int = CODES) -> Quantiser:
    """Fitted on unit vectors [rows, dims] in a random order."""
    dims = x.shape[1]
    c = _kmeans(x, max(1, min(lists, len(x))))
    rest = x - c[_closest(x, c)]
    edges = np.linspace(0, dims, min(subspaces, dims) + 1).astype(int)
    slices = [slice(a, b) for a, b in zip(edges, edges[1:], strict=False)]
    return Quantiser(c, slices, [_kmeans(rest[:, s], min(codes, len(x))) for s in slices])


def _plain(dims: int) -> Quantiser:
    """One list, and a code that says nothing."""
    return Quantiser(np.zeros((1, dims)), [slice(0, dims)], [np.zeros((1, dims))])


def unit(vectors: list) -> np.ndarray:
    """[rows, dims] in double precision, of length 1; scaled first, so that squares neither overflow nor vanish."""
    x = np.stack(vectors).astype(np.float64)
    x /= np.abs(x).max(1, keepdims=True)
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def comparable(vector: str) -> Column:
    fine = F.forall(vector, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False)))
    return F.coalesce((F.size(vector) > 0) & fine & F.exists(vector, lambda x: x != 0), F.lit(False))


def _distinct(rows: DataFrame, vector: str) -> DataFrame:
    """(node, keys, weight, min_id, vector): equal vectors once. Partial aggregation meets a vector with very many copies."""
    once = rows.groupBy(*KEY).agg(F.count("*").alias("weight"), F.min("_id").alias("min_id"), F.first(vector).alias("vector"))
    return cut_lineage(once.withColumn("node", F.monotonically_increasing_id()), "vectors")


def fit_sample(nodes: DataFrame, lists: int, sample: int) -> dict[int, Quantiser]:
    """A quantiser for each vector length among the `sample` vectors with the smallest hashes."""
    rows = nodes.orderBy(*KEY).select("vector").limit(sample).toPandas()["vector"]
    by: dict[int, list] = {}
    for v in rows:
        by.setdefault(len(v), []).append(v)
    return {dims: fit(unit(vs), max(1, round(lists * len(vs) / len(rows)))) for dims, vs in by.items()}


def index(nodes: DataFrame, model: dict[int, Quantiser], near: float) -> DataFrame:
    """(node, weight, dims, home, probes, codes, miss, unit): every vector in its list."""

    def encode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for dims, part in batch.groupby(batch["vector"].map(len)):
                x = unit(list(part["vector"]))
                home, probes, codes, miss = model.get(dims, _plain(dims)).encode(x, near)
                yield pd.DataFrame(
                    {
                        "node": part["node"].to_numpy(), "weight": part["weight"].to_numpy(), "dims": dims, "home": home, "probes": probes,
                        "codes": [r.tobytes() for r in codes], "miss": miss, "unit": [r.tobytes() for r in x],
                    }
                )

    kinds = "node long, weight long, dims int, home int, probes array<int>, codes binary, miss double, unit binary"
    return cut_lineage(nodes.select("node", "weight", "vector").mapInPandas(encode, kinds), "index")


def spanning(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """The smallest place in the component of each of `n` places, under links a - b."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, label[a], low)
        np.minimum.at(new, label[b], low)
        while not np.array_equal(new, jumped := new[new]):
            new = jumped
        if np.array_equal(new, label):
            return label
        label = new


def links_in_block(q: pd.DataFrame, m: pd.DataFrame, home: int, model: Quantiser, cosine: float, step: int = STEP) -> tuple[pd.DataFrame, int]:
    """(node, links, root) of the vectors with links between queries and members of list `home`, and the number of reranked pairs.

    A pair that both sides probe is counted in the smaller list only, a pair of one list from the smaller node.
    """
    if q.empty or m.empty:
        return pd.DataFrame({"node": [], "links": [], "root": []}).astype("int64"), 0
    x = np.frombuffer(b"".join(q["unit"]), np.float64).reshape(len(q), -1)
    y = np.frombuffer(b"".join(m["unit"]), np.float64).reshape(len(m), -1)
    codes = np.frombuffer(b"".join(m["codes"]), np.uint8).reshape(len(m), -1)
    bound = ((math.sqrt(2 - 2 * cosine) + m["miss"].to_numpy() + 1e-4) ** 2).astype(np.float32)
    x_home, x_node, y_node = q["home"].to_numpy(), q["node"].to_numpy(), m["node"].to_numpy()
    x_weight, y_weight = q["weight"].to_numpy(), m["weight"].to_numpy()
    probed = np.zeros((len(m), len(model.centroids)), dtype=bool)
    sizes = m["probes"].map(len).to_numpy()
    probed[np.repeat(np.arange(len(m)), sizes), np.concatenate(m["probes"].to_numpy())] = True
    x_links, y_links, reranked = np.zeros(len(x), np.int64), np.zeros(len(y), np.int64), 0
    stars: list[tuple[np.ndarray, np.ndarray]] = []
    n = len(x) + len(y)
    for at in range(0, len(x), step):
        part = slice(at, at + step)
        distance = np.zeros((len(x[part]), len(y)), np.float32)
        for table_, code in zip(model.tables(x[part], home), codes.T, strict=True):
            distance += table_[:, code]
        i, j = np.nonzero(distance <= bound)
        h = x_home[part][i]
        mine = np.where(h == home, x_node[part][i] < y_node[j], ~((h < home) & probed[j, h]))
        i, j = i[mine] + at, j[mine]
        reranked += len(i)
        keep = [np.zeros(0, bool)]
        for k in range(0, len(i), 1 << 16):
            keep.append(np.einsum("ij,ij->i", x[i[k : k + (1 << 16)]], y[j[k : k + (1 << 16)]]) >= cosine)
        keep = np.concatenate(keep)
        i, j = i[keep], j[keep]
        if len(i):
            x_links += np.bincount(i, weights=y_weight[j], minlength=len(x)).astype(np.int64)
            y_links += np.bincount(j, weights=x_weight[i], minlength=len(y)).astype(np.int64)
            label = spanning(i, j + len(x), n)
            moved = np.flatnonzero(label != np.arange(n))
            stars.append((moved, label[moved]))
    if not stars:
        return pd.DataFrame({"node": [], "links": [], "root": []}).astype("int64"), reranked
    label = spanning(np.concatenate([s[0] for s in stars]), np.concatenate([s[1] for s in stars]), n)
    node, links = np.concatenate([x_node, y_node]), np.concatenate([x_links, y_links])
    linked = np.flatnonzero(links)
    return pd.DataFrame({"node": node[linked], "links": links[linked], "root": node[label[linked]]}), reranked


def _tiled(indexed: DataFrame, block: int) -> DataFrame:
    """Every block of a list: its members (query = false) and the vectors that probe it, with their place."""
    probing = indexed.withColumn("list", F.explode("probes"))
    sizes = probing.groupBy("dims", "list").agg(F.count_if(F.col("list") == F.col("home")).alias("n_in"), F.count("*").alias("n_out"))
    sizes = sizes.where("n_in > 0").select(
        "dims", "list", F.ceil(F.col("n_in") / block).cast("int").alias("tiles"), F.ceil(F.col("n_out") / block).cast("int").alias("rounds")
    )
    sizes = cut_lineage(sizes, "lists")  # one row per list
    spot = lambda mark, n: F.pmod(F.xxhash64("node", F.lit(mark)), F.col(n)).cast("int")
    each = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    nothing = F.lit(None)
    members = indexed.withColumn("list", F.col("home")).join(sizes, ["dims", "list"]).select(
        "dims", "list", spot("member", "tiles").alias("tile"), each("rounds").alias("round"),
        F.lit(False).alias("query"), "node", "weight", "home", "probes", "codes", "miss", "unit",
    )
    queries = probing.join(sizes, ["dims", "list"]).select(
        "dims", "list", each("tiles").alias("tile"), spot("query", "rounds").alias("round"), F.lit(True).alias("query"),
        "node", "weight", "home", nothing.cast("array<int>").alias("probes"), nothing.cast("binary").alias("codes"),
        nothing.cast("double").alias("miss"), "unit",
    )
    return members.unionByName(queries)


def links(indexed: DataFrame, model: dict[int, Quantiser], cosine: float, block: int = BLOCK) -> DataFrame:
    """(node, links, root): partial numbers of links and spanning edges, from every block."""

    def compare(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        dims, home = int(key[0]), int(key[1])
        asks = rows["query"].to_numpy(dtype=bool)
        return links_in_block(rows[asks], rows[~asks], home, model.get(dims, _plain(dims)), cosine)[0]

    found = _tiled(indexed, block).groupBy("dims", "list", "tile", "round").applyInPandas(compare, "node long, links long, root long")
    return cut_lineage(found, "found")


def near_duplicates(
    vectors: DataFrame,
    id: str = "vec_id",
    vector: str = "embedding",
    cosine: float = COSINE,
    reach: float = 1.0,
    lists: int | None = None,
    sample: int = SAMPLE,
    block: int = BLOCK,
) -> DataFrame:
    """One row per row of `vectors`: `id`, n_links, component_id, kept. `lists`: a quarter of the root of the distinct vectors if not given."""
    rows = vectors.select(F.col(id).alias("_id"), F.col(vector).alias("_v")).withColumn("_ok", comparable("_v"))
    # Two hashes with seeds of their own: 128 bits tell vectors apart.
    keyed = rows.where("_ok").select("_id", "_v", F.xxhash64("_v").alias(KEY[0]), F.xxhash64(F.lit(7), "_v").alias(KEY[1]))
    alone = rows.where(~F.col("_ok")).select("_id", F.lit(0).cast("long").alias("n_links"), F.col("_id").alias("component_id"))
    nodes = _distinct(keyed, "_v")
    count = nodes.count()
    if count:
        model = fit_sample(nodes, lists or max(1, round(math.sqrt(count) / 4)), sample)
        found = links(index(nodes, model, reach * math.sqrt(2 - 2 * cosine) / 2), model, cosine, block)
        facts = _components(nodes, found)
        linked = keyed.select("_id", *KEY).join(facts, KEY).select("_id", "n_links", "component_id")
        alone = alone.unionByName(linked)
    return alone.select(F.col("_id").alias(id), "n_links", "component_id", F.col("_id").eqNullSafe(F.col("component_id")).alias("kept"))


def _components(nodes: DataFrame, found: DataFrame) -> DataFrame:
    """(keys, n_links, component_id) of every distinct vector."""
    own = nodes.select("node", *KEY, "weight", "min_id")
    if found.isEmpty():
        return own.select(*KEY, (F.col("weight") - 1).alias("n_links"), F.col("min_id").alias("component_id"))
    roots = components(found.where("node <> root").select(F.col("node").alias("a"), F.col("root").alias("b")).distinct())
    linked = found.groupBy("node").agg(F.sum("links").alias("links")).join(roots.withColumnRenamed("id", "node"), "node")
    linked = cut_lineage(own.join(linked, "node", "left"), "linked")
    smallest = linked.where("root is not null").groupBy("root").agg(F.min("min_id").alias("component_id"))
    apart = linked.where("root is null").select(*KEY, (F.col("weight") - 1).alias("n_links"), F.col("min_id").alias("component_id"))
    together = linked.where("root is not null").join(smallest, "root")
    return apart.unionByName(together.select(*KEY, (F.col("weight") - 1 + F.col("links")).alias("n_links"), "component_id"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "embeddings"))


SQL = """
WITH RECURSIVE every AS MATERIALIZED (
    SELECT row_number() OVER () AS n, vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS v,
        coalesce(len(embedding) > 0 AND list_bool_and(list_transform(embedding, lambda x: x IS NOT NULL AND isfinite(x)))
            AND list_bool_or(list_transform(embedding, lambda x: x <> 0)), false) AS fine
    FROM embeddings),
links AS MATERIALIZED (
    SELECT a.n AS a, b.n AS b FROM every a JOIN every b ON a.fine AND b.fine AND a.n <> b.n AND len(a.v) = len(b.v)
    WHERE CASE WHEN len(a.v) = len(b.v) THEN list_cosine_similarity(a.v, b.v) >= 0.95 ELSE false END),
reach AS (
    SELECT n AS a, n AS b FROM every
    UNION
    SELECT r.a, l.b FROM reach r JOIN links l ON l.a = r.b),
least_id AS (SELECT r.a, min(e.vec_id) AS component_id FROM reach r JOIN every e ON e.n = r.b GROUP BY r.a)
SELECT e.vec_id, (SELECT count(*) FROM links l WHERE l.a = e.n) AS n_links, c.component_id, e.vec_id IS NOT DISTINCT FROM c.component_id AS kept
FROM every e JOIN least_id c ON c.a = e.n
"""
