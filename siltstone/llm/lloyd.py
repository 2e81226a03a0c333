"""Centroid clustering: exact integer Lloyd rounds over column blocks.

Vectors become integers, floor(scale * x), and are cut twice: into chunks of rows and
into `shards` blocks of columns. A tile (chunk, shard) is the unit of work. In a round

1. tasks over tiles compute the exact partial distances of the tile's rows to the
   centroids' slices of that block;
2. the partial distances of a chunk are added over its blocks, and the nearest
   centroid (ties: the smaller number) is taken;
3. the chunk's assignment goes back to its tiles, each block adds its columns by
   cluster inside the task, and every block's slice of a centroid becomes
   floor(sum / count). Empty clusters keep their centroid.

The tiles are shuffled once, into buckets of (chunk, shard) in the shared folder; a
round moves 8 * k bytes a row and block of partial distances and `shards` bytes a row of
assignments, never the vectors, and starts from the stored tiles, so a lost executor
costs its own tasks only. The driver holds the centroids (k * dims numbers) alone. A
cluster with any share of the rows costs each task one row per block.

Defined cases: a vector is kept if it has `dims` components and each is finite and below
2^27 / scale in magnitude (a larger one's squared distance need not fit the 64-bit result);
others have no row. Repeated rows count as vectors of their own; rows that share an id start
in the order of their vectors. Rows without an id are clustered and start last. With
fewer than k vectors there are as many centroids as vectors; without any the result is
empty. Other columns are not read.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import new_path, table

K, DIMS, ROUNDS, SHARDS, SCALE, SEED = 8, 64, 10, 4, 1024, 3
CHUNK = 4096
LIMIT = 1 << 27


def fixed_point(vector: str, dims: int, scale: int) -> tuple[Column, Column]:
    """(test, integers): whether the vector is kept, and floor(scale * x) of its components."""
    small = F.forall(vector, lambda x: F.coalesce(F.abs(x.cast("double")) * scale < LIMIT, F.lit(False)))
    ints = F.transform(vector, lambda x: F.floor(x.cast("double") * scale).cast("int"))
    return F.col(vector).isNotNull() & (F.size(vector) == dims) & small, ints


def first_centroids(points: DataFrame, k: int, seed: int) -> np.ndarray:
    """[k, dims]: the points whose id has the smallest sha256 of `seed:id`, a top-k of k rows."""
    order = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")), 256)
    rows = points.orderBy(order.asc_nulls_last(), "ints").select("ints").limit(k).collect()
    return np.array([r["ints"] for r in rows], dtype=np.int64)


def _blocks(dims: int, shards: int) -> list[slice]:
    edges = [dims * s // shards for s in range(shards + 1)]
    return [slice(a, b) for a, b in zip(edges, edges[1:], strict=False)]


class Tiles:
    """The vectors as a stored table (chunk, shard, ids, tile), bucketed by (chunk, shard).

    `ids` is filled in the tiles of block 0. A chunk has at most `chunk` rows.
    """

    def __init__(self, points: DataFrame, dims: int, shards: int, chunk: int) -> None:
        self.spark, self.blocks = points.sparkSession, _blocks(dims, shards)
        self.name, blocks = f"tiles_{uuid.uuid4().hex}", self.blocks
        kind = points.schema["id"].dataType.simpleString()

        def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            from pyspark import TaskContext

            task, number, ids, rows = TaskContext.get().partitionId() << 32, 0, [], []

            def tiles(n: int) -> pd.DataFrame:
                x = np.stack(rows[:n]).astype("<i4")
                return pd.DataFrame(
                    {
                        "chunk": task + number,
                        "shard": np.arange(len(blocks), dtype=np.int32),
                        "ids": [ids[:n], *[None] * (len(blocks) - 1)],
                        "tile": [np.ascontiguousarray(x[:, b]).tobytes() for b in blocks],
                    }
                )

            for batch in batches:
                ids.extend(batch["id"].astype(object).where(batch["id"].notna(), None))
                rows.extend(batch["ints"])
                while len(rows) >= chunk:
                    yield tiles(chunk)
                    number, ids, rows = number + 1, ids[chunk:], rows[chunk:]
            if rows:
                yield tiles(len(rows))

        made = points.mapInPandas(cut, f"chunk long, shard int, ids array<{kind}>, tile binary")
        buckets = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        made.repartition(buckets, "chunk", "shard").write.bucketBy(buckets, "chunk", "shard").sortBy("chunk", "shard").option(
            "path", new_path(self.spark, "tiles")
        ).saveAsTable(self.name, format="parquet")

    def rows(self) -> DataFrame:
        return self.spark.table(self.name)

    def forget(self) -> None:
        """Drop the name; the files stay with the other scratch tables."""
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")


def _matrix(tile: bytes, block: slice) -> np.ndarray:
    return np.frombuffer(tile, "<i4").reshape(-1, block.stop - block.start).astype(np.int64)


def partial_distances(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """[rows, k] exact squared distances of integer rows to integer centroids."""
    top = int(max(np.abs(x).max(initial=0), np.abs(c).max(initial=0)))
    if 4 * top * top * max(1, x.shape[1]) < 1 << 53:  # every sum is an integer that a double holds
        y, d = x.astype(np.float64), c.astype(np.float64)
        return ((y * y).sum(1)[:, None] - 2 * (y @ d.T) + (d * d).sum(1)).astype(np.int64)
    return np.stack([((x - row) ** 2).sum(1) for row in c], axis=1)


def nearest(tiles: Tiles, centroids: np.ndarray) -> DataFrame:
    """(chunk, near, distance): for each row of a chunk its centroid and squared distance."""
    blocks, k = tiles.blocks, len(centroids)

    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            parts = [
                partial_distances(_matrix(t, blocks[s]), centroids[:, blocks[s]]).tobytes()
                for s, t in zip(batch["shard"], batch["tile"], strict=True)
            ]
            yield pd.DataFrame({"chunk": batch["chunk"], "part": parts})

    def best(key: tuple, parts: pd.DataFrame) -> pd.DataFrame:
        total = np.sum([np.frombuffer(p, np.int64) for p in parts["part"]], axis=0).reshape(-1, k)
        near = total.argmin(1).astype(np.int32)  # the first of equals
        return pd.DataFrame({"chunk": [key[0]], "near": [near], "distance": [total[np.arange(len(total)), near]]})

    parts = tiles.rows().select("chunk", "shard", "tile").mapInPandas(partial, "chunk long, part binary")
    return parts.groupBy("chunk").applyInPandas(best, "chunk long, near array<int>, distance array<long>")


def moved(tiles: Tiles, centroids: np.ndarray) -> np.ndarray:
    """The centroids after one round."""
    blocks, k = tiles.blocks, len(centroids)
    back = nearest(tiles, centroids).select("chunk", "near", F.explode(F.lit(list(range(len(blocks))))).alias("shard"))
    met = tiles.rows().select("chunk", "shard", "tile").join(back, ["chunk", "shard"])

    def add(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums = [np.zeros((k, b.stop - b.start), np.int64) for b in blocks]
        counts = np.zeros((len(blocks), k), np.int64)
        for batch in batches:
            for s, tile, near in zip(batch["shard"], batch["tile"], batch["near"], strict=True):
                x = _matrix(tile, blocks[s])
                np.add.at(sums[s], near, x)
                counts[s] += np.bincount(near, minlength=k)
        for s, c in np.argwhere(counts):
            yield pd.DataFrame({"shard": [s], "cluster": [c], "n": [counts[s, c]], "sums": [sums[s][c]]})

    parts = met.select("shard", "tile", "near").mapInPandas(add, "shard int, cluster int, n long, sums array<long>")
    added = parts.select("shard", "cluster", "n", F.posexplode("sums").alias("column", "sum")).groupBy("shard", "cluster", "column").agg(
        F.sum("n").alias("n"), F.sum("sum").alias("sum")
    )
    out = centroids.copy()
    for r in added.collect():  # k * dims rows
        out[r["cluster"], blocks[r["shard"]].start + r["column"]] = r["sum"] // r["n"]
    return out


def cluster(
    vectors: DataFrame,
    id: str = "vec_id",
    vector: str = "embedding",
    k: int = K,
    dims: int = DIMS,
    rounds: int = ROUNDS,
    shards: int = SHARDS,
    scale: int = SCALE,
    seed: int = SEED,
    chunk: int = CHUNK,
) -> DataFrame:
    """One row per kept vector: `id`, cluster, distance, cluster_inertia, inertia, centroid_sha256."""
    spark = vectors.sparkSession
    test, ints = fixed_point(vector, dims, scale)
    points = vectors.where(test).select(F.col(id).alias("id"), ints.alias("ints"))
    centroids = first_centroids(points, k, seed)
    if not len(centroids):
        return vectors.where(F.lit(False)).select(
            id, *[F.lit(None).cast(t).alias(c) for c, t in (("cluster", "int"), ("distance", "long"), ("cluster_inertia", "long"), ("inertia", "long"), ("centroid_sha256", "string"))]
        )
    tiles = Tiles(points, dims, shards, chunk)
    for _ in range(rounds):
        centroids = moved(tiles, centroids)
    ids = tiles.rows().where("shard = 0").select("chunk", "ids")
    path = new_path(spark, "nearest")
    ids.join(nearest(tiles, centroids), "chunk").write.parquet(path)
    tiles.forget()
    rows = spark.read.parquet(path).select(F.explode(F.arrays_zip("ids", "near", "distance")).alias("r"))
    rows = rows.select(F.col("r.ids").alias(id), F.col("r.near").alias("cluster"), F.col("r.distance").alias("distance"))
    sums = {r["cluster"]: int(r["s"]) for r in rows.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()}
    facts = spark.createDataFrame(
        [(c, s, sum(sums.values()), hashlib.sha256(",".join(map(str, centroids[c])).encode()).hexdigest()) for c, s in sums.items()],
        "cluster int, cluster_inertia long, inertia long, centroid_sha256 string",
    )
    return rows.join(F.broadcast(facts), "cluster").select(id, "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")  # k rows


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cluster(table(spark, sf_dir, "embeddings"))


def _sql() -> str:
    """The rounds written out one after the other."""
    nearest_to = """
        SELECT p.n, p.vec_id, p.v, min(struct_pack(d := list_sum(list_transform(range(1, 65), lambda i: (p.v[i] - c.v[i]) * (p.v[i] - c.v[i]))), k := c.k)) AS near
        FROM kept p CROSS JOIN {centroids} c GROUP BY ALL"""
    parts = [
        """kept AS MATERIALIZED (
        SELECT row_number() OVER () AS n, vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
        FROM embeddings
        WHERE len(embedding) = 64 AND list_bool_and(list_transform(embedding, lambda x: x IS NOT NULL AND isfinite(x))))""",
        """c0 AS MATERIALIZED (
        SELECT row_number() OVER (ORDER BY sha256('3:' || CAST(vec_id AS VARCHAR)) NULLS LAST, v) - 1 AS k, v FROM kept
        ORDER BY k LIMIT 8)""",
    ]
    for i in range(ROUNDS):
        parts.append(f"a{i} AS MATERIALIZED ({nearest_to.format(centroids=f'c{i}')})")
        parts.append(f"""s{i} AS MATERIALIZED (
        SELECT near.k AS k, i, sum(v[i]) AS s, count(*) AS m FROM a{i} CROSS JOIN range(1, 65) AS t(i) GROUP BY ALL)""")
        parts.append(f"""c{i + 1} AS MATERIALIZED (
        SELECT c.k, coalesce(new.v, c.v) AS v FROM c{i} c
        LEFT JOIN (SELECT k, list(CAST((s - ((s % m) + m) % m) // m AS BIGINT) ORDER BY i) AS v FROM s{i} GROUP BY k) new ON new.k = c.k)""")
    parts.append(f"a AS MATERIALIZED ({nearest_to.format(centroids=f'c{ROUNDS}')})")
    return f"""WITH {', '.join(parts)}
    SELECT a.vec_id, CAST(near.k AS INTEGER) AS "cluster", CAST(near.d AS BIGINT) AS distance,
        CAST(sum(near.d) OVER (PARTITION BY near.k) AS BIGINT) AS cluster_inertia, CAST(sum(near.d) OVER () AS BIGINT) AS inertia,
        sha256(array_to_string(c.v, ',')) AS centroid_sha256
    FROM a JOIN c{ROUNDS} c ON c.k = near.k"""


SQL = _sql()
