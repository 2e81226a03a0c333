"""Neighbours, gaps, near duplicates and clusters of vectors."""

from pyspark.sql import functions as F

from siltstone.functions.vectors import cosine_distance
from siltstone.operators import gap_links
from siltstone.operators import vectors as V

from .registry import check, table
from .text import words_sql

VECTORS_SQL = "e AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings)"
QUERIES_SQL = "q AS (SELECT label AS query_id, list_reverse(arg_min(v, vec_id)) AS qv FROM e GROUP BY label)"


def label_queries(spark, sf):
    """One query vector per label: the reversed vector of its first row."""
    e = table(spark, sf, "embeddings")
    return e.groupBy(F.col("label").alias("query_id")).agg(F.reverse(F.min_by("embedding", "vec_id")).alias("vector"))


@check("cosine_top_k", f"""WITH {VECTORS_SQL}, {QUERIES_SQL},
s AS (SELECT query_id, vec_id, round(list_cosine_similarity(v, qv), 9) AS sim FROM e, q)
SELECT query_id, vec_id, round(sim, 6) AS similarity, CAST(rank AS INTEGER) AS rank
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY sim DESC, vec_id) AS rank FROM s) WHERE rank <= 5""")
def cosine_top_k(spark, sf):
    best = V.top_k_similar(table(spark, sf, "embeddings"), label_queries(spark, sf), 5)
    return best.select("query_id", "vec_id", F.round("similarity", 6).alias("similarity"), "rank")


@check("cosine_pairs", f"""WITH {VECTORS_SQL}
SELECT vec_id, round(1 - list_cosine_similarity(v, list_reverse(v)), 6) AS distance FROM e""")
def cosine_pairs(spark, sf):
    e = table(spark, sf, "embeddings")
    return e.select("vec_id", F.round(cosine_distance("embedding", F.reverse("embedding")), 6).alias("distance"))


@check("embedding_gaps", f"""WITH {VECTORS_SQL}, {QUERIES_SQL}
SELECT query_id, round(min(1 - list_cosine_similarity(v, qv)), 6) AS distance FROM e, q GROUP BY query_id""")
def embedding_gaps(spark, sf):
    rows = V.gaps(table(spark, sf, "embeddings"), label_queries(spark, sf))
    return rows.select("query_id", F.round("distance", 6).alias("distance"))


@check("embedding_dedup", f"""WITH {VECTORS_SQL}
SELECT vec_id FROM e WHERE NOT EXISTS (
  SELECT 1 FROM e o WHERE o.vec_id < e.vec_id AND list_cosine_similarity(o.v, e.v) >= 0.36 - 1e-9)""")
def embedding_dedup(spark, sf):
    return V.dedup(table(spark, sf, "embeddings"), 0.36).select("vec_id")


@check("cosine_clusters", f"""WITH RECURSIVE {VECTORS_SQL},
links AS (SELECT a.vec_id AS a, b.vec_id AS b FROM e a JOIN e b ON a.vec_id <> b.vec_id AND 1 - list_cosine_similarity(a.v, b.v) <= 0.58 + 1e-9),
reach(id, r) AS (SELECT vec_id, vec_id FROM e UNION SELECT reach.id, links.b FROM reach JOIN links ON reach.r = links.a),
named AS (SELECT id AS vec_id, min(r) AS cluster FROM reach GROUP BY id),
sizes AS (
  SELECT cluster, count(*) AS size, coalesce(sum(len({words_sql('text')})), 0)::BIGINT AS n_words
  FROM named LEFT JOIN documents ON vec_id = doc_id GROUP BY cluster HAVING coalesce(sum(len({words_sql('text')})), 0) >= 100
)
SELECT vec_id, cluster, size, n_words FROM named JOIN (SELECT * FROM sizes ORDER BY size DESC, cluster LIMIT 8) USING (cluster)""")
def cosine_clusters(spark, sf):
    docs = table(spark, sf, "documents").select(F.col("doc_id").alias("vec_id"), F.col("text"))
    rows = table(spark, sf, "embeddings").join(docs, "vec_id", "left").withColumn("text", F.coalesce("text", F.lit("")))
    return V.clusters(rows, 0.58, min_words=100, top_k=8, text="text")


# Every vector beside a longer copy of itself, under a larger id: cosine 1.
DOUBLED_SQL = f"""{VECTORS_SQL},
doubled AS (SELECT vec_id, v FROM e UNION ALL SELECT vec_id + 1000000, list_transform(v, lambda x: x * 4) FROM e)"""


def doubled(spark, sf):
    e = table(spark, sf, "embeddings").select("vec_id", "embedding")
    longer = e.select((F.col("vec_id") + 1_000_000).alias("vec_id"), F.transform("embedding", lambda x: (x * 4).cast("float")).alias("embedding"))
    return e.unionByName(longer)


@check("embedding_dedup_bands", f"""WITH {DOUBLED_SQL}
SELECT vec_id FROM doubled d WHERE NOT EXISTS (
  SELECT 1 FROM doubled o WHERE o.vec_id < d.vec_id AND list_cosine_similarity(o.v, d.v) >= 0.95 - 1e-9)""")
def embedding_dedup_bands(spark, sf):
    return V.dedup(doubled(spark, sf), 0.95, method="bands").select("vec_id")


@check("cosine_clusters_bands", f"""WITH RECURSIVE {DOUBLED_SQL},
links AS (SELECT a.vec_id AS a, b.vec_id AS b FROM doubled a JOIN doubled b ON a.vec_id <> b.vec_id AND 1 - list_cosine_similarity(a.v, b.v) <= 0.05 + 1e-9),
reach(id, r) AS (SELECT vec_id, vec_id FROM doubled UNION SELECT reach.id, links.b FROM reach JOIN links ON reach.r = links.a)
SELECT id AS vec_id, min(r) AS cluster FROM reach GROUP BY id""")
def cosine_clusters_bands(spark, sf):
    return V.similarity_labels(doubled(spark, sf), 0.05, method="bands")


def greedy_sql(k: int) -> str:
    """Choice by choice: the odd vector that covers most even ones that are still open."""
    out = ["""covered AS (
  SELECT a.vec_id AS link, b.vec_id AS gap FROM e a JOIN e b ON a.vec_id % 2 = 1 AND b.vec_id % 2 = 0 AND 1 - list_cosine_similarity(a.v, b.v) <= 0.8 + 1e-9)"""]
    for i in range(1, k + 1):
        closed = " UNION ALL ".join(f"SELECT gap FROM covered JOIN c{j} USING (link)" for j in range(1, i)) or "SELECT NULL WHERE FALSE"
        out.append(
            f"c{i} AS MATERIALIZED (SELECT link, count(*) AS gain FROM covered WHERE gap NOT IN ({closed}) GROUP BY link ORDER BY gain DESC, link LIMIT 1)"
        )
    return ", ".join(out) + " " + " UNION ALL ".join(f"SELECT CAST({i} AS INTEGER) AS rank, link, gain FROM c{i}" for i in range(1, k + 1))


@check("gap_filling_links", f"WITH {VECTORS_SQL}, {greedy_sql(4)}")
def gap_filling_links(spark, sf):
    e = table(spark, sf, "embeddings")
    links = e.where("vec_id % 2 = 1").select(F.col("vec_id").alias("link_id"), F.col("embedding").alias("vector"))
    gaps = e.where("vec_id % 2 = 0").select(F.col("vec_id").alias("gap_id"), F.col("embedding").alias("vector"))
    return gap_links.gap_filling_links(gap_links.Covers(links, gaps, 0.8), 4)
