"""Frontiers over the link graph, and crawl statistics."""

from pyspark.sql import functions as F

from siltstone.operators import frontier, traversal
from siltstone.operators.chunking import chunk_overlapping
from siltstone.operators.links import KeywordScorer, PathDepthScorer, composite_score
from siltstone.plans import crawl
from siltstone.schema import BRONZE, relaxed
from siltstone.sources.topics import decode

from .fixtures import BRONZE_SQL, bronze
from .registry import check, table
from .text import WORDS_SQL, windows_sql, words_sql

# Page links do not point at pages, so the graph is p -> 7p+1 and p -> 3p+2 (mod n).
EDGES_SQL = """
n AS (SELECT count(*) AS n FROM pages),
node AS (SELECT page_id, 'https://site.example/' || page_id % 3 || '/p/' || page_id AS url FROM pages),
pairs AS (
  SELECT page_id AS s, (7 * page_id + 1) % n AS d FROM pages, n
  UNION SELECT page_id, (3 * page_id + 2) % n FROM pages, n
),
edges AS (SELECT a.url AS src, b.url AS dst FROM pairs JOIN node a ON s = a.page_id JOIN node b ON d = b.page_id WHERE s <> d),
seeds AS (
  SELECT DISTINCT node.url FROM (SELECT min(page_id) AS page_id FROM pages GROUP BY regexp_extract(url, '^https?://[^/]*/([^/?#]*)', 1))
  JOIN node USING (page_id)
)"""


def edges(spark, sf):
    pages = table(spark, sf, "pages")
    n = pages.agg(F.count(F.lit(1)).alias("n")).scalar()
    address = lambda c: F.concat(F.lit("https://site.example/"), c % 3, F.lit("/p/"), c)
    p = F.col("page_id")
    targets = F.explode(F.array((p * 7 + 1) % n, (p * 3 + 2) % n))
    pairs = pages.select(p, targets.alias("d"))
    language = F.regexp_extract("url", "^https?://[^/]*/([^/?#]*)", 1)
    seeds = pages.groupBy(language).agg(F.min("page_id").alias("page_id")).select(address(p).alias("url"))
    return pairs.select(address(p).alias("src"), address(F.col("d")).alias("dst")), seeds


def levels_sql(depth: int, allowed: str, narrow: str = "") -> str:
    """Level by level: each excludes every earlier one."""
    out = ["l0 AS (SELECT url, 0 AS depth, NULL AS parent FROM seeds)"]
    for i in range(1, depth + 1):
        earlier = " UNION ALL ".join(f"SELECT url FROM l{j}" for j in range(i))
        out.append(
            f"l{i} AS (SELECT dst AS url, {i} AS depth, min(src) AS parent FROM edges JOIN l{i - 1} ON src = url "
            f"WHERE {allowed} AND dst NOT IN ({earlier}) GROUP BY dst {narrow})"
        )
    everything = " UNION ALL ".join(f"SELECT url, depth, parent FROM l{j}" for j in range(depth + 1))
    return ",\n".join(out) + f" {everything}"


@check("bfs_depths", f"WITH {EDGES_SQL}, {levels_sql(4, 'NOT ends_with(dst, chr(55))')}")
def bfs_depths(spark, sf):
    links, seeds = edges(spark, sf)
    return traversal.bfs(links, seeds, 4, allowed=lambda u: ~F.endswith(u, F.lit("7")))


SCORERS = [KeywordScorer(["/0/", "5"]), PathDepthScorer(optimal=3)]
BEAM_SCORE = "(contains(dst, '/0/')::INT + contains(dst, '5')::INT) / 2.0"


@check("best_first_beam", f"WITH {EDGES_SQL}, {levels_sql(4, 'TRUE', f'ORDER BY {BEAM_SCORE} DESC, dst LIMIT 6')}")
def best_first_beam(spark, sf):
    links, seeds = edges(spark, sf)
    return traversal.best_first(links, seeds, lambda u: composite_score(u, SCORERS), beam=6, max_depth=4)


# Links as the tables have them: suppliers and the parts they deliver, in both directions.
SUPPLY_SQL = """
pairs AS (SELECT DISTINCT 's/' || l_suppkey AS s, 'p/' || l_partkey AS p FROM lineitem),
edges AS (SELECT s AS src, p AS dst FROM pairs UNION ALL SELECT p, s FROM pairs),
seeds AS (SELECT 's/' || min(s_suppkey) AS url FROM supplier GROUP BY s_nationkey % 5)"""


def supply_edges(spark, sf):
    lines = table(spark, sf, "lineitem")
    ends = F.struct(F.concat(F.lit("s/"), "l_suppkey").alias("src"), F.concat(F.lit("p/"), "l_partkey").alias("dst"))
    pairs = lines.select(ends.alias("e")).select("e.*").distinct()
    seeds = table(spark, sf, "supplier").groupBy(F.col("s_nationkey") % 5).agg(F.concat(F.lit("s/"), F.min("s_suppkey")).alias("url"))
    return pairs.unionByName(pairs.select(F.col("dst").alias("src"), F.col("src").alias("dst"))), seeds.select("url")


@check("bfs_supply", f"WITH {SUPPLY_SQL}, {levels_sql(3, 'NOT ends_with(dst, chr(55))')}")
def bfs_supply(spark, sf):
    links, seeds = supply_edges(spark, sf)
    return traversal.bfs(links, seeds, 3, allowed=lambda u: ~F.endswith(u, F.lit("7")))


SUPPLY_SCORERS = [KeywordScorer(["p/1", "5"]), PathDepthScorer(optimal=3)]
SUPPLY_SCORE = "(contains(dst, 'p/1')::INT + contains(dst, '5')::INT) / 2.0"


@check("best_first_supply", f"WITH {SUPPLY_SQL}, {levels_sql(4, 'TRUE', f'ORDER BY {SUPPLY_SCORE} DESC, dst LIMIT 10')}")
def best_first_supply(spark, sf):
    links, seeds = supply_edges(spark, sf)
    return traversal.best_first(links, seeds, lambda u: composite_score(u, SUPPLY_SCORERS), beam=10, max_depth=4)


LOG_SQL = """
log AS (
  SELECT 'https://e.example/' || user_id || '/' || event_id % 300 AS url, ts, user_id % 4 AS part, event_id,
         CASE event_type WHEN 'purchase' THEN 'processed' WHEN 'error' THEN 'failed' WHEN 'signup' THEN 'skipped' ELSE 'queued' END AS status,
         event_type, event_id % 12 AS depth, user_id
  FROM events
)"""


def log(spark, sf):
    e = table(spark, sf, "events")
    status = (
        F.when(F.col("event_type") == "purchase", "processed")
        .when(F.col("event_type") == "error", "failed")
        .when(F.col("event_type") == "signup", "skipped")
        .otherwise("queued")
    )
    return e.select(
        F.concat(F.lit("https://e.example/"), "user_id", F.lit("/"), F.col("event_id") % 300).alias("url"),
        F.col("ts").alias("timestamp"),
        (F.col("user_id") % 4).cast("int").alias("partition"),
        F.col("event_id").alias("offset"),
        status.alias("status"),
        F.col("event_type").alias("language"),
        (F.col("event_id") % 12).alias("depth"),
    )


@check("discovery_unvisited", f"""WITH {LOG_SQL},
fresh AS (SELECT * FROM log WHERE url NOT IN (SELECT url FROM log WHERE status = 'skipped'))
SELECT url, event_id AS "offset", event_type AS language FROM (
  SELECT *, row_number() OVER (PARTITION BY url ORDER BY ts, part, event_id) AS rn FROM fresh) WHERE rn = 1""")
def discovery_unvisited(spark, sf):
    messages = log(spark, sf)
    visited = messages.where("status = 'skipped'").select("url")
    return frontier.unvisited(messages, visited).select("url", "offset", "language")


@check("discovery_counters", f"""WITH {LOG_SQL}
SELECT count(DISTINCT url) AS visited, count(DISTINCT url) AS discovered,
       count(DISTINCT url) FILTER (WHERE status = 'processed') AS processed FROM log""")
def discovery_counters(spark, sf):
    return frontier.counters(log(spark, sf))


@check("traversal_stats", f"""WITH {LOG_SQL}
SELECT count(*) FILTER (WHERE status = 'processed') AS processed, count(*) FILTER (WHERE status = 'failed') AS failed,
       count(*) FILTER (WHERE status = 'skipped') AS skipped, max(depth) AS max_depth FROM log""")
def traversal_stats(spark, sf):
    return traversal.traversal_stats(log(spark, sf))


CRAWL_SQL = f"""
sessions AS (
  SELECT source AS seed, min(lang) AS language FROM documents GROUP BY source
),
found AS (
  SELECT seed, d.source || '/' || doc_id AS url, s.language, {words_sql('text')} AS ws FROM documents d JOIN sessions s ON d.source = s.seed
),
crawl AS (
  SELECT seed, url, language, i, array_to_string(ws[i * 450 + 1 : i * 450 + 500], ' ') AS chunk
  FROM (SELECT *, unnest(range(0, greatest(ceil((len(ws) - 50) / 450.0)::BIGINT, 1))) AS i FROM found WHERE len(ws) > 0)
)"""


def crawled(spark, sf):
    """Every source is a session."""
    docs = table(spark, sf, "documents")
    work = docs.groupBy(F.col("source").alias("url")).agg(F.min("lang").alias("language"))
    pages = docs.select(F.col("source").alias("seed"), F.concat("source", F.lit("/"), "doc_id").alias("url"), "text")
    return crawl.crawl_chunks(work, pages, now=1704067200.5)


@check("crawl_chunks", f"""WITH {CRAWL_SQL}
SELECT seed, url || '::' || i AS chunk_id, url AS source_url, sha256(chunk) AS content_hash, CAST(1704067200.5 AS DOUBLE) AS ingested_at, language
FROM crawl WHERE length(chunk) > 100""")
def crawl_chunks(spark, sf):
    rows = crawled(spark, sf)
    return rows.select("seed", "chunk_id", "source_url", F.sha2("content", 256).alias("content_hash"), "ingested_at", "language")


@check("crawl_chunk_messages", f"""WITH {CRAWL_SQL}
SELECT 'relevant_chunks' AS topic, url AS key, url || '::' || i AS chunk_id, length(chunk) AS n, language FROM crawl WHERE length(chunk) > 100""")
def crawl_chunk_messages(spark, sf):
    good, _ = decode(crawl.chunk_messages(crawled(spark, sf)), relaxed(BRONZE), required=["source_url"])
    return good.select("topic", "key", "data.chunk_id", F.length("data.content").cast("long").alias("n"), "data.language")


@check("session_summary", f"""WITH {BRONZE_SQL}, {WORDS_SQL},
{windows_sql(120, 100, 'greatest(ceil((len(ws) - 20) / 100.0)::BIGINT, 1)')}
SELECT source_url AS seed, count(DISTINCT chunk_id) AS pages, count(*) AS chunks FROM cut WHERE length(chunk) > 100 GROUP BY source_url""")
def session_summary(spark, sf):
    rows = bronze(spark, sf).withColumn("page", F.col("chunk_id"))
    chunks = chunk_overlapping(rows, 120, 20)
    return frontier.session_summary(chunks, seed="source_url", url="page").withColumnRenamed("source_url", "seed")
