"""BM25, saturation and the sufficiency of a crawl."""

from pyspark.sql import functions as F

from siltstone.operators import adaptive as A
from siltstone.operators import pages as P
from siltstone.operators import postings
from siltstone.operators import ranking as R
from siltstone.operators import terms
from siltstone.scale import new_path

from .pages import DEPTH_SQL, LINKS_SQL, TITLE_SQL
from .registry import check, table
from .text import tokens_sql

QUERY = "The with eaux und der"
TERMS = ["the", "with", "eaux", "und", "der"]


def bm25_sql(source: str, text: str, terms: list[str]) -> str:
    """Every term against every document, by the formula."""
    values = ", ".join(f"('{t}')" for t in terms)
    return f"""
q(term) AS (VALUES {values}),
d AS (SELECT *, {tokens_sql(f'lower({text})')} AS toks FROM {source}),
n AS (SELECT count(*)::DOUBLE AS n, avg(len(toks)) AS avgdl FROM d),
df AS (SELECT term, count(*)::DOUBLE AS df FROM q JOIN d ON list_contains(toks, term) GROUP BY term),
parts AS (
  SELECT d.*, q.term, len(list_filter(toks, lambda x: x = q.term))::DOUBLE AS tf FROM d CROSS JOIN q
),
bm AS (
  SELECT p.* EXCLUDE (toks, term, tf), sum(CASE WHEN tf > 0 THEN
    ln(1 + (n - df + 0.5) / (df + 0.5)) * tf * 2.5 / (tf + 1.5 * (0.25 + 0.75 * len(toks) / avgdl)) ELSE 0 END) AS score
  FROM parts p LEFT JOIN df ON p.term = df.term CROSS JOIN n GROUP BY ALL
)"""


@check("bm25_filter", f"""WITH {bm25_sql('(SELECT doc_id, text FROM documents)', 'text', TERMS)}
SELECT doc_id, round(score, 6) AS score FROM bm WHERE score >= 1.0""")
def bm25_filter(spark, sf):
    rows = R.bm25_filter(table(spark, sf, "documents").select("doc_id", "text"), QUERY, text="text")
    return rows.select("doc_id", F.round("score", 6).alias("score"))


TOP_SQL = f"""{bm25_sql('(SELECT doc_id, text FROM documents)', 'text', TERMS)},
top AS (SELECT doc_id, text, score FROM bm ORDER BY round(score, 9) DESC, doc_id LIMIT 5)"""


@check("kb_top_k", f"WITH {TOP_SQL} SELECT doc_id, round(score, 6) AS score FROM top")
def kb_top_k(spark, sf):
    best = R.top_k(table(spark, sf, "documents").select("doc_id", "text"), QUERY, 5, text="text")
    return best.select("doc_id", F.round("score", 6).alias("score"))


@check("kb_top_k_stored", f"WITH {TOP_SQL} SELECT doc_id, round(score, 6) AS score FROM top")
def kb_top_k_stored(spark, sf):
    """The same from stored postings."""
    path = new_path(spark, "postings")
    postings.build_postings(table(spark, sf, "documents"), path, text="text", buckets=32)
    best = postings.stored_top_k(spark, path, QUERY, 5)
    return best.select(F.col("key").alias("doc_id"), F.round("score", 6).alias("score"))


NEW_TERMS_SQL = f"""
firsts AS (
  SELECT term, min(doc_id) AS doc_id FROM (SELECT doc_id, unnest({tokens_sql('lower(text)')}) AS term FROM documents) GROUP BY term
),
fresh AS (
  SELECT d.doc_id, count(f.term) AS new_terms FROM documents d LEFT JOIN firsts f ON d.doc_id = f.doc_id GROUP BY d.doc_id
)"""


@check("saturation_history", f"""WITH {NEW_TERMS_SQL}
SELECT doc_id, new_terms, sum(new_terms) OVER (ORDER BY doc_id)::BIGINT AS known_terms FROM fresh""")
def saturation_history(spark, sf):
    return R.saturation_history(table(spark, sf, "documents"), "doc_id", "text")


COVERAGE_SQL = f"""
cov AS (
  SELECT sum(sqrt(coalesce(df, 0) / (SELECT count(*)::DOUBLE FROM documents))) / 5 AS coverage
  FROM (SELECT unnest({TERMS!r}) AS term) q LEFT JOIN df ON q.term = df.term
)"""


@check("coverage", f"WITH {TOP_SQL}, {COVERAGE_SQL} SELECT round(coverage, 6) AS coverage FROM cov")
def coverage(spark, sf):
    rows = A.coverage(table(spark, sf, "documents"), QUERY, "text")
    return rows.select(F.round("coverage", 6).alias("coverage"))


CONSISTENCY_SQL = f"""
sets AS (SELECT doc_id, list_distinct({tokens_sql('lower(text)')}) AS s FROM top),
con AS (
  SELECT avg(len(list_intersect(a.s, b.s))::DOUBLE / len(list_distinct(list_concat(a.s, b.s)))) AS consistency
  FROM sets a JOIN sets b ON a.doc_id < b.doc_id
)"""


@check("consistency", f"WITH {TOP_SQL}, {CONSISTENCY_SQL} SELECT round(consistency, 6) AS consistency FROM con")
def consistency(spark, sf):
    rows = A.consistency(table(spark, sf, "documents").select("doc_id", "text"), QUERY, 5, "text")
    return rows.select(F.round("consistency", 6).alias("consistency"))


# --- links ------------------------------------------------------------------------------

GAIN_SQL = f"""
vocab AS (SELECT DISTINCT unnest({tokens_sql('lower(text)')}) AS term FROM documents),
link_toks AS (
  SELECT page_id, position, target, list_distinct({tokens_sql('lower(link_text)')}) AS own, 1.0::DOUBLE / ({DEPTH_SQL} + 1) AS authority FROM links
),
unknown AS (
  SELECT page_id, position, count(*) AS n FROM (SELECT page_id, position, unnest(own) AS term FROM link_toks)
  WHERE term NOT IN (SELECT term FROM vocab) GROUP BY ALL
),
gains AS (
  SELECT l.*, len(list_intersect(own, {TERMS!r})) / 5.0::DOUBLE AS relevance,
         CASE WHEN len(own) > 0 THEN coalesce(u.n, 0)::DOUBLE / len(own) ELSE 0 END AS novelty
  FROM link_toks l LEFT JOIN unknown u ON l.page_id = u.page_id AND l.position = u.position
),
ranked AS (SELECT *, 0.5 * relevance + 0.3 * novelty + 0.2 * authority AS gain FROM gains)"""


def gains(spark, sf):
    links = P.page_links(table(spark, sf, "pages")).select("page_id", "position", "link_text", "target")
    vocabulary = terms.term_stats(table(spark, sf, "documents"), "text")
    return A.link_gain(links, vocabulary, QUERY)


@check("link_gain", f"""WITH {LINKS_SQL}, {GAIN_SQL}
SELECT page_id, position, round(relevance, 6) AS relevance, round(novelty, 6) AS novelty, round(authority, 6) AS authority,
       round(gain, 6) AS gain FROM ranked""")
def link_gain(spark, sf):
    columns = ("relevance", "novelty", "authority", "gain")
    return gains(spark, sf).select("page_id", "position", *[F.round(c, 6).alias(c) for c in columns])


@check("link_top_k", f"""WITH {LINKS_SQL}, {GAIN_SQL}
SELECT page_id, position, target, round(gain, 6) AS gain FROM ranked ORDER BY round(gain, 9) DESC, page_id, position LIMIT 10""")
def link_top_k(spark, sf):
    return A.top_links(gains(spark, sf)).select("page_id", "position", "target", F.round("gain", 6).alias("gain"))


@check("confidence", f"""WITH {TOP_SQL}, {COVERAGE_SQL}, {CONSISTENCY_SQL}, {NEW_TERMS_SQL}, {LINKS_SQL}, {GAIN_SQL},
sat AS (
  SELECT least(greatest(1 - arg_max(new_terms, doc_id)::DOUBLE / arg_min(new_terms, doc_id), 0), 1) AS saturation FROM fresh
),
conf AS (
  SELECT (SELECT count(*) FROM documents) AS pages, coverage, consistency, saturation, (SELECT max(gain) FROM ranked) AS best_gain,
         0.4 * coverage + 0.3 * consistency + 0.3 * saturation AS confidence FROM cov, con, sat
)
SELECT pages, round(coverage, 6) AS coverage, round(consistency, 6) AS consistency, round(saturation, 6) AS saturation,
       round(best_gain, 6) AS best_gain, round(confidence, 6) AS confidence,
       CASE WHEN confidence >= 0.6 THEN 'confident' WHEN pages >= 500 THEN 'max pages' WHEN best_gain < 0.0 THEN 'no gain' END AS stop_reason
FROM conf""")
def confidence(spark, sf):
    row = A.confidence(table(spark, sf, "documents").select("doc_id", "text"), QUERY, gains(spark, sf), text="text")
    rounded = ("coverage", "consistency", "saturation", "best_gain", "confidence")
    return row.select("pages", *[F.round(c, 6).alias(c) for c in rounded], "stop_reason")


SEED_TERMS = ["the", "und", "le"]
UTILITY = "('robots.txt', 'sitemap.xml', 'ads.txt', 'favicon.ico')"


@check("seed_discovery", f"""WITH
candidates AS (
  SELECT page_id, CASE WHEN page_id % 9 = 0 THEN regexp_replace(url, '[?#].*$', '') || '/robots.txt' ELSE url END AS url, html FROM pages
),
titled AS (
  SELECT page_id, url, {TITLE_SQL} AS title FROM candidates
  WHERE regexp_matches(url, '^http.*example[.].*$')
    AND list_reverse(string_split(regexp_replace(url, '[?#].*$', ''), '/'))[1] NOT IN {UTILITY}
), {bm25_sql('titled', 'title', SEED_TERMS)}
SELECT page_id, url, round(score, 6) AS score FROM bm WHERE score >= 0.5 ORDER BY round(score, 9) DESC, url LIMIT 25""")
def seed_discovery(spark, sf):
    pages = table(spark, sf, "pages")
    utility = F.concat(F.regexp_replace("url", "[?#].*$", ""), F.lit("/robots.txt"))
    pages = pages.withColumn("url", F.when(F.col("page_id") % 9 == 0, utility).otherwise(F.col("url")))
    rows = P.seed_discovery(pages, "http*example.*", "the und le", threshold=0.5, max_urls=25)
    return rows.select("page_id", "url", F.round("score", 6).alias("score"))
