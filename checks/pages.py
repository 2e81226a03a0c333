"""Page text, metadata, links and previews."""

from pyspark.sql import functions as F

from siltstone.functions import rules
from siltstone.operators import links as L
from siltstone.operators import pages as P

from .fixtures import WS
from .policy import domain_sql, part
from .registry import check, table


def plain_sql(text: str) -> str:
    out = f"regexp_replace({text}, '<[^>]*>', ' ', 'g')"
    for name, char in (("lt", "<"), ("gt", ">"), ("quot", '"'), ("#39", "''"), ("nbsp", " "), ("amp", "&")):
        out = f"replace({out}, '&{name};', '{char}')"
    return f"trim(regexp_replace({out}, '{WS}+', ' ', 'g'))"


def dropped_sql(html: str) -> str:
    tags = "|".join(rf"<{t}(?:\s[^>]*)?>.*?</{t}\s*>" for t in ("script", "style", "nav", "footer"))
    return f"regexp_replace({html}, '(?is)<!--.*?-->|{tags}', ' ', 'g')"


@check("page_text", f"SELECT page_id, {plain_sql(dropped_sql('html'))} AS text FROM pages")
def page_text(spark, sf):
    return P.page_text(table(spark, sf, "pages")).select("page_id", "text")


TITLE_SQL = plain_sql("regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1)")


@check("page_metadata", f"""
SELECT page_id, {TITLE_SQL} AS title,
       array_to_string(list_transform(regexp_extract_all(html, '(?is)<h[1-6][^>]*>(.*?)</h[1-6]>', 1), lambda h: {plain_sql('h')}), ' | ') AS headings,
       lower(regexp_extract(html, '(?i)<html[^>]*lang="([a-z-]+)"', 1)) AS page_language
FROM pages""")
def page_metadata(spark, sf):
    rows = P.page_metadata(table(spark, sf, "pages"))
    return rows.select("page_id", "title", F.array_join("headings", " | ").alias("headings"), "page_language")


ANCHOR = r"""(?is)<a\s[^>]*?href\s*=\s*["'']([^"'']*)["''][^>]*>(.*?)</a>"""
# Links here are rooted paths without a query, so the target is the page's origin and the path.
LINKS_SQL = f"""
raw AS (
  SELECT page_id, url, html, regexp_extract_all(html, '{ANCHOR}', 1) AS hrefs, regexp_extract_all(html, '{ANCHOR}', 2) AS labels FROM pages
),
links AS (
  SELECT page_id, url, html, CAST(i - 1 AS INTEGER) AS position, hrefs[i] AS href, {plain_sql('labels[i]')} AS link_text,
    CASE WHEN {part('hrefs[i]', 2)} <> '' THEN {part('hrefs[i]', 1)} || '://' || lower({part('hrefs[i]', 2)}) || {part('hrefs[i]', 3)}
         ELSE {part('url', 1)} || '://' || lower({part('url', 2)}) || {part('hrefs[i]', 3)} END AS target
  FROM (SELECT *, unnest(range(1, len(hrefs) + 1)) AS i FROM raw)
)"""


@check("page_links", f"""WITH {LINKS_SQL}
SELECT page_id, position, href, link_text, target, {domain_sql('target')} <> {domain_sql('url')} AS external FROM links""")
def page_links(spark, sf):
    rows = P.page_links(table(spark, sf, "pages"))
    return rows.select("page_id", "position", "href", "link_text", "target", "external")


@check("link_citations", f"""WITH {LINKS_SQL},
firsts AS (SELECT page_id, target AS href, min(position) AS first_at FROM links GROUP BY ALL)
SELECT page_id, CAST(dense_rank() OVER (PARTITION BY page_id ORDER BY first_at) AS INTEGER) AS n, href FROM firsts""")
def link_citations(spark, sf):
    return P.link_citations(table(spark, sf, "pages")).select("page_id", "n", "href")


DEPTH_SQL = "len(list_filter(string_split({0}, '/'), lambda x: x <> ''))".format(part("target", 3))
SCORED_LINKS_SQL = f"""
titled AS (SELECT *, {TITLE_SQL} AS title FROM links),
toks AS (
  SELECT *, list_distinct(regexp_extract_all(lower(link_text), '[\\p{{L}}\\p{{N}}_]+')) AS own,
         regexp_extract_all(lower(title), '[\\p{{L}}\\p{{N}}_]+') AS head FROM titled
),
scored AS (
  SELECT *, least(length(link_text), 20) / 5.0::DOUBLE
    + CASE WHEN len(own) > 0 THEN len(list_intersect(own, head)) * 4.0::DOUBLE / len(own) ELSE 0 END
    + 2.0::DOUBLE / ({DEPTH_SQL} + 1) AS intrinsic FROM toks
)"""


def scored_links(spark, sf):
    rows = P.page_links(P.page_metadata(table(spark, sf, "pages")))
    return rows.withColumn("intrinsic", L.intrinsic_score("link_text", "title", "target"))


@check("link_total_score", f"""WITH {LINKS_SQL}, {SCORED_LINKS_SQL},
given AS (
  SELECT page_id, position, CASE WHEN position % 4 IN (0, 1) THEN intrinsic END AS own,
         CASE WHEN position % 2 = 0 THEN (page_id % 11) / 10.0::DOUBLE END AS context FROM scored
)
SELECT page_id, position, round(CASE WHEN own IS NULL AND context IS NULL THEN 5.0 WHEN context IS NULL THEN own
  WHEN own IS NULL THEN context * 10 ELSE 0.7::DOUBLE * own + 0.3::DOUBLE * context * 10 END, 6) AS total FROM given""")
def link_total_score(spark, sf):
    at = F.col("position") % 4
    own = F.when(at.isin(0, 1), F.col("intrinsic"))
    context = F.when(F.col("position") % 2 == 0, (F.col("page_id") % 11) / F.lit(10.0).cast("double"))
    total = rules.link_total_score(own, context)
    return scored_links(spark, sf).select("page_id", "position", F.round(total, 6).alias("total"))


@check("link_preview", f"""WITH {LINKS_SQL}, {SCORED_LINKS_SQL},
kept AS (
  SELECT *, row_number() OVER (PARTITION BY page_id ORDER BY round(intrinsic, 9) DESC, position) AS place FROM scored
  WHERE contains(target, 'example.') AND NOT contains(target, '/la') AND {domain_sql('target')} = {domain_sql('url')} AND intrinsic >= 1.5
)
SELECT page_id, position, target, CAST(place AS INTEGER) AS place FROM kept WHERE place <= 3""")
def link_preview(spark, sf):
    rows = scored_links(spark, sf).withColumn("rank_score", F.round("intrinsic", 9))
    best = P.link_preview(
        rows, include=["*example.*"], exclude=["*/la*"], include_external=False, max_links=3,
        score="rank_score", score_threshold=1.5,
    )
    return best.select("page_id", "position", "target", "place")
