"""Configuration, traversal, keyword and verdict rules, URL expressions."""

from pyspark.sql import functions as F

from siltstone.functions import rules, urls
from siltstone.functions.vectors import normalise_embedding
from siltstone.operators import gate, links, policies, records
from siltstone.scale import new_path
from siltstone.schema import RELEVANCE_CONFIG
from siltstone.sources import config

from .fixtures import BRONZE_SQL, bronze
from .registry import check, table

# --- configuration -------------------------------------------------------------


@check("active_config", """
WITH c AS (
  SELECT d.source, d.lang, count(*) AS n, coalesce(sum(l.quality), 0) * 3 > count(*) AS active
  FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id GROUP BY ALL
)
SELECT s.source AS file, CASE WHEN p.source IS NULL THEN 'none active' ELSE 'ok' END AS status,
       p.name, p.description, p.terms
FROM (SELECT DISTINCT source FROM documents) s
LEFT JOIN (
  SELECT source, arg_max('policy ' || n, lang) AS name, max(lang) AS description, max(lang) || ',x' AS terms
  FROM c WHERE active GROUP BY source
) p ON s.source = p.source""")
def active_config(spark, sf):
    docs = table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id", "left")
    counts = docs.groupBy("source", "lang").agg(
        F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("quality"), F.lit(0)).alias("good")
    )
    item = F.struct(
        (F.col("good") * 3 > F.col("n")).alias("active"),
        F.concat(F.lit("policy "), "n").alias("name"),
        F.col("lang").alias("description"),
        F.array("lang", F.lit("x")).alias("include_terms"),
        F.array().cast("array<string>").alias("exclude_terms"),
    )
    # A file per source with one policy per language: as many rows as there are languages.
    arrays = counts.groupBy("source").agg(
        F.to_json(F.transform(F.sort_array(F.collect_list(F.struct("lang", item.alias("c")))), lambda x: x["c"])).alias("value")
    )
    path = new_path(spark, "configs")
    arrays.write.partitionBy("source").text(path)
    rows = config.read_configs(spark, path + "/*", RELEVANCE_CONFIG)
    rows = rows.withColumn("file", F.regexp_extract("file", r"source=([^/]+)/", 1))
    best = config.active_config(rows, by=["file"])
    return best.select("file", "status", "name", "description", F.array_join("include_terms", ",").alias("terms"))


SEED_LISTS = """
include_langs AS (SELECT lang FROM documents GROUP BY lang HAVING count(*) >= 50),
exclude_langs AS (
  SELECT lang FROM (
    SELECT d.lang, row_number() OVER (ORDER BY sum(l.toxic) * 1.0 / count(*) DESC, d.lang) AS place
    FROM documents d JOIN labels l ON d.doc_id = l.doc_id GROUP BY d.lang
  ) WHERE place = 1
)"""


@check("seed_urls", f"""WITH {SEED_LISTS},
seeds AS (SELECT regexp_extract(url, '^https?://[^/]*/([^/?#]*)', 1) AS language, url FROM pages)
SELECT language, url FROM seeds
WHERE language IN (SELECT lang FROM include_langs) AND language NOT IN (SELECT lang FROM exclude_langs)""")
def seed_urls(spark, sf):
    docs, labels = table(spark, sf, "documents"), table(spark, sf, "labels")
    include = docs.groupBy("lang").count().where("count >= 50").select(F.col("lang").alias("language"))
    share = docs.join(labels, "doc_id").groupBy("lang").agg((F.sum("toxic") / F.count(F.lit(1))).alias("share"))
    exclude = share.orderBy(F.desc("share"), "lang").limit(1).select(F.col("lang").alias("language"))
    seeds = table(spark, sf, "pages").select(
        F.regexp_extract("url", "^https?://[^/]*/([^/?#]*)", 1).alias("language"), "url"
    )
    return config.seed_urls(seeds, include, exclude).select("language", "url")


# --- traversal -----------------------------------------------------------------

SEGMENTS_SQL = r"""
segs AS (
  SELECT page_id, url, page_id % 6 AS depth,
    list_filter(string_split(lower(regexp_extract(url, '^https?://[^/?#]*([^?#]*)', 1)), '/'), lambda s: s <> '') AS segs
  FROM pages
)"""


@check("traversal_allowed", f"""WITH {SEGMENTS_SQL}
SELECT page_id, CASE WHEN depth > 4 THEN FALSE
                     WHEN list_has_any(segs, ['de', '685', 'EN']) THEN FALSE
                     WHEN depth = 0 THEN TRUE
                     WHEN NOT list_has_any(segs, ['en', 'fr']) THEN FALSE
                     ELSE TRUE END AS allowed FROM segs""")
def traversal_allowed(spark, sf):
    pages = table(spark, sf, "pages")
    allowed = rules.traversal_allowed(
        "url", F.col("page_id") % 6, required=["en", "fr"], blocked=["de", "685", "EN"], max_depth=4
    )
    return pages.select("page_id", allowed.alias("allowed"))


@check("seed_admission", f"WITH {SEGMENTS_SQL} SELECT page_id, url FROM segs WHERE NOT list_has_any(segs, ['de', 'es'])")
def seed_admission(spark, sf):
    pages = table(spark, sf, "pages").select("page_id", "url")
    return links.seed_admission(pages, blocked=["de", "es"], required=["never"], max_depth=0)


# --- keyword policy and verdicts -------------------------------------------------

KEYWORD_SQL = "(contains(lower(content), 'ment') OR contains(lower(content), 'enthe')) AND NOT contains(lower(content), 'license')"
POLICY = gate.Policy("mentions", "Text that mentions.", ["Ment", "ENTHE"], ["License"])


@check("keyword_policy", f"WITH {BRONZE_SQL} SELECT chunk_id, {KEYWORD_SQL} AS passed FROM bronze")
def keyword_policy(spark, sf):
    passed = rules.keyword_policy("content", POLICY.include_terms, POLICY.exclude_terms)
    return bronze(spark, sf).select("chunk_id", passed.alias("passed"))


@check("keyword_policy_multi", f"""WITH {BRONZE_SQL}
SELECT 'mentions' AS policy, chunk_id FROM bronze WHERE {KEYWORD_SQL}
UNION ALL SELECT 'german', chunk_id FROM bronze WHERE contains(lower(content), 'sch') AND NOT contains(lower(content), 'tion')
UNION ALL SELECT 'skip', chunk_id FROM bronze WHERE contains(lower(content), 'skip to')""")
def keyword_policy_multi(spark, sf):
    policies = [
        POLICY,
        gate.Policy("german", "", ["sch"], ["tion"]),
        gate.Policy("skip", "", ["Skip to"]),
        gate.Policy("nothing", "", []),
    ]
    return gate.keyword_policies(bronze(spark, sf), policies).select("policy", "chunk_id")


VERDICTS_SQL = """
verdicts AS (
  SELECT doc_id, CASE WHEN quality = 1 THEN 'RELEVANT' ELSE 'NOT RELEVANT' END AS answer FROM labels
)"""


def verdicts(spark, sf):
    answer = F.when(F.col("quality") == 1, "RELEVANT").otherwise("NOT RELEVANT")
    return table(spark, sf, "labels").select("doc_id", answer.alias("answer"))


@check("relevance_gate", f"""WITH {BRONZE_SQL}, {VERDICTS_SQL}
SELECT chunk_id FROM bronze LEFT JOIN verdicts USING (doc_id)
WHERE {KEYWORD_SQL} AND (answer IS NULL OR (contains(answer, 'RELEVANT') AND NOT contains(answer, 'NOT')))""")
def relevance_gate(spark, sf):
    survivors = gate.keyword_filter(bronze(spark, sf), POLICY)
    return gate.relevance_gate(survivors, verdicts(spark, sf), key="doc_id").select("chunk_id")


@check("relevance_scorer", f"""WITH {BRONZE_SQL}
SELECT chunk_id, answer, answer IS NULL AS failed FROM (
  SELECT chunk_id, CASE WHEN length(content) % 7 = 0 THEN NULL WHEN length(content) % 2 = 0 THEN 'RELEVANT' ELSE 'NOT RELEVANT' END AS answer
  FROM bronze WHERE {KEYWORD_SQL}
) WHERE answer IS NULL OR answer = 'RELEVANT'""")
def relevance_scorer(spark, sf):
    """A stand-in model that answers by text length and fails on every seventh length."""

    def scorer(prompts):
        bodies = prompts.str.replace(r"(?s)\A.*?\nTEXT: ", "", regex=True).str.replace(r"\nINSTRUCTION:.*\Z", "", regex=True)
        if (bodies.str.len() % 7 == 0).any():
            raise RuntimeError("model failed")
        return ["RELEVANT" if n % 2 == 0 else "NOT RELEVANT" for n in bodies.str.len()]

    kept = gate.ask_and_gate(bronze(spark, sf), scorer, POLICY)
    return kept.select("chunk_id", "answer", F.col("error").isNotNull().alias("failed"))


@check("relevance_prompt", f"""WITH {BRONZE_SQL}
SELECT chunk_id, sha256('SYSTEM: You are a strict relevance classifier.' || chr(10) || 'POLICY: Text that mentions.' || chr(10) ||
  'LANGUAGE: ' || language || chr(10) || 'TEXT: ' || content || chr(10) ||
  'INSTRUCTION: Answer ONLY ''RELEVANT'' or ''NOT RELEVANT''.') AS prompt_hash FROM bronze""")
def relevance_prompt(spark, sf):
    text = rules.prompt("content", POLICY.description, F.col("language"))
    return bronze(spark, sf).select("chunk_id", F.sha2(text, 256).alias("prompt_hash"))


# --- records ---------------------------------------------------------------------

STRIP_SQL = r"regexp_replace(regexp_replace({0}, '\A[\t-\r\x1c-\x20\x{{85}}\p{{Z}}]+', ''), '[\t-\r\x1c-\x20\x{{85}}\p{{Z}}]+\z', '')"


@check("bronze_record", f"""WITH {BRONZE_SQL}
SELECT CASE WHEN doc_id % 5 = 0 THEN source_url || '_1704067200.25' ELSE chunk_id END AS chunk_id, source_url,
       sha256({STRIP_SQL.format("'  ' || content || chr(160) || chr(10)")}) AS content_hash,
       CAST(1704067200.25 AS DOUBLE) AS ingested_at,
       CASE WHEN language = 'fr' THEN 'en' ELSE language END AS language FROM bronze""")
def bronze_record(spark, sf):
    messages = bronze(spark, sf).select(
        F.when(F.col("doc_id") % 5 != 0, F.col("chunk_id")).alias("chunk_id"),
        "source_url",
        F.concat(F.lit("  "), "content", F.lit("\xa0\n")).alias("content"),
        F.when(F.col("language") != "fr", F.col("language")).alias("language"),
    )
    rows = records.to_bronze_record(messages, 1704067200.25)
    return rows.select("chunk_id", "source_url", F.sha2("content", 256).alias("content_hash"), "ingested_at", "language")


@check("embedding_normalised", """
SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN -1 ELSE len(embedding) END AS n,
       CASE WHEN vec_id % 7 <> 0 THEN round(CAST(embedding[3] AS DOUBLE), 6) END AS third
FROM embeddings""")
def embedding_normalised(spark, sf):
    e = table(spark, sf, "embeddings")
    text = F.transform("embedding", lambda x: x.cast("string"))
    broken = F.when(F.col("vec_id") % 7 == 0, F.concat(F.slice(text, 1, 10), F.array(F.lit("n/a")))).otherwise(text)
    done = e.select("vec_id", normalise_embedding(broken).alias("v"))
    return done.select(
        "vec_id",
        F.coalesce(F.size("v"), F.lit(-1)).cast("long").alias("n"),
        F.round(F.get("v", 2).cast("double"), 6).alias("third"),
    )


# --- URLs --------------------------------------------------------------------------

URL = "^(?:([A-Za-z][A-Za-z0-9+.-]*):)?(?://([^/?#]*))?([^?#]*)(?:[?]([^#]*))?(?:#(.*))?$"


def part(column: str, group: int) -> str:
    return f"regexp_extract({column}, '{URL}', {group})"


def host_sql(column: str) -> str:
    return f"lower(regexp_replace({part(column, 2)}, ':[0-9]*$', ''))"


def domain_sql(column: str) -> str:
    return f"array_to_string(list_reverse(list_reverse(string_split(regexp_replace({host_sql(column)}, '^www[.]', ''), '.'))[1:2]), '.')"


HREFS_SQL = """
hrefs AS (
  SELECT page_id, url AS base, unnest(list_concat(
    regexp_extract_all(html, '(?is)<a\\s[^>]*?href\\s*=\\s*["'']([^"'']*)["'']', 1),
    [url, '?z=1&utm_source=n&a=2&REF=q', '#top', 'HTTPS://Other.Example.ORG:8080/Path/' || page_id || '?b=2&a=1#f',
     '//cdn.example.net/' || page_id, 'next/' || page_id, '   ']
  )) AS href FROM pages
)"""
NORMAL_SQL = f"""
p AS (
  SELECT *, trim(href) AS raw, {part('trim(href)', 1)} AS hs, {part('trim(href)', 2)} AS ha, {part('trim(href)', 3)} AS hp,
         {part('trim(href)', 4)} AS hq, {part('base', 1)} AS bs, {part('base', 2)} AS ba, {part('base', 3)} AS bp,
         {part('base', 4)} AS bq FROM hrefs
),
q AS (
  SELECT page_id, base, href, raw, lower(CASE WHEN hs <> '' THEN hs ELSE bs END) AS s,
    lower(CASE WHEN hs <> '' OR ha <> '' THEN ha ELSE ba END) AS a,
    CASE WHEN hs <> '' OR ha <> '' THEN hp WHEN hp = '' THEN bp WHEN starts_with(hp, '/') THEN hp
         ELSE regexp_replace(bp, '[^/]*$', '') || hp END AS path,
    list_sort(list_filter(string_split(CASE WHEN hs <> '' OR ha <> '' OR hp <> '' OR hq <> '' THEN hq ELSE bq END, '&'),
      lambda x: x <> '' AND NOT starts_with(lower(x), 'utm_')
                AND lower(split_part(x, '=', 1)) NOT IN ('ref', 'fbclid', 'gclid'))) AS params FROM p
),
normal AS (
  SELECT page_id, base, href, CASE WHEN raw <> '' THEN s || '://' || a || CASE WHEN path = '' THEN '/' ELSE path END ||
    CASE WHEN len(params) > 0 THEN '?' || array_to_string(params, '&') ELSE '' END END AS target FROM q
)"""


def hrefs(spark, sf):
    p = table(spark, sf, "pages")
    found = F.regexp_extract_all("html", F.lit(r"(?is)<a\s[^>]*?href\s*=\s*[\"']([^\"']*)[\"']"), F.lit(1))
    extra = F.array(
        F.col("url"), F.lit("?z=1&utm_source=n&a=2&REF=q"), F.lit("#top"),
        F.concat(F.lit("HTTPS://Other.Example.ORG:8080/Path/"), "page_id", F.lit("?b=2&a=1#f")),
        F.concat(F.lit("//cdn.example.net/"), "page_id"), F.concat(F.lit("next/"), "page_id"), F.lit("   "),
    )
    return p.select("page_id", F.col("url").alias("base"), F.explode(F.concat(found, extra)).alias("href"))


@check("url_normalized", f"WITH {HREFS_SQL}, {NORMAL_SQL} SELECT page_id, href, target FROM normal")
def url_normalized(spark, sf):
    return hrefs(spark, sf).select("page_id", "href", urls.normalize_url("href", "base").alias("target"))


@check("url_base_domain", f"""
SELECT url, {domain_sql('url')} AS domain FROM pages
UNION ALL
SELECT british AS url, list_reverse(string_split({host_sql('british')}, '.'))[3] || '.co.uk' AS domain
FROM (SELECT 'http://www.sub.h' || page_id || '.co.uk:81/x' AS british FROM pages)""")
def url_base_domain(spark, sf):
    """Every given URL, and one with a two-part suffix for each page."""
    british = F.concat(F.lit("http://www.sub.h"), "page_id", F.lit(".co.uk:81/x"))
    rows = table(spark, sf, "pages").select(F.explode(F.array("url", british)).alias("url"))
    return rows.select("url", urls.base_domain("url").alias("domain"))


@check("link_internal_external", f"""WITH {HREFS_SQL}, {NORMAL_SQL}
SELECT page_id, count(*) FILTER (WHERE {domain_sql('target')} = {domain_sql('base')}) AS internal,
       count(*) FILTER (WHERE {domain_sql('target')} <> {domain_sql('base')}) AS external
FROM normal WHERE target IS NOT NULL GROUP BY page_id""")
def link_internal_external(spark, sf):
    rows = hrefs(spark, sf).withColumn("target", urls.normalize_url("href", "base")).where(F.col("target").isNotNull())
    out = urls.is_external("target", urls.base_domain("base"))
    return rows.groupBy("page_id").agg(F.count_if(~out).alias("internal"), F.count_if(out).alias("external"))


# Page URLs with a year and an extension on two thirds of them.
VARIANTS_SQL = """
v AS (
  SELECT page_id, CASE page_id % 3 WHEN 0 THEN url
    WHEN 1 THEN regexp_replace(url, '[?#].*$', '') || '/' || (2005 + page_id % 25) || '/a.html'
    ELSE regexp_replace(url, '[?#].*$', '') || '/pic' || page_id || '.PNG' END AS url FROM pages
)"""


def variants(spark, sf):
    bare = F.regexp_replace("url", "[?#].*$", "")
    n = F.col("page_id") % 3
    url = (
        F.when(n == 0, F.col("url"))
        .when(n == 1, F.concat(bare, F.lit("/"), F.col("page_id") % 25 + 2005, F.lit("/a.html")))
        .otherwise(F.concat(bare, F.lit("/pic"), "page_id", F.lit(".PNG")))
    )
    return table(spark, sf, "pages").select("page_id", url.alias("url"))


FILTERS = [
    links.PatternFilter(["*example.com/*", "*example.org/??/*"]),
    links.ContentTypeFilter(["text/html"]),
    links.DomainFilter(blocked=["m.example.org"], allowed=["example.com", "example.org"]),
    links.PatternFilter([r"/fr/"], use_glob=False, reverse=True, name="no_french"),
]
REASON_SQL = f"""CASE
  WHEN NOT (regexp_matches(url, '^.*example[.]com/.*$') OR regexp_matches(url, '^.*example[.]org/../.*$')) THEN 'pattern'
  WHEN ends_with(url, '.PNG') THEN 'content_type'
  WHEN NOT regexp_matches({host_sql('url')}, '(^|[.])example[.](com|org)$') OR regexp_matches({host_sql('url')}, '(^|[.])m[.]example[.]org$') THEN 'domain'
  WHEN contains(url, '/fr/') THEN 'no_french' END"""


@check("url_filter_chain", f"WITH {VARIANTS_SQL} SELECT page_id, {REASON_SQL} AS reason, ({REASON_SQL}) IS NULL AS passed FROM v")
def url_filter_chain(spark, sf):
    return links.filter_chain(variants(spark, sf), FILTERS).select("page_id", "reason", "passed")


@check("filter_stats", f"""WITH {VARIANTS_SQL}, r AS (SELECT {REASON_SQL} AS reason FROM v)
SELECT count(*) AS total, count(*) FILTER (WHERE reason IS NULL) AS passed, count(reason) AS rejected FROM r""")
def filter_stats(spark, sf):
    return links.filter_stats(links.filter_chain(variants(spark, sf), FILTERS))


SCORERS = [
    links.KeywordScorer(["EN", "example.com", "html"], weight=2.0),
    links.PathDepthScorer(optimal=3),
    links.ExtensionScorer({"html": 1.0, "png": 0.2}, default=0.4),
    links.FreshnessScorer(current_year=2024),
    links.DomainAuthorityScorer({"example.com": 0.9, "example.org": 0.7}, default=0.1, weight=0.5),
]
SCORES_SQL = f"""
s AS (
  SELECT page_id, url,
    (contains(lower(url), 'en')::INT + contains(lower(url), 'example.com')::INT + contains(lower(url), 'html')::INT) / 3.0::DOUBLE AS k,
    1.0::DOUBLE / (abs(len(list_filter(string_split({part('url', 3)}, '/'), lambda x: x <> '')) - 3) + 1) AS d,
    CASE WHEN ends_with(url, '.html') THEN 1.0 WHEN ends_with(url, '.PNG') THEN 0.2 ELSE 0.4 END::DOUBLE AS e,
    CASE WHEN y = '' THEN 0.5 ELSE greatest(1.0 - greatest(2024 - y::INT, 0) * 0.1::DOUBLE, 0.0) END::DOUBLE AS f,
    CASE {domain_sql('url')} WHEN 'example.com' THEN 0.9 WHEN 'example.org' THEN 0.7 ELSE 0.1 END::DOUBLE AS a
  FROM (SELECT *, CASE WHEN regexp_matches(url, '(^|[^0-9])(19|20)[0-9][0-9]([^0-9]|$)')
                       THEN regexp_extract(url, '(?:^|[^0-9])((?:19|20)[0-9][0-9])(?:[^0-9]|$)', 1) ELSE '' END AS y FROM v)
),
scored AS (SELECT *, (2.0 * k + d + e + f + 0.5 * a) / 5.5 AS score FROM s)"""


@check("url_scores", f"""WITH {VARIANTS_SQL}, {SCORES_SQL}
SELECT page_id, round(k, 6) AS score_keyword, round(d, 6) AS score_path_depth, round(e, 6) AS score_extension,
       round(f, 6) AS score_freshness, round(a, 6) AS score_authority, round(score, 6) AS score FROM scored""")
def url_scores(spark, sf):
    rows = links.score_urls(variants(spark, sf), SCORERS)
    return rows.select("page_id", *[F.round(c, 6).alias(c) for c in rows.columns if c.startswith("score")])


@check("score_stats", f"""WITH {VARIANTS_SQL}, {SCORES_SQL}
SELECT count(score) AS n, round(avg(score), 6) AS avg_score, round(min(score), 6) AS min_score, round(max(score), 6) AS max_score FROM scored""")
def score_stats(spark, sf):
    stats = links.score_stats(links.score_urls(variants(spark, sf), SCORERS))
    return stats.select("n", *[F.round(c, 6).alias(c) for c in ("avg_score", "min_score", "max_score")])


@check("keyword_policy_table", """
WITH w AS (SELECT item_id, regexp_extract_all(lower(text), '[a-z]{5,}', 0) AS ws FROM benchmark),
p AS (SELECT 'item ' || item_id AS policy, ws[1:2] AS include, ws[-1:] AS exclude FROM w),
d AS (SELECT doc_id, lower(text) AS text FROM documents)
SELECT doc_id, policy FROM d JOIN p
ON list_bool_or(list_transform(include, lambda t: contains(text, t))) AND NOT coalesce(list_bool_or(list_transform(exclude, lambda t: contains(text, t))), FALSE)""")
def keyword_policy_table(spark, sf):
    """A policy for every benchmark item: two of its words wanted, its last one not."""
    words = F.regexp_extract_all(F.lower("text"), F.lit("[a-z]{5,}"), F.lit(0))
    items = table(spark, sf, "benchmark").select(F.concat(F.lit("item "), "item_id").alias("policy"), words.alias("ws"))
    rules_ = items.select("policy", F.slice("ws", 1, 2).alias("include_terms"), F.slice("ws", -1, 1).alias("exclude_terms"))
    return policies.policy_matches(table(spark, sf, "documents"), rules_, key="doc_id", content="text")
