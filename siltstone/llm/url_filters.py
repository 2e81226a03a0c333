"""URL filters: host-suffix and path-prefix expressions, joined on short hash prefixes.

Each rule is an expression `host/path`. A URL is expanded into every suffix of its host
at a label boundary times every prefix of its path that is as long as some rule's
path. Expressions meet rules by an equi-join on the first four bytes of their SHA-256
digest; a match counts only if the full digests agree. Of the rules that fit, the
longest expression wins (between equal lengths the one with the longer host, then
block before allow). Only the short prefixes and the lengths of paths leave the rule
table before the join.

Host and path: host from the first `://` up to `/`, `?`, `#` or the end, A to Z in
lower case; path from there up to `?`, `#` or the end. Null URLs and URLs without
`://` have an empty host and path and no rule; nor does a URL without a path fit a
rule's path. The verdict without a rule is `allow`. Repeated pages are judged each;
other columns are not read; null rules are skipped, and of rules repeated with both
verdicts block wins.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table

DEFAULT = "allow"
# The query's rules: verdict, host, path.
RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: Column) -> tuple[Column, Column]:
    rest = F.when(F.instr(url, "://") > 0, F.expr("substring(_url, instr(_url, '://') + 3)"))
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), UPPER, LOWER)
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)
    return F.coalesce(host, F.lit("")), F.coalesce(path, F.lit(""))


def rules_table(rules: DataFrame) -> DataFrame:
    """verdict, host and path to the digests the join needs."""
    rule = F.concat("host", "path")
    known = rules.where(F.col("host").isNotNull() & F.col("path").isNotNull() & F.col("verdict").isNotNull())
    merged = known.withColumn("host", F.translate("host", UPPER, LOWER)).groupBy("host", "path").agg(F.max("verdict").alias("verdict"))
    return merged.select(
        rule.alias("rule"), "verdict", F.char_length("host").alias("host_length"), F.char_length("path").alias("path_length"),
        F.char_length(rule).alias("length"), F.sha2(rule, 256).alias("digest"),
    ).withColumn("short", F.substring("digest", 1, 8))


def judge(pages: DataFrame, rules: DataFrame, key: str = "page_id", url: str = "url", default: str = DEFAULT) -> DataFrame:
    """(key, host, path, rule, verdict) per row of `pages`."""
    prepared = rules_table(rules)
    # Distinct path lengths: bounded by the longest path a rule may have.
    lengths = prepared.agg(F.array_sort(F.collect_set("path_length")).alias("n")).scalar()
    host, path = host_and_path(F.col("_url"))
    urls = pages.select(F.col(key).alias("_key"), F.col(url).alias("_url")).select("_key", host.alias("host"), path.alias("path"))
    # Equal host and path get equal answers, so each is expanded and joined once.
    distinct = urls.select("host", "path").distinct().withColumn("_lengths", lengths)
    labels = F.split("host", r"\.", -1)
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    prefixes = F.transform(F.filter("_lengths", lambda n: n <= F.char_length("path")), lambda n: F.substring(F.col("path"), F.lit(1), n))
    expressions = F.flatten(F.transform(suffixes, lambda h: F.transform(prefixes, lambda p: F.concat(h, p))))
    expanded = (
        distinct.where(F.col("host") != "")
        .select("host", "path", F.explode(F.array_distinct(expressions)).alias("expression"))
        .withColumn("full", F.sha2("expression", 256))
        .withColumn("short", F.substring("full", 1, 8))
    )
    met = expanded.join(prepared, "short").where("full = digest")
    best = F.struct("length", "host_length", "verdict", "rule")
    chosen = met.groupBy("host", "path").agg(F.max(best).alias("best"))
    return (
        urls.join(chosen, ["host", "path"], "left")
        .select(
            F.col("_key").alias(key), "host", "path", F.col("best.rule").alias("rule"), F.coalesce("best.verdict", F.lit(default)).alias("verdict")
        )
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(list(RULES), "verdict string, host string, path string")
    return judge(table(spark, sf_dir, "pages"), rules)


# Each rule written out as a condition on host and path.
SQL = r"""
WITH u AS (
  SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) END AS rest FROM pages
), h AS (
  SELECT page_id,
    coalesce(translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
    coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path
  FROM u
), r AS (
  SELECT *, CASE
    WHEN (host = 'www.example.com' OR host LIKE '%.www.example.com') AND path LIKE '/en/%' THEN 'www.example.com/en/'
    WHEN (host = 'example.com' OR host LIKE '%.example.com') AND path LIKE '/en/%' THEN 'example.com/en/'
    WHEN (host = 'net' OR host LIKE '%.net') AND path LIKE '/es/%' THEN 'net/es/'
    WHEN (host = 'net' OR host LIKE '%.net') AND path LIKE '/fr/%' THEN 'net/fr/'
    WHEN (host = 'com' OR host LIKE '%.com') AND path LIKE '/%' THEN 'com/' END AS rule
  FROM h
)
SELECT page_id, host, path, rule,
  CASE WHEN rule IN ('example.com/en/', 'net/es/', 'net/fr/') THEN 'block' ELSE 'allow' END AS verdict
FROM r
"""
