"""Not-modified revisits of a crawl, resolved to the response they stand for.

Captures are sorted by (canonical URL, time, revisits after responses, record id) over
the whole crawl in ranges, so a URL that owns a third of all captures is spread over
many tasks like any other rows. Each task walks its range once and remembers the last
full response of the URL it is in; what it cannot know, the response before its range,
comes from one summary row per task. A revisit then takes the latest earlier full
response of its URL (as-of join), if the validators agree: a strong or weak ETag that
the revisit carries must equal the response's; without one, Last-Modified must; without
that, the payload digest; a revisit that carries none of them is taken as it is.
Headers are the response's, with those the revisit may update in their place.

Bodies stay where they are: the result names the record whose body holds.

Defined cases: null and blank URLs have no canonical form and resolve nothing; a null
time sorts before all others; equal times are ordered response first, then by record
id; repeated rows are captures of their own; null headers are empty; a URL without an
earlier response gives `no_response`; a disagreeing validator gives
`validator_mismatch`, and older responses are not tried; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import cut_lineage, table

# Headers that a 304 response may update (HTTP semantics, cache section).
PERMITTED = ("cache-control", "content-location", "date", "etag", "expires", "last-modified", "vary")
# Query parameters that name a campaign, not a resource.
TRACKING = r"(^|&)(utm_[a-z]+|gclid|fbclid|ref)=[^&]*"
_VALUES = ("response_id", "etag", "last_modified", "digest")


def canonical_url(url: Column) -> Column:
    """Scheme, default port, `www.` and `m.`, fragment, tracking parameters and a closing slash dropped; host in lower case."""
    u = F.trim(url)
    rest = F.regexp_replace(F.regexp_replace(u, r"^[A-Za-z][A-Za-z0-9+.-]*://", ""), r"#.*$", "")
    host = F.regexp_replace(F.lower(F.regexp_extract(rest, r"^[^/?]*", 0)), r"^(www|m)\.|:(80|443)$", "")
    path = F.regexp_replace(F.regexp_extract(rest, r"^[^/?]*([^?]*)", 1), r"/+$", "")
    query = F.regexp_replace(F.regexp_replace(F.regexp_extract(rest, r"\?(.*)$", 1), TRACKING, ""), r"^&+", "")
    whole = F.concat(host, path, F.when(query != "", F.concat(F.lit("?"), query)).otherwise(F.lit("")))
    return F.when(host != "", whole)


def resolve(captures: DataFrame) -> DataFrame:
    """(record_id, url_key, status, response_id, headers) per revisit of `captures`.

    `captures`: record_id, url, time, kind ('response' or 'revisit'), etag,
    last_modified, digest, headers (map of lower-case names).
    """
    spark = captures.sparkSession
    thin = captures.where(F.col("kind").isin("response", "revisit")).select(
        F.col("record_id").cast("long").alias("record_id"), canonical_url(F.col("url")).alias("url_key"), F.col("time").cast("long").alias("time"),
        (F.col("kind") == "revisit").alias("revisit"), "etag", "last_modified", "digest",
    )
    order = ["url_key", "time", "revisit", "record_id"]
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    walked = (
        thin.where(F.col("url_key").isNotNull())
        .repartitionByRange(parts, *order)
        .sortWithinPartitions(*order)
        .mapInPandas(_walk, "part int, record_id long, url_key string, revisit boolean, etag string, last_modified string, digest string, open boolean, r_response_id long, r_etag string, r_last_modified string, r_digest string, first string, n long")
    )
    walked = cut_lineage(walked, "walked")
    rows = walked.where("n is null and revisit")
    # One row per task: its first URL, and its last response with that one's URL.
    carried, latest = [], None
    for r in walked.where("n is not null").orderBy("part").collect():
        if latest is not None and latest["url_key"] == r["first"]:
            carried.append((r["part"], *[latest[f"r_{v}"] for v in _VALUES]))
        if r["r_response_id"] is not None:
            latest = r
        elif latest is not None and latest["url_key"] != r["url_key"]:
            latest = None
    before = spark.createDataFrame(carried, "part int, c_response_id long, c_etag string, c_last_modified string, c_digest string")
    # As many rows as tasks, at most.
    joined = rows.join(F.broadcast(before), "part", "left")
    for v in _VALUES:
        joined = joined.withColumn(v if v == "response_id" else f"r_{v}", F.when(F.col("open"), F.col(f"c_{v}")).otherwise(F.col(f"r_{v}")))
    agrees = (
        F.when(F.col("etag").isNotNull(), _strong(F.col("etag")).eqNullSafe(_strong(F.col("r_etag"))))
        .when(F.col("last_modified").isNotNull(), F.col("last_modified").eqNullSafe(F.col("r_last_modified")))
        .when(F.col("digest").isNotNull(), F.col("digest").eqNullSafe(F.col("r_digest")))
        .otherwise(F.lit(True))
    )
    status = F.when(F.col("response_id").isNull(), "no_response").when(agrees, "resolved").otherwise("validator_mismatch")
    judged = joined.select("record_id", "url_key", status.alias("status"), F.when(status == "resolved", F.col("response_id")).alias("response_id"))
    unkeyed = thin.where(F.col("url_key").isNull() & F.col("revisit")).select(
        "record_id", "url_key", F.lit("no_response").alias("status"), F.lit(None).cast("long").alias("response_id")
    )
    return _with_headers(judged.unionByName(unkeyed), captures)


def _strong(etag: Column) -> Column:
    return F.regexp_replace(etag, r"^W/", "")


def _walk(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows of one range in order, each revisit with the last response of its URL in the range.

    `open`: no response of the URL yet, and the URL is the first of the range. The
    last row is the summary.
    """
    from pyspark import TaskContext

    part = TaskContext.get().partitionId()
    first, url, held, n = None, None, None, 0
    for batch in batches:
        out = []
        for record, key, revisit, etag, modified, digest in zip(*(batch[c] for c in ("record_id", "url_key", "revisit", "etag", "last_modified", "digest")), strict=True):
            first = key if n == 0 else first
            n += 1
            if key != url:
                url, held = key, None
            if revisit:
                out.append((part, record, key, True, etag, modified, digest, held is None and key == first, *(held or (None,) * 4), None, None))
            else:
                held = (record, etag, modified, digest)
        yield pd.DataFrame(out, columns=_COLUMNS).astype({"r_response_id": "Int64", "record_id": "Int64", "n": "Int64"})
    if n:
        row = (part, None, url, False, None, None, None, False, *(held or (None,) * 4), first, n)
        yield pd.DataFrame([row], columns=_COLUMNS).astype({"r_response_id": "Int64", "record_id": "Int64", "n": "Int64"})


_COLUMNS = ["part", "record_id", "url_key", "revisit", "etag", "last_modified", "digest", "open", *[f"r_{v}" for v in _VALUES], "first", "n"]


def _with_headers(judged: DataFrame, captures: DataFrame) -> DataFrame:
    """Merge the headers: both sides are joined by record id, a response's headers once per revisit."""
    held = captures.select(F.col("record_id").cast("long").alias("_id"), F.coalesce("headers", F.create_map().cast("map<string,string>")).alias("_headers"))
    held = held.groupBy("_id").agg(F.max(F.array_sort(F.map_entries("_headers"))).alias("_headers")).withColumn("_headers", F.map_from_entries("_headers"))
    own = judged.join(held, judged["record_id"] == held["_id"], "left").drop("_id").withColumnRenamed("_headers", "own")
    both = own.join(held, own["response_id"] == held["_id"], "left").drop("_id").withColumnRenamed("_headers", "base")
    updates = F.map_filter("own", lambda k, _: k.isin(*PERMITTED))
    merged = F.map_concat(F.map_filter("base", lambda k, _: ~F.map_contains_key(updates, k)), updates)
    return both.select("record_id", "url_key", "status", "response_id", F.when(F.col("response_id").isNotNull(), merged).otherwise(F.col("own")).alias("headers"))


def captures_of(pages: DataFrame) -> DataFrame:
    """A crawl log over the pages: each page fetched once, then visited again.

    A page is captured as a response, two revisits with validators that agree or not
    by its id, and every fourth page as a revisit before the response; pages of one
    host also revisit the host's front page, so hosts with many pages have a hot URL.
    """
    body = F.md5(F.coalesce("html", F.lit("")))
    t = F.col("page_id") * 10
    front = F.concat(F.lit("http://"), F.regexp_extract("url", r"://([^/?#]*)", 1), F.lit("/"))
    domain = F.concat(F.lit("http://"), F.regexp_extract("url", r"([^./]+\.[^./?#]+)([/?#].*)?$", 1), F.lit("/"))

    def capture(kind: str, at: Column, n: int, url: Column, etag: Column, modified: Column, digest: Column) -> Column:
        return F.struct(
            (F.col("page_id") * 8 + n).alias("record_id"), url.alias("url"), at.alias("time"), F.lit(kind).alias("kind"), etag.alias("etag"),
            modified.alias("last_modified"), digest.alias("digest"),
            F.create_map(F.lit("content-type"), F.lit("text/html"), F.lit("date"), at.cast("string"), F.lit("server"), F.lit(kind)).alias("headers"),
        )

    none = F.lit(None).cast("string")
    stamp = F.concat(F.lit("day "), F.pmod("page_id", F.lit(7)).cast("string"))
    stale = F.when(F.pmod("page_id", F.lit(5)) == 0, F.lit("old")).otherwise(body)
    log = [
        capture("response", t, 0, F.col("url"), body, stamp, body),
        capture("revisit", t + 3, 1, F.concat("url", F.lit("#again")), F.concat(F.lit("W/"), stale), none, none),
        capture("revisit", t + 4, 2, F.col("url"), none, stamp, none),
        F.when(F.pmod("page_id", F.lit(4)) == 0, capture("revisit", t - 1, 3, F.col("url"), none, none, body)),
        capture("revisit", t + 5, 4, front, none, none, none),
        F.when(F.pmod("page_id", F.lit(50)) == 0, capture("response", t, 5, domain, body, stamp, body)),
        capture("revisit", t + 6, 6, domain, none, none, none),
    ]
    return pages.select("page_id", "url", "html").select(F.explode(F.array_compact(F.array(*log))).alias("c")).select("c.*")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = cut_lineage(captures_of(table(spark, sf_dir, "pages")), "captures")
    resolved = resolve(log)
    return resolved.select(
        "record_id", "url_key", "status", F.coalesce("response_id", F.lit(-1)).alias("response_id"), F.element_at("headers", "date").alias("date"), F.element_at("headers", "server").alias("server")
    )


SQL = r"""
WITH p AS (
  SELECT page_id, url, md5(coalesce(html, '')) AS body, page_id * 10 AS t, 'day ' || (page_id % 7) AS stamp,
    'http://' || regexp_extract(url, '://([^/?#]*)', 1) || '/' AS front,
    'http://' || regexp_extract(url, '([^./]+\.[^./?#]+)([/?#].*)?$', 1) || '/' AS domain
  FROM pages
), c AS (
  SELECT page_id * 8 AS id, url, t AS time, 0 AS revisit, body AS etag, stamp AS lm, body AS digest FROM p
  UNION ALL SELECT page_id * 8 + 1, url || '#again', t + 3, 1, CASE WHEN page_id % 5 = 0 THEN 'old' ELSE body END, NULL, NULL FROM p
  UNION ALL SELECT page_id * 8 + 2, url, t + 4, 1, NULL, stamp, NULL FROM p
  UNION ALL SELECT page_id * 8 + 3, url, t - 1, 1, NULL, NULL, body FROM p WHERE page_id % 4 = 0
  UNION ALL SELECT page_id * 8 + 4, front, t + 5, 1, NULL, NULL, NULL FROM p
  UNION ALL SELECT page_id * 8 + 5, domain, t, 0, body, stamp, body FROM p WHERE page_id % 50 = 0
  UNION ALL SELECT page_id * 8 + 6, domain, t + 6, 1, NULL, NULL, NULL FROM p
), s AS (
  SELECT *, regexp_replace(regexp_replace(trim(url), '^[A-Za-z][A-Za-z0-9+.-]*://', ''), '#.*$', '') AS rest FROM c
), q AS (
  SELECT *, regexp_replace(lower(regexp_extract(rest, '^[^/?]*')), '^(www|m)\.|:(80|443)$', '', 'g') AS host,
    regexp_replace(regexp_extract(rest, '^[^/?]*([^?]*)', 1), '/+$', '') AS path,
    regexp_replace(regexp_replace(regexp_extract(rest, '\?(.*)$', 1), '(^|&)(utm_[a-z]+|gclid|fbclid|ref)=[^&]*', '', 'g'), '^&+', '') AS query
  FROM s
), k AS (
  SELECT *, host || path || CASE WHEN query <> '' THEN '?' || query ELSE '' END AS url_key FROM q
), m AS (
  SELECT v.id AS record_id, v.url_key, v.time, v.etag, v.lm, v.digest,
    (SELECT max({'time': r.time, 'id': r.id}) FROM k r WHERE r.revisit = 0 AND r.url_key = v.url_key AND r.time <= v.time) AS found
  FROM k v WHERE v.revisit = 1
), j AS (
  SELECT m.*, r.id AS rid, CASE
    WHEN r.id IS NULL THEN 'no_response'
    WHEN CASE WHEN m.etag IS NOT NULL THEN m.etag = r.etag WHEN m.lm IS NOT NULL THEN m.lm = r.lm WHEN m.digest IS NOT NULL THEN m.digest = r.digest ELSE true END
    THEN 'resolved' ELSE 'validator_mismatch' END AS status
  FROM m LEFT JOIN k r ON r.id = m.found.id AND r.revisit = 0
)
SELECT record_id, url_key, status, CASE WHEN status = 'resolved' THEN rid ELSE -1 END AS response_id, CAST(time AS VARCHAR) AS date,
  CASE WHEN status = 'resolved' THEN 'response' ELSE 'revisit' END AS server
FROM j
"""
