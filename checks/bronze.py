"""Bronze lake and silver layers."""

from pyspark.sql import functions as F

from siltstone.plans import silver as S
from siltstone.plans import silver_delta
from siltstone.scale import new_path
from siltstone.schema import BRONZE, enforce
from siltstone.sources import lake as L

from .fixtures import BRONZE_SQL, DEDUPED_SQL, bronze, lake, records, sql_time, text_time, written_lake
from .registry import check, table

FIELDS = ["chunk_id", "source_url", "content", "ingested_at", "language"]


@check("bronze_roundtrip", f"""WITH {BRONZE_SQL}
SELECT chunk_id, source_url, content, ingested_at, language, TRUE AS embedding_is_null FROM bronze""")
def bronze_roundtrip(spark, sf):
    read = lake(spark, sf, corrupt_column="_bad")
    return read.where(F.col("_bad").isNull()).select(*FIELDS, F.col("embedding").isNull().alias("embedding_is_null"))


@check("bronze_source_column", f"WITH {BRONZE_SQL} SELECT source, count(*) AS n FROM bronze GROUP BY source")
def bronze_source_column(spark, sf):
    return lake(spark, sf).groupBy("source").agg(F.count(F.lit(1)).alias("n"))


@check("bronze_file_inventory", f"""WITH {BRONZE_SQL}
SELECT source, TRUE AS has_files, TRUE AS has_bytes, TRUE AS has_time FROM (SELECT DISTINCT source FROM bronze)""")
def bronze_file_inventory(spark, sf):
    """Numbers and sizes of files depend on the writing tasks; what must hold for each source does not."""
    found = L.file_inventory(spark, written_lake(spark, sf)[0])
    return found.select(
        "source", (F.col("n_files") > 0).alias("has_files"), (F.col("bytes") > 0).alias("has_bytes"), F.col("last_modified").isNotNull().alias("has_time")
    )


@check("bronze_write_count", f"WITH {BRONZE_SQL} SELECT count(*) AS written, count(*) AS found FROM bronze")
def bronze_write_count(spark, sf):
    root, written = written_lake(spark, sf)
    return L.read_bronze(spark, root).agg(F.lit(written).cast("long").alias("written"), F.count(F.lit(1)).alias("found"))


@check("ingested_date_counts", f"""WITH {BRONZE_SQL}
SELECT strftime(make_timestamp(CAST(trunc(ingested_at) AS BIGINT) * 1000000), '%Y-%m-%d') AS ingested_date, count(*) AS n
FROM bronze GROUP BY 1""")
def ingested_date_counts(spark, sf):
    read = lake(spark, sf, with_partitions=True)
    return read.groupBy(F.col("ingested_date").cast("string").alias("ingested_date")).agg(F.count(F.lit(1)).alias("n"))


URL_PARTS = r"""
parts AS (
  SELECT url, regexp_extract(url, '^(?:[A-Za-z][A-Za-z0-9+.-]*:)?(?://([^/?#]*))?', 1) AS authority,
         regexp_replace(regexp_extract(url, '^(?:[A-Za-z][A-Za-z0-9+.-]*:)?(?://[^/?#]*)?([^?#]*)', 1), ';[^/]*$', '') AS path
  FROM (SELECT url FROM pages UNION ALL SELECT source_url FROM bronze)
)"""


@check("bronze_target_dir", f"""WITH {BRONZE_SQL}, {URL_PARTS}
SELECT url, translate(CASE WHEN authority = '' THEN 'unknown' ELSE authority END, '/:.', '___') || '_' ||
       translate(CASE WHEN trim(path, '/') = '' THEN 'root' ELSE trim(path, '/') END, '/:.', '___') AS target_dir
FROM parts""")
def bronze_target_dir(spark, sf):
    urls = table(spark, sf, "pages").select("url").unionByName(bronze(spark, sf).select(F.col("source_url").alias("url")))
    return urls.select("url", L.target_dir("url").alias("target_dir"))


@check("bronze_schema_enforced", f"""WITH {BRONZE_SQL}
SELECT chunk_id, source_url, length(content) AS n, CAST(CAST(ingested_at AS BIGINT) AS DOUBLE) AS ingested_at, language,
       TRUE AS embedding_is_null
FROM (SELECT * REPLACE (trunc(ingested_at) AS ingested_at) FROM bronze)""")
def bronze_schema_enforced(spark, sf):
    # A wrong column order, an extra column, an integer time and no embedding.
    loose = records(spark, sf).select(
        "language", "content", F.lit(1).alias("extra"), F.coalesce(F.col("ingested_at").cast("int"), F.lit(0)).alias("ingested_at"),
        "source_url", "chunk_id",
    )
    typed = enforce(loose, BRONZE)
    return typed.select(
        "chunk_id", "source_url", F.length("content").cast("long").alias("n"), "ingested_at", "language",
        F.col("embedding").isNull().alias("embedding_is_null"),
    )


@check("bronze_count", f"WITH {BRONZE_SQL} SELECT count(*) AS n FROM bronze")
def bronze_count(spark, sf):
    return S.row_count(lake(spark, sf))


@check("silver_hashed", f"WITH {DEDUPED_SQL} SELECT chunk_id, content_hash FROM hashed")
def silver_hashed(spark, sf):
    return S.hashed(lake(spark, sf)).select("chunk_id", "content_hash")


@check("silver_deduped", f"WITH {DEDUPED_SQL} SELECT chunk_id, source, content_hash, CAST(rn AS INTEGER) AS rn FROM deduped")
def silver_deduped(spark, sf):
    return lake(spark, sf).transform(S.hashed).transform(S.deduped).select("chunk_id", "source", "content_hash", "rn")


@check("dedup_summary", f"""WITH {DEDUPED_SQL}
SELECT b.source, b.n_before, d.n_after FROM (SELECT source, count(*) AS n_before FROM bronze GROUP BY source) b
JOIN (SELECT source, count(*) AS n_after FROM deduped GROUP BY source) d ON b.source = d.source""")
def dedup_summary(spark, sf):
    rows = S.hashed(bronze(spark, sf))
    kept = rows.transform(S.deduped).groupBy("source").agg(F.count(F.lit(1)).alias("n_after"))
    return rows.groupBy("source").agg(F.count(F.lit(1)).alias("n_before")).join(kept, "source")


@check("silver_time_buckets", f"""WITH {DEDUPED_SQL}
SELECT chunk_id, {sql_time('ingested_ts', 'ingest_day', 'ingest_hour')} FROM bucketed""")
def silver_time_buckets(spark, sf):
    rows = lake(spark, sf).transform(S.hashed).transform(S.deduped).transform(S.time_buckets)
    return rows.select("chunk_id", *text_time("ingested_ts", "ingest_day", "ingest_hour"))


@check("silver_classified", f"WITH {DEDUPED_SQL} SELECT chunk_id, content_type FROM classified")
def silver_classified(spark, sf):
    return S.silver(lake(spark, sf)).select("chunk_id", "content_type")


@check("silver_classified_v1", f"""WITH {DEDUPED_SQL}
SELECT chunk_id, CASE WHEN contains(content, 'Skip to content') THEN 'listing'
                      WHEN contains(content, 'By ') AND length(content) > 2000 THEN 'article_like'
                      WHEN length(content) < 1000 THEN 'short' ELSE 'unknown' END AS content_type
FROM deduped""")
def silver_classified_v1(spark, sf):
    return S.silver(lake(spark, sf), variant="v1").select("chunk_id", "content_type")


@check("silver_pieces", f"WITH {DEDUPED_SQL} SELECT chunk_id, sha256(substring(content, 1, 500)) AS prefix_hash FROM classified")
def silver_pieces(spark, sf):
    return S.silver(lake(spark, sf)).select("chunk_id", "prefix_hash")


VERTICAL_SQL = DEDUPED_SQL + """,
vertical AS (
  SELECT *, concat_ws(chr(10), 'SOURCE: ' || source, 'TYPE: ' || content_type,
    'INGEST_DAY: ' || strftime(ingest_day, '%Y-%m-%d %H:%M:%S'), 'LEN: ' || length(content), '', '----- HEAD -----',
    substring(content, 1, 800), '', '----- MID -----',
    substring(content, greatest(CAST(trunc(length(content) / 2) AS BIGINT), 1), 800), '', '----- TAIL -----',
    substring(content, greatest(length(content) - 800, 1), 800)) AS record
  FROM classified
)"""


@check("silver_vertical", f"WITH {VERTICAL_SQL} SELECT chunk_id, record FROM vertical")
def silver_vertical(spark, sf):
    return S.vertical(S.silver(lake(spark, sf))).select("chunk_id", "record")


@check("silver_sample", f"WITH {VERTICAL_SQL} SELECT chunk_id, record FROM vertical ORDER BY chunk_id LIMIT 5")
def silver_sample(spark, sf):
    return S.sample(S.vertical(S.silver(lake(spark, sf)))).select("chunk_id", "record")


@check("silver_via_sql", f"""WITH {DEDUPED_SQL}
SELECT content_type, source, count(*) AS n, sum(length(content))::BIGINT AS chars FROM classified GROUP BY ALL""")
def silver_via_sql(spark, sf):
    lake(spark, sf).createOrReplaceTempView("bronze_df")
    S.silver_sql(spark, "bronze_df")
    return spark.sql(
        "SELECT content_type, source, count(*) AS n, sum(length(content)) AS chars FROM s1_pieces GROUP BY ALL"
    )


@check("kb_roundtrip", f"""WITH {BRONZE_SQL}
SELECT chunk_id, source_url, language, length(content) AS n FROM bronze""")
def kb_roundtrip(spark, sf):
    kb = bronze(spark, sf).select("chunk_id", "source_url", "language", "content")
    path = new_path(spark, "kb")
    L.export_kb(kb, path)
    back = L.import_kb(spark, path, kb.schema)
    return back.select("chunk_id", "source_url", "language", F.length("content").cast("long").alias("n"))


@check("silver_by_delta", f"""WITH {DEDUPED_SQL}
SELECT chunk_id, source, content_hash, content_type, sha256(substr(content, 1, 500)) AS prefix_hash, {sql_time('ingested_ts', 'ingest_day', 'ingest_hour')}
FROM classified""")
def silver_by_delta(spark, sf):
    """Three bronze batches, the last records first, one of them applied twice."""
    root = new_path(spark, "silver") + "/records"
    rows = lake(spark, sf)
    for number, part in enumerate((2, 0, 1)):
        some = rows.where(F.pmod(F.xxhash64("chunk_id"), F.lit(3)) == part)
        for _ in range(1 + (number == 1)):
            silver_delta.apply_batch(spark, some, root, number, buckets=16)
    return silver_delta.silver_now(spark, root).select(
        "chunk_id", "source", "content_hash", "content_type", "prefix_hash", *text_time("ingested_ts", "ingest_day", "ingest_hour")
    )
