"""Topics, offsets, group buffers and the two streams."""

from pyspark.sql import functions as F

from siltstone.operators.records import group_flush, to_bronze_record
from siltstone.plans import crawl
from siltstone.scale import new_path
from siltstone.schema import DISCOVERY
from siltstone.sources import topics
from siltstone.sources.lake import read_bronze, write_bronze
from siltstone.sources.visited import Visited
from siltstone.streaming import event_time, first_seen, jobs

from .fixtures import BRONZE_SQL, bronze
from .policy import KEYWORD_SQL, POLICY, STRIP_SQL, VERDICTS_SQL, verdicts
from .registry import check, table

# events as a topic: topic = event_type, partition = user_id mod 4, offset = event_id, value = props,
# with every 13th value cut short and every 17th missing.
MESSAGES_SQL = """
messages AS (
  SELECT event_type AS topic, CAST(user_id % 4 AS INTEGER) AS part, event_id AS "offset", CAST(user_id AS VARCHAR) AS key,
         CASE WHEN event_id % 17 = 0 THEN NULL WHEN event_id % 13 = 0 THEN substr(props, 1, 5) ELSE props END AS value
  FROM events
)"""


def messages(spark, sf):
    e = table(spark, sf, "events")
    value = F.when(F.col("event_id") % 17 == 0, F.lit(None)).when(
        F.col("event_id") % 13 == 0, F.substring("props", 1, 5)
    ).otherwise(F.col("props"))
    return e.select(
        F.col("event_type").alias("topic"),
        (F.col("user_id") % 4).cast("int").alias("partition"),
        F.col("event_id").alias("offset"),
        F.col("ts").alias("timestamp"),
        F.col("user_id").cast("string").alias("key"),
        value.alias("value"),
    )


@check("topic_source_batch", f"""WITH {MESSAGES_SQL}
SELECT topic, part AS partition, count(*) AS n, count(value) AS n_values, min("offset") AS first_offset, max("offset") AS last_offset
FROM messages WHERE topic IN ('click', 'error') GROUP BY ALL""")
def topic_source_batch(spark, sf):
    path = new_path(spark, "topics")
    topics.write_topic(messages(spark, sf), "json", path)
    rows = topics.read_topic(spark, "json", path, ["click", "error"])
    return rows.groupBy("topic", "partition").agg(
        F.count(F.lit(1)).alias("n"),
        F.count("value").alias("n_values"),
        F.min("offset").alias("first_offset"),
        F.max("offset").alias("last_offset"),
    )


@check("topic_sink_rows", """
SELECT 'discovery_queue' AS topic, url AS key, '{"url":"' || url || '","language":' ||
       CASE WHEN lang = 'fr' THEN 'null' ELSE '"' || lang || '"' END || '}' AS value
FROM (SELECT url, regexp_extract(url, '^https?://[^/]*/([^/?#]*)', 1) AS lang FROM pages)""")
def topic_sink_rows(spark, sf):
    language = F.regexp_extract("url", "^https?://[^/]*/([^/?#]*)", 1)
    rows = table(spark, sf, "pages").select("url", F.when(language != "fr", language).alias("language"))
    path = new_path(spark, "topics")
    topics.write_topic(topics.encode(rows, "discovery_queue", "url", ["url", "language"]), "json", path)
    return topics.read_topic(spark, "json", path, ["discovery_queue"]).select("topic", "key", "value")


@check("seed_messages", """
SELECT 'discovery_queue' AS topic, url AS key, url, lang AS language FROM (
  SELECT url, regexp_extract(url, '^https?://[^/]*/([^/?#]*)', 1) AS lang FROM pages) WHERE lang NOT IN ('de', 'es')""")
def seed_messages(spark, sf):
    language = F.regexp_extract("url", "^https?://[^/]*/([^/?#]*)", 1)
    seeds = table(spark, sf, "pages").select(language.alias("language"), "url")
    good, _ = topics.decode(crawl.seed_messages(seeds, blocked=["de", "es"]), DISCOVERY, required=["url"])
    return good.select("topic", "key", "data.url", "data.language")


@check("visited_messages", "SELECT 'visited_urls' AS topic, url AS key, '1' AS value FROM pages GROUP BY url")
def visited_messages(spark, sf):
    """Through the streaming sink: pages as discovery messages in, visited messages out."""
    base = new_path(spark, "visited")
    pages = table(spark, sf, "pages")
    sent = topic_rows(pages, "discovery_queue", F.col("page_id"), F.to_json(F.struct("url")))
    topics.write_topic(sent, "json", f"{base}/in")
    source = topics.read_topic(spark, "json", f"{base}/in", ["discovery_queue"], stream=True)
    urls = jobs.first_seen_stream(source).select("url")
    out = crawl.visited_messages(urls)
    topics.write_topic_stream(out, "json", f"{base}/out", f"{base}/checkpoint").awaitTermination()
    return topics.read_topic(spark, "json", f"{base}/out", ["visited_urls"]).select("topic", "key", "value")


@check("topic_decode_good", f"""WITH {MESSAGES_SQL}
SELECT topic, "offset", CAST(regexp_extract(value, '"k": ([0-9]+)', 1) AS INTEGER) AS k FROM messages
WHERE value IS NOT NULL AND json_valid(value)""")
def topic_decode_good(spark, sf):
    from pyspark.sql.types import IntegerType, StructField, StructType

    good, _ = topics.decode(messages(spark, sf), StructType([StructField("k", IntegerType())]), required=["k"])
    return good.select("topic", "offset", F.col("data.k").alias("k"))


@check("topic_decode_dead", f"""WITH {MESSAGES_SQL}
SELECT topic, "offset", value, CASE WHEN value IS NULL THEN 'empty payload' WHEN NOT json_valid(value) THEN 'invalid json'
  ELSE 'missing url' END AS error FROM messages""")
def topic_decode_dead(spark, sf):
    # These messages carry no url, so as discovery messages every one of them is dead.
    _, dead = topics.decode(messages(spark, sf), DISCOVERY, required=["url"])
    return dead.select("topic", "offset", "value", "error")


@check("topic_offsets", f"""WITH {MESSAGES_SQL}
SELECT topic, part AS partition, max("offset") + 1 AS next_offset FROM messages GROUP BY ALL""")
def topic_offsets(spark, sf):
    return topics.next_offsets(messages(spark, sf))


GROUPS_SQL = f"""{MESSAGES_SQL},
placed AS (
  SELECT key, "offset", row_number() OVER (PARTITION BY key ORDER BY "offset") AS rn, count(*) OVER (PARTITION BY key) AS n FROM messages
)"""


@check("group_flush_ready", f"""WITH {GROUPS_SQL} SELECT key, "offset" FROM placed WHERE rn <= n - n % 5""")
def group_flush_ready(spark, sf):
    return group_flush(messages(spark, sf), "key", "offset", 5).where("ready").select("key", "offset")


@check("group_flush_pending", f"""WITH {GROUPS_SQL} SELECT key, "offset" FROM placed WHERE rn > n - n % 5""")
def group_flush_pending(spark, sf):
    return group_flush(messages(spark, sf), "key", "offset", 5).where("NOT ready").select("key", "offset")


def topic_rows(df, topic, offset, value):
    """Message rows of one topic; `offset` is a long column."""
    return df.select(
        F.lit(topic).alias("topic"),
        F.pmod(offset, F.lit(4)).cast("int").alias("partition"),
        offset.alias("offset"),
        F.timestamp_seconds(F.lit(1704067200) + offset).alias("timestamp"),
        F.lit(None).cast("string").alias("key"),
        value.alias("value"),
    )


@check("stream_discovery", """
SELECT url, CASE WHEN bool_or(contains(url, '/en/')) THEN 'first' ELSE 'en' END AS language, TRUE AS visited, 'once' AS runs
FROM pages GROUP BY url""")
def stream_discovery(spark, sf):
    """English pages first, then every page without a language, with broken messages between."""
    pages = table(spark, sf, "pages")
    base = new_path(spark, "discovery")
    first = F.to_json(F.struct("url", F.lit("first").alias("language")))
    again = F.when(F.col("page_id") % 10 == 3, F.lit("{broken")).otherwise(F.lit(None))
    wave1 = topic_rows(pages.where("contains(url, '/en/')"), "discovery_queue", F.col("page_id"), first)
    wave2 = topic_rows(pages, "discovery_queue", F.col("page_id") + 1_000_000_000, F.to_json(F.struct("url")))
    noise = topic_rows(pages, "discovery_queue", F.col("page_id") + 2_000_000_000, again)
    run = lambda: jobs.discovery(
        spark,
        topics.read_topic(spark, "json", f"{base}/topics", ["discovery_queue"], stream=True, max_per_trigger=12),
        f"{base}/visited", f"{base}/work", f"{base}/checkpoint", f"{base}/dead",
    ).awaitTermination()
    for wave in (wave1, wave2.unionByName(noise)):
        topics.write_topic(wave, "json", f"{base}/topics")
        run()
    run()  # nothing new: must add nothing
    work = spark.read.parquet(f"{base}/work")
    seen = spark.read.parquet(f"{base}/visited").groupBy("url").agg(F.count(F.lit(1)).alias("n"))
    times = F.when(F.col("n") == 1, "once").otherwise("repeated")
    return work.join(seen, "url", "left").select(
        "url", "language", F.col("n").isNotNull().alias("visited"), times.alias("runs")
    )


@check("stream_ingest", f"""WITH {BRONZE_SQL}, {VERDICTS_SQL}
SELECT chunk_id, source_url, sha256({STRIP_SQL.format('content')}) AS content_hash, CAST(1704200000.5 AS DOUBLE) AS ingested_at, language
FROM bronze LEFT JOIN verdicts USING (doc_id) WHERE {KEYWORD_SQL} AND (answer IS NULL OR answer = 'RELEVANT')""")
def stream_ingest(spark, sf):
    base = new_path(spark, "ingest")
    docs = bronze(spark, sf)
    value = F.to_json(F.struct("chunk_id", "source_url", "content", "ingested_at", "language"))
    broken = topic_rows(docs, "relevant_chunks", F.col("doc_id") + 1_000_000_000, F.lit("{broken"))
    sent = topic_rows(docs, "relevant_chunks", F.col("doc_id"), value).unionByName(broken)
    topics.write_topic(sent.repartition(6, "offset"), "json", f"{base}/topics")
    keyed = docs.join(verdicts(spark, sf), "doc_id").select("chunk_id", "answer")
    for _ in range(2):  # the second run finds nothing new
        source = topics.read_topic(spark, "json", f"{base}/topics", ["relevant_chunks"], stream=True, max_per_trigger=3)
        jobs.ingest(
            spark, source, f"{base}/bronze", POLICY, f"{base}/checkpoint", verdicts=keyed, now=1704200000.5,
            dead_path=f"{base}/dead",
        ).awaitTermination()
    rows = read_bronze(spark, f"{base}/bronze")
    return rows.select("chunk_id", "source_url", F.sha2("content", 256).alias("content_hash"), "ingested_at", "language")


@check("bronze_batch_replay", f"""WITH {BRONZE_SQL}
SELECT chunk_id, source_url, CAST(86400.25 AS DOUBLE) AS ingested_at, language FROM bronze WHERE doc_id % 3 <> 0""")
def bronze_batch_replay(spark, sf):
    """A batch written just before midnight and again just after it with fewer records; another one replayed empty."""
    root = new_path(spark, "replay") + "/bronze"
    docs = bronze(spark, sf)
    write_bronze(to_bronze_record(docs, 86399.75), root, batch=7)
    write_bronze(to_bronze_record(docs, 86399.75), root, batch=8)
    write_bronze(to_bronze_record(docs.where("doc_id % 3 <> 0"), 86400.25), root, batch=7)
    write_bronze(to_bronze_record(docs.limit(0), 86400.25), root, batch=8)
    return read_bronze(spark, root).select("chunk_id", "source_url", "ingested_at", "language")


@check("stream_first_seen", """
WITH sent AS (
  SELECT url, page_id + 2000000000 AS "offset", 'late' AS language, 0 AS wave FROM pages
  UNION ALL SELECT url, page_id + 1000000000, 'mid', 1 FROM pages WHERE page_id % 2 = 0
  UNION ALL SELECT url, page_id, 'en', 2 FROM pages WHERE page_id % 5 = 0)
SELECT url, arg_min(language, "offset") AS language, min("offset") AS "offset", count(DISTINCT wave) - 1 AS corrections
FROM sent GROUP BY url""")
def stream_first_seen(spark, sf):
    """Three waves, the latest messages first, each in a run of its own: state is restored between them."""
    pages = table(spark, sf, "pages")
    base = new_path(spark, "first-seen")
    session = spark.newSession()
    session.conf.set(first_seen.PROVIDER, first_seen.ROCKSDB)
    waves = [
        (pages, 2_000_000_000, F.struct("url", F.lit("late").alias("language"))),
        (pages.where("page_id % 2 = 0"), 1_000_000_000, F.struct("url", F.lit("mid").alias("language"))),
        (pages.where("page_id % 5 = 0"), 0, F.struct("url")),
    ]
    for some, offset, value in waves:
        topics.write_topic(topic_rows(some, "discovery_queue", F.col("page_id") + offset, F.to_json(value)), "json", f"{base}/topics")
        source = topics.read_topic(session, "json", f"{base}/topics", ["discovery_queue"], stream=True)
        first_seen.first_seen_job(session, source, f"{base}/seen", f"{base}/checkpoint").awaitTermination()
    return first_seen.settled(spark.read.parquet(f"{base}/seen")).select("url", "language", "offset", "corrections")


@check("stream_discovery_compacted", """
SELECT url, 1 AS times, 1 AS messages, TRUE AS visited, TRUE AS indexed FROM pages GROUP BY url""")
def stream_discovery_compacted(spark, sf):
    """Many small micro-batches, every page sent twice, with an index made anew after every three of them."""
    pages = table(spark, sf, "pages")
    base = new_path(spark, "compacted")
    for k in range(2):
        sent = topic_rows(pages, "discovery_queue", F.col("page_id") + k * 1_000_000_000, F.to_json(F.struct("url")))
        topics.write_topic(sent.repartition(5, "offset"), "json", f"{base}/topics")
        jobs.discovery(
            spark,
            topics.read_topic(spark, "json", f"{base}/topics", ["discovery_queue"], stream=True, max_per_trigger=1),
            f"{base}/visited", f"{base}/work", f"{base}/checkpoint", f"{base}/dead", compact_every=3, messages_path=f"{base}/out", per_bucket=100,
        ).awaitTermination()
    times = spark.read.parquet(f"{base}/work").groupBy("url").agg(F.count(F.lit(1)).alias("times"))
    sent = topics.read_topic(spark, "json", f"{base}/out", ["visited_urls"]).groupBy(F.col("key").alias("url")).agg(F.count(F.lit(1)).alias("messages"))
    visited = Visited(spark, f"{base}/visited")
    index = visited.current()
    seen = visited.urls(10).withColumn("visited", F.lit(True))
    return (
        times.join(sent, "url", "full").join(seen, "url", "full")
        .select("url", "times", "messages", "visited", F.lit(index.upto >= 5 and index.buckets > 0).alias("indexed"))
    )


# Sent after all events: some a long time late, some ahead of them.
EVENT_TIME_SQL = """
first_wave AS (SELECT event_type, ts FROM events),
second_wave AS (
  SELECT event_type, ts - INTERVAL 40 DAY AS ts FROM events WHERE event_id % 7 = 0
  UNION ALL SELECT event_type, ts + INTERVAL 60 DAY FROM events WHERE event_id % 5 = 0),
marks AS (SELECT max(ts) AS first_mark FROM first_wave),
placed AS (
  SELECT event_type, ts, FALSE AS late FROM first_wave
  UNION ALL SELECT event_type, ts, date_trunc('hour', ts) + INTERVAL 1 HOUR <= first_mark - INTERVAL 2 HOUR FROM second_wave, marks)"""


def event_time_job(spark, sf):
    events = table(spark, sf, "events").select("event_id", "event_type", "ts")
    base = new_path(spark, "event-time")
    late = events.where("event_id % 7 = 0").withColumn("ts", F.col("ts") - F.expr("INTERVAL 40 DAYS"))
    ahead = events.where("event_id % 5 = 0").withColumn("ts", F.col("ts") + F.expr("INTERVAL 60 DAYS"))
    for wave in (events, late.unionByName(ahead)):
        wave.write.mode("append").parquet(f"{base}/in")
        source = spark.readStream.schema(events.schema).parquet(f"{base}/in")
        event_time.count_windows(spark, source, "ts", ["event_type"], f"{base}/out", f"{base}/checkpoint").awaitTermination()
    return f"{base}/out"


@check("event_time_counts", f"""WITH {EVENT_TIME_SQL}
SELECT CAST(epoch(date_trunc('hour', ts)) AS BIGINT) AS window_start, event_type, count(*) AS n,
  date_trunc('hour', ts) + INTERVAL 1 HOUR <= (SELECT max(ts) FROM placed) - INTERVAL 2 HOUR AS closed
FROM placed WHERE NOT late GROUP BY ALL""")
def event_time_counts(spark, sf):
    counts = event_time.counted(spark, event_time_job(spark, sf), ["event_type"])
    return counts.withColumn("window_start", F.unix_seconds("window_start"))


@check("event_time_late", f"""WITH {EVENT_TIME_SQL}
SELECT event_type, count(*) AS n, CAST(floor(min(epoch(ts))) AS BIGINT) AS first_ts FROM placed WHERE late GROUP BY event_type""")
def event_time_late(spark, sf):
    late = event_time.late_rows(spark, event_time_job(spark, sf))
    return late.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.unix_seconds(F.min("ts").cast("timestamp")).alias("first_ts"))


@check("stream_counters", """
SELECT 2 * count(*) + count(*) FILTER (WHERE page_id % 10 = 3) AS records, count(*) FILTER (WHERE page_id % 10 = 3) AS dead,
  count(DISTINCT url) AS discovered, TRUE AS visited_is_near, TRUE AS observed_all FROM pages""")
def stream_counters(spark, sf):
    """The counters of a discovery job over several micro-batches, and what a listener saw of it."""
    pages = table(spark, sf, "pages")
    base = new_path(spark, "counters")
    value = F.to_json(F.struct("url"))
    sent = topic_rows(pages, "discovery_queue", F.col("page_id"), value).unionByName(
        topic_rows(pages, "discovery_queue", F.col("page_id") + 1_000_000_000, value)
    ).unionByName(topic_rows(pages.where("page_id % 10 = 3"), "discovery_queue", F.col("page_id") + 2_000_000_000, F.lit("{broken")))
    topics.write_topic(sent.repartition(4, "offset"), "json", f"{base}/topics")
    seen = jobs.RunCounters()
    spark.streams.addListener(seen)
    try:
        query = jobs.discovery(
            spark,
            topics.read_topic(spark, "json", f"{base}/topics", ["discovery_queue"], stream=True, max_per_trigger=1),
            f"{base}/visited", f"{base}/work", f"{base}/checkpoint", f"{base}/dead", counters_path=f"{base}/counters",
        )
        query.awaitTermination()
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
    finally:
        spark.streams.removeListener(seen)
    row = jobs.run_counters(spark, f"{base}/counters")
    near = F.abs(F.col("visited") - F.col("discovered")) <= F.col("discovered") * 0.03 + 1
    return row.select(
        "records", "dead", "discovered", near.alias("visited_is_near"), (F.col("records") == seen.records[str(query.id)]).alias("observed_all")
    )
