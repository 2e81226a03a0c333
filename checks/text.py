"""Chunkers, tokens, trigrams, keywords and entities."""

from pyspark.sql import functions as F

from siltstone.functions.text import clean_tokens as cleaned
from siltstone.functions.text import tokens as token_array
from siltstone.operators import chunking, entities as E, terms

from .fixtures import BRONZE_SQL, TOKEN, WS, bronze
from .registry import check, table


def words_sql(text: str) -> str:
    return rf"list_filter(regexp_split_to_array({text}, '{WS}+'), lambda w: w <> '')"


def strip_sql(text: str) -> str:
    return rf"regexp_replace(regexp_replace({text}, '\A{WS}+', ''), '{WS}+\z', '')"


WORDS_SQL = f"w AS (SELECT chunk_id, source_url, doc_id, {words_sql('content')} AS ws FROM bronze)"


def windows_sql(window: int, step: int, count: str) -> str:
    return f"""cut AS (
  SELECT chunk_id, source_url, doc_id, i AS idx, array_to_string(ws[i * {step} + 1 : i * {step} + {window}], ' ') AS chunk
  FROM (SELECT *, unnest(range(0, {count})) AS i FROM w WHERE len(ws) > 0)
)"""


@check("chunk_overlapping", f"""WITH {BRONZE_SQL}, {WORDS_SQL},
{windows_sql(500, 450, 'greatest(ceil((len(ws) - 50) / 450.0)::BIGINT, 1)')}
SELECT chunk_id || '::' || idx AS chunk_id, sha256(chunk) AS chunk_hash FROM cut WHERE length(chunk) > 100""")
def chunk_overlapping(spark, sf):
    rows = bronze(spark, sf).withColumn("source_url", F.col("chunk_id"))
    return chunking.chunk_overlapping(rows).select("chunk_id", F.sha2("chunk", 256).alias("chunk_hash"))


@check("chunk_overlapping_small", f"""WITH {BRONZE_SQL}, {WORDS_SQL},
{windows_sql(120, 100, 'greatest(ceil((len(ws) - 20) / 100.0)::BIGINT, 1)')}
SELECT chunk_id || '::' || idx AS chunk_id, sha256(chunk) AS chunk_hash FROM cut WHERE length(chunk) > 100""")
def chunk_overlapping_small(spark, sf):
    rows = bronze(spark, sf).withColumn("source_url", F.col("chunk_id"))
    return chunking.chunk_overlapping(rows, 120, 20).select("chunk_id", F.sha2("chunk", 256).alias("chunk_hash"))


@check("chunk_identity", f"WITH {BRONZE_SQL} SELECT chunk_id, 0 AS idx, sha256(content) AS chunk_hash FROM bronze")
def chunk_identity(spark, sf):
    return chunking.chunk_identity(bronze(spark, sf)).select("chunk_id", "idx", F.sha2("chunk", 256).alias("chunk_hash"))


@check("chunk_fixed", f"""WITH {BRONZE_SQL}, {WORDS_SQL}, {windows_sql(80, 80, 'ceil(len(ws) / 80.0)::BIGINT')}
SELECT chunk_id, CAST(idx AS INTEGER) AS idx, sha256(chunk) AS chunk_hash FROM cut""")
def chunk_fixed(spark, sf):
    return chunking.chunk_fixed(bronze(spark, sf), 80).select("chunk_id", "idx", F.sha2("chunk", 256).alias("chunk_hash"))


@check("chunk_sliding", f"""WITH {BRONZE_SQL}, {WORDS_SQL},
{windows_sql(100, 40, 'greatest(ceil((len(ws) - 100) / 40.0)::BIGINT + 1, 1)')}
SELECT chunk_id, CAST(idx AS INTEGER) AS idx, sha256(chunk) AS chunk_hash FROM cut""")
def chunk_sliding(spark, sf):
    rows = chunking.chunk_sliding(bronze(spark, sf), 100, 40)
    return rows.select("chunk_id", "idx", F.sha2("chunk", 256).alias("chunk_hash"))


def pieces_sql(array: str) -> str:
    return f"""SELECT chunk_id, CAST(i - 1 AS INTEGER) AS idx, sha256(ps[i]) AS chunk_hash FROM (
  SELECT chunk_id, ps, unnest(range(1, len(ps) + 1)) AS i FROM (
    SELECT chunk_id, list_filter(list_transform({array}, lambda p: {strip_sql('p')}), lambda p: p <> '') AS ps FROM bronze))"""


@check("chunk_regex", f"WITH {BRONZE_SQL} " + pieces_sql(r"regexp_split_to_array(content, '\n|;\s')"))
def chunk_regex(spark, sf):
    rows = chunking.chunk_regex(bronze(spark, sf), [r"\n", r";\s"])
    return rows.select("chunk_id", "idx", F.sha2("chunk", 256).alias("chunk_hash"))


@check("chunk_sentence", f"WITH {BRONZE_SQL} " + pieces_sql(
    rf"string_split(regexp_replace(translate(content, chr(30), ' '), '([.!?]){WS}+', '\1' || chr(30), 'g'), chr(30))"))
def chunk_sentence(spark, sf):
    return chunking.chunk_sentences(bronze(spark, sf)).select("chunk_id", "idx", F.sha2("chunk", 256).alias("chunk_hash"))


@check("chunk_merge_tokens", f"""
WITH a AS (
  SELECT conv_id, flatten(list({words_sql('text')} ORDER BY turn)) AS ws FROM conversations GROUP BY conv_id
),
b AS (SELECT *, unnest(range(0, greatest(ceil((len(ws) - 15) / 60.0)::BIGINT, 1))) AS idx FROM a WHERE len(ws) > 0)
SELECT conv_id, idx, sha256(array_to_string(ws[idx * 60 + 1 : idx * 60 + 75], ' ')) AS chunk_hash FROM b""")
def chunk_merge_tokens(spark, sf):
    rows = table(spark, sf, "conversations")
    merged = chunking.merge_by_tokens(rows, 100, 1.33, overlap=20, key="conv_id", order="turn", text="text")
    return merged.select("conv_id", "idx", F.sha2("chunk", 256).alias("chunk_hash"))


@check("chunk_merge_whole", f"""
WITH a AS (SELECT conv_id, turn, {strip_sql('text')} AS t, len({words_sql('text')}) AS n FROM conversations),
b AS (
  SELECT *, coalesce(sum(n) OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM a WHERE n > 0
)
SELECT conv_id, CAST(floor(before / 200.0) AS BIGINT) AS bucket, sha256(string_agg(t, ' ' ORDER BY turn)) AS chunk_hash
FROM b GROUP BY ALL""")
def chunk_merge_whole(spark, sf):
    rows = table(spark, sf, "conversations")
    merged = chunking.merge_whole(rows, 200, key="conv_id", order="turn", text="text")
    return merged.select("conv_id", "bucket", F.sha2("chunk", 256).alias("chunk_hash"))


# --- tokens -------------------------------------------------------------------------


def tokens_sql(text: str) -> str:
    return rf"regexp_extract_all({text}, '{TOKEN}')"


@check("tokens", f"""WITH {BRONZE_SQL}
SELECT chunk_id, len(t) AS n, sha256(array_to_string(t, ' ')) AS token_hash FROM (SELECT chunk_id, {tokens_sql('content')} AS t FROM bronze)""")
def tokens(spark, sf):
    rows = terms.with_tokens(bronze(spark, sf))
    return rows.select(
        "chunk_id", F.size("tokens").cast("long").alias("n"), F.sha2(F.array_join("tokens", " "), 256).alias("token_hash")
    )


GRAMS_SQL = f"""
t AS (SELECT chunk_id, {tokens_sql('content')} AS t FROM bronze),
grams AS (
  SELECT chunk_id, i AS pos, t[i + 1] || ' ' || t[i + 2] || ' ' || t[i + 3] AS gram
  FROM (SELECT *, unnest(range(0, len(t) - 2)) AS i FROM t WHERE len(t) >= 3)
)"""


@check("trigram_counts", f"WITH {BRONZE_SQL}, {GRAMS_SQL} SELECT gram, count(*) AS n FROM grams GROUP BY gram")
def trigram_counts(spark, sf):
    return terms.trigram_counts(bronze(spark, sf))


@check("semantic_records", f"""WITH {BRONZE_SQL}, {GRAMS_SQL},
ids AS (SELECT *, CAST('0x' || substr(md5(gram), 1, 8) AS BIGINT) % 500 AS vec_id FROM grams)
SELECT chunk_id, count(*) AS n, max(gram) AS last_gram, sum(vec_id)::BIGINT AS vec_ids,
       sum(CAST(floor(CAST(e.embedding[1] AS DOUBLE) * 10000) AS BIGINT))::BIGINT AS first_sum
FROM ids JOIN (SELECT * FROM embeddings WHERE label <> 7) e USING (vec_id) GROUP BY chunk_id""")
def semantic_records(spark, sf):
    docs = bronze(spark, sf)
    # The embedding service: a vector per distinct gram; it fails for those of one label.
    vec_id = F.conv(F.substring(F.md5("gram"), 1, 8), 16, 10).cast("long") % 500
    service = table(spark, sf, "embeddings").where("label <> 7").select("vec_id", "embedding")
    # The distinct grams, with their occurrences, each named the vector it gets.
    vectors = terms.trigram_counts(docs, "content").withColumn("vec_id", vec_id)
    rows = terms.semantic_records(docs, vectors=vectors, store=service, counts="n")
    # The digest sorts by record: what it needs of a vector is taken out before, and a hash
    # goes first in the order, since all ids begin alike.
    first = F.floor(F.get("embedding", 0).cast("double") * 10000)
    parts = rows.select(F.xxhash64("chunk_id").alias("hash"), "chunk_id", "content", "vec_id", first.alias("first"))
    digest = parts.groupBy("hash", "chunk_id").agg(
        F.count(F.lit(1)).alias("n"),
        F.max("content").alias("last_gram"),
        F.sum("vec_id").alias("vec_ids"),
        F.sum("first").alias("first_sum"),
    )
    return digest.drop("hash")


# The stop words, written out for the oracle.
STOP_SQL = ", ".join(f"'{w}'" for w in "a an and are as at be by for from has he in is it its of on or that the this to was were will with".split())


def clean_sql(toks: str) -> str:
    return f"list_filter({toks}, lambda x: length(x) >= 3 AND lower(x) NOT IN ({STOP_SQL}))"


@check("clean_tokens", f"""WITH {BRONZE_SQL}
SELECT chunk_id, len(t) AS n, sha256(array_to_string(t, ' ')) AS token_hash
FROM (SELECT chunk_id, {clean_sql(tokens_sql('content'))} AS t FROM bronze)""")
def clean_tokens(spark, sf):
    rows = bronze(spark, sf).select("chunk_id", cleaned(token_array("content")).alias("t"))
    return rows.select("chunk_id", F.size("t").cast("long").alias("n"), F.sha2(F.array_join("t", " "), 256).alias("token_hash"))


@check("topic_keywords", f"""
WITH t AS (SELECT doc_id, unnest({clean_sql(tokens_sql('lower(text)'))}) AS term FROM documents),
tf AS (SELECT doc_id, term, count(*) AS tf FROM t GROUP BY ALL),
df AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
s AS (SELECT doc_id, term, tf, tf * ln(CAST((SELECT count(*) FROM documents) AS DOUBLE) / df) AS score FROM tf JOIN df USING (term)),
r AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY round(score, 9) DESC, term) AS rank FROM s)
SELECT doc_id, CAST(rank AS INTEGER) AS rank, term, tf, round(score, 6) AS score FROM r WHERE rank <= 5""")
def topic_keywords(spark, sf):
    rows = terms.topic_keywords(table(spark, sf, "documents"), 5, text="text")
    return rows.select("doc_id", "rank", "term", "tf", F.round("score", 6).alias("score"))


# --- entities -----------------------------------------------------------------------


# What each label means, written out for the oracle's engine, which matches in linear time and has no look-around.
ENTITY_SQL = {
    "email": r"[0-9A-Za-z_.%+-]+@[0-9A-Za-z.-]+[.][a-zA-Z][a-zA-Z]+",
    "phone_intl": r"[+]\d{1,3}[-. ]?\d{2,4}([-. ]?\d{2,4}){2,4}",
    "phone_us": r"[(]?[2-9]\d\d[)]?[-. ][2-9]\d\d[-. ]\d{4}",
    "url": r"https?://[^\s\"'<>]+",
    "ipv4": r"\d{1,3}[.]\d{1,3}[.]\d{1,3}[.]\d{1,3}",
    "ipv6": r"([[:xdigit:]]{1,4}:){7}[[:xdigit:]]{1,4}",
    "uuid": r"[[:xdigit:]]{8}-[[:xdigit:]]{4}-[1-5][[:xdigit:]]{3}-[89abAB][[:xdigit:]]{3}-[[:xdigit:]]{12}",
    "currency": r"(USD|EUR|GBP|[$€£¥])\s?\d+(,\d{3})*([.]\d\d?)?",
    "percentage": r"\d+([.]\d+)?\s?%",
    "number": r"\d+(,\d{3})*([.]\d+)?",
    "date_iso": r"\d{4}-(0[1-9]|1[0-2])-(0[1-9]|[12]\d|3[01])",
    "date_us": r"(0?[1-9]|1[0-2])/(0?[1-9]|[12]\d|3[01])/\d{4}",
    "time_24h": r"([01]\d|2[0-3]):[0-5]\d(:[0-5]\d)?",
    "postal_us": r"[A-Z][A-Z] \d{5}(-\d{4})?",
    "postal_uk": r"[A-Z][A-Z]?\d[A-Z0-9]? ?\d[A-Z][A-Z]",
    "html_color_hex": r"#[[:xdigit:]]{6}",
    "twitter_handle": r"@[0-9A-Za-z_]{1,15}",
    "hashtag": r"#[0-9A-Za-z_]+",
    "mac_addr": r"([[:xdigit:]]{2}[:-]){5}[[:xdigit:]]{2}",
    "iban": r"[A-Z][A-Z]\d\d( ?[A-Z0-9]{4}){3,7}( ?[A-Z0-9]{1,3})?",
    "credit_card": r"(\d{4}[- ]?){3}\d{4}",
}


def entity_sql() -> str:
    """Matches with their places: the text before match i is what splitting leaves."""
    parts = []
    for label, pattern in ENTITY_SQL.items():
        p = pattern.replace("'", "''")
        parts.append(f"SELECT doc_id, '{label}' AS label, regexp_extract_all(text, '{p}', 0) AS m, regexp_split_to_array(text, '{p}') AS g FROM documents")
    return f"""
found AS ({' UNION ALL '.join(parts)}),
placed AS (
  SELECT doc_id, label, m[i] AS value,
    list_sum(list_transform(g[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(m[1:i - 1], lambda x: length(x))), 0) AS start
  FROM (SELECT *, unnest(range(1, len(m) + 1)) AS i FROM found WHERE len(m) > 0)
)"""


@check("entities", f"""WITH {entity_sql()}
SELECT doc_id, label, value, CAST(start AS INTEGER) AS start, CAST(start + length(value) AS INTEGER) AS "end" FROM placed""")
def entities(spark, sf):
    return E.entities(table(spark, sf, "documents").select("doc_id", "text"), text="text")


@check("entity_counts", f"""WITH {entity_sql()}
SELECT label, count(*) AS n, count(DISTINCT value) AS n_values FROM placed GROUP BY label""")
def entity_counts(spark, sf):
    return E.entity_counts(table(spark, sf, "documents"), text="text")


# --- term statistics ------------------------------------------------------------------


@check("term_stats", f"""
WITH t AS (SELECT doc_id, unnest({tokens_sql('lower(text)')}) AS term FROM documents)
SELECT term, count(*) AS tf, count(DISTINCT doc_id) AS df FROM t GROUP BY term""")
def term_stats(spark, sf):
    return terms.term_stats(table(spark, sf, "documents"), "text")


@check("corpus_stats", f"""
SELECT count(*) AS n_docs, sum(n)::BIGINT AS n_tokens, round(avg(n), 6) AS avgdl
FROM (SELECT len({tokens_sql('lower(text)')}) AS n FROM documents)""")
def corpus_stats(spark, sf):
    stats = terms.corpus_stats(table(spark, sf, "documents"), "text")
    return stats.select("n_docs", "n_tokens", F.round("avgdl", 6).alias("avgdl"))
