"""Token, trigram, keyword and term-statistic rows."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..functions.text import clean_tokens, tokens, trigram_array
from ..scale import broadcast_if_small, cut_lineage, lookup_join, skew_join, spread_text, text_parts

# Terms whose document counts are broadcast.
FREQUENT_TERMS = 100_000


def with_tokens(df: DataFrame, text: str = "content", out: str = "tokens", lower: bool = False) -> DataFrame:
    return df.withColumn(out, tokens(F.lower(F.col(text)) if lower else F.col(text)))


def trigrams(df: DataFrame, text: str = "content") -> DataFrame:
    """One row per word triple (`gram`) with its place (`pos`), without the text itself."""
    toks = with_tokens(df, text, "_tokens")
    keep = [c for c in df.columns if c not in (text, "pos", "gram")]
    return toks.select(*keep, F.posexplode(trigram_array("_tokens")).alias("pos", "gram"))


def trigram_counts(df: DataFrame, text: str = "content") -> DataFrame:
    return trigrams(spread_text(df.select(text), text), text).groupBy("gram").agg(F.count(F.lit(1)).alias("n"))


def embed_texts(
    df: DataFrame, embedder: Callable[[pd.Series], list], text: str = "gram", out: str = "embedding"
) -> DataFrame:
    """Call a model on batches of text; a failed text gives NULL, never an exception."""

    def one(value: str) -> list | None:
        try:
            return embedder(pd.Series([value]))[0]
        except Exception:  # the service is the caller's: any failure is a value
            return None

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            try:
                vectors = list(embedder(batch[text]))
            except Exception:
                vectors = [one(v) for v in batch[text]]
            yield pd.DataFrame({text: batch[text], out: vectors})

    return df.select(text).mapInPandas(run, f"{text} string, {out} array<float>")


def semantic_records(
    df: DataFrame,
    vectors: DataFrame | None = None,
    embedder: Callable[[pd.Series], list] | None = None,
    store: DataFrame | None = None,
    counts: str | None = None,
) -> DataFrame:
    """Every trigram of a record as a record of its own, with its embedding.

    `vectors(gram, embedding)` is a lookup table; otherwise `embedder` is asked
    once per distinct gram.  A gram without a vector is skipped.  Frequent grams
    are salted, so a gram that fills much of the corpus is spread out.

    Where grams share vectors, `vectors(gram, id)` may name them and `store(id, embedding)` hold each
    of them once (`id`: the columns both have): then no vector is shuffled or sorted with a gram.
    `counts` is a column of `vectors` with the grams' occurrences in `df`, which
    saves the pass that looks for frequent ones; it is not returned.
    """
    if (vectors is None) == (embedder is None):
        raise ValueError("give either vectors or embedder")
    if store is not None and vectors is None:
        raise ValueError("a store goes with vectors")
    grams = trigrams(df.select("chunk_id", "source_url", "language", "content"))
    if vectors is None:
        vectors = embed_texts(grams.select("gram").distinct(), embedder)
    usable = vectors if store is not None else vectors.where(F.col("embedding").isNotNull())
    if counts:
        found = lookup_join(grams, usable, "gram", ["chunk_id", "pos"], counts).drop(counts)
    else:
        found = skew_join(grams, usable, "gram", spread=["chunk_id", "pos"])
    if store is not None:
        ids = [c for c in store.columns if c in vectors.columns]
        found = found.join(broadcast_if_small(store.where(F.col("embedding").isNotNull())), ids)
    return found.withColumnRenamed("gram", "content")


def term_stats(df: DataFrame, text: str = "content") -> DataFrame:
    """Corpus counts per lower-cased term: `tf` occurrences, `df` documents.

    Both counts come from one map-side-combined aggregation on the term alone:
    a document contributes its tokens and, beside them, its distinct tokens.
    """
    toks = F.col("_tokens")
    marked = F.concat(
        F.transform(toks, lambda t: F.struct(t.alias("term"), F.lit(1).alias("tf"), F.lit(0).alias("df"))),
        F.transform(
            F.array_distinct(toks), lambda t: F.struct(t.alias("term"), F.lit(0).alias("tf"), F.lit(1).alias("df"))
        ),
    )
    return (
        with_tokens(df.select(text), text, "_tokens", lower=True)
        .select(F.inline(marked))
        .groupBy("term")
        .agg(F.sum("tf").alias("tf"), F.sum("df").alias("df"))
    )


def corpus_stats(df: DataFrame, text: str = "content") -> DataFrame:
    """One row: documents `n_docs`, tokens `n_tokens` and average length `avgdl`."""
    length = F.size(tokens(F.lower(F.col(text)))).cast("long")
    return df.select(length.alias("dl")).agg(
        F.count(F.lit(1)).alias("n_docs"),
        F.coalesce(F.sum("dl"), F.lit(0)).alias("n_tokens"),
        F.avg("dl").alias("avgdl"),
    )


def topic_keywords(df: DataFrame, n: int = 3, key: str = "doc_id", text: str = "content") -> DataFrame:
    """The `n` terms of highest tf-idf per document; ties go to the smaller term.

    The texts, not their words, are brought together by `key`; a document's terms are counted
    there and written, and read for the documents per term and for the scores. The most frequent
    terms, a bounded table, get their counts by a broadcast, and only the rest is shuffled
    by term; of the others a document's `n` best are taken before its parts meet.
    """
    texts = df.select(key, text)
    parts = max(text_parts(texts, text), int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    counts = (
        with_tokens(texts.repartition(parts, key), text, "_tokens", lower=True)
        .select(key, F.explode(clean_tokens("_tokens")).alias("term"))
        .groupBy(key, "term")
        .agg(F.count(F.lit(1)).alias("tf"))
    )
    terms = cut_lineage(counts, "terms")
    n_docs = cut_lineage(df.agg(F.count(F.lit(1)).alias("n")), "documents").scalar()
    spread = cut_lineage(terms.groupBy("term").agg(F.count(F.lit(1)).alias("df")), "document-counts")
    # FREQUENT_TERMS rows at most, so it may be broadcast; a term is in one of both tables.
    frequent = cut_lineage(spread.orderBy(F.desc("df"), "term").limit(FREQUENT_TERMS), "frequent-terms")
    known = terms.join(F.broadcast(frequent.select("term", "df")), "term", "left").select(key, "term", "tf", "df")
    rare = spread.join(F.broadcast(frequent.select("term")), "term", "left_anti")
    rest = known.where(F.col("df").isNull()).select(key, "term", "tf")
    score = F.col("tf") * F.ln(n_docs.cast("double") / F.col("df"))
    best = W.partitionBy(key).orderBy(F.desc(F.round("score", 9)), "term")
    scored = known.where(F.col("df").isNotNull()).unionByName(skew_join(rest, rare, "term", spread=[key], counts="df"))
    return (
        scored.withColumn("score", score)
        .withColumn("rank", F.row_number().over(best))
        .where(F.col("rank") <= n)
        .select("term", key, "tf", "score", "rank")
    )
