"""BM25 and crawl-order statistics."""

from __future__ import annotations

import re
from collections.abc import Sequence
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import let, tokens
from ..scale import cut_lineage, running_sum


def query_terms(query: str | Sequence[str]) -> list[str]:
    """Distinct lower-cased query tokens, in order."""
    text = query if isinstance(query, str) else " ".join(query)
    return list(dict.fromkeys(re.findall(r"\w+", text.lower())))


def counted(df: DataFrame, terms: Sequence[str], text: str, distinct: bool = False) -> DataFrame:
    """Add document length `_dl` and one count per query term; with `distinct` also the set of terms, `_set`.

    Counting the few query terms inside the row means no token ever leaves it.
    """
    more = ["_set"] if distinct else []

    def summary(toks: Column) -> Column:
        hits = F.filter(toks, lambda t: t.isin(list(terms)))
        return F.struct(F.size(toks).alias("_dl"), hits.alias("_hits"), *[F.array_distinct(toks).alias(c) for c in more])

    # An exploded one-element array is computed once per row: neither a filter on the
    # score nor another projection can pull the tokenizer through it a second time.
    once = F.explode(F.array(let(tokens(F.lower(F.col(text))), summary)))
    hits = df.select("*", once.alias("_doc")).select(*df.columns, "_doc._dl", "_doc._hits", *[f"_doc.{c}" for c in more])

    def occurrences(term: str) -> Column:
        return F.size(F.filter("_hits", lambda t: t == F.lit(term)))

    counts = {f"_tf{i}": occurrences(term) for i, term in enumerate(terms)}
    return hits.withColumns(counts).drop("_hits")


def bm25(
    df: DataFrame,
    query: str | Sequence[str],
    k1: float = 1.5,
    b: float = 0.75,
    text: str = "content",
    avgdl: float | None = None,
) -> DataFrame:
    """Add `score`, the BM25 of the text for the query over the whole of `df`.

    Corpus statistics are one aggregated row, used as a scalar subquery; no row
    is shuffled.
    """
    terms = query_terms(query)
    if not terms:
        raise ValueError("the query has no words")
    stats = statistics(counted(df.select(text), terms, text), len(terms))
    return scored(counted(df, terms, text), stats, len(terms), k1, b, avgdl)


def statistics(rows: DataFrame, n_terms: int) -> Column:
    """A scalar subquery over `counted` rows: n, avgdl, and the number of documents with each term."""
    return (
        rows.agg(
            F.count(F.lit(1)).alias("n"),
            F.avg("_dl").alias("avgdl"),
            *[F.count_if(F.col(f"_tf{i}") > 0).alias(f"df{i}") for i in range(n_terms)],
        )
        .select(F.struct("n", "avgdl", *[f"df{i}" for i in range(n_terms)]).alias("s"))
        .scalar()
    )


def scored(rows: DataFrame, stats: Column, n_terms: int, k1: float = 1.5, b: float = 0.75, avgdl: float | None = None) -> DataFrame:
    """`counted` rows with their `score` instead of the counts."""
    found = rows.withColumn("_s", stats)
    mean = F.lit(float(avgdl)) if avgdl is not None else F.col("_s.avgdl")
    norm = F.lit(k1) * (F.lit(1.0 - b) + F.lit(b) * F.col("_dl") / mean)

    def part(i: int) -> Column:
        tf, seen = F.col(f"_tf{i}"), F.col(f"_s.df{i}")
        idf = F.ln(F.lit(1.0) + (F.col("_s.n") - seen + F.lit(0.5).cast("double")) / (seen + F.lit(0.5).cast("double")))
        return F.when(tf > 0, idf * tf * F.lit(k1 + 1.0) / (tf + norm)).otherwise(F.lit(0.0))

    score = reduce(add, [part(i) for i in range(n_terms)])
    return found.withColumn("score", score).drop("_dl", "_s", *[f"_tf{i}" for i in range(n_terms)])


def bm25_filter(df: DataFrame, query: str | Sequence[str], threshold: float = 1.0, **options) -> DataFrame:
    return bm25(df, query, **options).where(F.col("score") >= threshold)


def top_k(df: DataFrame, query: str | Sequence[str], k: int = 5, key: str = "doc_id", **options) -> DataFrame:
    """The `k` most relevant documents; ties go to the smaller key."""
    return bm25(df, query, **options).orderBy(F.desc(F.round("score", 9)), key).limit(k)


def new_terms(df: DataFrame, order: str = "page_id", text: str = "content") -> DataFrame:
    """Per page in crawl order, the number of terms no earlier page had."""
    sets = df.select(order, F.array_distinct(tokens(F.lower(F.col(text)))).alias("_set"))
    return df.select(order).join(_firsts(sets, order), order, "left").select(order, F.coalesce("_new", F.lit(0)).alias("new_terms"))


def _firsts(sets: DataFrame, order: str) -> DataFrame:
    """(order, _new): pages with terms that no earlier page had, and how many; `sets`: order, _set."""
    return (
        sets.select(order, F.explode("_set").alias("_term"))
        .groupBy("_term")
        .agg(F.min(order).alias(order))
        .groupBy(order)
        .agg(F.count(F.lit(1)).alias("_new"))
    )


def new_terms_of(sets: DataFrame, order: str) -> DataFrame:
    """`new_terms` from the pages' stored sets of terms (order, _set)."""
    return sets.select(order).join(_firsts(sets, order), order, "left").select(order, F.coalesce("_new", F.lit(0)).alias("new_terms"))


def saturation_history(df: DataFrame, order: str = "page_id", text: str = "content") -> DataFrame:
    """`new_terms` per page and `known_terms`, the running total in crawl order.

    `order` is an integer, unique per page. The texts are tokenised once: the counts, a row
    per page, are written before the running total reads them twice.
    """
    counts = cut_lineage(new_terms(df, order, text), "new-terms")
    history = running_sum(counts, "new_terms", order, before="_before", total="_total")
    return history.select(order, "new_terms", (F.col("_before") + F.col("new_terms")).alias("known_terms"))
