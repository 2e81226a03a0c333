"""Is the crawl sufficient, and which link is next?"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import urls as U
from ..functions.text import literal_array, tokens
from ..scale import cut_lineage, skew_join
from .ranking import counted, new_terms, new_terms_of, query_terms, scored, statistics, top_k

# When an adaptive crawl stops, and how many links it follows.
CONFIDENCE_THRESHOLD = 0.6
MAX_PAGES = 500
TOP_K_LINKS = 10
MIN_GAIN = 0.0


def coverage(df: DataFrame, terms: Sequence[str] | str, text: str = "content") -> DataFrame:
    """One row: mean over the query terms of sqrt(share of documents with the term)."""
    wanted = query_terms(terms)
    toks = df.select(tokens(F.lower(F.col(text))).alias("_t")).select(
        F.array_intersect(F.col("_t"), literal_array(wanted)).alias("_t")
    )
    seen = toks.agg(
        F.count(F.lit(1)).alias("n"),
        *[F.count_if(F.array_contains("_t", t)).alias(f"df{i}") for i, t in enumerate(wanted)],
    )
    return _coverage(seen, wanted)


def _coverage(seen: DataFrame, wanted: Sequence[str]) -> DataFrame:
    parts = [F.sqrt(F.col(f"df{i}") / F.greatest("n", F.lit(1))) for i in range(len(wanted))]
    total = parts[0]
    for p in parts[1:]:
        total = total + p
    return seen.select((total / F.lit(float(len(wanted)))).alias("coverage"))


def consistency(
    df: DataFrame, query: Sequence[str] | str, k: int = 5, text: str = "content", key: str = "doc_id"
) -> DataFrame:
    """One row: mean pairwise Jaccard of the token sets of the `k` most relevant documents.

    Only those `k` documents meet; `k` is a small parameter.  Fewer than two give 0.
    """
    best = top_k(df, query, k, key=key, text=text)
    return _mean_jaccard(best.select(key, F.array_distinct(tokens(F.lower(F.col(text)))).alias("_s")), k, key)


def _mean_jaccard(best: DataFrame, k: int, key: str) -> DataFrame:
    """`best`: at most `k` rows (key, _s)."""
    sets = best.agg(F.sort_array(F.collect_list(F.struct(key, "_s"))).alias("_sets"))
    found = F.col("_sets")

    def jaccard(a: Column, b: Column) -> Column:
        union = F.size(F.array_union(a, b))
        return F.when(union > 0, F.size(F.array_intersect(a, b)) / union).otherwise(F.lit(1.0))

    pairs = F.flatten(
        F.transform(
            found,
            lambda a, i: F.transform(
                F.slice(found, i + 2, F.lit(k)), lambda b: jaccard(a["_s"], b["_s"])
            ),
        )
    )
    total = F.aggregate("_j", F.lit(0.0), lambda acc, x: acc + x)
    return sets.select(pairs.alias("_j")).select(
        F.when(F.size("_j") > 0, total / F.size("_j")).otherwise(F.lit(0.0)).alias("consistency")
    )


def saturation(df: DataFrame, order: str = "doc_id", text: str = "content") -> DataFrame:
    """One row: 1 - new terms of the last page / new terms of the first, within 0…1."""
    return _saturation(new_terms(df, order, text), order)


def _saturation(counts: DataFrame, order: str) -> DataFrame:
    ends = counts.agg(
        F.min_by("new_terms", order).alias("first"), F.max_by("new_terms", order).alias("last")
    )
    raw = F.when(F.col("first") > 0, F.lit(1.0) - F.col("last") / F.col("first")).otherwise(F.lit(0.0))
    return ends.select(F.least(F.greatest(raw, F.lit(0.0)), F.lit(1.0)).alias("saturation"))


def link_gain(
    links: DataFrame,
    vocabulary: DataFrame,
    query: Sequence[str] | str,
    weights: tuple[float, float, float] = (0.5, 0.3, 0.2),
    key: Sequence[str] = ("page_id", "position"),
    text: str = "link_text",
    target: str = "target",
    term: str = "term",
) -> DataFrame:
    """Add `relevance`, `novelty`, `authority` and `gain` to links.

    Relevance is the share of query tokens in the link text, novelty the share
    of link tokens missing from `vocabulary(term)`, authority 1 / (1 + path depth).
    """
    wanted = query_terms(query)
    own = F.array_distinct(tokens(F.lower(F.col(text))))
    rows = links.withColumn("_own", own)
    exploded = rows.select(*key, F.explode("_own").alias(term))
    known = vocabulary.select(term).distinct().withColumn("_known", F.lit(1))
    counted = (
        skew_join(exploded, known, term, spread=list(key))
        .groupBy(*key)
        .agg(F.count(F.lit(1)).alias("_known"))
    )
    size = F.size("_own")
    relevance = F.size(F.array_intersect("_own", literal_array(wanted))) / F.lit(float(len(wanted)))
    novelty = F.when(size > 0, (size - F.coalesce("_known", F.lit(0))) / size).otherwise(F.lit(0.0))
    w_rel, w_nov, w_auth = (F.lit(float(w)) for w in weights)
    return (
        rows.join(counted, list(key), "left")
        .withColumns(
            {
                "relevance": relevance,
                "novelty": novelty,
                "authority": F.lit(1.0) / (U.path_depth(target) + 1),
            }
        )
        .withColumn("gain", F.col("relevance") * w_rel + F.col("novelty") * w_nov + F.col("authority") * w_auth)
        .drop("_own", "_known")
    )


def top_links(gains: DataFrame, k: int = TOP_K_LINKS, key: Sequence[str] = ("page_id", "position")) -> DataFrame:
    """The `k` links of highest gain; ties go to the smaller key."""
    return gains.orderBy(F.desc(F.round("gain", 9)), *key).limit(k)


def confidence(
    df: DataFrame,
    query: Sequence[str] | str,
    best_gain: DataFrame | None = None,
    k: int = 5,
    order: str = "doc_id",
    text: str = "content",
    weights: tuple[float, float, float] = (0.4, 0.3, 0.3),
    threshold: float = CONFIDENCE_THRESHOLD,
    max_pages: int = MAX_PAGES,
    min_gain: float = MIN_GAIN,
) -> DataFrame:
    """One row: coverage, consistency, saturation, confidence, and why to stop (or NULL).

    `best_gain(gain)` is the table of pending links; its maximum is used. The texts are read
    and tokenised once; lengths, counts of the query's terms and sets of terms are
    written, and every part reads the columns of its own.
    """
    wanted = query_terms(query)
    once = cut_lineage(counted(df.select(order, text), wanted, text, distinct=True).drop(text), "page-terms")
    pages = once.agg(F.count(F.lit(1)).alias("pages"))
    gain = best_gain.agg(F.max("gain").alias("g")).scalar() if best_gain is not None else F.lit(None).cast("double")
    seen = once.agg(F.count(F.lit(1)).alias("n"), *[F.count_if(F.col(f"_tf{i}") > 0).alias(f"df{i}") for i in range(len(wanted))])
    best = scored(once, statistics(once, len(wanted)), len(wanted)).orderBy(F.desc(F.round("score", 9)), order).limit(k)
    row = pages.withColumns(
        {
            "coverage": _coverage(seen, wanted).scalar(),
            "consistency": _mean_jaccard(best.select(order, F.col("_set").alias("_s")), k, order).scalar(),
            "saturation": _saturation(new_terms_of(once.select(order, "_set"), order), order).scalar(),
            "best_gain": gain,
        }
    )
    w_cov, w_con, w_sat = (F.lit(float(w)) for w in weights)
    total = F.col("coverage") * w_cov + F.col("consistency") * w_con + F.col("saturation") * w_sat
    reason = (
        F.when(F.col("confidence") >= threshold, "confident")
        .when(F.col("pages") >= max_pages, "max pages")
        .when(F.col("best_gain") < min_gain, "no gain")
    )
    return row.withColumn("confidence", total).withColumn("stop_reason", reason)
