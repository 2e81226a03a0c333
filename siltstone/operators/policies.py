"""Keyword policies as a table: any number of policies without an expression for each.

A term is found by its first characters (up to `GRAM`): a record's stretches of that length are
joined with the terms' beginnings by equality, and the exact `contains` decides on
the hits. Stretches that no term begins with are dropped inside the record by a bitmap of fixed size,
before a row is made of them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..scale import cut_lineage

GRAM = 5
# 64-bit words of the bitmap: half a megabyte.
BITMAP_WORDS = 1 << 16


def policy_terms(policies: DataFrame) -> DataFrame:
    """(policy, term, excludes) from (policy, include_terms, exclude_terms): terms in lower case, once each."""

    def side(column: str, excludes: bool) -> DataFrame:
        return policies.select("policy", F.explode(column).alias("term"), F.lit(excludes).alias("excludes"))

    both = side("include_terms", False).unionByName(side("exclude_terms", True))
    return both.where("term is not null").select("policy", F.lower("term").alias("term"), "excludes").distinct()


def _bitmap(keys: DataFrame, key: str) -> Column:
    """A scalar subquery of 64 * BITMAP_WORDS bits, one of them set for each 64-bit key."""
    spot = F.pmod(F.col(key), F.lit(64 * BITMAP_WORDS))
    filled = keys.groupBy(F.shiftright(spot, 6).cast("int").alias("word")).agg(
        F.bit_or(F.expr(f"shiftleft(1L, cast(pmod({key}, 64) as int))")).alias("bits")
    )
    places = keys.sparkSession.range(0, BITMAP_WORDS, 1, 1).select(F.col("id").cast("int").alias("word"))
    entry = F.struct("word", F.coalesce("bits", F.lit(0).cast("bigint")).alias("bits"))
    whole = places.join(filled, "word", "left").agg(F.transform(F.array_sort(F.collect_list(entry)), lambda s: s["bits"]).alias("bitmap"))
    return cut_lineage(whole, "policy-bitmap").scalar()


def _maybe_in(key: Column, bitmap: Column) -> Column:
    spot = F.pmod(key, F.lit(64 * BITMAP_WORDS))
    word = F.get(bitmap, F.shiftright(spot, 6).cast("int"))
    return F.getbit(word, F.pmod(key, F.lit(64)).cast("int")) == 1


def _stretches(lowered: Column, lengths: list[int]) -> Column:
    """Hashes of all stretches of the given lengths, each once.

    A match takes one character and looks at those behind it, so a text is walked once per length
    however long it is; `substring` would walk it from its beginning for every place.
    """

    def of(n: int) -> Column:
        return F.transform(F.regexp_extract_all(lowered, F.lit(f"(?s)(?=(.{{{n}}}))."), F.lit(1)), lambda x: F.xxhash64(x))

    lists = [of(n) for n in lengths]
    return F.array_distinct(F.concat(*lists)) if len(lists) > 1 else F.array_distinct(lists[0])


def policy_matches(df: DataFrame, policies: DataFrame, key: str = "chunk_id", content: str = "content") -> DataFrame:
    """(key, policy) for every record that a policy accepts: an include term is held and no exclude term.

    `policies(policy, include_terms, exclude_terms)`: terms are substrings, whatever the case; a policy
    without include terms accepts nothing; a null content is empty; an empty term is held by
    every record. `key` must tell records apart.
    """
    terms = cut_lineage(policy_terms(policies).withColumn("start", F.xxhash64(F.substring("term", 1, GRAM))), "policy-terms")
    found = terms.where("term <> ''")
    # GRAM + 1 numbers at most; 0 stands for empty terms.
    lengths = sorted(r["n"] for r in terms.select(F.least(F.length("term"), F.lit(GRAM)).alias("n")).distinct().collect())
    lowered = df.select(F.col(key).alias("_key"), F.lower(F.coalesce(F.col(content), F.lit(""))).alias("_text"))
    held = lowered.sparkSession.createDataFrame([], T.StructType([lowered.schema["_key"], terms.schema["policy"], terms.schema["excludes"]]))
    if 0 in lengths:
        # An empty term is in every record; only then does every record meet its policies.
        held = lowered.select("_key").crossJoin(terms.where("term = ''").select("policy", "excludes"))
    if sizes := [n for n in lengths if n]:
        distinct = found.select("term", "start").distinct()
        bitmap = _bitmap(found.select("start"), "start")
        starts = F.filter(_stretches(F.col("_text"), sizes), lambda h: _maybe_in(h, F.col("_bits")))
        hits = (
            lowered.withColumn("_bits", bitmap)
            .select("_key", "_text", F.explode(starts).alias("start"))
            .join(distinct, "start")
            .where(F.contains("_text", "term"))
            .select("_key", "term")
        )
        held = held.unionByName(hits.join(found.select("policy", "term", "excludes"), "term").select("_key", "policy", "excludes"))
    judged = held.groupBy("_key", "policy").agg(F.bool_or("excludes").alias("rejected"), F.bool_or(~F.col("excludes")).alias("wanted"))
    return judged.where("wanted and not rejected").select(F.col("_key").alias(key), "policy")
