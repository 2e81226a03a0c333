"""Benchmark decontamination by spaced seeds, in DataFrame functions only.

A mask selects three to six token positions; the others may differ. The hash of the
selected tokens at every position of every text is joined with the hashes of the
benchmark items, and each hit is verified on its diagonal (text position minus item
position): the whole item is laid along the text, and the text is contaminated
when some stretch of `overlap` tokens (the whole item, if that is shorter) agrees in
at least `agreement` of its places.

An item's length names its masks. At the default overlap and agreement they miss
nothing: wherever the allowed substitutions stand in a stretch, a mask fits between
them somewhere (the tests go through all patterns). A lower agreement or a longer overlap, for
which that does not hold, is refused. Items of one to four words must agree whole.

Two bitmaps of fixed size rule out nearly every position before the join: one over the
first two tokens that a mask selects, tested at every position, and one over the whole hashes,
tested where the first answers. They may pass a place for nothing, and never lose one, and the equi-join on full
hashes decides. Positions travel without their text; only texts with a hit are read
again for the verification, one row per distinct text.

Defined cases: null, empty and wordless texts and items are never contaminated or
contaminating; repeated rows are judged alike; rows with a null doc_id are judged like others; other columns are
not read; empty tables give an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import cut_lineage, key_bitmap, maybe_in, table, word_hashes

# Shortest item -> its masks. Found by search: for each length from there to the next
# entry (20 for the last) every choice of substitutions that leaves 80 % leaves a mask whole.
MASKS = {
    1: ((0,),),
    2: ((0, 1),),
    3: ((0, 1, 2),),
    4: ((0, 1, 2, 3),),
    5: ((0, 1, 3), (0, 2, 4)),
    10: ((0, 1, 2, 4, 5), (0, 1, 5, 6, 7), (0, 2, 3, 6, 8)),
    15: ((0, 1, 3, 4, 5, 6), (0, 1, 2, 7, 9, 10), (0, 1, 2, 3, 5, 6), (0, 2, 3, 4, 8, 10)),
}
SPAN = 1 + max(m[-1] for masks in MASKS.values() for m in masks)
OVERLAP = 20
AGREEMENT = 0.8


def _windows(rows: DataFrame, tokens: str, keep: list[str]) -> DataFrame:
    """One row per position: `at` and the tokens t0 to t10 from there on, null past the end."""
    shifted = [F.slice(F.col(tokens), k + 1, F.greatest(F.size(tokens) - k, F.lit(0))).alias(f"t{k}") for k in range(SPAN)]
    places = F.sequence(F.lit(0), F.size(tokens) - 1).alias("at")
    return rows.where(F.size(tokens) > 0).select(*keep, F.inline(F.arrays_zip(places, *shifted)))


def _hash(places: tuple[int, ...], salt: int) -> Column:
    return F.xxhash64(*[F.col(f"t{p}") for p in places], F.lit(salt))


def _heads(masks: dict[int, tuple[int, ...]]) -> list[Column]:
    """Hashes of the first two tokens that the masks select, once for each choice."""
    return [_hash(h, -1 - h[-1]) for h in sorted({m[:2] for m in masks.values()})]


def _marks(masks: dict[int, tuple[int, ...]], hashes: Column | None = None) -> Column:
    """(mask, hash) of each mask that fits at a position, if the bitmap `hashes` may hold it."""
    marks = []
    for k, m in masks.items():
        fits = F.col(f"t{m[-1]}").isNotNull()
        fits = fits if hashes is None else fits & maybe_in(_hash(m, k), hashes)
        marks.append(F.when(fits, F.struct(F.lit(k).alias("mask"), _hash(m, k).alias("hash"))))
    return F.explode(F.array_compact(F.array(*marks)))


def seed_hits(texts: DataFrame, items: DataFrame, overlap: int = OVERLAP) -> DataFrame:
    """(text_key, item_id, diagonal) of every seed that a text (text_key, tokens) shares with an item (item_id, item)."""
    bounds = sorted(MASKS)
    kind = F.lit(bounds[0])
    for least in bounds[1:]:
        kind = F.when(F.least(F.size("item"), F.lit(overlap)) >= least, F.lit(least)).otherwise(kind)
    # As many rows as `MASKS` has entries at most; texts are read for the masks that some item has.
    kinds = [r["kind"] for r in items.select(kind.alias("kind")).distinct().collect()]
    masks = {least: {100 * least + k: m for k, m in enumerate(MASKS[least])} for least in sorted(kinds)}
    spots = items.sparkSession.createDataFrame([], "item_id string, item_at int, mask int, hash long, heads array<long>")
    spots = spots.withColumn("item_id", F.col("item_id").cast(items.schema["item_id"].dataType))
    for least, some in masks.items():
        places = _windows(items.where(kind == least), "item", ["item_id"])
        seeds = places.select("item_id", F.col("at").alias("item_at"), F.array(*_heads(some)).alias("heads"), _marks(some).alias("s"))
        spots = spots.unionByName(seeds.select("item_id", "item_at", "s.mask", "s.hash", "heads"))
    spots = cut_lineage(spots, "seeds")
    hashes = key_bitmap(spots.select("hash").distinct(), "hash")
    heads = key_bitmap(spots.select(F.explode("heads").alias("head")).distinct(), "head")
    every = {k: m for some in masks.values() for k, m in some.items()} or {-1: (0,)}
    # The filter stands before the masks are hashed, so most positions cost a hash or two.
    begins = F.lit(False)
    for head in _heads(every):
        begins = begins | maybe_in(head, heads)
    begun = _windows(texts, "tokens", ["text_key"]).where(begins)
    marks = begun.select("text_key", "at", _marks(every, hashes).alias("s")).select("text_key", "at", "s.mask", "s.hash")
    met = marks.join(spots, ["hash", "mask"])
    return met.select("text_key", "item_id", (F.col("at") - F.col("item_at")).alias("diagonal")).distinct()


def contaminated(docs: DataFrame, benchmark: DataFrame, overlap: int = OVERLAP, agreement: float = AGREEMENT) -> DataFrame:
    """(text_key, item_id, doc_at, item_at, length, equal) per distinct text, item and verified diagonal.

    `doc_at`, `item_at`: first token of the best stretch; `equal` of its `length` tokens agree.
    """
    if agreement < AGREEMENT or overlap > OVERLAP:
        raise ValueError(f"the masks miss nothing from an agreement of {AGREEMENT} and up to an overlap of {OVERLAP}")
    items = benchmark.select("item_id", word_hashes("text").alias("item")).where(F.size("item") > 0)
    items = cut_lineage(items, "items")
    keyed = docs.select(F.xxhash64("text").alias("text_key"), "text")
    hits = cut_lineage(seed_hits(keyed.select("text_key", word_hashes("text").alias("tokens")), items, overlap), "hits")
    wanted = key_bitmap(hits.select("text_key").distinct(), "text_key")
    texts = (
        keyed.where(maybe_in(F.col("text_key"), wanted))
        .join(hits.select("text_key").distinct(), "text_key", "left_semi")
        .groupBy("text_key")
        .agg(F.first("text").alias("text"))
        .select("text_key", word_hashes("text").alias("tokens"))
    )
    laid = hits.join(texts, "text_key").join(items, "item_id")
    first = F.greatest(F.lit(0), -F.col("diagonal")).alias("first")
    laid = laid.select(
        "text_key", "item_id", "diagonal", first, F.least(F.lit(overlap), F.size("item")).alias("need"), "item",
        F.slice("tokens", F.greatest(F.col("diagonal"), F.lit(0)) + 1, F.size("item")).alias("along"),
    ).select(
        "text_key", "item_id", "diagonal", "first", "need",
        F.transform(
            F.slice("along", F.lit(1), F.greatest(F.size("item") - F.col("first"), F.lit(0))),
            lambda t, i: (t == F.get(F.col("item"), i + F.col("first"))).cast("int"),
        ).alias("same"),
    )
    starts = F.when(F.size("same") >= F.col("need"), F.sequence(F.lit(0), F.size("same") - F.col("need"))).otherwise(F.array().cast("array<int>"))
    stretch = F.transform(
        starts, lambda k: F.struct(F.aggregate(F.slice("same", k + 1, F.col("need")), F.lit(0), lambda a, x: a + x).alias("equal"), (-k).alias("back"))
    )
    best = laid.select("text_key", "item_id", "diagonal", "first", "need", F.array_max(stretch).alias("best"))
    at = F.col("first") - F.col("best.back")
    return best.where(F.col("best.equal") >= F.ceil(F.col("need") * agreement)).select(
        "text_key", "item_id", (F.col("diagonal") + at).alias("doc_at"), at.alias("item_at"), F.col("need").alias("length"), F.col("best.equal").alias("equal")
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every contaminated row with each item and place that contaminates it."""
    docs = table(spark, sf_dir, "documents")
    found = cut_lineage(contaminated(docs, table(spark, sf_dir, "benchmark")), "leaks")
    rows = docs.select("doc_id", F.xxhash64("text").alias("text_key"))
    return rows.join(found, "text_key").drop("text_key")


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The rows of `docs` whose text has no verified overlap, as they are."""
    bad = cut_lineage(contaminated(docs, benchmark, **options).select(F.col("text_key").alias("_bad")).distinct(), "bad")
    return docs.join(bad, F.xxhash64(docs["text"]) == bad["_bad"], "left_anti")
