"""Helpers shared by the training-data operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..scale import cut_lineage, new_path

# Words end at white space and ASCII punctuation.
BREAKS = r"[\s\p{Punct}]+"
BITMAP_WORDS = 1 << 17


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def words(text: Column | str) -> Column:
    """Lower-case words of the whole text; null and blank texts have none."""
    c = F.col(text) if isinstance(text, str) else text
    return F.array_remove(F.split(F.lower(F.coalesce(c, F.lit(""))), BREAKS), "")


def word_hashes(text: Column | str) -> Column:
    """The words as 64-bit hashes, in order."""
    return F.transform(words(text), lambda w: F.xxhash64(w))


def key_bitmap(keys: DataFrame, key: str, size: int = BITMAP_WORDS) -> Column:
    """A scalar subquery: 64 * `size` bits, two of them set for each 64-bit key.

    Its memory is fixed by `size` (1 MB) whatever the number of keys is; more keys
    only make `maybe_in` pass more rows, and the equi-join behind it decides.
    """
    spots = keys.select(F.explode(F.array(*_spots(F.col(key), 64 * size))).alias("_spot"))
    # One row per 64-bit word at most.
    filled = spots.groupBy(F.shiftright("_spot", 6).cast("int").alias("_word")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(_spot % 64 as int))")).alias("_bits")
    )
    places = keys.sparkSession.range(0, size, 1, 1).select(F.col("id").cast("int").alias("_word"))
    entry = F.struct("_word", F.coalesce("_bits", F.lit(0).cast("bigint")).alias("_bits"))
    whole = places.join(filled, "_word", "left").agg(
        F.transform(F.array_sort(F.collect_list(entry)), lambda s: s["_bits"]).alias("_bitmap")
    )
    return cut_lineage(whole, "bitmap").scalar()


def _spots(key: Column, bits: int) -> list[Column]:
    return [F.pmod(key, F.lit(bits)), F.pmod(F.shiftright(key, 24), F.lit(bits))]


def maybe_in(key: Column, bitmap: Column, size: int = BITMAP_WORDS) -> Column:
    """False only for keys that are surely not in the bitmap."""
    tests = [
        F.getbit(F.get(bitmap, F.shiftright(s, 6).cast("int")), F.pmod(s, F.lit(64)).cast("int")) == 1
        for s in _spots(key, 64 * size)
    ]
    return tests[0] & tests[1]


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """Connected components of edges (a, b): (id, root) for every id in an edge, root the smallest id.

    Distributed union-find: in each round every id takes the smallest label among
    its neighbours' and its own, and then its label's label (pointer jumping), so
    the rounds grow with the logarithm of a component's diameter. Labels are
    written to the shared folder in each round.
    """
    links = cut_lineage(
        edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).where("a <> b").distinct(),
        "links",
    )
    labels = cut_lineage(links.groupBy(F.col("a").alias("id")).agg(F.min("b").alias("m")).select("id", F.least("id", "m").alias("root")), "labels")
    for _ in range(max_rounds):
        near = (
            links.join(labels.withColumnRenamed("id", "b"), "b")
            .groupBy(F.col("a").alias("id"))
            .agg(F.min("root").alias("near"))
        )
        lowered = labels.join(near, "id").select("id", F.col("root").alias("old"), F.least("root", "near").alias("root"))
        lowered = cut_lineage(lowered, "lowered")
        jump = lowered.select(F.col("id").alias("root"), F.col("root").alias("next"))
        labels = cut_lineage(
            lowered.join(jump, "root", "left").select("id", F.least("root", F.coalesce("next", "root")).alias("root"), "old"), "labels"
        )
        if labels.where("root <> old").isEmpty():
            return labels.select("id", "root")
        labels = labels.select("id", "root")
    raise RuntimeError("components did not settle")


def crowded_buckets(bands: DataFrame) -> DataFrame:
    """Distinct (node, band) of the bands that hold two nodes or more.

    Copies fall together map-side: only the extremes of a bucket are kept. A bitmap
    of the crowded bands keeps the others out of the second shuffle.
    """
    crowded = bands.groupBy("band").agg(F.min("node").alias("lo"), F.max("node").alias("hi")).where("lo < hi").select("band")
    crowded = cut_lineage(crowded, "crowded")
    return cut_lineage(bands.where(maybe_in(F.col("band"), key_bitmap(crowded, "band"))).join(crowded, "band").distinct(), "buckets")


def link_buckets(
    shared: DataFrame, verify: Callable[[DataFrame], DataFrame], rest: Callable[[DataFrame], DataFrame], stars: int, small: int, block: int
) -> DataFrame:
    """(id, root) of every node in `shared` (node, band): components of the similar pairs that share a band.

    Each of `stars` rounds compares every node with one centre per bucket, if they are
    in different components; then the pairs still apart in buckets of at most `small`
    nodes are compared. `verify` keeps of such pairs (a, b) the similar ones. Larger
    buckets that are still open go to `rest` in pairs of blocks of about `block`
    nodes; it gives links (a, b) between components, and no pair is left out.
    """
    spark = shared.sparkSession
    edges = spark.createDataFrame([], "a long, b long")
    nodes = shared.select(F.col("node").alias("id")).distinct()
    roots = nodes.withColumn("root", F.col("id"))
    tried, rows = edges, shared
    for star in range(stars + 1):
        placed = _open_buckets(rows, roots)
        # A bucket that lies in one component stays in it, so later rounds leave it out.
        rows = placed.select("node", "band")
        if star < stars:
            pairs = _with_centres(placed, star)
        else:
            # What the stars left open in buckets of a bounded size: every pair that is in two components.
            few = placed.where(F.col("size") <= small)
            other = few.select("band", F.col("node").alias("node2"), F.col("root").alias("root2"))
            pairs = few.join(other, "band").where("node < node2 and root <> root2").select(F.col("node").alias("a"), F.col("node2").alias("b"))
        pairs = cut_lineage(pairs.distinct().join(tried, ["a", "b"], "left_anti"), "pairs")
        if pairs.isEmpty():
            continue
        tried = tried.unionByName(pairs)
        kept = verify(pairs)
        if kept.isEmpty():
            continue
        edges = edges.unionByName(kept)
        roots = _relabelled(nodes, edges)
    large = _open_buckets(rows, roots).where(F.col("size") > small)
    if large.isEmpty():
        return roots
    kept = cut_lineage(rest(_block_pairs(large, block)).distinct(), "rest")
    return roots if kept.isEmpty() else _relabelled(nodes, edges.unionByName(kept))


def _open_buckets(rows: DataFrame, roots: DataFrame) -> DataFrame:
    """(band, node, root, size) of the buckets whose nodes are in different components."""
    placed = rows.join(roots.withColumnRenamed("id", "node"), "node").select("band", "node", "root")
    open_ = (
        placed.groupBy("band")
        .agg(F.min("root").alias("lo"), F.max("root").alias("hi"), F.count("*").alias("size"))
        .where("lo < hi")
        .select("band", "size")
    )
    return cut_lineage(placed.join(open_, "band"), "open")


def _relabelled(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    found = components(edges)
    return cut_lineage(nodes.join(found, "id", "left").select("id", F.coalesce("root", "id").alias("root")), "roots")


def _block_pairs(large: DataFrame, block: int) -> DataFrame:
    """(band, i, j, at, node, root): the nodes of block `at`, once for each pair of blocks i <= j to compare.

    The nodes of a bucket's largest component are known to each other, so their blocks
    meet only the blocks of the nodes outside it.
    """
    shares = large.groupBy("band", "root").agg(F.count("*").alias("n"))
    main = shares.groupBy("band").agg(F.max(F.struct("n", "root")).alias("m")).select("band", F.col("m.root").alias("main"), F.col("m.n").alias("inside"))
    sized = large.join(main, "band").select(
        "band",
        "node",
        "root",
        (F.col("root") == F.col("main")).alias("known"),
        F.ceil(F.col("inside") / block).cast("int").alias("n_in"),
        F.ceil((F.col("size") - F.col("inside")) / block).cast("int").alias("n_out"),
    )
    spot = F.xxhash64("node", F.lit("block"))
    at = F.when(F.col("known"), F.col("n_out") + F.pmod(spot, "n_in")).otherwise(F.pmod(spot, "n_out")).cast("int")
    last = F.when(F.col("known"), F.col("n_out")).otherwise(F.col("n_out") + F.col("n_in")) - 1
    met = sized.select("band", "node", "root", at.alias("at"), F.explode(F.sequence(F.lit(0), last)).alias("other"))
    return met.select("band", F.least("at", "other").alias("i"), F.greatest("at", "other").alias("j"), "at", "node", "root")


def _with_centres(placed: DataFrame, star: int) -> DataFrame:
    """(a, b) of each node with the centre of each of its buckets.

    The first centres are the nodes that share buckets with most others, so the text
    that a group of edited copies comes from is met by all of them; later centres
    are drawn by a hash, and a node meets that of its largest bucket (small buckets
    have met their centre, and meet pair by pair in the end). A node has as many
    partners as bands in the first round, and one in the later ones.
    """
    rank = F.sum("size").alias("rank") if star == 0 else F.xxhash64(F.first("node"), F.lit(star)).alias("rank")
    ranked = placed.groupBy("node").agg(rank)
    centre = (
        placed.join(ranked, "node")
        .groupBy("band")
        .agg(F.max(F.struct("rank", "node", "root")).alias("c"))
        .select("band", F.col("c.node").alias("centre"), F.col("c.root").alias("theirs"))
    )
    apart = placed.join(centre, "band").where("root <> theirs")
    if star:
        apart = apart.groupBy("node").agg(F.max(F.struct("size", "centre")).alias("m")).select("node", F.col("m.centre").alias("centre"))
    return apart.select(F.least("node", "centre").alias("a"), F.greatest("node", "centre").alias("b"))
