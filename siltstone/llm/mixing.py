"""Mixing sources to target weights: budgets flow down a domain-language-source tree.

A node's budget is split among its children by weight. A child cannot take more than
its whole subtree holds (tokens times `max_epochs`); what it leaves goes to its
siblings, by weight, until they are full too. Since a node's own share was already
limited by what its subtree holds, a shortage is made up by siblings first and only
what they cannot take reaches the next ancestor's siblings. The split of one node has
a closed form (sort children by capacity over weight, find the last full one), so each
level is one window over the small table of nodes.

A leaf reads its texts in seeded epochs: in epoch e they are ordered by a hash of
(seed, e, row), and the leaf takes the token prefix that fills its budget. Whole
epochs need no order; in the last one texts are counted by ranges of the hash, and only
the range that the end of the budget falls into is sorted. So a leaf that holds a
third of all rows is neither sorted nor gathered.

Defined cases: null domains, languages and sources are nodes of their own; a node
that the weights do not name has its level's default weight, one with a weight of zero, less
or null gets nothing; null and wordless texts hold no token and are never taken; repeated
rows are separate texts at one place of the order: where the budget ends among them, as many
of them as fit are taken whole and one in part; a budget beyond all capacity takes everything `max_epochs`
times; an empty table gives an empty result; other columns are carried along.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import cut_lineage, table, words

LEVELS = ("domain", "lang", "source")
RANGES = 4096
# Weight of a name that the weights do not have.
DEFAULTS = {"domain": 0.2, "lang": 0.15, "source": 1.0}


def domain_of(source: Column) -> Column:
    """The query's domains: the crawl that holds a third of the rows, and two groups of the other sources."""
    number = F.regexp_extract(source, r"(\d+)$", 1).try_cast("int")
    return F.when(number == 0, "crawl").when(number < 10, "reference").when(number >= 10, "community").otherwise("other")


def target_weights(spark: SparkSession) -> DataFrame:
    """The query's weights: (level, name, weight). A name's weight counts among its siblings."""
    rows = [("domain", "crawl", 0.3), ("domain", "reference", 0.5), ("domain", "community", 0.2)]
    rows += [("lang", "en", 0.55), ("lang", "de", 0.15), ("lang", "fr", 0.15), ("lang", "es", 0.15)]
    rows += [("source", f"src{i}", 1.0 + i % 3) for i in range(20)]
    return spark.createDataFrame(rows, "level string, name string, weight double")


def budgets(
    stock: DataFrame, weights: DataFrame, budget: Column, max_epochs: int, levels: Sequence[str] = LEVELS, defaults: dict[str, float] = DEFAULTS
) -> DataFrame:
    """`stock` (levels and tokens per leaf) with the leaf's budget `take`, a whole number.

    `budget`: column over a row with `total`, the tokens of the whole stock.
    """
    nodes = stock.withColumn("capacity", F.col("tokens") * F.lit(max_epochs))
    for depth, level in enumerate(levels):
        named = weights.where(F.col("level") == level).groupBy("name").agg(F.max("weight").alias("_w")).withColumn("_named", F.lit(True))
        nodes = nodes.join(named, nodes[level].eqNullSafe(named["name"]), "left")
        own = F.when(F.col("_named"), F.col("_w")).otherwise(F.lit(float(defaults.get(level, 0.0))))
        nodes = nodes.withColumn(f"w{depth}", F.when(own > 0, own)).drop("name", "_w", "_named")
    # A leaf below a node without weight can take nothing, so it is no capacity of its ancestors.
    live = F.lit(True)
    for depth in range(len(levels)):
        live = live & F.col(f"w{depth}").isNotNull()
    nodes = nodes.withColumn("capacity", F.when(live, F.col("capacity")).otherwise(F.lit(0).cast("bigint")))
    nodes = cut_lineage(nodes, "nodes")
    whole = nodes.agg(F.sum("tokens").alias("total")).select(budget.cast("double").alias("given"))
    given = whole.scalar()
    shares = None
    for depth in range(len(levels)):
        by, parent = list(levels[: depth + 1]), list(levels[:depth])
        level = nodes.where(live).groupBy(*by).agg(F.sum("capacity").alias("c"), F.first(f"w{depth}").alias("w"))
        if shares is None:
            level = level.withColumn("b", given)
        else:
            up = shares.select(*[F.col(k).alias(f"_{k}") for k in parent], F.col("share").alias("b"))
            same = F.lit(True)
            for k in parent:
                same = same & level[k].eqNullSafe(up[f"_{k}"])
            level = level.join(up, same).drop(*[f"_{k}" for k in parent])
        shares = cut_lineage(_split(level, parent), f"level{depth}")
    keys = F.lit(True)
    taken = shares.select(*[F.col(k).alias(f"_{k}") for k in levels], "share")
    for k in levels:
        keys = keys & nodes[k].eqNullSafe(taken[f"_{k}"])
    return nodes.join(taken, keys, "left").select(*levels, "rows", "tokens", F.floor(F.coalesce("share", F.lit(0.0)) + 1e-6).cast("bigint").alias("take"))


def _split(children: DataFrame, parent: Sequence[str]) -> DataFrame:
    """Share `b` among the children of each parent by `w`, none above its `c`."""
    group = W.partitionBy(*parent) if parent else W.partitionBy(F.lit(0))
    # In the order in which they fill up; at the k-th, the earlier ones are full.
    fill = group.orderBy(F.col("c") / F.col("w"), F.struct(*[F.coalesce(F.col(x).cast("string"), F.lit("")) for x in children.columns if x not in ("c", "w", "b")]))
    before = fill.rowsBetween(W.unboundedPreceding, -1)
    level = (
        children.withColumn("full", F.coalesce(F.sum("c").over(before), F.lit(0)))
        .withColumn("open", F.sum("w").over(group) - F.coalesce(F.sum("w").over(before), F.lit(0.0)))
        .withColumn("rate", (F.col("b") - F.col("full")) / F.col("open"))
        # The level at which the rest is divided: the first child that it does not fill.
        .withColumn("stops", F.col("rate") * F.col("w") < F.col("c"))
    )
    rate = F.first(F.when(F.col("stops"), F.col("rate")), ignorenulls=True).over(fill.rowsBetween(W.unboundedPreceding, W.unboundedFollowing))
    return level.withColumn("level_rate", rate).withColumn(
        "share",
        F.when(F.col("level_rate").isNull(), F.col("c")).otherwise(F.least(F.col("level_rate") * F.col("w"), F.col("c").cast("double"))),
    ).select(*[x for x in children.columns if x not in ("c", "w", "b")], F.col("share").cast("double").alias("share"))


def mix(
    docs: DataFrame,
    weights: DataFrame,
    budget: Column,
    max_epochs: int = 2,
    seed: int = 1,
    tokens: Column | None = None,
    domain: Column | None = None,
) -> DataFrame:
    """Each taken row once per epoch: the row's columns as struct `row`, `epoch`, its `tokens` and the `taken` ones.

    The last text of a leaf's prefix may be taken in part (`taken` < `tokens`).
    """
    counted = F.size(words("text")) if tokens is None else tokens
    rows = docs.select(
        F.struct(*docs.columns).alias("row"),
        (domain_of(F.col("source")) if domain is None else domain).alias("domain"),
        F.col("lang"),
        F.col("source"),
        F.col("doc_id").alias("id"),
        F.xxhash64("doc_id", "text").alias("key"),
        counted.cast("bigint").alias("tokens"),
    ).where("tokens > 0")
    # One row per leaf, written first: the join with the whole texts sees its true size.
    plan = cut_lineage(leaf_plan(rows, weights, budget, max_epochs, seed), "plan")
    return _taken(rows, plan, seed)


def leaf_plan(rows: DataFrame, weights: DataFrame, budget: Column, max_epochs: int, seed: int) -> DataFrame:
    """Per leaf: whole epochs, what the last epoch takes, and the hash range in which that ends."""
    thin = cut_lineage(rows.select(*LEVELS, "key", "id", "tokens"), "thin")
    stock = thin.groupBy(*LEVELS).agg(F.sum("tokens").alias("tokens"), F.count("*").alias("rows"))
    leaves = budgets(stock, weights, budget, max_epochs).withColumn("whole", F.floor(F.col("take") / F.col("tokens")))
    leaves = cut_lineage(leaves.withColumn("rest", F.col("take") - F.col("whole") * F.col("tokens")).where("take > 0"), "leaves")
    part = _join_leaves(thin, leaves.where("rest > 0")).withColumn("range", _range(seed))
    sums = part.groupBy(*LEVELS, "range").agg(F.sum("tokens").alias("n"), F.first("rest").alias("rest"))
    # RANGES rows per leaf at most.
    run = W.partitionBy(*LEVELS).orderBy("range").rowsBetween(W.unboundedPreceding, -1)
    ends = (
        sums.withColumn("before", F.coalesce(F.sum("n").over(run), F.lit(0)))
        .where("before < rest and before + n >= rest")
        .select(*LEVELS, F.col("range").alias("end_range"), (F.col("rest") - F.col("before")).alias("end_rest"))
    )
    ends = cut_lineage(ends, "ends")
    last = _join_leaves(part.select(*LEVELS, "key", "id", "tokens", "whole", "range"), ends).where("range = end_range")
    # Copies of a row share their place, and count together.
    places = last.groupBy(*LEVELS, _order(seed).alias("order"), "key").agg(F.sum("tokens").alias("n"), F.first("end_rest").alias("end_rest"))
    earlier = F.sum("n").over(W.partitionBy(*LEVELS).orderBy("order", "key").rowsBetween(W.unboundedPreceding, -1))
    cut = (
        places.withColumn("earlier", F.coalesce(earlier, F.lit(0)))
        .where("earlier < end_rest and earlier + n >= end_rest")
        .select(*LEVELS, F.struct("order", "key").alias("edge"), (F.col("end_rest") - F.col("earlier")).alias("edge_rest"))
    )
    return _join_leaves(leaves, cut, "left")


def _range(seed: int) -> Column:
    return F.shiftrightunsigned(_order(seed), 52)


def _order(seed: int) -> Column:
    """The place of a row in the epoch that is not read to its end; never negative."""
    return F.xxhash64("key", F.col("whole"), F.lit(seed)).bitwiseAND(F.lit((1 << 63) - 1))


def _join_leaves(rows: DataFrame, leaves: DataFrame, how: str = "inner") -> DataFrame:
    same = F.lit(True)
    right = leaves.select(*[F.col(k).alias(f"_{k}") for k in LEVELS], *[c for c in leaves.columns if c not in LEVELS])
    right = right.drop(*[c for c in rows.columns if c in right.columns])
    for k in LEVELS:
        same = same & rows[k].eqNullSafe(right[f"_{k}"])
    return rows.join(right, same, how).drop(*[f"_{k}" for k in LEVELS])


def _taken(rows: DataFrame, plan: DataFrame, seed: int) -> DataFrame:
    joined = _join_leaves(rows, plan.withColumnRenamed("tokens", "leaf_tokens").drop("rows", "take"))
    order = F.struct(_order(seed).alias("order"), F.col("key"))
    joined = joined.withColumn("at_edge", F.coalesce(order == F.col("edge"), F.lit(False)))
    before = F.when(order < F.col("edge"), F.col("tokens")).otherwise(F.lit(0).cast("bigint"))
    inner = joined.where(~F.col("at_edge")).withColumn("last", F.coalesce(before, F.lit(0).cast("bigint")))
    # One text per leaf, and its copies.
    edge = _numbered(cut_lineage(joined.where("at_edge"), "edge-rows"))
    left = F.col("edge_rest") - F.col("copy") * F.col("tokens")
    edge = edge.withColumn("last", F.greatest(F.lit(0).cast("bigint"), F.least(F.col("tokens"), left)))
    epochs = F.transform(
        F.sequence(F.lit(0).cast("bigint"), F.col("whole")),
        lambda e: F.struct(e.cast("int").alias("epoch"), F.when(e < F.col("whole"), F.col("tokens")).otherwise(F.col("last")).alias("taken")),
    )
    columns = ["row", "domain", "lang", "source", "id", "tokens"]
    return (
        inner.select(*columns, F.explode(epochs).alias("e"))
        .unionByName(edge.select(*columns, F.explode(epochs).alias("e")))
        .where("e.taken > 0")
        .select("row", "domain", "lang", "source", "id", F.col("e.epoch").alias("epoch"), "tokens", F.col("e.taken").alias("taken"))
    )


def _numbered(stored: DataFrame) -> DataFrame:
    """`copy`: numbers from 0 among a leaf's rows, counted by partition of the stored table, so no leaf's rows meet in one task."""
    placed = stored.withColumn("_part", F.spark_partition_id())
    by = [*LEVELS, "_part"]
    sizes = placed.groupBy(*by).agg(F.count("*").alias("_n"))
    upto = F.sum("_n").over(W.partitionBy(*LEVELS).orderBy("_part").rowsBetween(W.unboundedPreceding, -1))
    offsets = sizes.select(*[F.col(k).alias(f"_{k}") for k in LEVELS], F.col("_part").alias("_of"), F.coalesce(upto, F.lit(0)).alias("_before"))
    same = placed["_part"] == offsets["_of"]
    for k in LEVELS:
        same = same & placed[k].eqNullSafe(offsets[f"_{k}"])
    within = F.row_number().over(W.partitionBy(*by).orderBy("id")) - 1
    return placed.withColumn("_within", within).join(offsets, same).withColumn("copy", F.col("_before") + F.col("_within"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Six tenths of the corpus's tokens, mixed to the target weights."""
    mixed = mix(table(spark, sf_dir, "documents"), target_weights(spark), F.col("total") * 0.6)
    return mixed.select(F.col("id").alias("doc_id"), "domain", "lang", "source", "epoch", "tokens", "taken")


def mixed_documents(docs: DataFrame, weights: DataFrame, budget: Column, **options) -> DataFrame:
    """The mixture as rows of `docs`: a text taken in part is cut behind its last taken word."""
    taken = mix(docs, weights, budget, **options)
    # A word and the break behind it, as `words` counts them; a leading break belongs to the first.
    piece = r"[\s\p{Punct}]*[^\s\p{Punct}]+"
    cut = F.concat_ws("", F.slice(F.regexp_extract_all(F.col("row.text"), F.lit(piece), F.lit(0)), F.lit(1), F.col("taken").cast("int")))
    text = F.when(F.col("taken") >= F.col("tokens"), F.col("row.text")).otherwise(cut)
    out = []
    for c in docs.columns:
        column = text if c == "text" else F.when(F.col("taken") >= F.col("tokens"), F.col("row.n_chars")).otherwise(F.char_length(cut)) if c == "n_chars" else F.col("row")[c]
        out.append(column.cast(docs.schema[c].dataType).alias(c))
    return taken.select(*out)
