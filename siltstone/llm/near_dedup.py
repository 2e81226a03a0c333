"""Near duplicates by ProbMinHash, banding, exact verification and union-find.

A text is its five-word shingles, weighted by how often each occurs. Each shingle is
a Poisson process whose rate is its weight; an arrival claims one of `registers`
registers, the earliest arrival keeps it, and a shingle stops as soon as its next
arrival is later than every register (early termination). Two texts agree in a
register with the probability Jaccard of their weighted shingles:

    J = sum over shared d of 1 / sum over d' of max(a[d'] / a[d], b[d'] / b[d])

Bands of registers propose pairs, the exact J on whole shingle lists decides them,
and components of verified pairs are the classes. Inside a bucket of a band, texts
are compared with a few centres (a star each round); pairs that are still in different
components are compared afterwards, one by one in small buckets and by blocks of texts
in larger ones. So a group of copies costs a few comparisons per copy, and no pair that
shares a band is left out. Equal word sequences are one node from the start.

With 25 bands of 5 registers a pair at J = 0.8 is missed with probability 5e-5.

Defined cases: null and wordless texts have equal (empty) word sequences and are one
class; a text of one to four words is a single shingle; repeated rows and rows that
share a doc_id are copies or not by their texts, and carry their own class; other
columns are not read; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import crowded_buckets, cut_lineage, key_bitmap, link_buckets, maybe_in, table, word_hashes

WORDS = 5
SIMILARITY = 0.8
BANDS, ROWS = 25, 5
STARS = 3
# Buckets of at most so many nodes are compared pair by pair in the end.
SMALL = 32
# Larger ones in blocks of about so many.
BLOCK = 512
# Words that are sketched at a time.
AT_ONCE = 1 << 18
# Shingles whose overlaps are counted at a time.
SLICE = 1024
_U = np.uint64


def _mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def shingle_counts(hashes: np.ndarray, words: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingles of a sequence of word hashes, and their counts."""
    h = np.asarray(hashes).astype(np.int64).view(_U)
    n = len(h)
    if n == 0:
        return np.zeros(0, _U), np.zeros(0, np.int64)
    span = min(words, n)
    s = np.full(n - span + 1, _U(span))
    for k in range(span):
        s = _mix(s * _U(0x9E3779B97F4A7C15) + h[k : n - span + 1 + k])
    return np.unique(s, return_counts=True)


def prob_minhash(texts: list[tuple[np.ndarray, np.ndarray]], registers: int, seed: int = 1) -> np.ndarray:
    """Signatures [texts, registers] of weighted shingle lists, all texts at once.

    One pass handles the next arrival of every shingle that is still running.
    """
    counts = np.array([len(s) for s, _ in texts], dtype=np.int64)
    owner = np.repeat(np.arange(len(texts)), counts)
    items = np.concatenate([s for s, _ in texts]) if texts else np.zeros(0, _U)
    rate = np.concatenate([w for _, w in texts]).astype(np.float64) if texts else np.zeros(0)
    first = np.full(len(texts) * registers, np.inf)
    held = np.zeros(len(texts) * registers, dtype=_U)
    when, running, step = np.zeros(len(items)), np.arange(len(items)), 0
    with np.errstate(over="ignore"):
        while len(running):
            step += 1
            r = _mix(items[running] + _U(seed) * _U(0xD1B54A32D192ED03) + _U(step) * _U(0x9E3779B97F4A7C15))
            when[running] += -np.log(((r >> _U(11)).astype(np.float64) + 0.5) * 2.0**-53) / rate[running]
            slot = owner[running] * registers + (_mix(r) % _U(registers)).astype(np.int64)
            now = when[running]
            np.minimum.at(first, slot, now)
            won = first[slot] == now
            held[slot[won]] = items[running[won]]
            last = first.reshape(len(texts), registers).max(1)
            running = running[now < last[owner[running]]]
    return held.reshape(len(texts), registers)


def probability_jaccard(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """The exact probability Jaccard of two weighted lists."""
    both, i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    if not len(both):
        return 1.0 if not len(a[0]) and not len(b[0]) else 0.0
    x, y = a[1][i].astype(np.float64), b[1][j].astype(np.float64)
    only_a, only_b = float(a[1].sum() - x.sum()), float(b[1].sum() - y.sum())
    # sum over d' of max(x'/x, y'/y): x' y >= y' x decides which, so sort by x'/y'.
    order = np.argsort(x / y, kind="stable")
    x, y = x[order], y[order]
    ratio = x / y
    tail_x = np.concatenate([np.cumsum(x[::-1])[::-1], [0.0]])
    head_y = np.concatenate([[0.0], np.cumsum(y)])
    k = np.searchsorted(ratio, ratio, side="left")
    return float(np.sum(1.0 / ((tail_x[k] + only_a) / x + (head_y[k] + only_b) / y)))


def sketched(batches: Iterator[pd.DataFrame], bands: int, rows: int) -> Iterator[pd.DataFrame]:
    """The rows of `sketches`; a batch is taken by words, so that long texts need no more memory than short ones."""
    for batch in batches:
        ends = batch["h"].map(len).to_numpy(dtype=np.int64).cumsum() // AT_ONCE
        for span in np.split(np.arange(len(batch)), np.flatnonzero(np.diff(ends)) + 1):
            part = batch.iloc[span]
            nodes = part["node"].to_numpy()
            once = np.unique(nodes, return_index=True)[1]
            texts = [shingle_counts(h) for h in part["h"].to_numpy()[once]]
            some = [k for k, (s, _) in enumerate(texts) if len(s)]
            sign = prob_minhash([texts[k] for k in some], bands * rows)
            with np.errstate(over="ignore"):
                key = np.zeros((len(some), bands), _U) + np.arange(bands, dtype=_U)
                for r in range(rows):
                    key = _mix(key * _U(0x9E3779B97F4A7C15) + sign[:, r::rows])
            out: list = [None] * len(part)
            for k, row in zip(some, key.view(np.int64), strict=True):
                out[once[k]] = row
            yield pd.DataFrame({"doc_id": part["doc_id"].array, "text_key": part["text_key"].array, "node": nodes, "bands": out})


def sketches(docs: DataFrame, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """(doc_id, text_key, node, bands): node identifies the word sequence, bands its band hashes.

    A node repeated inside one batch has its bands in one row only.
    """
    hashed = docs.select("doc_id", F.xxhash64("text").alias("text_key"), word_hashes("text").alias("h"))
    hashed = hashed.select("doc_id", "text_key", F.xxhash64("h", F.size("h")).alias("node"), "h")

    kind = docs.schema["doc_id"].dataType.simpleString()
    return hashed.mapInPandas(lambda batches: sketched(batches, bands, rows), f"doc_id {kind}, text_key long, node long, bands array<long>")


def word_lists(docs: DataFrame, members: DataFrame, nodes: DataFrame) -> DataFrame:
    """(node, h): the word hashes of each of `nodes`, from one of its rows.

    A bitmap of fixed size keeps other texts out of the shuffle.
    """
    rows = members.join(nodes, "node").groupBy("node").agg(F.min("doc_id").alias("doc_id"))
    rows = cut_lineage(rows, "rows")
    wanted = key_bitmap(rows.select(F.xxhash64("doc_id").alias("key")), "key")
    texts = docs.select("doc_id", "text").where(maybe_in(F.xxhash64("doc_id"), wanted))
    return cut_lineage(
        texts.join(rows, texts["doc_id"].eqNullSafe(rows["doc_id"]))
        .select("node", word_hashes("text").alias("h"))
        .where(F.xxhash64("h", F.size("h")) == F.col("node"))
        .groupBy("node")
        .agg(F.first("h").alias("h")),
        "lists",
    )


def verified(pairs: DataFrame, lists: DataFrame, similarity: float) -> DataFrame:
    """The pairs (a, b) of nodes whose exact similarity over whole texts is enough."""
    left = lists.select(F.col("node").alias("a"), F.col("h").alias("ha"))
    right = lists.select(F.col("node").alias("b"), F.col("h").alias("hb"))

    def decide(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            known: dict[int, tuple] = {}
            ok = []
            for a, b, x, y in zip(batch["a"], batch["b"], batch["ha"], batch["hb"], strict=True):
                # A centre meets many texts one after the other; its shingles are counted once.
                if b not in known:
                    known = {b: shingle_counts(y)} if len(known) > 64 else known | {b: shingle_counts(y)}
                ok.append(probability_jaccard(shingle_counts(x), known[b]) >= similarity - 1e-9)
            yield batch.loc[ok, ["a", "b"]]

    joined = pairs.join(left, "a").join(right, "b").select("a", "b", "ha", "hb")
    return cut_lineage(joined.mapInPandas(decide, "a long, b long"), "verified")


def overlaps(left: list[tuple[np.ndarray, np.ndarray]], right: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, ...]:
    """For each pair of lists: the number of common shingles, and their weight in the left and in the right list."""
    sides = []
    for lists in (left, right):
        owner = np.repeat(np.arange(len(lists)), [len(s) for s, _ in lists])
        sides.append((owner, np.concatenate([s for s, _ in lists]), np.concatenate([w for _, w in lists])))
    common = np.intersect1d(sides[0][1], sides[1][1])
    placed = []
    for owner, items, weight in sides:
        order = np.argsort(items, kind="stable")
        order = order[np.isin(items[order], common)]
        placed.append((owner[order], np.searchsorted(common, items[order]), weight[order]))
    count, in_left, in_right = np.zeros((3, len(left), len(right)))
    # One pair of tables a side, filled anew for each slice.
    tables = [np.zeros((2, len(lists), SLICE), np.float32) for lists in (left, right)]
    for start in range(0, len(common), SLICE):
        for (owner, spot, weight), dense in zip(placed, tables, strict=True):
            part = slice(*np.searchsorted(spot, [start, start + SLICE]))
            dense[:] = 0
            dense[0, owner[part], spot[part] - start] = 1
            dense[1, owner[part], spot[part] - start] = weight[part]
        (ones_left, weights_left), (ones_right, weights_right) = tables
        count += ones_left @ ones_right.T
        in_left += weights_left @ ones_right.T
        in_right += ones_left @ weights_right.T
    return count, in_left, in_right


def linked(blocks: DataFrame, lists: DataFrame, similarity: float) -> DataFrame:
    """Links (a, b) that join the components of the nodes in each pair of blocks.

    Overlaps bound the similarity of every pair of texts (and are it, where no shingle
    repeats); the exact similarity decides what the bound lets through. A task
    gives the links of a spanning forest, never all pairs.
    """

    def find(part: pd.DataFrame) -> pd.DataFrame:
        part = part.reset_index(drop=True)
        texts = [shingle_counts(h) for h in part["h"]]
        node, root = part["node"].to_numpy(), part["root"].to_numpy()
        i, j = (np.flatnonzero(part["at"] == part[side]) for side in ("i", "j"))
        count, in_left, in_right = overlaps([texts[k] for k in i], [texts[k] for k in j])
        size = np.array([len(s) for s, _ in texts], float)
        total = np.array([w.sum() for _, w in texts], float)
        # J is at most the common share of either text.
        bound = np.minimum(in_left / total[i][:, None], in_right / total[j])
        plain = (size == total)[i][:, None] & (size == total)[j]
        bound = np.where(plain, count / (size[i][:, None] + size[j] - count), bound)
        likely = (bound >= similarity - 1e-6) & (root[i][:, None] != root[j])
        above = dict.fromkeys(root.tolist())

        def top(r: int) -> int:
            while above[r] is not None:
                r = above[r]
            return r

        links = []
        for x, y in zip(*np.nonzero(likely), strict=True):
            a, b = i[x], j[y]
            ra, rb = top(root[a]), top(root[b])
            if ra != rb and probability_jaccard(texts[a], texts[b]) >= similarity - 1e-9:
                above[max(ra, rb)] = min(ra, rb)
                links.append((min(node[a], node[b]), max(node[a], node[b])))
        return pd.DataFrame(links, columns=["a", "b"], dtype="int64")

    return blocks.join(lists, "node").groupBy("band", "i", "j").applyInPandas(find, "a long, b long")


def near_duplicates(docs: DataFrame, similarity: float = SIMILARITY, stars: int = STARS, small: int = SMALL, block: int = BLOCK) -> DataFrame:
    """(doc_id, text_key, class_id, class_key) per row of `docs`.

    `class_id`: the smallest doc_id of the class; `text_key`, `class_key`: hashes of the row's text and of that one's.
    """
    found = cut_lineage(sketches(docs), "sketches")
    members = found.select("doc_id", "text_key", "node")
    bands = found.where("bands is not null").select("node", F.explode("bands").alias("band"))
    shared = crowded_buckets(bands)
    lists = word_lists(docs, members, shared.select("node").distinct())
    roots = link_buckets(
        shared, lambda pairs: verified(pairs, lists, similarity), lambda blocks: linked(blocks, lists, similarity), stars, small, block
    )
    classes = members.join(roots.withColumnRenamed("id", "node"), "node", "left").select(
        "doc_id", "text_key", F.coalesce("root", "node").alias("root")
    )
    # Null ids sort last, so a class with any id is named by one.
    row = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id"), F.col("text_key"))
    first = classes.groupBy("root").agg(F.min(row).alias("first"))
    return classes.join(first, "root").select(
        "doc_id", "text_key", F.col("first.doc_id").alias("class_id"), F.col("first.text_key").alias("class_key")
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents")).select("doc_id", "class_id")


def keep_one(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """One row of each class: the one with the smallest doc_id; of rows equal in id and text one."""
    marked = near_duplicates(docs, similarity)
    keep = marked.select(F.col("class_id").alias("_id"), F.col("class_key").alias("_key")).distinct()
    keep = cut_lineage(keep.withColumn("_known", F.col("_id").isNotNull()).fillna(0, ["_id"]), "keep")
    # No name of the caller's columns can clash inside the struct.
    rows = docs.select(
        F.struct(*docs.columns).alias("_row"), F.coalesce("doc_id", F.lit(0)).alias("_id"), F.col("doc_id").isNotNull().alias("_known"), F.xxhash64("text").alias("_key")
    )
    return rows.join(keep, ["_id", "_known", "_key"]).dropDuplicates(["_id", "_known", "_key"]).select("_row.*")
