"""Cross-tokenizer alignment by pointer jumping.

Two tokenizers cut the same bytes, " " + text, into tokens. Every token points to its
farthest-right overlapping token of the other side; a token whose end both sides share
points to the first side's token there, which points to itself. Doubling the successor
(next = next[next], one gather for all tokens of a block of texts) converges in the
logarithm of the longest chain to each component's terminal token, which labels the
groups: the smallest runs of tokens that both sides cut alike. Two tokens whose byte
ranges overlap are a link.

Texts are handled in blocks of about `block_bytes`; a word that a block repeats is tokenised
once, since no token reaches over the space before it. Blocks are stored: ids of linked pairs
as places in the block's own list of distinct pairs. The numbers of documents per
pair are one shuffle of those lists (a pair costs a block one row, however many texts hold
it), and come back to the blocks by a join on the pair, so no table of pairs is broadcast
and no text is tokenised twice.

Defined cases: null and empty texts, and texts that either side's tokens do not spell
exactly (U+2581, for one), have no tokens: counts are 0 and the digest is ''. Strings of
special tokens inside a text are plain text. Every row is a document of its own, repeated
rows and rows without an id too; other columns are not read; an empty table gives an
empty result. A text is never cut: one longer than a block is a block of its own.
"""

from __future__ import annotations

import array
import hashlib
import json
import os
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import cut_lineage, table
from .training_order import PATTERN

BYTE_BPE = "/opt/tokenizers/byte_bpe_50k.json"
PIECE_BPE = "/opt/tokenizers/piece_bpe_32k.model"
BLOCK_BYTES = 2 << 20
# Characters of text given to a tokenizer at a time, if texts or words are shorter.
CALL_BYTES = 1 << 12


def _byte_letters() -> dict[str, int]:
    """Byte-level vocabularies write a printable byte as itself, and the others as the letters from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class ByteLevel:
    """A byte-level vocabulary in a tokenizer file; encodes " " + text.

    Where the file's merges make its ids one after the other, a merge's rank is the id it
    makes, and a rank-based encoder over the same vocabulary gives the same tokens
    in less time; else the file's own model is run.
    """

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as f:
            file = json.load(f)
        letters = _byte_letters()
        vocab = file["model"]["vocab"] | {t["content"]: t["id"] for t in file["added_tokens"]}
        special = {t["id"] for t in file["added_tokens"]}
        self.bytes = [b""] * (max(vocab.values()) + 1)
        for token, i in vocab.items():
            self.bytes[i] = token.encode() if i in special else bytes(letters[c] for c in token)
        merges = [m.split(" ") if isinstance(m, str) else m for m in file["model"]["merges"]]
        cuts = file["pre_tokenizer"] or {}
        if (
            all(vocab.get(a + b) == 256 + i for i, (a, b) in enumerate(merges))
            and cuts.get("type") == "ByteLevel" and cuts.get("use_regex") and not cuts.get("add_prefix_space") and not file["normalizer"]
        ):
            import tiktoken

            ranks = {self.bytes[i]: i for i in vocab.values() if i not in special}
            model = tiktoken.Encoding("byte-level", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
            self.encode = lambda texts: [model.encode_ordinary(" " + t) for t in texts]
        else:
            self.encode = self.by_file(path)

    @staticmethod
    def by_file(path: str) -> Callable[[list[str]], list[list[int]]]:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks share the cores
        from tokenizers import Tokenizer

        model = Tokenizer.from_file(path)
        model.encode_special_tokens = True
        return lambda texts: [e.ids for e in model.encode_batch_fast([" " + t for t in texts], add_special_tokens=False)]


class Pieces:
    """A sentence-piece model with byte fallback; it puts the space before the text itself."""

    def __init__(self, path: str) -> None:
        from sentencepiece import SentencePieceProcessor

        self.model = SentencePieceProcessor(model_file=path)
        self.bytes = []
        for i in range(self.model.get_piece_size()):
            piece = self.model.id_to_piece(i)
            self.bytes.append(bytes([int(piece[1:-1], 16)]) if self.model.is_byte(i) else piece.replace("▁", " ").encode())
        # No piece has a space mark behind another character.
        self.whole_words = all("▁" not in self.model.id_to_piece(i).lstrip("▁") for i in range(self.model.get_piece_size()))

    def encode(self, texts: list[str]) -> list[list[int]]:
        return self.model.encode(texts, num_threads=1)


@lru_cache(maxsize=4)
def _loaded(kind: type, path: str) -> tuple:
    """(tokenizer, bytes per id, lengths per id, id + mark for each mark)."""
    one = kind(path)
    text = {mark: np.array([f"{i}{mark}" for i in range(len(one.bytes))], dtype=object) for mark in ",|;"}
    return one, one.bytes, np.array([len(b) for b in one.bytes], dtype=np.int64), text


def labels(ends_a: np.ndarray, ends_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The group number of each token, from the tokens' ends in the bytes that both sides cut."""
    n = len(ends_a)
    over_b = np.searchsorted(ends_b, ends_a)  # the farthest-right overlapping token: the one with the token's last byte
    over_a = np.searchsorted(ends_a, ends_b)
    own = np.arange(n)
    shared = ends_b[over_b] == ends_a
    successor = np.concatenate([np.where(shared, own, n + over_b), over_a])
    while not np.array_equal(successor, jumped := successor[successor]):
        successor = jumped
    number = np.cumsum(shared) - 1  # terminal tokens in order
    return number[successor[:n]], number[successor[n:]]


@dataclass
class Block:
    """The aligned tokens of some texts, one text after the other."""

    a: np.ndarray
    b: np.ndarray
    n_a: np.ndarray
    n_b: np.ndarray
    ends_a: np.ndarray
    ends_b: np.ndarray
    group_a: np.ndarray
    group_b: np.ndarray

    @classmethod
    def of(cls, texts: list[str | None], byte_bpe: str, piece_bpe: str) -> Block:
        found = _by_chunk(texts, byte_bpe, piece_bpe) or _by_text(texts, byte_bpe, piece_bpe)
        ends = [np.cumsum(_loaded(kind, path)[2][ids]) for (kind, path), (ids, _) in zip(_kinds(byte_bpe, piece_bpe), found, strict=True)]
        return cls(*[ids for ids, _ in found], *[sizes for _, sizes in found], *ends, *labels(*ends))

    def groups(self) -> np.ndarray:
        """Groups per text."""
        last = np.cumsum(self.n_a)
        upto = np.where(last > 0, np.append(self.group_a, -1)[last - 1] + 1, 0)
        return np.diff(upto, prepend=0)

    def links(self) -> tuple[np.ndarray, np.ndarray]:
        """Places (in a, in b) of all overlapping tokens, in order."""
        starts = np.concatenate([[0], self.ends_a[:-1]]) if len(self.ends_a) else self.ends_a
        first = np.searchsorted(self.ends_b, starts, side="right")
        count = np.searchsorted(self.ends_b, self.ends_a) - first + 1
        i = np.repeat(np.arange(len(self.a)), count)
        within = np.arange(len(i)) - np.repeat(np.cumsum(count) - count, count)
        return i, np.repeat(first, count) + within

    def written(self, byte_bpe: str, piece_bpe: str) -> list[str]:
        """For each text its groups as `a1,a2|b1;a3|b2,b3`."""
        n_groups = int(self.group_a[-1]) + 1 if len(self.group_a) else 0
        size_a, size_b = np.bincount(self.group_a, minlength=n_groups), np.bincount(self.group_b, minlength=n_groups)
        before_b, upto_a = np.cumsum(size_b) - size_b, np.cumsum(size_a)
        out = np.empty(len(self.a) + len(self.b), dtype=object)
        for ids, group, place, mark, kind, path in (
            (self.a, self.group_a, before_b[self.group_a], "|", ByteLevel, byte_bpe),
            (self.b, self.group_b, upto_a[self.group_b], ";", Pieces, piece_bpe),
        ):
            text = _loaded(kind, path)[3]
            last = np.append(group[1:] != group[:-1], True) if len(group) else np.zeros(0, bool)
            place = place + np.arange(len(ids))
            out[place[~last]] = text[","][ids[~last]]
            out[place[last]] = text[mark][ids[last]]
        ends = np.cumsum(self.n_a + self.n_b)
        return ["".join(out[e - n : e].tolist())[:-1] for e, n in zip(ends, self.n_a + self.n_b, strict=True)]


def _kinds(byte_bpe: str, piece_bpe: str) -> tuple[tuple[type, str], tuple[type, str]]:
    return (ByteLevel, byte_bpe), (Pieces, piece_bpe)


def _by_text(texts: list[str | None], byte_bpe: str, piece_bpe: str) -> list[tuple[np.ndarray, np.ndarray]]:
    """(ids, tokens per text) of both sides, each text tokenised whole."""
    sides = []
    for kind, path in _kinds(byte_bpe, piece_bpe):
        one, spelled, _, _ = _loaded(kind, path)
        ids: list[list[int]] = []
        for part in _parts(texts, CALL_BYTES):
            ids += one.encode([t or "" for t in part])
        sides.append([x if t and b"".join([spelled[i] for i in x]) == b" " + t.encode() else [] for t, x in zip(texts, ids, strict=True)])
    both = [bool(x and y) for x, y in zip(*sides, strict=True)]
    out = []
    for side in sides:
        side = [x if ok else [] for ok, x in zip(both, side, strict=True)]
        sizes = np.array([len(x) for x in side], dtype=np.int64)
        out.append((np.fromiter(chain.from_iterable(side), dtype=np.int64, count=int(sizes.sum())), sizes))
    return out


# A place where both tokenizers cut whatever stands around it: before a space that follows
# something other than white space and is followed by more than spaces.
_CUT = re.compile(r"(?<=\S)(?= +[^ ])")


# White space other than these makes the search for a space behind white space worthwhile.
_RARE = re.compile(r"[^\S \n\r\t]")


class _Numbered(dict):
    """Numbers its keys in the order they are met."""

    def __missing__(self, key: str) -> int:
        self[key] = number = len(self)
        return number


def _chunks(text: str) -> list[str]:
    """" " + text, cut before spaces as far as that changes no token; a chunk is given without its first space."""
    plain = text[0] != " " and text[-1] != " " and not any(w in text for w in ("  ", "\n ", "\t ", "\r ")) and not _RARE.search(text)
    return text.split(" ") if plain else [c[1:] for c in _CUT.split(" " + text)]


def _by_chunk(texts: list[str | None], byte_bpe: str, piece_bpe: str) -> list[tuple[np.ndarray, np.ndarray]] | None:
    """The same as `_by_text`, with each distinct chunk of the block tokenised once; None if that can't be done.

    No token of either side reaches from behind a non-space into a space: the byte-level
    pattern matches no such stretch, and no piece holds a space mark behind another
    character (`whole_words`). So a text's tokens are its chunks' tokens, one after the other.
    """
    if not _loaded(Pieces, piece_bpe)[0].whole_words:
        return None
    index = _Numbered()
    flat, counts = array.array("q"), np.zeros(len(texts), np.int64)
    for k, t in enumerate(texts):
        if t and "▁" not in t:  # such a letter is never spelled
            parts = _chunks(t)
            counts[k] = len(parts)
            flat.extend(map(index.__getitem__, parts))
    chunks = list(index)
    last = np.cumsum([len(c.encode()) + 1 for c in chunks], dtype=np.int64)
    joined = [" ".join(part) for part in _parts(chunks, CALL_BYTES, open_end=False)]
    whole = "".join([" " + j for j in joined]).encode()
    of = np.frombuffer(flat, np.int64) if flat else np.zeros(0, np.int64)
    ends = np.cumsum(counts)
    out = []
    for kind, path in _kinds(byte_bpe, piece_bpe):
        one, spelled, lengths, _ = _loaded(kind, path)
        ids = list(chain.from_iterable(one.encode(joined)))
        if b"".join([spelled[i] for i in ids]) != whole:
            return None
        ids = np.array(ids, dtype=np.int64)
        token_ends = np.cumsum(lengths[ids])
        stop = np.searchsorted(token_ends, last) + 1
        if len(last) and not np.array_equal(token_ends[stop - 1], last):
            return None
        start = np.concatenate([[0], stop[:-1]]).astype(np.int64)[: len(stop)]
        size = (stop - start)[of]
        upto = np.concatenate([[0], np.cumsum(size)])
        at = np.repeat(start[of] - upto[:-1], size) + np.arange(upto[-1])
        out.append((ids[at], upto[ends] - upto[ends - counts]))
    return out


def _parts(texts: list[str | None], size: int, open_end: bool = True) -> Iterator[list[str | None]]:
    """Runs of about `size` characters; without `open_end` nothing follows a text that is empty or ends in white space."""
    part, held = [], 0
    for t in texts:
        part.append(t)
        held += len(t or "")
        if held >= size or not open_end and not (t and not t[-1].isspace()):
            yield part
            part, held = [], 0
    if part:
        yield part


def _blocks(batches: Iterator[pd.DataFrame], size: int) -> Iterator[tuple[list, list[str | None]]]:
    """Ids and texts, in blocks of about `size` characters or 4,096 texts."""
    ids, texts, held = [], [], 0
    for batch in batches:
        for i, t in zip(batch["doc_id"].astype(object).where(batch["doc_id"].notna(), None), batch["text"], strict=True):
            ids.append(i)
            texts.append(t)
            held += len(t or "")
            if held >= size or len(ids) == 4096:
                yield ids, texts
                ids, texts, held = [], [], 0
    if ids:
        yield ids, texts


def align(docs: DataFrame, byte_bpe: str = BYTE_BPE, piece_bpe: str = PIECE_BPE, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per document: doc_id, a_ids, b_ids, a_group, b_group, and the byte each group ends at in " " + text."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for ids, texts in _blocks(batches, block_bytes):
            x = Block.of(texts, byte_bpe, piece_bpe)
            n_groups, at_a, at_b, at_g, base = x.groups(), 0, 0, 0, 0
            last = np.append(x.group_a[1:] != x.group_a[:-1], True) if len(x.a) else np.zeros(0, bool)
            ends, rows = x.ends_a[last], []
            for i, na, nb, ng in zip(ids, x.n_a, x.n_b, n_groups, strict=True):
                a, b, g = slice(at_a, at_a + na), slice(at_b, at_b + nb), slice(at_g, at_g + ng)
                rows.append((i, x.a[a], x.b[b], x.group_a[a] - at_g, x.group_b[b] - at_g, ends[g] - base))
                at_a, at_b, at_g, base = at_a + na, at_b + nb, at_g + ng, int(ends[at_g + ng - 1]) if ng else base
            yield pd.DataFrame(rows, columns=["doc_id", "a_ids", "b_ids", "a_group", "b_group", "ends"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInPandas(
        run, f"doc_id {kind}, a_ids array<int>, b_ids array<int>, a_group array<int>, b_group array<int>, ends array<long>"
    )


def _packed(x: np.ndarray) -> bytes:
    return pa.Codec("zstd", compression_level=1).compress(x.astype("<u4").tobytes(), asbytes=True)


def _opened(packed: bytes, count: int) -> np.ndarray:
    return np.frombuffer(pa.Codec("zstd").decompress(packed, decompressed_size=4 * count, asbytes=True), "<u4").astype(np.int64)


def linked_blocks(docs: DataFrame, byte_bpe: str, piece_bpe: str, block_bytes: int) -> DataFrame:
    """One stored row per block: its documents' counts and digests, and its distinct linked pairs.

    `codes`: a * 2^32 + b of each distinct pair, ascending; `held`: how many of the
    block's documents hold it. `places`, `times`: for each document (`sizes` of them) its
    distinct pairs as places in `codes`, and how often it links them.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        task = TaskContext.get().partitionId() << 32
        for number, (ids, texts) in enumerate(_blocks(batches, block_bytes)):
            x = Block.of(texts, byte_bpe, piece_bpe)
            i, j = x.links()
            codes, place = np.unique((x.a[i] << 32) + x.b[j], return_inverse=True)
            doc = np.repeat(np.arange(len(ids)), x.n_a)[i]
            # A document's links are together, so one sort orders them by document and pair.
            key, times = np.unique(doc * max(1, len(codes)) + place, return_counts=True)
            owner, place = np.divmod(key, max(1, len(codes)))
            yield pd.DataFrame(
                {
                    "block": [task + number],
                    "doc_id": [ids],
                    "n_a": [x.n_a],
                    "n_b": [x.n_b],
                    "n_groups": [x.groups()],
                    "n_links": [np.bincount(doc, minlength=len(ids))],
                    "digest": [[hashlib.sha256(s.encode()).hexdigest() if s else "" for s in x.written(byte_bpe, piece_bpe)]],
                    "codes": [codes],
                    "held": [np.bincount(place, minlength=len(codes))],
                    "sizes": [np.bincount(owner, minlength=len(ids))],
                    "places": [_packed(place)],
                    "times": [_packed(times)],
                }
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    lists = ", ".join(f"{c} array<long>" for c in ("n_a", "n_b", "n_groups", "n_links"))
    made = docs.select("doc_id", "text").mapInPandas(
        run, f"block long, doc_id array<{kind}>, {lists}, digest array<string>, codes array<long>, held array<long>, sizes array<long>, places binary, times binary"
    )
    return cut_lineage(made, "blocks")


def pair_counts(blocks: DataFrame) -> DataFrame:
    """(code, n, best): how many documents hold each pair linked, and whether no pair of its A id is held by more.

    A window's group is the pairs of one A id, at most the other vocabulary's size.
    """
    pairs = blocks.select(F.explode(F.arrays_zip("codes", "held")).alias("p"))
    counted = pairs.groupBy(F.col("p.codes").alias("code")).agg(F.sum("p.held").alias("n"))
    most = F.max("n").over(W.partitionBy(F.shiftright("code", 32)))
    return cut_lineage(counted.withColumn("best", F.col("n") == most), "pair-counts")


def digests(docs: DataFrame, byte_bpe: str = BYTE_BPE, piece_bpe: str = PIECE_BPE, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per document: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256."""
    blocks = linked_blocks(docs, byte_bpe, piece_bpe, block_bytes)
    met = blocks.select("block", F.explode("codes").alias("code")).join(pair_counts(blocks), "code")
    kind = docs.schema["doc_id"].dataType.simpleString()

    def add(block: pd.DataFrame, found: pd.DataFrame) -> pd.DataFrame:
        row, found = block.iloc[0], found.sort_values("code")  # the block's distinct pairs, in its own order
        sizes = np.asarray(row["sizes"], dtype=np.int64)
        place, times = (_opened(row[c], int(sizes.sum())) for c in ("places", "times"))
        ends = np.cumsum(sizes)

        def per_doc(value: np.ndarray) -> np.ndarray:
            upto = np.concatenate([[0], np.cumsum(value)])
            return upto[ends] - upto[ends - sizes]

        return pd.DataFrame(
            {
                "doc_id": row["doc_id"], "n_a": row["n_a"], "n_b": row["n_b"], "n_groups": row["n_groups"], "n_links": row["n_links"],
                "n_best": per_doc(found["best"].to_numpy(dtype=np.int64)[place] * times),
                "count_sum": per_doc(found["n"].to_numpy(dtype=np.int64)[place] * times),
                "groups_sha256": row["digest"],
            }
        )

    counts = ", ".join(f"{c} long" for c in ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum"))
    own = blocks.select(F.col("block").alias("own"), "doc_id", "n_a", "n_b", "n_groups", "n_links", "digest", "sizes", "places", "times")
    return own.groupBy("own").cogroup(met.groupBy("block")).applyInPandas(add, f"doc_id {kind}, {counts}, groups_sha256 string")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(table(spark, sf_dir, "documents"))
