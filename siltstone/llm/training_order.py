"""Training-order materialisation: token sequences in shuffled order, as binary shards.

Texts are tokenised, joined with an end mark and cut into sequences of `length`
tokens inside each task; the sequences get dense numbers (task offset plus place in
the task). A keyed Feistel network over the smallest even-bit domain that holds all
numbers, walked until the value falls below their count, is a permutation of the
numbers: the slot of each sequence, computed from its number and the key alone, with
no sort and no shared state. Sequences are dealt to tasks by ranges of slots, and each
task writes its range of slots as one shard: slot s is `length` little-endian
uint16 ids at byte (s mod shard) * stride of shard s div shard. A reader
seeks to any slot; a run that was stopped resumes at its slot. A shard is written
under a temporary name and renamed, so a repeated task replaces the file by an equal
one.

Tokenised sequences are stored once in the shared folder before they are numbered,
so numbers do not change when an executor is lost.

Defined cases: null and empty texts give no tokens; the last sequence of a task is
filled up with the end mark and its `n_tokens` says how many count; repeated rows are
tokenised each; null ids are kept as null in the list of texts of a sequence; other
columns are not read; an empty table gives an empty result and no shard.
"""

from __future__ import annotations

import array
import base64
import uuid
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import cut_lineage, new_path, table

RANKS = "/opt/tokenizers/byte_bpe_50k.tiktoken"
LENGTH = 2048
END = 50256
SHARD = 1024
# Sequences are stored in groups of so many: zstd finds repeats within a megabyte.
GROUP = 256
ROUNDS = 6
# Fixed value: the public pre-tokenizer pattern that belongs to the ranks.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

_STORED = ["task", "place", "n_tokens", "docs", "packed"]
_PLACED = "slot long, shard long, offset long, n_tokens int, docs array<long>, checksum long"


@lru_cache(maxsize=2)
def tokenizer(ranks: str):
    import tiktoken

    with open(ranks, "rb") as f:
        table_ = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=table_, special_tokens={})


def feistel(number: Column, count: int, key: int, rounds: int = ROUNDS) -> Column:
    """The slot of each number below `count`: a keyed permutation of 0 .. count - 1.

    The domain has fewer than four times `count` values, so a walk takes few steps;
    after 220 steps one in 10^27 would be left, and that raises.
    """
    half = max(1, (max(count - 1, 1).bit_length() + 1) // 2)
    mask = (1 << half) - 1

    def once(x: Column) -> Column:
        left, right = F.shiftright(x, half), x.bitwiseAND(F.lit(mask))
        for r in range(rounds):
            left, right = right, left.bitwiseXOR(F.xxhash64(right, F.lit(key), F.lit(r)).bitwiseAND(F.lit(mask)))
        return F.shiftleft(left, half).bitwiseOR(right)

    walked = once(number.cast("bigint"))
    # aggregate() stops nothing early, but a value below `count` stays as it is.
    steps = F.sequence(F.lit(1), F.lit(220))
    return F.when(walked < count, walked).otherwise(
        F.aggregate(
            steps, walked, lambda x, _: F.when(x < count, x).otherwise(once(x)),
            lambda x: F.when(x < count, x).otherwise(F.raise_error(F.lit("the walk did not end")).cast("bigint")),
        )
    )


def _codec(level: int) -> pa.Codec:
    return pa.Codec("zstd", compression_level=level)


def _pack(ids: np.ndarray) -> bytes:
    """Low and high bytes of 16-bit numbers apart, then zstd."""
    return _codec(3).compress(ids.astype("<u2").view(np.uint8).reshape(-1, 2).T.tobytes(), asbytes=True)


def _unpack(packed: bytes, length: int) -> np.ndarray:
    a = np.frombuffer(_codec(3).decompress(packed, decompressed_size=2 * length, asbytes=True), dtype=np.uint8)
    return np.ascontiguousarray(a.reshape(2, -1).T).view("<u2").ravel()


def _opened(packed: bytes, count: int, length: int) -> np.ndarray:
    """The ids of a stored group of `count` sequences, one row each."""
    return np.frombuffer(_codec(6).decompress(packed, decompressed_size=2 * count * length, asbytes=True), dtype="<u2").reshape(count, length)


def ids_by_use(stored: DataFrame, length: int) -> np.ndarray:
    """All 65,536 ids, the often used ones first, as counted in one stored group.

    Sequences travel as places in this list, which pack into fewer bytes. The result
    does not depend on it, so one group (of at most GROUP sequences) is enough.
    """
    group = stored.select("n_tokens", "packed").first()
    used = np.bincount(_opened(bytes(group["packed"]), len(group["n_tokens"]), length).ravel(), minlength=1 << 16)
    return np.argsort(-used, kind="stable").astype("<u2")


def sequences(docs: DataFrame, length: int = LENGTH, ranks: str = RANKS, end: int = END) -> DataFrame:
    """(task, place, n_tokens, docs, packed): texts joined and cut into `length` 16-bit ids, up to GROUP sequences a row.

    `place`: the number of the row's first sequence in its task. `n_tokens`, `docs`: for
    each sequence its tokens and the doc_id of each text that has tokens in it.
    """

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        task, place = TaskContext.get().partitionId(), 0
        encode = tokenizer(ranks).encode_ordinary
        held, ids, full = array.array("H"), [], []

        def group() -> pd.DataFrame:
            packed = _codec(6).compress(held[: len(full) * length].tobytes(), asbytes=True)
            return pd.DataFrame([(task, place, [length] * len(full), full, packed)], columns=_STORED)

        for batch in batches:
            for doc_id, text in zip(batch["doc_id"], batch["text"], strict=True):
                if not text:
                    continue
                doc = None if pd.isna(doc_id) else int(doc_id)
                held.extend(encode(text))
                held.append(end)
                ids = [*ids, doc]
                while len(held) >= (len(full) + 1) * length:
                    full.append(ids)
                    ids = [doc] if len(held) > len(full) * length else []
                    if len(full) == GROUP:
                        yield group()
                        place, held, full = place + GROUP, held[GROUP * length :], []
        if full:
            yield group()
            place, held = place + len(full), held[len(full) * length :]
        if held:
            n = len(held)
            held.extend([end] * (length - n))
            yield pd.DataFrame([(task, place, [n], [ids], _codec(6).compress(held.tobytes(), asbytes=True))], columns=_STORED)

    return docs.select("doc_id", "text").mapInPandas(cut, "task int, place int, n_tokens array<int>, docs array<array<long>>, packed binary")


def _one_by_one(stored: DataFrame, by_use: np.ndarray, length: int) -> DataFrame:
    """(task, place, n_tokens, docs, packed) per sequence."""
    place_of = np.empty(1 << 16, "<u2")
    place_of[by_use] = np.arange(1 << 16, dtype="<u2")

    def split(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples(index=False):
                ids = place_of[_opened(row.packed, len(row.n_tokens), length)]
                yield pd.DataFrame(
                    {"task": row.task, "place": row.place + np.arange(len(ids)), "n_tokens": row.n_tokens, "docs": list(row.docs), "packed": [_pack(x) for x in ids]}
                )

    return stored.mapInPandas(split, "task int, place int, n_tokens int, docs array<long>, packed binary")


def materialise(
    docs: DataFrame,
    folder: str,
    length: int = LENGTH,
    shard: int = SHARD,
    key: int = 1,
    ranks: str = RANKS,
    end: int = END,
) -> DataFrame:
    """Write the shards below `folder`; one row per sequence: slot, shard, byte offset, n_tokens, docs, checksum."""
    stored = cut_lineage(sequences(docs, length, ranks, end), "sequences")
    # One row per task of the tokenising stage.
    sizes = stored.groupBy("task").agg(F.max(F.col("place") + F.size("n_tokens")).cast("bigint").alias("n")).orderBy("task").collect()
    total, start = 0, []
    for r in sizes:
        start.append((r["task"], total))
        total += r["n"]
    if not total:
        return docs.sparkSession.createDataFrame([], _PLACED)
    by_use = ids_by_use(stored, length)
    offsets = docs.sparkSession.createDataFrame(start, "task int, first long")
    numbered = _one_by_one(stored, by_use, length).join(F.broadcast(offsets), "task").withColumn("slot", feistel(F.col("first") + F.col("place"), total, key))
    placed = numbered.select("slot", F.expr(f"slot div {shard}").alias("shard"), "n_tokens", "docs", "packed")
    shards = -(-total // shard)
    dealt = placed.repartition(shards, "shard").sortWithinPartitions("shard", "slot")
    size = 2 * length

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        fs, root = _filesystem(folder)
        out = _Shard(fs, root)
        for batch in batches:
            sums = []
            for s, n in zip(batch["shard"], batch["packed"], strict=True):
                blob = by_use[_unpack(n, length)].tobytes()
                out.add(int(s), blob)
                sums.append(zlib.crc32(blob))
            yield pd.DataFrame(
                {"slot": batch["slot"], "shard": batch["shard"], "offset": batch["slot"] % shard * size, "n_tokens": batch["n_tokens"], "docs": batch["docs"], "checksum": sums}
            )
        out.close()

    return dealt.mapInPandas(write, _PLACED)


def _filesystem(folder: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(folder) if "://" in folder or folder.startswith("file:") else (pafs.LocalFileSystem(), folder)


def shard_name(root: str, shard: int) -> str:
    return f"{root}/shard-{shard:08d}.bin"


class _Shard:
    """The shard a task is writing: blobs come in the order of slots."""

    def __init__(self, fs: pafs.FileSystem, root: str) -> None:
        self.fs, self.root, self.shard, self.out = fs, root, None, None
        fs.create_dir(root, recursive=True)

    def add(self, shard: int, blob: bytes) -> None:
        if shard != self.shard:
            self.close()
            self.shard, self.part = shard, f"{shard_name(self.root, shard)}.{uuid.uuid4().hex}"
            self.out = self.fs.open_output_stream(self.part)
        self.out.write(blob)

    def close(self) -> None:
        if self.out is not None:
            self.out.close()
            self.fs.move(self.part, shard_name(self.root, self.shard))
            self.out = None


def read_slots(folder: str, first: int, count: int, length: int = LENGTH, shard: int = SHARD) -> np.ndarray:
    """Slots first .. first + count - 1 as an array [count, length]: sequential reads, from any place."""
    fs, root = _filesystem(folder)
    out = []
    while count > 0:
        number, within = divmod(first, shard)
        take = min(count, shard - within)
        with fs.open_input_file(shard_name(root, number)) as f:
            f.seek(within * 2 * length)
            out.append(np.frombuffer(f.read(take * 2 * length), dtype="<u2").reshape(-1, length))
        first, count = first + take, count - take
    return np.concatenate(out) if out else np.zeros((0, length), dtype="<u2")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return materialise(docs, new_path(spark, "shards"))


def documents_to_shards(docs: DataFrame) -> DataFrame:
    """The pipeline's last stage: what `materialise` returns, with the ids of each sequence's texts."""
    return materialise(docs, new_path(docs.sparkSession, "shards"))
