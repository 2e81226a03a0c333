"""Text to chunk rows.

Everything but the mergers is row-local: no shuffle, no Python.  Windows are cut
inside one expression and the source text column is dropped, so a long document
is never copied once per chunk.  Result: the other columns, `idx` and `chunk`.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import WS, strip, words
from ..scale import running_sum

# Python's record separator counts as whitespace, so it can never be content.
_MARK = "\x1e"


def _explode(df: DataFrame, pieces: Column, text: str) -> DataFrame:
    """One row per array element, numbered from 0 in `idx`."""
    keep = [c for c in df.columns if c not in (text, "_words", "idx", "chunk")]
    return df.select(*keep, F.posexplode(pieces).alias("idx", "chunk"))


def _windows(ws: Column, count: Column, window: int, step: int) -> Column:
    empty = F.array().cast("array<string>")
    cut = F.transform(
        F.sequence(F.lit(0), count - 1),
        lambda i: F.array_join(F.slice(ws, i * step + 1, F.lit(window)), " "),
    )
    return F.when(F.size(ws) == 0, empty).otherwise(cut)


def _by_windows(df: DataFrame, text: str, count: Column, window: int, step: int) -> DataFrame:
    with_words = df.withColumn("_words", words(text))
    return _explode(with_words, _windows(F.col("_words"), count, window, step), text)


def _overlap_count(n: Column, window: int, overlap: int) -> Column:
    return F.greatest(F.ceil((n - overlap) / F.lit(window - overlap)), F.lit(1)).cast("int")


def chunk_overlapping(
    df: DataFrame,
    window: int = 500,
    overlap: int = 50,
    min_chars: int = 100,
    text: str = "content",
    url: str = "source_url",
) -> DataFrame:
    """Overlapping word windows as chunk records.

    `window` words per chunk, neighbours share `overlap` words, the last window
    may be short.  Chunks of `min_chars` characters or fewer are dropped after
    numbering, so ids keep gaps.
    """
    if not 0 <= overlap < window:
        raise ValueError("overlap must be at least 0 and below window")
    n = F.size(F.col("_words"))
    rows = _by_windows(df, text, _overlap_count(n, window, overlap), window, window - overlap)
    return (
        rows.withColumn("chunk", strip("chunk"))
        .where(F.length("chunk") > min_chars)
        .withColumn("chunk_id", F.concat(F.col(url), F.lit("::"), F.col("idx")))
    )


def chunk_sliding(df: DataFrame, window: int, step: int, text: str = "content") -> DataFrame:
    """Windows of `window` words starting every `step` words until the text is covered."""
    if window < 1 or step < 1:
        raise ValueError("window and step must be positive")
    n = F.size(F.col("_words"))
    count = F.greatest(F.ceil((n - window) / F.lit(step)) + 1, F.lit(1)).cast("int")
    # A step beyond the window may leave a start behind the last word.
    return _by_windows(df, text, count, window, step).where(F.col("chunk") != "")


def chunk_fixed(df: DataFrame, size: int, text: str = "content") -> DataFrame:
    """Consecutive pieces of `size` words."""
    return chunk_sliding(df, size, size, text)


def chunk_identity(df: DataFrame, text: str = "content") -> DataFrame:
    """The whole text as chunk 0."""
    keep = [c for c in df.columns if c not in (text, "idx", "chunk")]
    return df.select(*keep, F.lit(0).alias("idx"), F.col(text).alias("chunk"))


def chunk_regex(df: DataFrame, patterns: Sequence[str] = (r"\n\n",), text: str = "content") -> DataFrame:
    """Pieces between matches of any pattern; blank pieces are not numbered."""
    if not patterns:
        raise ValueError("at least one pattern is needed")
    any_of = "|".join(f"(?:{p})" for p in patterns)
    pieces = F.transform(F.split(F.col(text), any_of), strip)
    return _explode(df, F.filter(pieces, lambda p: p != ""), text)


def chunk_sentences(df: DataFrame, text: str = "content") -> DataFrame:
    """Sentences: text up to `.`, `!` or `?` that is followed by whitespace."""
    flat = F.translate(F.col(text), _MARK, " ")
    marked = F.regexp_replace(flat, f"([.!?]){WS}+", f"$1{_MARK}")
    pieces = F.transform(F.split(marked, _MARK), strip)
    return _explode(df, F.filter(pieces, lambda p: p != ""), text)


def merge_by_tokens(
    df: DataFrame,
    target: int,
    ratio: float = 1.0,
    overlap: int = 0,
    key: str = "doc_id",
    order: str = "idx",
    text: str = "content",
) -> DataFrame:
    """Join a document's pieces in order and cut them into chunks of `target` tokens.

    A word counts as `ratio` tokens.  Pieces are placed by their running word
    offset and sliced before the shuffle, so a group holds one output chunk and
    never a whole document.
    """
    window, shared = int(target / ratio), int(overlap / ratio)
    if not 0 <= shared < window:
        raise ValueError("target must exceed overlap and hold a word")
    step = window - shared
    pieces = (
        df.select(F.col(key), F.col(order), words(text).alias("_words"))
        .withColumn("_n", F.size("_words").cast("long"))
        .where(F.col("_n") > 0)
    )
    placed = running_sum(pieces, "_n", order, by=[key], before="_start", total="_total")
    last_chunk = F.greatest(F.ceil((F.col("_total") - shared) / F.lit(step)), F.lit(1)) - 1
    first = F.greatest(F.floor((F.col("_start") - window) / F.lit(step)) + 1, F.lit(0))
    last = F.least(F.floor((F.col("_start") + F.col("_n") - 1) / F.lit(step)), last_chunk)
    # With an overlap a short tail may lie wholly inside the last chunk already started.
    spread = placed.where(first <= last).withColumn("idx_out", F.explode(F.sequence(first, last)))
    at = F.col("idx_out") * step
    skip = F.greatest(at - F.col("_start"), F.lit(0))
    take = F.least(at + window, F.col("_start") + F.col("_n")) - F.col("_start") - skip
    part = F.array_join(F.slice(F.col("_words"), (skip + 1).cast("int"), take.cast("int")), " ")
    return (
        spread.where(take > 0)
        .select(F.col(key), F.col("idx_out").alias("idx"), F.struct(F.col("_start"), part.alias("t")).alias("_part"))
        .groupBy(key, "idx")
        .agg(F.array_join(F.transform(F.sort_array(F.collect_list("_part")), lambda p: p["t"]), " ").alias("chunk"))
    )


def merge_whole(
    df: DataFrame,
    threshold: int,
    ratio: float = 1.0,
    key: str = "doc_id",
    order: str = "idx",
    text: str = "content",
) -> DataFrame:
    """Pack whole pieces: a piece joins the chunk numbered by the tokens before it.

    Blank pieces carry no tokens and are left out, so a chunk holds at most
    `threshold` pieces.
    """
    if threshold < 1:
        raise ValueError("threshold must be positive")
    pieces = (
        df.select(F.col(key), F.col(order), strip(text).alias("_text"), F.size(words(text)).cast("long").alias("_n"))
        .where(F.col("_n") > 0)
    )
    placed = running_sum(pieces, "_n", order, by=[key], before="_start", total="_total")
    bucket = F.floor(F.col("_start") * F.lit(float(ratio)) / F.lit(threshold))
    return (
        placed.select(F.col(key), bucket.alias("_bucket"), F.struct(F.col(order), F.col("_text").alias("t")).alias("_part"))
        .groupBy(key, "_bucket")
        .agg(F.array_join(F.transform(F.sort_array(F.collect_list("_part")), lambda p: p["t"]), " ").alias("chunk"))
        .withColumnRenamed("_bucket", "bucket")
    )
