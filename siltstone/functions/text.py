"""Whitespace, word and token expressions."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters Python's str.strip() and str.split() remove.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x20\x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
WS = r"[\t-\r\x1c-\x20\x85\p{Z}]"
TOKEN = r"[\p{L}\p{N}_]+"

STOP_WORDS = (
    "a", "an", "and", "are", "as", "at", "be", "by", "for", "from", "has", "he", "in", "is",
    "it", "its", "of", "on", "or", "that", "the", "this", "to", "was", "were", "will", "with",
)
NOISE_MARKS = ("↑", "▲", "▼", "⬆", "•")


def as_column(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body(value)` with `value` computed once per row, however often it is named."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def strip(c: Column | str) -> Column:
    return F.btrim(as_column(c), F.lit(WHITESPACE))


def words(c: Column | str) -> Column:
    """Whitespace-separated words; blank text gives an empty array."""
    text = strip(c)
    empty = F.array().cast("array<string>")
    return F.when(text == "", empty).otherwise(F.split(text, WS + "+"))


def tokens(c: Column | str) -> Column:
    """Unicode word tokens.  `[\\p{L}\\p{N}_]` and not `\\w`, which is ASCII on the JVM."""
    return F.regexp_extract_all(as_column(c), F.lit(TOKEN), F.lit(0))


def clean_tokens(
    toks: Column | str,
    stop: Sequence[str] = STOP_WORDS,
    min_length: int = 3,
    marks: Sequence[str] = NOISE_MARKS,
) -> Column:
    """Drop short tokens, stop words and tokens led by a noise mark; repeats stay."""

    def keep(t: Column) -> Column:
        ok = F.length(t) >= F.lit(min_length)
        if stop:
            ok = ok & ~F.lower(t).isin(list(stop))
        for mark in marks:
            ok = ok & ~F.startswith(t, F.lit(mark))
        return ok

    return F.filter(as_column(toks), keep)


def trigram_array(toks: Column | str) -> Column:
    """Consecutive word triples, joined by one space; fewer than three tokens give none."""
    t = as_column(toks)
    n = F.size(t)
    # sequence(1, 0) would count down, hence the guard.
    return F.when(
        n >= 3,
        F.transform(
            F.sequence(F.lit(0), n - 3),
            lambda i: F.concat_ws(" ", F.get(t, i), F.get(t, i + 1), F.get(t, i + 2)),
        ),
    ).otherwise(F.array().cast("array<string>"))


def literal_array(values: Sequence[str]) -> Column:
    if not values:
        return F.array().cast("array<string>")
    return F.array(*[F.lit(v) for v in values])
