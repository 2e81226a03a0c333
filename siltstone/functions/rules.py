"""Traversal, keyword and verdict rules as Column expressions."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import as_column, literal_array
from .urls import segments

# The classifier prompt, part by part, and the two answer words.
PROMPT_SYSTEM = "SYSTEM: You are a strict relevance classifier."
PROMPT_POLICY = "POLICY: "
PROMPT_LANGUAGE = "LANGUAGE: "
PROMPT_TEXT = "TEXT: "
PROMPT_INSTRUCTION = "INSTRUCTION: Answer ONLY 'RELEVANT' or 'NOT RELEVANT'."
ACCEPT_WORD = "RELEVANT"
REJECT_WORD = "NOT"

# Beyond this many terms one array scan is smaller to plan than a chain of ORs.
INLINE_TERMS = 64


def traversal_allowed(
    url: Column | str,
    depth: Column | int,
    required: Sequence[str] = (),
    blocked: Sequence[str] = (),
    max_depth: int = 10,
) -> Column:
    """May this URL be visited at this depth?

    Depth beyond the limit says no, then any blocked segment says no, then the
    root says yes, then one required segment must occur.  Path segments are
    compared in lower case; the rule terms are taken as written, so a term with
    capitals never matches.
    """
    d = F.lit(depth) if isinstance(depth, int) else as_column(depth)
    segs = segments(url)
    verdict = F.when(d > F.lit(max_depth), F.lit(False))
    if blocked:
        verdict = verdict.when(F.arrays_overlap(segs, literal_array(blocked)), F.lit(False))
    verdict = verdict.when(d == F.lit(0), F.lit(True))
    if required:
        verdict = verdict.when(~F.arrays_overlap(segs, literal_array(required)), F.lit(False))
    return verdict.otherwise(F.lit(True))


def mentions_any(lowered: Column, terms: Sequence[str]) -> Column:
    """Does already lower-cased text contain one of the terms?"""
    if not terms:
        return F.lit(False)
    needles = [t.lower() for t in terms]
    if len(needles) <= INLINE_TERMS:
        return reduce(or_, [F.contains(lowered, F.lit(t)) for t in needles])
    return F.exists(literal_array(needles), lambda t: F.contains(lowered, t))


def keyword_policy(content: Column | str, include: Sequence[str], exclude: Sequence[str] = ()) -> Column:
    """An exclude term rejects; otherwise an include term is needed.

    Terms are case-insensitive substrings; no include terms reject everything.
    """
    lowered = F.lower(F.coalesce(as_column(content), F.lit("")))
    return ~mentions_any(lowered, exclude) & mentions_any(lowered, include)


def prompt(content: Column | str, policy: Column | str, language: Column | str = "en") -> Column:
    """The classifier prompt; `policy` and `language` strings are literals. Always five parts: NULLs are empty."""

    def value(v: Column | str) -> Column:
        return F.lit(v) if isinstance(v, str) else F.coalesce(v, F.lit(""))

    return F.concat_ws(
        "\n",
        F.lit(PROMPT_SYSTEM),
        F.concat(F.lit(PROMPT_POLICY), value(policy)),
        F.concat(F.lit(PROMPT_LANGUAGE), value(language)),
        F.concat(F.lit(PROMPT_TEXT), F.coalesce(as_column(content), F.lit(""))),
        F.lit(PROMPT_INSTRUCTION),
    )


def verdict(answer: Column | str) -> Column:
    """Case-sensitive reading of a classifier answer; NULL stays NULL (call failed)."""
    a = as_column(answer)
    return F.contains(a, F.lit(ACCEPT_WORD)) & ~F.contains(a, F.lit(REJECT_WORD))


def link_total_score(intrinsic: Column | str, contextual: Column | str) -> Column:
    """Combine a 0-10 link quality with a 0-1 query relevance; NULL means not scored."""
    own, context = as_column(intrinsic), as_column(contextual)
    return (
        F.when(own.isNull() & context.isNull(), F.lit(5.0))
        .when(context.isNull(), own)
        .when(own.isNull(), context * 10)
        .otherwise(own * 0.7 + context * 10 * 0.3)
    )
