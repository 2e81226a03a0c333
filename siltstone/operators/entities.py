"""Regular-expression entities with exact spans."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from functools import reduce
from operator import add, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import let

# label -> (pattern, characters of which one must occur, whether a digit must occur).
# A value is whole, however long. A repeat that a later character decides about is tried
# from the beginning of its run only and never given back in parts, so junk text costs linear time and no stack.
PATTERNS: dict[str, tuple[str, str, bool]] = {
    "email": (r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@[A-Za-z0-9.-]+\.[A-Za-z]{2,}", "@", False),
    "phone_intl": (r"\+[0-9]{1,3}[ .-]?[0-9]{2,4}(?:[ .-]?[0-9]{2,4}){2,4}", "+", True),
    "phone_us": (r"\(?[2-9][0-9]{2}\)?[ .-][2-9][0-9]{2}[ .-][0-9]{4}", "", True),
    "url": (r"https?://[^\s\"'<>]+", ":", False),
    "ipv4": (r"(?:[0-9]{1,3}\.){3}[0-9]{1,3}", "", True),
    "ipv6": (r"(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}", ":", False),
    "uuid": (r"[0-9A-Fa-f]{8}-[0-9A-Fa-f]{4}-[1-5][0-9A-Fa-f]{3}-[89ABab][0-9A-Fa-f]{3}-[0-9A-Fa-f]{12}", "-", True),
    "currency": (r"(?:USD|EUR|GBP|[$€£¥])\s?[0-9]+(?:,[0-9]{3})*(?:\.[0-9]{1,2})?", "$€£¥DRP", True),
    "percentage": (r"(?<![0-9])[0-9]++(?:\.[0-9]++)?\s?%", "%", True),
    "number": (r"[0-9]+(?:,[0-9]{3})*(?:\.[0-9]+)?", "", True),
    "date_iso": (r"[0-9]{4}-(?:0[1-9]|1[0-2])-(?:0[1-9]|[12][0-9]|3[01])", "-", True),
    "date_us": (r"(?:0?[1-9]|1[0-2])/(?:0?[1-9]|[12][0-9]|3[01])/[0-9]{4}", "/", True),
    "time_24h": (r"(?:[01][0-9]|2[0-3]):[0-5][0-9](?::[0-5][0-9])?", ":", True),
    "postal_us": (r"[A-Z]{2} [0-9]{5}(?:-[0-9]{4})?", "", True),
    "postal_uk": (r"[A-Z]{1,2}[0-9][0-9A-Z]? ?[0-9][A-Z]{2}", "", True),
    "html_color_hex": (r"#[0-9A-Fa-f]{6}", "#", False),
    "twitter_handle": (r"@[A-Za-z0-9_]{1,15}", "@", False),
    "hashtag": (r"#[A-Za-z0-9_]+", "#", False),
    "mac_addr": (r"(?:[0-9A-Fa-f]{2}[:-]){5}[0-9A-Fa-f]{2}", ":-", False),
    "iban": (r"[A-Z]{2}[0-9]{2}(?: ?[0-9A-Z]{4}){3,7}(?: ?[0-9A-Z]{1,3})?", "", True),
    "credit_card": (r"(?:[0-9]{4}[ -]?){3}[0-9]{4}", "", True),
}


def _found(text: Column, pattern: str, needed: str, digit: bool) -> Column:
    """All matches; cheap scans for what a match needs spare most texts the pattern."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    possible = reduce(or_, [F.contains(text, F.lit(c)) for c in needed]) if needed else F.lit(True)
    return F.when(possible & F.col("_digit") if digit else possible, found)


def _running(blocks: Column, at: str, lengths: tuple[str, ...]) -> Column:
    """(total, starts): where each element begins when the named lengths are laid end to end."""
    return F.aggregate(
        blocks,
        F.struct(F.lit(0).alias("total"), F.array().cast("array<int>").alias("starts")),
        lambda acc, x: F.struct(
            reduce(add, [x[n] for n in lengths], acc["total"]).alias("total"),
            F.concat(acc["starts"], F.array(acc["total"] + x[at] if at else acc["total"])).alias("starts"),
        ),
    )


def _starts(lengths: Column) -> Column:
    """Start of every match from (gap before it, own length).

    A fold copies what it has so far at each step, so the matches are folded in
    blocks of about the root of their number: a text with a million of them
    costs a thousand short folds and not one long one.
    """
    size = F.size(lengths)
    step = F.ceil(F.sqrt(size)).cast("int")
    blocks = F.transform(
        F.sequence(F.lit(0), F.ceil(size / step).cast("int") - 1),
        lambda b: _running(F.slice(lengths, b * step + 1, step), "gap", ("gap", "own")),
    )
    return let(
        blocks,
        lambda folded: F.flatten(
            F.zip_with(
                folded,
                _running(folded, "", ("total",))["starts"],
                lambda block, first: F.transform(block["starts"], lambda s: s + first),
            )
        ),
    )


def _spans(text: Column, found: Column, label: str, pattern: str) -> Column:
    """Array of (label, value, start, end) for one pattern; offsets count characters.

    The text between matches comes from `split`, so equal values keep their own spans.
    """
    lengths = F.zip_with(
        found,
        F.slice(F.split(text, pattern, -1), F.lit(1), F.size(found)),
        lambda m, g: F.struct(F.length(g).alias("gap"), F.length(m).alias("own")),
    )
    rows = F.zip_with(
        found,
        let(lengths, _starts),
        lambda m, s: F.struct(
            F.lit(label).alias("label"), m.alias("value"), s.alias("start"), (s + F.length(m)).alias("end")
        ),
    )
    none = F.array().cast("array<struct<label:string,value:string,start:int,end:int>>")
    return F.when(F.size(found) > 0, rows).otherwise(none)


def entities(
    df: DataFrame,
    labels: Sequence[str] | None = None,
    custom: Mapping[str, str] | None = None,
    text: str = "content",
) -> DataFrame:
    """Rows (…, label, value, start, end), `end` exclusive; the whole text is searched.

    `labels` narrows the built-in set; `custom` adds or replaces label patterns.
    """
    # A match may also begin where the one before it ended.
    begun = lambda p: re.sub(r"^(\(\?<![^)]*\))", r"(?:\\G|\1)", p)
    chosen = {name: (begun(PATTERNS[name][0]), *PATTERNS[name][1:]) for name in (PATTERNS if labels is None else labels)}
    chosen.update({name: (pattern, "", False) for name, pattern in (custom or {}).items()})
    keep = [c for c in df.columns if c not in (text, "label", "value", "start", "end")]
    # Matches get columns of their own, so each pattern runs once per text.
    matched = df.select(
        *keep, F.col(text).alias("_text"), F.rlike(F.col(text), F.lit("[0-9]")).alias("_digit")
    ).select("*", *[_found(F.col("_text"), *spec).alias(f"_m{i}") for i, spec in enumerate(chosen.values())])
    rows = [
        _spans(F.col("_text"), F.col(f"_m{i}"), name, spec[0]) for i, (name, spec) in enumerate(chosen.items())
    ]
    return matched.select(*keep, F.inline(F.concat(*rows)))


def entity_counts(df: DataFrame, text: str = "content", **options) -> DataFrame:
    return (
        entities(df.select(text), text=text, **options)
        .groupBy("label")
        .agg(F.count(F.lit(1)).alias("n"), F.countDistinct("value").alias("n_values"))
    )
