"""Raw pages to text, metadata and links.

A corpus job over the stored pages: patterns over whole documents, no DOM.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..functions import urls as U
from ..functions.text import WS, strip
from .ranking import bm25

_DROPPED = ("script", "style", "nav", "footer")
_DROP = "(?is)<!--.*?-->|" + "|".join(rf"<{t}(?:\s[^>]*)?>.*?</{t}\s*>" for t in _DROPPED)
_TAG = r"<[^>]*>"
_TITLE = r"(?is)<title[^>]*>(.*?)</title>"
_HEADING = r"(?is)<h[1-6][^>]*>(.*?)</h[1-6]>"
_LANG = r"(?i)<html[^>]*\slang\s*=\s*[\"']?([A-Za-z-]+)"
_ANCHOR = r"(?is)<a\s[^>]*?href\s*=\s*[\"']([^\"']*)[\"'][^>]*>(.*?)</a>"
_MD_LINK = r"\[([^\]]*)\]\(([^)\s]+)[^)]*\)"

# Character references decoded here; the ampersand comes last.
_REFERENCES = (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&nbsp;", " "), ("&amp;", "&"))

UTILITY_FILES = ("robots.txt", "sitemap.xml", "ads.txt", "favicon.ico")


def plain(fragment: Column) -> Column:
    """Tags to spaces, references decoded, whitespace collapsed."""
    text = F.regexp_replace(fragment, _TAG, " ")
    for name, char in _REFERENCES:
        text = F.replace(text, F.lit(name), F.lit(char))
    return strip(F.regexp_replace(text, WS + "+", " "))


def page_text(df: DataFrame, html: str = "html") -> DataFrame:
    """Add `text`: the page without scripts, styles, navigation, footer and tags."""
    return df.withColumn("text", plain(F.regexp_replace(F.col(html), _DROP, " ")))


def page_metadata(df: DataFrame, html: str = "html") -> DataFrame:
    """Add `title`, `headings` (array) and `page_language`."""
    page = F.col(html)
    headings = F.transform(F.regexp_extract_all(page, F.lit(_HEADING), F.lit(1)), plain)
    return df.withColumns(
        {
            "title": plain(F.regexp_extract(page, _TITLE, 1)),
            "headings": headings,
            "page_language": F.lower(F.regexp_extract(page, _LANG, 1)),
        }
    )


def _anchors(df: DataFrame, html: str) -> DataFrame:
    """`hrefs` and `labels` arrays, parallel."""
    page = F.col(html)
    return df.withColumns(
        {
            "_hrefs": F.regexp_extract_all(page, F.lit(_ANCHOR), F.lit(1)),
            "_labels": F.regexp_extract_all(page, F.lit(_ANCHOR), F.lit(2)),
        }
    )


def page_links(df: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """One row per link: position, href, label, canonical target, internal or external."""
    keep = [c for c in df.columns if c not in (html, "position", "href", "link_text")]
    rows = _anchors(df, html).select(
        *keep, F.posexplode(F.arrays_zip("_hrefs", "_labels")).alias("position", "_link")
    )
    return rows.select(
        *keep,
        "position",
        F.col("_link._hrefs").alias("href"),
        plain(F.col("_link._labels")).alias("link_text"),
    ).withColumn("target", U.normalize_url("href", url)).withColumn(
        "external", U.is_external("target", U.base_domain(url))
    )


def link_citations(df: DataFrame, html: str = "html", url: str = "url", markdown: bool = False) -> DataFrame:
    """Reference list of a page: (page columns, n, href), numbered by first appearance.

    The links of a page come from one row, and `array_distinct` keeps the order
    of first appearance, so no shuffle is needed.
    """
    keep = [c for c in df.columns if c != html]
    pattern, group = (_MD_LINK, 2) if markdown else (_ANCHOR, 1)
    raw = F.regexp_extract_all(F.col(html), F.lit(pattern), F.lit(group))
    targets = F.filter(F.transform(raw, lambda h: U.normalize_url(h, F.col(url))), lambda h: h.isNotNull())
    rows = df.select(*keep, F.posexplode(F.array_distinct(targets)).alias("_at", "href"))
    return rows.withColumn("n", F.col("_at") + 1).drop("_at")


def _any_glob(url: Column, globs: Sequence[str]) -> Column:
    return reduce(or_, [F.rlike(url, F.lit(U.glob_regex(g))) for g in globs])


def link_preview(
    links: DataFrame,
    include: Sequence[str] = (),
    exclude: Sequence[str] = (),
    include_internal: bool = True,
    include_external: bool = True,
    max_links: int | None = None,
    score: str | None = None,
    score_threshold: float | None = None,
    page: str = "page_id",
) -> DataFrame:
    """The links of a page worth a look: filters first, then the first `max_links` per page, if given.

    Order is by `score` when one is named, then by position.
    """
    target = F.col("target")
    rows = links.where(target.isNotNull())
    if include:
        rows = rows.where(_any_glob(target, include))
    if exclude:
        rows = rows.where(~_any_glob(target, exclude))
    if not include_internal:
        rows = rows.where(F.col("external"))
    if not include_external:
        rows = rows.where(~F.col("external"))
    if score and score_threshold is not None:
        rows = rows.where(F.col(score) >= score_threshold)
    order = [F.desc(score), "position"] if score else ["position"]
    place = F.row_number().over(W.partitionBy(page).orderBy(*order))
    placed = rows.withColumn("place", place)
    return placed if max_links is None else placed.where(F.col("place") <= max_links)


def seed_discovery(
    pages: DataFrame,
    pattern: str = "*",
    query: str | None = None,
    threshold: float | None = None,
    max_urls: int = -1,
    filter_utility: bool = True,
    url: str = "url",
    html: str = "html",
) -> DataFrame:
    """URLs to seed a crawl from: glob, no utility files, title relevance, a maximum.

    Relevance is BM25 of the title; -1 keeps every URL.
    """
    rows = pages
    if pattern != "*":
        rows = rows.where(F.rlike(F.col(url), F.lit(U.glob_regex(pattern))))
    if filter_utility:
        name = F.lower(F.substring_index(U.path(url), "/", -1))
        rows = rows.where(~name.isin(list(UTILITY_FILES)))
    rows = page_metadata(rows, html).drop(html, "headings", "page_language")
    if query is None:
        return rows if max_urls < 0 else rows.orderBy(url).limit(max_urls)
    rows = bm25(rows, query, text="title")
    if threshold is not None:
        rows = rows.where(F.col("score") >= threshold)
    return rows if max_urls < 0 else rows.orderBy(F.desc(F.round("score", 9)), url).limit(max_urls)
