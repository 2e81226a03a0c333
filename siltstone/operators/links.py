"""URL filters, scorers, link admission and their statistics."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce
from operator import add, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import urls as U
from ..functions.rules import traversal_allowed
from ..functions.text import tokens


def seed_admission(df: DataFrame, blocked: Sequence[str] = (), url: str = "url", **rules) -> DataFrame:
    """Seeds are judged at depth 0, so only blocked segments can refuse them."""
    return df.where(traversal_allowed(url, 0, blocked=blocked, **rules))


# --- filters -----------------------------------------------------------------


@dataclass(frozen=True)
class PatternFilter:
    """Pass URLs that match one of the globs (or regular expressions); `reverse` inverts."""

    patterns: Sequence[str]
    use_glob: bool = True
    reverse: bool = False
    name: str = "pattern"

    def passes(self, url: Column) -> Column:
        regexes = [U.glob_regex(p) for p in self.patterns] if self.use_glob else list(self.patterns)
        hit = reduce(or_, [F.rlike(url, F.lit(r)) for r in regexes])
        return ~hit if self.reverse else hit


@dataclass(frozen=True)
class ContentTypeFilter:
    """Pass URLs whose extension maps to an allowed type; no extension passes."""

    allowed: Sequence[str]
    extensions: Mapping[str, str] = field(
        default_factory=lambda: {
            "html": "text/html", "htm": "text/html", "php": "text/html", "txt": "text/plain",
            "xml": "application/xml", "json": "application/json", "pdf": "application/pdf",
            "css": "text/css", "js": "application/javascript", "png": "image/png",
            "jpg": "image/jpeg", "jpeg": "image/jpeg", "gif": "image/gif", "svg": "image/svg+xml",
            "zip": "application/zip", "mp4": "video/mp4", "mp3": "audio/mpeg",
        }
    )
    name: str = "content_type"

    def passes(self, url: Column) -> Column:
        ext = extension(url)
        good = [e for e, kind in self.extensions.items() if any(a in kind for a in self.allowed)]
        return (ext == "") | ext.isin(good)


@dataclass(frozen=True)
class DomainFilter:
    """Blocked hosts and their subdomains fail; with an allow list the host must be on it."""

    allowed: Sequence[str] = ()
    blocked: Sequence[str] = ()
    name: str = "domain"

    def passes(self, url: Column) -> Column:
        host = U.host(url)

        def under(domains: Sequence[str]) -> Column:
            return reduce(or_, [(host == d.lower()) | F.endswith(host, F.lit("." + d.lower())) for d in domains])

        ok = F.lit(True)
        if self.blocked:
            ok = ok & ~under(self.blocked)
        if self.allowed:
            ok = ok & under(self.allowed)
        return ok


def extension(url: Column | str) -> Column:
    return F.lower(F.regexp_extract(U.path(url), r"\.([A-Za-z0-9]+)$", 1))


def filter_chain(df: DataFrame, filters: Sequence, url: str = "url") -> DataFrame:
    """Add `passed` and `reason`, the name of the first filter that refused."""
    reason = F.coalesce(*[F.when(~f.passes(F.col(url)), F.lit(f.name)) for f in filters], F.lit(None).cast("string"))
    return df.withColumn("reason", reason).withColumn("passed", F.col("reason").isNull())


def filter_stats(df: DataFrame) -> DataFrame:
    return df.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if("passed").alias("passed"),
        F.count_if(~F.col("passed")).alias("rejected"),
    )


# --- scorers -----------------------------------------------------------------


@dataclass(frozen=True)
class KeywordScorer:
    """Share of the keywords that occur in the URL."""

    keywords: Sequence[str]
    weight: float = 1.0
    case_sensitive: bool = False
    name: str = "keyword"

    def score(self, url: Column) -> Column:
        text = url if self.case_sensitive else F.lower(url)
        words = self.keywords if self.case_sensitive else [k.lower() for k in self.keywords]
        hits = reduce(add, [F.contains(text, F.lit(k)).cast("int") for k in words])
        return hits / F.lit(float(len(words)))


@dataclass(frozen=True)
class PathDepthScorer:
    """1 at the optimal path depth, falling as 1 / (1 + distance)."""

    optimal: int = 3
    weight: float = 1.0
    name: str = "path_depth"

    def score(self, url: Column) -> Column:
        return F.lit(1.0) / (F.abs(U.path_depth(url) - self.optimal) + 1)


@dataclass(frozen=True)
class ExtensionScorer:
    """A weight per file extension; others get `default`."""

    weights: Mapping[str, float]
    default: float = 0.0
    weight: float = 1.0
    name: str = "extension"

    def score(self, url: Column) -> Column:
        ext = extension(url)
        return reduce(
            lambda rest, kv: F.when(ext == kv[0].lower(), F.lit(float(kv[1]))).otherwise(rest),
            self.weights.items(),
            F.lit(float(self.default)),
        )


@dataclass(frozen=True)
class FreshnessScorer:
    """max(0, 1 - 0.1 · age) for the first year in the URL; `default` without a year."""

    current_year: int = 2024
    default: float = 0.5
    weight: float = 1.0
    name: str = "freshness"

    def score(self, url: Column) -> Column:
        year = F.regexp_extract(url, r"(?:^|[^0-9])((?:19|20)[0-9]{2})(?:[^0-9]|$)", 1)
        age = F.greatest(F.lit(self.current_year) - year.try_cast("int"), F.lit(0))
        return F.when(year == "", F.lit(self.default)).otherwise(F.greatest(F.lit(1.0) - age * 0.1, F.lit(0.0)))


@dataclass(frozen=True)
class DomainAuthorityScorer:
    """A weight per base domain."""

    weights: Mapping[str, float]
    default: float = 0.5
    weight: float = 1.0
    name: str = "authority"

    def score(self, url: Column) -> Column:
        domain = U.base_domain(url)
        return reduce(
            lambda rest, kv: F.when(domain == kv[0].lower(), F.lit(float(kv[1]))).otherwise(rest),
            self.weights.items(),
            F.lit(float(self.default)),
        )


def composite_score(url: Column | str, scorers: Sequence, normalize: bool = True) -> Column:
    """Weighted sum of the scores, divided by the weights when `normalize`."""
    u = F.col(url) if isinstance(url, str) else url
    total = reduce(add, [s.score(u) * F.lit(float(s.weight)) for s in scorers])
    return total / F.lit(float(sum(s.weight for s in scorers))) if normalize else total


def score_urls(df: DataFrame, scorers: Sequence, normalize: bool = True, url: str = "url") -> DataFrame:
    """One `score_<name>` column per scorer, and the composite `score`."""
    parts = {f"score_{s.name}": s.score(F.col(url)) for s in scorers}
    return df.withColumns({**parts, "score": composite_score(url, scorers, normalize)})


def score_stats(df: DataFrame, score: str = "score") -> DataFrame:
    return df.agg(
        F.count(score).alias("n"),
        F.avg(score).alias("avg_score"),
        F.min(score).alias("min_score"),
        F.max(score).alias("max_score"),
    )


def intrinsic_score(text: Column | str, title: Column | str, url: Column | str) -> Column:
    """Link quality 0-10 from what the page shows.

    Up to 4 points for the length of the link text, up to 4 for the share of its
    tokens found in the page title, up to 2 for a shallow path.
    """
    label = F.col(text) if isinstance(text, str) else text
    head = F.col(title) if isinstance(title, str) else title
    own = F.array_distinct(tokens(F.lower(label)))
    shared = F.size(F.array_intersect(own, tokens(F.lower(head))))
    length_points = F.least(F.length(label), F.lit(20)) / F.lit(5.0)
    title_points = F.when(F.size(own) > 0, shared / F.size(own) * 4).otherwise(F.lit(0.0))
    return length_points + title_points + F.lit(2.0) / (U.path_depth(url) + 1)

