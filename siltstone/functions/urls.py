"""URL expressions (A06, D10-D12) by one anchored pattern.

`parse_url` is a strict URI parser and raises on URLs a crawler meets daily, so
the generic-syntax pattern of RFC 3986 appendix B is used; it never fails.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import as_column, let, strip

URL = r"^(?:([A-Za-z][A-Za-z0-9+.-]*):)?(?://([^/?#]*))?([^?#]*)(?:\?([^#]*))?(?:#([\s\S]*))?$"
TRACKING = ("ref", "fbclid", "gclid")
TRACKING_PREFIX = "utm_"
TWO_LEVEL_SUFFIXES = (
    "ac.uk", "co.uk", "gov.uk", "org.uk", "com.au", "net.au", "org.au",
    "co.jp", "co.nz", "co.za", "co.in", "com.br",
)


# A URL loses its line breaks before it is split, so one may separate the parts.
_BREAK = "\n"


def _clean(url: Column | str) -> Column:
    return F.translate(as_column(url), "\t\r\n", "")


def _part(url: Column | str, group: int) -> Column:
    return F.regexp_extract(_clean(url), URL, group)


def parts(url: Column | str) -> Column:
    """[scheme, authority, path, query, fragment] by one run of the pattern."""
    return F.split(F.regexp_replace(_clean(url), URL, _BREAK.join(f"${i}" for i in range(1, 6))), _BREAK)


def scheme(url: Column | str) -> Column:
    return F.lower(_part(url, 1))


def authority(url: Column | str) -> Column:
    """User, host and port as written; empty for a relative reference."""
    return _part(url, 2)


def path(url: Column | str) -> Column:
    """The path without `;parameters` of its last segment."""
    return F.regexp_replace(_part(url, 3), r";[^/]*$", "")


def query(url: Column | str) -> Column:
    return _part(url, 4)


def fragment(url: Column | str) -> Column:
    return _part(url, 5)


def segments(url: Column | str) -> Column:
    """Lower-cased, non-empty path segments."""
    return F.filter(F.split(F.lower(path(url)), "/"), lambda s: s != "")


def path_depth(url: Column | str) -> Column:
    return F.size(segments(url))


def target_dir(url: Column | str) -> Column:
    """Bronze directory name: authority and path with `/`, `:` and `.` turned into `_`."""

    def safe(part: Column, default: str) -> Column:
        return F.translate(F.when(part == "", F.lit(default)).otherwise(part), "/:.", "___")

    return F.concat(safe(authority(url), "unknown"), F.lit("_"), safe(F.btrim(path(url), F.lit("/")), "root"))


def _bare_host(name: Column) -> Column:
    return F.lower(F.regexp_replace(name, r"^.*@|:[0-9]*$", ""))


def host(url: Column | str) -> Column:
    """Lower-case host without user and port."""
    return _bare_host(authority(url))


def _registrable(name: Column, suffixes: Sequence[str]) -> Column:
    def pick(labels: Column) -> Column:
        last_two = F.array_join(F.slice(labels, -2, 2), ".")
        last_three = F.array_join(F.slice(labels, F.greatest(-F.size(labels), F.lit(-3)), F.lit(3)), ".")
        whole = F.array_join(labels, ".")
        return (
            F.when(F.size(labels) <= 2, whole).when(last_two.isin(list(suffixes)), last_three).otherwise(last_two)
        )

    return let(F.split(F.regexp_replace(name, r"^www\.", ""), r"\."), pick)


def base_domain(url: Column | str, suffixes: Sequence[str] = TWO_LEVEL_SUFFIXES) -> Column:
    """Registrable domain: the last two labels, or three below a two-level suffix."""
    return _registrable(host(url), suffixes)


def is_external(url: Column | str, domain: Column | str) -> Column:
    """True when the URL leaves `domain`; a relative reference never does."""

    def leaves(p: Column) -> Column:
        web = F.lower(F.get(p, 0)).isin("", "http", "https")
        own = _registrable(_bare_host(F.get(p, 1)), TWO_LEVEL_SUFFIXES)
        return F.when(F.get(p, 1) == "", ~web).otherwise(own != F.lower(as_column(domain)))

    return let(parts(url), leaves)


def _without_dots(p: Column) -> Column:
    """Resolve `.` and `..` in an absolute path."""
    empty = F.array().cast("array<string>")
    folded = F.aggregate(
        F.split(p, "/"),
        empty,
        lambda acc, s: F.when(s == ".", acc)
        .when(s == "..", F.when(F.size(acc) > 1, F.slice(acc, 1, F.size(acc) - 1)).otherwise(acc))
        .otherwise(F.concat(acc, F.array(s))),
    )
    joined = F.array_join(folded, "/")
    # A final dot segment names a directory.
    closed = F.when(p.rlike(r"/\.{1,2}$"), F.concat(joined, F.lit("/"))).otherwise(joined)
    return F.when(p.contains("/."), closed).otherwise(p)


def normalize_url(
    href: Column | str,
    base: Column | str,
    keep_fragment: bool = False,
    sort_query: bool = True,
    drop_tracking: bool = True,
    extra_drop_params: Sequence[str] = (),
) -> Column:
    """Canonical absolute URL: resolved, host lower-cased, fragment and tracking dropped.

    Query parameters are sorted as text; empty input gives NULL.
    """
    dropped = [p.lower() for p in ((*TRACKING, *extra_drop_params) if drop_tracking else extra_drop_params)]

    def kept(param: Column) -> Column:
        name = F.lower(F.substring_index(param, "=", 1))
        ok = param != ""
        if dropped:
            ok = ok & ~name.isin(dropped)
        if drop_tracking:
            ok = ok & ~F.startswith(name, F.lit(TRACKING_PREFIX))
        return ok

    def resolved(h: Column, b: Column) -> Column:
        own_scheme, own_authority, own_path, own_query, own_fragment = (F.get(h, i) for i in range(5))
        base_scheme, base_authority, base_path, base_query = (F.get(b, i) for i in range(4))
        rooted = (own_scheme != "") | (own_authority != "")
        base_dir = F.regexp_replace(base_path, r"[^/]*$", "")

        new_scheme = F.lower(F.when(own_scheme != "", own_scheme).otherwise(base_scheme))
        new_authority = F.when(rooted, own_authority).otherwise(base_authority)
        new_path = (
            F.when(rooted | F.startswith(own_path, F.lit("/")), own_path)
            .when(own_path == "", base_path)
            .otherwise(F.concat(F.when(base_dir == "", F.lit("/")).otherwise(base_dir), own_path))
        )
        new_query = F.when(rooted | (own_path != "") | (own_query != ""), own_query).otherwise(base_query)
        params = F.filter(F.split(new_query, "&"), kept)
        text = F.array_join(F.array_sort(params) if sort_query else params, "&")

        # Opaque references such as mailto: have no authority and keep their path as it is.
        front = F.when(
            new_authority != "",
            F.concat(
                F.lit("//"),
                F.regexp_extract(new_authority, r"^(.*@)?", 1),
                F.lower(F.regexp_replace(new_authority, r"^.*@", "")),
                F.when(new_path == "", F.lit("/")).otherwise(_without_dots(new_path)),
            ),
        ).otherwise(new_path)
        pieces = [
            F.when(new_scheme != "", F.concat(new_scheme, F.lit(":"))).otherwise(""),
            front,
            F.when(text != "", F.concat(F.lit("?"), text)).otherwise(""),
        ]
        if keep_fragment:
            pieces.append(F.when(own_fragment != "", F.concat(F.lit("#"), own_fragment)).otherwise(""))
        return F.concat(*pieces)

    raw = strip(href)
    whole = let(parts(raw), lambda h: let(parts(base), lambda b: resolved(h, b)))
    return F.when(raw != "", whole)


def glob_regex(glob: str) -> str:
    """Anchored regular expression of a glob (`*` any run, `?` one character)."""
    out = []
    for ch in glob:
        if ch == "*":
            out.append(".*")
        elif ch == "?":
            out.append(".")
        elif ch.isalnum() or ch in "_/-:%=&":
            out.append(ch)
        else:
            out.append("\\" + ch)
    return "^" + "".join(out) + "$"
