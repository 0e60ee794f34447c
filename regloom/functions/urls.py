"""URL helpers as column expressions (urljoin, license-wrapper unwrap)."""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_SCHEME = r"^[A-Za-z][A-Za-z0-9+.\-]*:"
_ORIGIN = r"^([A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*)"


def _without_dots(segments: Column) -> Column:
    """Path of the segments after '.' and '..' took effect; always absolute."""
    none = F.array().cast("array<string>")
    kept = F.reduce(
        segments,
        none,
        lambda acc, s: F.when(s == "..", F.slice(acc, F.lit(1), F.greatest(F.size(acc) - 1, F.lit(0)))).when(s == ".", acc).otherwise(F.concat(acc, F.array(s))),
    )
    open_end = F.element_at(segments, -1).isin(".", "..")
    path = F.array_join(F.when(open_end, F.concat(kept, F.array(F.lit("")))).otherwise(kept), "/")
    return F.when(path.startswith("/"), path).otherwise(F.concat(F.lit("/"), path))


def url_join(base: Column, href: Column) -> Column:
    """``urllib.parse.urljoin`` for the href shapes found on crawled pages:
    absolute URLs, scheme-relative ('//host/..'), absolute and relative paths
    with dot segments, query-only, fragment-only and empty.
    """
    return F.get(F.transform(F.array(F.coalesce(href, F.lit(""))), lambda h: _joined(base, h)), 0)  # the href is named many times, and bound once


def _joined(base: Column, h: Column) -> Column:
    scheme = F.regexp_extract(base, r"^([A-Za-z][A-Za-z0-9+.\-]*):", 1)
    origin = F.regexp_extract(base, _ORIGIN, 1)
    no_frag = F.regexp_replace(base, "#.*$", "")
    no_query = F.regexp_replace(no_frag, r"\?.*$", "")
    base_path = F.substring(no_query, F.length(origin) + 1, F.length(no_query))
    h_path = F.regexp_extract(h, r"^([^?#]*)", 1)
    rest = F.substring(h, F.length(h_path) + 1, F.length(h))
    # The base's folder, then the href's segments; doubled slashes between them vanish.
    folder = F.split(F.regexp_replace(base_path, "[^/]*$", ""), "/")
    joined = F.concat(folder, F.split(h_path, "/"))
    inner = F.filter(F.slice(joined, F.lit(2), F.size(joined) - 2), lambda s: s != "")
    relative = F.concat(F.array(F.lit("")), inner, F.slice(joined, -1, 1))
    rooted = h.startswith("/")
    # Paths are taken apart only where a segment may be a dot segment.
    return (
        F.when(h == "", base)
        .when(h.rlike(_SCHEME), h)
        .when(h.startswith("//"), F.concat(scheme, F.lit(":"), h))
        .when(rooted & ~h.contains("/."), F.concat(origin, h))
        .when(rooted, F.concat(origin, _without_dots(F.split(h_path, "/")), rest))
        .when(h.startswith("?"), F.concat(no_query, h))
        .when(h.startswith("#"), F.concat(no_frag, h))
        .otherwise(F.concat(origin, _without_dots(relative), rest))
    )


def unwrap_license(href: Column) -> Column:
    """L5: '/license/ama?file=<target>' -> target with '/{2,}' collapsed.

    ``try_parse_url`` reads path and query of relative hrefs; the ``file``
    value is percent-decoded like ``parse_qs``; an empty target keeps the href.
    """
    may_be = href.contains("/license/ama")
    path = F.try_parse_url(href, F.lit("PATH"))
    target = F.try_url_decode(F.try_parse_url(href, F.lit("QUERY"), F.lit("file")))
    wrapped = F.coalesce(path.endswith("/license/ama"), F.lit(False)) & F.coalesce(target != "", F.lit(False))
    return F.when(may_be & wrapped, F.regexp_replace(target, "/{2,}", "/")).otherwise(href)


def resolve_cms_href(href: Column, base: Column) -> Column:
    return url_join(base, unwrap_license(href))
