"""URL expressions: parts, resolution, validity, host suffixes."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Splitting pattern of RFC 3986, appendix B.
_PARTS = r"(?s)^(?:([a-zA-Z][a-zA-Z0-9+.-]*):)?(//[^/?#]*)?([^?#]*)(\?[^#]*)?(#.*)?$"
_SCHEME, _AUTHORITY, _PATH, _QUERY, _FRAGMENT = range(1, 6)

# Link prefixes that lead to no page.
SKIPPED_PREFIXES = ("tel", "javascript", "mailto", "webcal")


def _part(url: Column, index: int) -> Column:
    return F.regexp_extract(url, _PARTS, index)


def followable(href: Column) -> Column:
    """Case-sensitive prefix rule: drops ``telephone.html`` as well."""
    return ~reduce(Column.__or__, [href.startswith(p) for p in SKIPPED_PREFIXES])


def host(url: Column) -> Column:
    """Lowercased host without user info and port, NULL without one."""
    found = F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?(\[[^\]]*\]|[^:/?#]*)", 1)
    return F.nullif(F.lower(found), F.lit(""))


def host_suffixes(name: Column) -> Column:
    """The host and every parent domain: a.b.c -> [a.b.c, b.c, c]."""
    labels = F.split(name, r"\.")
    return F.transform(
        F.sequence(F.lit(1), F.size(labels)),
        lambda i: F.array_join(F.slice(labels, i, F.size(labels) - i + 1), "."),
    )


def valid_url(url: Column) -> Column:
    """An http, https or ftp URL with a dotted host name, IPv4 or localhost.

    The numbers of an address go to 255, those of a port to 65535.
    """
    octet = r"(?:25[0-5]|2[0-4][0-9]|[01]?[0-9]{1,2})"
    port = r"(?:6553[0-5]|655[0-2][0-9]|65[0-4][0-9]{2}|6[0-4][0-9]{3}|[0-5]?[0-9]{1,4})"
    label = r"[a-z0-9¡-￿](?:[a-z0-9¡-￿_-]{0,61}[a-z0-9¡-￿])?"
    pattern = (
        r"(?i)^(?:https?|ftp)://(?:[^\s/?#@]+@)?"
        rf"(?:localhost|(?:{label}\.)+[a-z¡-￿][a-z0-9¡-￿-]{{1,62}}"
        rf"|(?:{octet}\.){{3}}{octet})(?::{port})?(?:[/?#]\S*)?$"
    )
    return F.coalesce(url.rlike(pattern), F.lit(False))


def _remove_dots(path: Column) -> Column:
    """Resolve ``.`` and ``..`` segments; a trailing one keeps the slash."""
    start = F.array().cast("array<string>")
    segments = F.split(F.regexp_replace(path, "^/", ""), "/")
    closed = F.when(
        path.rlike(r"(^|/)\.{1,2}$"), F.concat(segments, F.array(F.lit("")))
    ).otherwise(segments)
    kept = F.aggregate(
        closed,
        start,
        lambda acc, s: F.when(s == ".", acc)
        .when(s == "..", F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(0))))
        .otherwise(F.array_append(acc, s)),
    )
    return F.when(
        path.rlike(r"(^|/)\.{1,2}(/|$)"), F.concat(F.lit("/"), F.array_join(kept, "/"))
    ).otherwise(path)


def base_parts(base: Column) -> Column:
    """What resolution needs of the page URL, computed once per page."""
    scheme = _part(base, _SCHEME)
    authority = _part(base, _AUTHORITY)
    path = _part(base, _PATH)
    folder = F.when((authority != "") & (path == ""), F.lit("/")).otherwise(
        F.regexp_replace(path, "[^/]*$", "")
    )
    return F.struct(
        base.alias("url"),
        scheme.alias("scheme"),
        F.concat(scheme, F.lit(":"), authority).alias("root"),
        path.alias("path"),
        folder.alias("folder"),
        _part(base, _QUERY).alias("query"),
    )


def trim_href(href: Column) -> Column:
    """Without leading control characters and spaces, and without line breaks."""
    return F.regexp_replace(href, r"^[\x00-\x20]+|[\t\r\n]", "")


def resolve_url(base: Column, href: Column) -> Column:
    """Resolve a trimmed link against ``base_parts`` of the page URL (RFC 3986, 5.2).

    The fragment and the query stay part of the target: a page and its
    fragment are different targets, as no URL is canonicalised. The frequent
    forms come first, so they cost one or two tests.
    """
    ref = href
    path = _part(ref, _PATH)
    tail = F.concat(_part(ref, _QUERY), _part(ref, _FRAGMENT))
    return (
        F.when(
            ref.startswith("/") & ~ref.startswith("//") & ~F.contains(ref, F.lit("/.")),
            F.concat(base["root"], ref),
        )
        .when(ref == "", base["url"])
        .when(ref.rlike("^[a-zA-Z][a-zA-Z0-9+.-]*:"), ref)
        .when(ref.startswith("//"), F.concat(base["scheme"], F.lit(":"), ref))
        .when(ref.startswith("/"), F.concat(base["root"], _remove_dots(path), tail))
        .when(ref.startswith("?"), F.concat(base["root"], base["path"], ref))
        .when(ref.startswith("#"), F.concat(base["root"], base["path"], base["query"], ref))
        .otherwise(F.concat(base["root"], _remove_dots(F.concat(base["folder"], path)), tail))
    )


def anchor(url: Column) -> Column:
    """The URL as a link for display."""
    return F.format_string('<a href="%s">%s</a>', url, url)
