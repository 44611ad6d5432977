"""Resolution of links against the site's origin, following RFC 3986.

``parse_url`` is not used: it gives NULL for paths with a space or a bar, which
occur in links and are accepted here.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_SCHEME = "(?:([A-Za-z][A-Za-z0-9+.\\-]*):)?"
_AUTHORITY = "(?://([^/?#]*))?"
_URL = f"(?s)^{_SCHEME}{_AUTHORITY}([^?#]*)(?:\\?([^#]*))?(?:#(.*))?\\z"
# Ignored in links: control characters and spaces in front, tabs and line breaks.
_IGNORED = "^[\\x00-\\x20]+|[\\t\\r\\n]"
_PARAMS = "(?s);[^/]*\\z"
_DOT_SEGMENT = "(?:^|/)\\.\\.?(?:/|\\z)"


def clean_url(url: Column) -> Column:
    """The link without the characters that are ignored in links."""
    return F.regexp_replace(url, _IGNORED, "")


def split_url(raw: Column, clean: Column) -> Column:
    """Split a link into a struct (raw, scheme, authority, whole_path, query,
    fragment); parts that are missing are empty."""
    return F.struct(
        raw.alias("raw"),
        F.lower(F.regexp_extract(clean, _URL, 1)).alias("scheme"),
        F.regexp_extract(clean, _URL, 2).alias("authority"),
        F.regexp_extract(clean, _URL, 3).alias("whole_path"),
        F.regexp_extract(clean, _URL, 4).alias("query"),
        F.regexp_extract(clean, _URL, 5).alias("fragment"),
    )


def url_path(url: Column) -> Column:
    """Path of an absolute link, without parameters, query and fragment."""
    return F.regexp_replace(F.regexp_extract(clean_url(url), _URL, 3), _PARAMS, "")


def url_authority(url: Column) -> Column:
    """Network location of an absolute link: host, port and user as written."""
    return F.regexp_extract(clean_url(url), _URL, 2)


def _remove_dot_segments(path: Column) -> Column:
    """Resolve "." and ".." in a path that starts with a slash."""

    def step(kept: Column, segment: Column) -> Column:
        popped = F.slice(kept, F.lit(1), F.greatest(F.size(kept) - 1, F.lit(0)))
        return (
            F.when(segment == "..", popped)
            .when(segment == ".", kept)
            .otherwise(F.array_append(kept, segment))
        )

    kept = F.aggregate(F.split(path, "/"), F.array().cast("array<string>"), step)
    closing = F.when(path.rlike("/\\.\\.?\\z"), F.array(F.lit(""))).otherwise(
        F.array().cast("array<string>")
    )
    joined = F.array_join(F.concat(kept, closing), "/")
    resolved = F.when(joined.startswith("/"), joined).otherwise(F.concat(F.lit("/"), joined))
    return F.when(path.rlike(_DOT_SEGMENT), resolved).otherwise(path)


def absolute_url(parts: Column, origin: str) -> Column:
    """Absolute form of a link split by :func:`split_url`.

    Links of another scheme stay as they are, and links with a network location
    keep their path as written. An unbalanced bracket in the network location
    gives NULL.
    """
    scheme, _, host = origin.partition("://")
    own_path = F.regexp_replace(parts.whole_path, _PARAMS, "")
    params = F.regexp_extract(parts.whole_path, _PARAMS, 0)
    rooted = F.when(own_path.startswith("/"), own_path).otherwise(
        F.concat(F.lit("/"), F.regexp_replace(own_path, "/{2,}", "/"))
    )
    path = (
        F.when((parts.authority != "") | (parts.whole_path == ""), parts.whole_path)
        .otherwise(F.concat(_remove_dot_segments(rooted), params))
    )
    url = F.concat(
        F.lit(f"{scheme}://"),
        F.when(parts.authority != "", parts.authority).otherwise(host),
        path,
        F.when(parts.query != "", F.concat(F.lit("?"), parts.query)).otherwise(""),
        F.when(parts.fragment != "", F.concat(F.lit("#"), parts.fragment)).otherwise(""),
    )
    unbalanced = F.contains(parts.authority, F.lit("[")) != F.contains(parts.authority, F.lit("]"))
    return (
        F.when(unbalanced, F.lit(None).cast("string"))
        .when(parts.raw == "", F.lit(origin))
        .when(~parts.scheme.isin("", scheme), parts.raw)
        .otherwise(url)
    )


def resolve_url(href: Column, origin: str) -> Column:
    """Absolute form of one link."""
    return absolute_url(split_url(href, clean_url(href)), origin)
