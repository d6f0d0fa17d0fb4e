"""URL parts and redirect targets.

The authority is cut out by pattern instead of a URI parser, so URLs with
blanks or other characters a strict parser refuses still keep their host.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_AUTHORITY = r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?//([^/?#]*)"
_SCHEME = r"^([A-Za-z][A-Za-z0-9+.\-]*):"


def url_netloc(url: Column) -> Column:
    """Host with port and user part; ``www.`` kept; empty when there is none."""
    return F.coalesce(F.regexp_extract(url, _AUTHORITY, 1), F.lit(""))


def url_domain(url: Column) -> Column:
    """``url_netloc`` without one leading ``www.``."""
    return F.regexp_replace(url_netloc(url), r"^www\.", "")


def url_scheme(url: Column) -> Column:
    return F.lower(F.regexp_extract(url, _SCHEME, 1))


def url_origin(url: Column) -> Column:
    """``scheme://netloc``, with https for a URL without a scheme; NULL without a host."""
    scheme = F.when(url_scheme(url) == "", F.lit("https")).otherwise(url_scheme(url))
    return F.when(url_netloc(url) != "", F.concat(scheme, F.lit("://"), url_netloc(url)))


def resolve_location(base: Column, location: Column) -> Column:
    """Absolute form of a redirect's Location header as seen from ``base``."""
    rooted = F.when(location.startswith("/"), location).otherwise(F.concat(F.lit("/"), location))
    return F.when(location.rlike(r"^https?://"), location).otherwise(
        F.concat(url_scheme(base), F.lit("://"), url_netloc(base), rooted)
    )


def same_site(left: Column, right: Column) -> Column:
    """True when both URLs share a host, ``www.`` aside."""
    return url_domain(left) == url_domain(right)
