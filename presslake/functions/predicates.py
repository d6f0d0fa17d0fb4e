"""Row conditions of the crawl queues and reports."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from presslake.functions.dates import moment

MIN_CONTENT_LENGTH = 500
REPORT_DATE_FLOOR = dt.datetime(2024, 4, 1)

# Sitemaps of listing pages, by URL.
LISTING_SUFFIXES = ["category-sitemap.xml", "author-sitemap.xml"]
LISTING_PARTS = ["/category/", "/author/"]


def is_listing_sitemap(url: Column) -> Column:
    """The URL names a sitemap of category or author pages."""
    hit = F.lit(False)
    for suffix in LISTING_SUFFIXES:
        hit = hit | url.endswith(suffix)
    for part in LISTING_PARTS:
        hit = hit | url.contains(part)
    return hit


def not_an_error(is_error: Column) -> Column:
    """Rows known to be without error; an unknown flag does not pass."""
    return is_error == F.lit(False)


def awaits_extraction(raw: Column, content: Column) -> Column:
    return raw.isNotNull() & content.isNull()


def long_enough(content: Column, min_len: int = MIN_CONTENT_LENGTH) -> Column:
    return content.isNotNull() & (F.length(content) >= min_len)


def has_text(content: Column) -> Column:
    return content.isNotNull() & (content != "")


def on_or_after(date: Column, floor: dt.datetime = REPORT_DATE_FLOOR) -> Column:
    return date >= moment(floor)


def result_ok(error: Column, status_code: Column) -> Column:
    """A result line without an error text and with status 200."""
    no_error = error.isNull() | error.isin("", "null", "{}", "[]", "false", "0")
    return no_error & F.coalesce(status_code == 200, F.lit(False))
