"""Dates out of sitemap text, always as UTC timestamps.

Recognised shapes form a closed list; whatever has another shape gives NULL and
the page counts as undated. A month or a year alone means its first day. The session time zone must be UTC (``configure``).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# Dates that stand for "no date".
PLACEHOLDER_DATES = ["0000-00-00", "1970-01-01", "0001-01-01"]

_ISO_SHAPE = r"^\d{4}(-\d{1,2}(-\d{1,2}([T ]\d.*)?)?)?$"
# A cast reads a zone after seconds only.
_MINUTE_ZONE = r"^(\S+[T ]\d{1,2}:\d{2}) ?(Z|[+\-]\d{2}:?\d{2})$"
_WEEKDAY = r"^[A-Za-z]{3,9},\s*"

# Shape of the text -> pattern that reads it. The shape is tested
# first because a failed parse costs an exception per row.
_SHAPES = [
    (r"^\d{1,2}\.\d{1,2}\.\d{4} \d{1,2}:\d{2}:\d{2}$", "d.M.yyyy H:mm:ss"),
    (r"^\d{1,2}\.\d{1,2}\.\d{4} \d{1,2}:\d{2}$", "d.M.yyyy H:mm"),
    (r"^\d{1,2}\.\d{1,2}\.\d{4}$", "d.M.yyyy"),
    (r"^\d{4}/\d{1,2}/\d{1,2}$", "yyyy/M/d"),
    (r"^\d{4}/\d{1,2}/\d{1,2} \d{1,2}:\d{2}:\d{2}$", "yyyy/M/d H:mm:ss"),
    (r"^\d{4}/\d{1,2}/\d{1,2} \d{1,2}:\d{2}$", "yyyy/M/d H:mm"),
    (r"^\d{1,2}/\d{1,2}/\d{4}$", "d/M/yyyy"),
    (r"^\d{1,2} [A-Z][a-z]{2} \d{4} \d{1,2}:\d{2}:\d{2} [+\-]\d{4}$", "d MMM yyyy H:mm:ss Z"),
    (r"^\d{1,2} [A-Z][a-z]{2} \d{4} \d{1,2}:\d{2}:\d{2} [A-Z]{1,4}$", "d MMM yyyy H:mm:ss z"),
    (r"^\d{1,2} [A-Z][a-z]{2} \d{4} \d{1,2}:\d{2}:\d{2}$", "d MMM yyyy H:mm:ss"),
    (r"^\d{1,2} [A-Z][a-z]{2} \d{4}$", "d MMM yyyy"),
    (r"^\d{1,2} [A-Z][a-z]{2} \d{2} \d{1,2}:\d{2}:\d{2} [+\-]\d{4}$", "d MMM yy H:mm:ss Z"),
    (r"^\d{1,2} [A-Z][a-z]{2} \d{2} \d{1,2}:\d{2}:\d{2} [A-Z]{1,4}$", "d MMM yy H:mm:ss z"),
    (r"^\d{1,2} [A-Z][a-z]{2} \d{2} \d{1,2}:\d{2}:\d{2}$", "d MMM yy H:mm:ss"),
    (r"^\d{1,2} [A-Z][a-z]{2} \d{2}$", "d MMM yy"),
    (r"^\d{1,2} [A-Z][a-z]{3,8} \d{4} \d{1,2}:\d{2}:\d{2}$", "d MMMM yyyy H:mm:ss"),
    (r"^\d{1,2} [A-Z][a-z]{3,8} \d{4}$", "d MMMM yyyy"),
    (r"^[A-Z][a-z]{2} \d{1,2}, \d{4}$", "MMM d, yyyy"),
    (r"^[A-Z][a-z]{3,8} \d{1,2}, \d{4}$", "MMMM d, yyyy"),
]


def _bare(text: Column) -> Column:
    has_cdata = text.contains("<![CDATA[") & text.contains("]]>")
    without = F.replace(F.replace(text, F.lit("<![CDATA["), F.lit("")), F.lit("]]>"), F.lit(""))
    untagged = F.regexp_replace(F.when(has_cdata, without).otherwise(text), r"<[^>]+>", "")
    return F.regexp_replace(untagged, r"^[ \t\r\n]+|[ \t\r\n]+$", "")


def _usable(texts: Column) -> Column:
    """Cleaned entries of an array of date texts, without empty ones and placeholders.

    Cleaning, testing and reading are passes of their own over the array, so
    that each step works on the result of the one before instead of redoing it.
    """
    return F.filter(F.transform(texts, _bare), lambda t: (t != "") & ~t.isin(PLACEHOLDER_DATES))


def clean_date_text(text: Column) -> Column:
    """Text without CDATA marks, tags and outer blanks; NULL when empty or a placeholder."""
    return F.get(_usable(F.array(text)), F.lit(0))


def _read(plain: Column) -> Column:
    full = F.regexp_replace(plain, _MINUTE_ZONE, "$1:00$2")
    parsed = F.when(plain.rlike(_ISO_SHAPE), full.try_cast("timestamp"))
    for shape, pattern in _SHAPES:
        parsed = parsed.when(plain.rlike(shape), F.try_to_timestamp(plain, F.lit(pattern)))
    return parsed


def first_date(texts: Column) -> Column:
    """First entry of an array of date texts that can be read as a date."""
    plain = F.transform(_usable(texts), lambda t: F.regexp_replace(t, _WEEKDAY, ""))
    read = F.transform(plain, _read)
    return F.get(F.filter(read, lambda d: d.isNotNull()), F.lit(0))


def parse_utc(text: Column) -> Column:
    """Timestamp of a date text; a text with an offset is moved to UTC, one without is UTC."""
    return first_date(F.array(text))


def moment(at: dt.datetime | dt.date | Column) -> Column:
    """A point in time as a column; without an offset it is UTC, whatever zone the machine is in."""
    return (at if isinstance(at, Column) else F.lit(at.isoformat())).cast("timestamp")


def min_date(as_of: dt.datetime | Column, months: int = 12) -> Column:
    """``as_of`` minus calendar months, time of day kept, clamped to the month's end."""
    return moment(as_of) - F.make_ym_interval(F.lit(0), F.lit(months))


def month_bucket(date: Column) -> Column:
    """First day of the date's month."""
    return F.trunc(date, "month")
