"""Sizes, durations, lengths and prices."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

PRICE_PER_MILLION_TOKENS = 0.02
BATCH_DISCOUNT = 0.5


def content_chars(text: Column) -> Column:
    return F.length(text)


def content_bytes(text: Column) -> Column:
    return F.octet_length(text)


def _hundredths(size: Column, shift: int) -> Column:
    """``size / 2^shift`` in whole hundredths, exact ties to the even digit."""
    scaled = size * F.lit(100).cast("bigint")
    whole = F.shiftright(scaled, shift)
    rest = scaled.bitwiseAND(F.lit((1 << shift) - 1).cast("bigint"))
    half = F.lit(1 << (shift - 1)).cast("bigint")
    up = (rest > half) | ((rest == half) & (whole % 2 == 1))
    return whole + up.cast("bigint")


def _two_digits(hundredths: Column, unit: str) -> Column:
    whole = F.floor(hundredths / 100).cast("bigint")
    return F.format_string(f"%d.%02d {unit}", whole, (hundredths % 100).cast("bigint"))


def format_size(size: Column) -> Column:
    """Bytes as ``B``, ``KB``, ``MB`` or ``GB`` with two decimals in steps of 1024."""
    size = size.cast("bigint")
    return (
        F.when(size < 1 << 10, F.concat(size.cast("string"), F.lit(" B")))
        .when(size < 1 << 20, _two_digits(_hundredths(size, 10), "KB"))
        .when(size < 1 << 30, _two_digits(_hundredths(size, 20), "MB"))
        .otherwise(_two_digits(_hundredths(size, 30), "GB"))
    )


def format_duration(seconds: Column) -> Column:
    """Seconds as ``s.ss seconds``, ``m min s sec`` or ``h hours m min s sec``."""
    seconds = seconds.cast("double")
    hours = F.floor(seconds / 3600).cast("bigint")
    minutes = F.floor((seconds % 3600) / 60).cast("bigint")
    rest = F.floor(seconds % 60).cast("bigint")
    return (
        F.when(seconds < 60, F.format_string("%.2f seconds", F.bround(seconds, 2)))
        .when(seconds < 3600, F.format_string("%d min %d sec", minutes, rest))
        .otherwise(F.format_string("%d hours %d min %d sec", hours, minutes, rest))
    )


def format_hms(seconds: Column, units: tuple[str, str, str] = ("ч", "м", "с")) -> Column:
    """Seconds as hours, minutes and seconds, all three always shown, fractions cut off."""
    seconds = seconds.cast("double")
    parts = [F.floor(seconds / 3600), F.floor((seconds % 3600) / 60), F.floor(seconds % 60)]
    return F.format_string("%d{} %d{} %d{}".format(*units), *[p.cast("bigint") for p in parts])


def token_cost(tokens: Column, price: float = PRICE_PER_MILLION_TOKENS, discount: float = 1.0) -> Column:
    """Price of a number of tokens; pass ``BATCH_DISCOUNT`` for batch jobs."""
    return tokens / F.lit(1_000_000) * F.lit(price) * F.lit(discount)


def ratio(part: Column, whole: Column, empty: float = 0.0) -> Column:
    """``part / whole``, or ``empty`` when there is nothing to divide by."""
    return F.coalesce(F.try_divide(part.cast("double"), whole.cast("double")), F.lit(empty))


def decimal_round(value: Column, digits: int) -> Column:
    """Round half up on the exact decimal value, then back to double."""
    return F.round(value.cast("decimal(38,12)"), digits).cast("double")


def normalise_fresh(is_master: Column, is_fresh: Column) -> Column:
    """A master sitemap always counts as fresh."""
    return F.when(is_master, F.lit(True)).otherwise(is_fresh)
