"""What is stored of a page, without reading the stored bodies where possible.

Two small columns stand in for the bodies: ``has_raw`` (HTML present) and
``text_chars`` (characters of the text, NULL without one). Tables written with
``write_content`` carry them, and a queue or report then never touches the body
columns. Tables without them are tested on the bodies themselves.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def raw_stored(content: DataFrame) -> Column:
    return F.col("has_raw") if "has_raw" in content.columns else F.col("page_raw_content").isNotNull()


def text_stored(content: DataFrame) -> Column:
    return F.col("text_chars").isNotNull() if "text_chars" in content.columns else F.col("content").isNotNull()


def text_not_empty(content: DataFrame) -> Column:
    if "text_chars" in content.columns:
        return F.coalesce(F.col("text_chars") > 0, F.lit(False))
    return F.coalesce(F.col("content") != "", F.lit(False))


def text_at_least(content: DataFrame, chars: int) -> Column:
    return (F.col("text_chars") if "text_chars" in content.columns else F.length("content")) >= chars


def with_stored_marks(content: DataFrame) -> DataFrame:
    """Adds the two columns to a table that holds the bodies."""
    return content.withColumns({
        "has_raw": F.col("page_raw_content").isNotNull(),
        "text_chars": F.length("content"),
    })
