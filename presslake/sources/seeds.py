"""Seed lists."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from presslake.functions.urls import url_origin


def seed_scan(spark: SparkSession, path: str) -> DataFrame:
    """One URL per line; outer blanks removed, blank lines dropped."""
    url = F.regexp_replace("value", r"^\s+|\s+$", "")
    return spark.read.text(path).select(url.alias("url")).where("url <> ''")


def seed_origins(urls: DataFrame) -> DataFrame:
    """Distinct ``scheme://host`` of the ``url`` column."""
    return urls.select(url_origin(F.col("url")).alias("origin")).where("origin is not null").distinct()
