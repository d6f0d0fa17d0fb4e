"""Dated snapshots of keyed payloads, e.g. one cookie list per domain and day."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _dated(df: DataFrame, date_text: str, fmt: str) -> DataFrame:
    day = F.try_to_timestamp(F.col(date_text), F.lit(fmt)).cast("date")
    return df.withColumn("_day", day).where("_day is not null")


def latest_snapshot_per_key(
    df: DataFrame, key: str, date_text: str, payload: str, row_id: str, fmt: str = "dd-MM-yyyy"
) -> DataFrame:
    """Newest payload of each key; rows whose date cannot be read are left out.

    Among rows of the same day the largest ``row_id`` counts as newest.
    """
    newest = F.max_by(F.struct("_day", row_id, payload), F.struct("_day", row_id))
    return (
        _dated(df, date_text, fmt)
        .groupBy(key)
        .agg(newest.alias("_n"))
        .select(key, F.col("_n._day").alias("day"), F.col(f"_n.{row_id}"), F.col(f"_n.{payload}"))
    )


def superseded_snapshots(
    df: DataFrame, key: str, date_text: str, row_id: str, fmt: str = "dd-MM-yyyy"
) -> DataFrame:
    """Every dated row that is not the newest of its key."""
    newest = latest_snapshot_per_key(df.select(key, date_text, row_id, F.lit(None).alias("_p")),
                                     key, date_text, "_p", row_id, fmt)
    # The row id is part of the join, so a key with many rows stays spread out.
    return _dated(df, date_text, fmt).drop("_day").join(newest.select(key, row_id), [key, row_id], "left_anti")


def snapshots_of_day(df: DataFrame, date_text: str, day: str, fmt: str = "dd-MM-yyyy") -> DataFrame:
    """Rows dated exactly ``day``, an ISO date."""
    return _dated(df, date_text, fmt).where(F.col("_day") == F.lit(day).cast("date")).drop("_day")


def pairs_to_map(pairs: Column) -> Column:
    """Array of ``{name, value}`` as a map; a repeated name keeps its last value.

    Needs ``spark.sql.mapKeyDedupPolicy=LAST_WIN`` (``configure``).
    """
    named = F.filter(pairs, lambda p: p["name"].isNotNull())
    return F.map_from_entries(F.transform(named, lambda p: F.struct(p["name"], p["value"])))
