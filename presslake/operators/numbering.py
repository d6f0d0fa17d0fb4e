"""Numbers for rows: surrogate keys, report line numbers, batch numbers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from presslake.session import materialize


def _running_start(sizes: DataFrame, part: str, size: str) -> DataFrame:
    """``(part, _start)``: rows before each part.

    One row per partition or bucket, a number fixed beforehand, so one task and a
    broadcast are safe.
    """
    before = Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    return F.broadcast(sizes.select(part, F.coalesce(F.sum(size).over(before), F.lit(0)).alias("_start")))


def report_row_number(df: DataFrame, order: list[Column], name: str = "row_no") -> DataFrame:
    """1-based number of every row in the given total order.

    Rows are sorted by range over all tasks and written once; a number is then
    the count of rows in earlier partitions plus the place within its own.
    """
    place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    placed = materialize(df.orderBy(*order).select("*", F.spark_partition_id().alias("_part"), place.alias("_place")))
    starts = _running_start(placed.groupBy("_part").agg(F.count("*").alias("_n")), "_part", "_n")
    numbered = placed.join(starts, "_part").withColumn(name, F.col("_start") + F.col("_place") + 1)
    return numbered.select(name, *df.columns)


def batch_assign(df: DataFrame, order: list[Column], size: int = 100) -> DataFrame:
    """Cut the rows, in the given total order, into batches of ``size``; adds ``batch_no`` from 0."""
    numbered = report_row_number(df, order, "_row")
    batch = F.floor((F.col("_row") - 1) / size).cast("bigint")
    return numbered.withColumn("batch_no", batch).drop("_row")


def surrogate_keys(df: DataFrame, key: str, name: str, after: Column | int = 0, buckets: int = 4096) -> DataFrame:
    """Dense ids ``after + 1 ...`` for rows with distinct ``key``.

    Keys are hashed into buckets, numbered inside each and shifted by the rows of
    the buckets before. The ids depend on the keys alone, so a task that runs
    again gives the same ones. Distinct keys hash evenly: no bucket gets large.
    """
    hashed = df.withColumn("_bucket", F.pmod(F.xxhash64(key), F.lit(buckets)))
    starts = _running_start(hashed.groupBy("_bucket").agg(F.count("*").alias("_n")), "_bucket", "_n")
    place = F.row_number().over(Window.partitionBy("_bucket").orderBy(key))
    first = after if isinstance(after, Column) else F.lit(after)
    return (
        hashed.withColumn("_place", place)
        .join(starts, "_bucket")
        .withColumn(name, (first + F.col("_start") + F.col("_place")).cast("bigint"))
        .select(name, *[c for c in df.columns if c != name])
    )
