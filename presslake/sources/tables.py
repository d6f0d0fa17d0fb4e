"""The four crawl tables: reading and writing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from presslake.operators.stored import with_stored_marks
from presslake.schemas import KEYS, TABLES


def crawl_tables_scan(spark: SparkSession, root: str, fmt: str = "parquet") -> dict[str, DataFrame]:
    """The tables under ``root``, one folder each, read with their declared schemas."""
    return {name: spark.read.schema(schema).format(fmt).load(f"{root}/{name}") for name, schema in TABLES.items()}


def crawl_tables_jdbc(
    spark: SparkSession, url: str, properties: dict[str, str], key_ranges: dict[str, tuple[int, int]], partitions: int
) -> dict[str, DataFrame]:
    """The tables in a database, each read in parallel over ranges of its surrogate key.

    ``key_ranges`` gives lowest and highest key per table; rows outside still
    arrive, in the first or last range.
    """
    return {
        name: spark.read.jdbc(
            url, name, column=KEYS[name][0], lowerBound=low, upperBound=high,
            numPartitions=partitions, properties=properties,
        )
        for name, (low, high) in key_ranges.items()
    }


def write_snapshot(df: DataFrame, path: str, by_month_of: str | None = None) -> None:
    """Write a table version to a new path; an existing path is an error.

    With ``by_month_of`` the files are split by the month of that date, so
    reports with a date floor skip old months. Rows of one month spread over as
    many tasks as hold them; nothing is gathered per month.
    """
    writer = df
    if by_month_of:
        writer = df.withColumn("month", F.trunc(by_month_of, "month"))
    out = writer.write.mode("errorifexists")
    (out.partitionBy("month") if by_month_of else out).parquet(path)


def write_bucketed(df: DataFrame, table: str, key: str, buckets: int) -> None:
    """Save as a table bucketed and sorted by its key, so joins on the key need no shuffle."""
    df.write.mode("errorifexists").bucketBy(buckets, key).sortBy(key).format("parquet").saveAsTable(table)


_BODIES = ["page_raw_content", "content"]


def write_content(content: DataFrame, path: str) -> None:
    """Write the content table as two folders: ``meta`` without bodies, ``body`` with them.

    Queues and reports read ``meta`` alone, a small part of the whole.
    """
    with_stored_marks(content).drop(*_BODIES).write.mode("errorifexists").parquet(f"{path}/meta")
    content.select("id_page", *_BODIES).write.mode("errorifexists").parquet(f"{path}/body")


def read_content(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """The ``meta`` and ``body`` halves written by ``write_content``."""
    return spark.read.parquet(f"{path}/meta"), spark.read.parquet(f"{path}/body")
