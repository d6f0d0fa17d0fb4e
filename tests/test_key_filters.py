"""Stored key filters: no key is missed, few others are let through, few stored rows are read."""

import datetime as dt

import numpy as np
from conftest import plan, rows
from pyspark.sql import functions as F

from presslake.operators import merge
from presslake.operators.key_filters import (
    FilteredTable, absent_filtered, existing_key_lookup_filtered, key_filters, maybe_there, merged_filters, partial_filter, with_maybe,
)
from presslake.schemas import NEWS_PAGES

AS_OF = dt.datetime(2025, 2, 1)


def pages(spark, first, n):
    return spark.range(first, first + n).select(
        F.col("id").alias("id_page"), F.lit(1).cast("bigint").alias("id_sitemap"), F.concat(F.lit("https://a/"), "id").alias("page_url"),
        F.lit(None).cast("timestamp").alias("publication_date"), F.lit(False).alias("is_error"), F.lit(None).cast("timestamp").alias("created_at"),
    )


def test_a_filter_misses_nothing_and_lets_little_through():
    dice = np.random.default_rng(5)
    there, other = (dice.integers(-(2**63), 2**63 - 1, 20_000) for _ in range(2))
    words = partial_filter(there, 20_000 * 16 // 256)
    assert maybe_there(there, words).all() and maybe_there(other, words).mean() < 0.01
    half = [partial_filter(there[i::2], 20_000 * 16 // 256) for i in range(2)]
    assert (half[0] | half[1] == words).all()


def test_parts_of_filters_add_up(spark):
    every = pages(spark, 0, 3000)
    whole = rows(key_filters(every, "page_url", 8, 500), "*")
    parts = [key_filters(every.where(F.col("id_page") % 3 == i), "page_url", 8, 500) for i in range(3)]
    assert rows(merged_filters(*parts), "*") == whole and sum(r[1] for r in whole) == 3000
    asked = pages(spark, 2000, 3000).unionByName(pages(spark, 0, 1).withColumn("page_url", F.lit(None).cast("string")))
    maybe = {r.id_page: r._maybe for r in with_maybe(asked, "page_url", merged_filters(*parts), 8).collect()}
    assert all(maybe[i] for i in range(2000, 3000)) and sum(maybe.values()) < 1100 and maybe[0] is False


def test_inserts_read_few_stored_rows(spark, tmp_path):
    stored = FilteredTable(spark, str(tmp_path / "t"), "page_url", "id_page", 512, 200)
    assert stored.version() is None
    for i in range(3):  # three versions
        assert stored.append(pages(spark, 5000 * i, 5000)) == i
    delta = pages(spark, 14_990, 2000).select("page_url", "id_sitemap", "publication_date")  # ten are known
    delta = delta.unionByName(delta.limit(50))
    asked, near = stored.stored_hits(merge.distinct_pages(delta))
    assert asked.count() == 2000 and 10 <= near.count() < 0.1 * 15_000
    assert "PartitionFilters: [isnotnull(version" in plan(near) or "bucket" in plan(near).split("PartitionFilters:")[1][:200]
    added = merge.new_pages_filtered(stored, delta, AS_OF)
    assert rows(added, "*") == rows(merge.new_pages(stored.rows().drop("version", "bucket").select(*NEWS_PAGES_NAMES), delta, AS_OF), "*")
    stored.append(added)
    assert merge.new_pages_filtered(stored, delta, AS_OF).count() == 0 and stored.rows().count() == 15_000 + 1990
    assert rows(stored.rows().agg(F.max("id_page"), F.count_distinct("page_url")), "*") == [(14_999 + 1990, 16_990)]


NEWS_PAGES_NAMES = [c.split()[0] for c in NEWS_PAGES.split(", ")]


def test_a_version_without_filters_does_not_count(spark, tmp_path):
    stored = FilteredTable(spark, str(tmp_path / "t"), "page_url", "id_page", 8, 100)
    stored.append(pages(spark, 0, 10))
    pages(spark, 10, 5).withColumn("bucket", F.lit(0)).write.partitionBy("bucket").parquet(str(tmp_path / "t/rows/version=1"))  # broke off
    assert stored.version() == 0 and stored.rows().count() == 10
    assert absent_filtered(pages(spark, 8, 4), stored).count() == 2
    assert stored.append(pages(spark, 10, 2)) == 1 and stored.rows().count() == 12
    known = existing_key_lookup_filtered(pages(spark, 11, 2).select("page_url"), stored)
    assert rows(known, "page_url", "id_page") == [("https://a/11", 11), ("https://a/12", None)]
    assert existing_key_lookup_filtered(pages(spark, 900, 3).select("page_url"), stored).where("id_page is null").count() == 3
    assert absent_filtered(pages(spark, 0, 0), stored).count() == 0
