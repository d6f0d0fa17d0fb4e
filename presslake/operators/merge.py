"""Keyed table maintenance: ``(stored table, delta, as_of) -> next table``.

A run usually changes little of a large table. When the keys of the delta are
small, by measure, they are broadcast: the stored rows pass by unshuffled, and
only those with a key in the delta are joined to it. For a large delta both
sides are shuffled by key once, or not at all on the stored side if that table
is bucketed by the key (``write_bucketed``). Measuring runs the delta, so one
that is costly to compute should be written first; the inserts do that.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from presslake.functions.dates import moment
from presslake.functions.measures import normalise_fresh
from presslake.functions.urls import url_netloc
from presslake.operators.key_filters import FilteredTable, absent_filtered
from presslake.operators.joins import MAX_BROADCAST_BYTES, small_keys
from presslake.operators.numbering import surrogate_keys
from presslake.schemas import NEWS_PAGES
from presslake.session import materialize


def delta_keys(delta: DataFrame, key: str) -> DataFrame | None:
    """The keys of a delta marked for broadcast, or None when they are too large for it, by measure.

    A key that repeats would give its stored row several times, so it is refused.
    """
    known = delta.where(F.col(key).isNotNull())
    each = known.groupBy(key).agg(F.count("*").alias("_n"))
    size = F.sum(F.octet_length(F.col(key).cast("string")) + 16)
    most, size = each.agg(F.max("_n"), size).first()
    if (most or 0) > 1:
        raise ValueError(f"the delta holds a {key} more than once")
    return F.broadcast(known.select(key)) if (size or 0) <= MAX_BROADCAST_BYTES else None


def _highest(table: DataFrame, key: str) -> Column:
    return table.agg(F.coalesce(F.max(key), F.lit(0)).cast("bigint")).scalar()


def _with_new_ids(stored: DataFrame, rows: DataFrame, surrogate: str, natural: str) -> DataFrame:
    """``rows`` numbered after the highest stored id."""
    numbered = surrogate_keys(rows, natural, "_n")
    return numbered.withColumn("_top", _highest(stored, surrogate)).withColumn(
        surrogate, F.col("_top") + F.col("_n")
    ).drop("_top", "_n")


def _changed(
    stored: DataFrame, delta: DataFrame, key: str, changes: dict[str, Column], keys: DataFrame | None
) -> DataFrame:
    """Stored rows with ``changes`` applied where the delta holds their key.

    Delta columns are visible as ``_d.<name>``; rows without a match stay as they
    are. ``keys`` are the delta's keys if small enough to broadcast.
    """
    matched = delta.select(F.col(key).alias("_k"), F.struct(*delta.columns).alias("_d"))
    columns = [(changes[c] if c in changes else F.col(c)).alias(c) for c in stored.columns]
    if keys is not None:
        touched = stored.join(keys, key, "left_semi")
        touched = touched.join(matched, F.col(key) == F.col("_k")).select(*columns)
        return stored.join(keys, key, "left_anti").select(*stored.columns).unionByName(touched)
    hit = F.col("_k").isNotNull()
    either = [F.when(hit, changes[c]).otherwise(F.col(c)).alias(c) if c in changes else F.col(c) for c in stored.columns]
    return stored.join(matched, F.col(key) == F.col("_k"), "left").select(*either)


def _absent(delta: DataFrame, stored: DataFrame, key: str, keys: DataFrame | None) -> DataFrame:
    """Delta rows whose key is not stored."""
    known = stored.select(key)
    if keys is not None:
        known = known.join(keys, key, "left_semi")
    return delta.join(known, key, "left_anti")


def _filled(rows: DataFrame, like: DataFrame) -> DataFrame:
    """``rows`` with the columns of ``like``; those it lacks are NULL."""
    return rows.select(*[
        (F.col(f.name) if f.name in rows.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in like.schema
    ])


def distinct_sitemaps(delta: DataFrame) -> DataFrame:
    """One row per sitemap URL: a master wins, then the smallest parent and latest date."""
    return delta.groupBy("sitemap_url").agg(
        F.max("is_master").alias("is_master"),
        F.min("parent_id").alias("parent_id"),
        F.max("last_mod").alias("last_mod"),
        F.max("is_fresh").alias("is_fresh"),
    )


def sitemap_insert_new(stored: DataFrame, delta: DataFrame, as_of: dt.datetime | Column) -> DataFrame:
    """Insert sitemaps with an unknown URL; a known one only turns fresh when seen as a master.

    ``delta``: ``sitemap_url, is_master, parent_id, last_mod, is_fresh``.
    """
    seen = materialize(distinct_sitemaps(delta))
    masters = seen.where("is_master").select("sitemap_url")
    kept = _changed(stored, masters, "sitemap_url", {"is_fresh": F.lit(True)}, small_keys(masters, "sitemap_url"))
    new = _absent(seen, stored, "sitemap_url", small_keys(seen, "sitemap_url")).withColumns({
        "domain": url_netloc(F.col("sitemap_url")),
        "is_fresh": normalise_fresh(F.col("is_master"), F.coalesce("is_fresh", F.lit(False))),
        "created_at": moment(as_of),
        "processed_at": moment(as_of),
    })
    return kept.unionByName(_filled(_with_new_ids(stored, new, "id_sitemap", "sitemap_url"), stored))


def distinct_pages(delta: DataFrame) -> DataFrame:
    """One row per page URL: the earliest date, then the smallest sitemap id."""
    first = F.min(F.struct(F.col("publication_date").isNull(), "publication_date", "id_sitemap"))
    return delta.groupBy("page_url").agg(first.alias("_f")).select("page_url", "_f.publication_date", "_f.id_sitemap")


def page_insert_new(stored: DataFrame, delta: DataFrame, as_of: dt.datetime | Column) -> DataFrame:
    """Insert pages with an unknown URL; known ones stay untouched.

    ``delta``: ``page_url, id_sitemap, publication_date``.
    """
    return stored.unionByName(new_pages(stored, delta, as_of))


def new_pages(stored: DataFrame, delta: DataFrame, as_of: dt.datetime | Column) -> DataFrame:
    """Only the rows ``page_insert_new`` adds."""
    seen = materialize(distinct_pages(delta))
    new = _absent(seen, stored, "page_url", small_keys(seen, "page_url"))
    return numbered_pages(new, _highest(stored, "id_page"), as_of)


def numbered_pages(new: DataFrame, top: Column, as_of: dt.datetime | Column) -> DataFrame:
    """Pages with distinct URLs as rows of the page table, numbered after ``top``."""
    numbered = surrogate_keys(new, "page_url", "_n").withColumn("_top", top)
    made = numbered.withColumns({
        "id_page": F.col("_top") + F.col("_n"), "is_error": F.lit(False), "created_at": moment(as_of),
    })
    kinds = [(f.name, f.dataType) for f in StructType.fromDDL(NEWS_PAGES)]
    return made.select(*[(F.col(n) if n in made.columns else F.lit(None)).cast(k).alias(n) for n, k in kinds])


def new_pages_filtered(stored: FilteredTable, delta: DataFrame, as_of: dt.datetime | Column) -> DataFrame:
    """``new_pages`` against a table with key filters: stored rows are read in buckets of possible hits only."""
    return numbered_pages(absent_filtered(materialize(distinct_pages(delta)), stored), stored.top(), as_of)


def page_insert_outcomes(stored: DataFrame, delta: DataFrame) -> DataFrame:
    """What became of each delta row: adds ``outcome`` = ``added`` or ``skipped``.

    Of several delta rows with one unknown URL, one is added and the rest are
    skipped: per URL ``(page_url, added, skipped)`` counts, plus the added date.
    """
    known = stored.select("page_url", F.lit(1).alias("_known"))
    counted = delta.groupBy("page_url").agg(F.count("*").alias("_seen"), F.min("publication_date").alias("publication_date"))
    added = F.when(F.col("_known").isNull(), 1).otherwise(0).cast("bigint")
    return counted.join(known, "page_url", "left").select(
        "page_url", added.alias("added"), (F.col("_seen") - added).alias("skipped"),
        F.when(added == 1, F.col("publication_date")).alias("publication_date"),
    )


def raw_upsert(stored: DataFrame, delta: DataFrame, as_of: dt.datetime | Column) -> DataFrame:
    """Store fetched HTML by page: URL, date, HTML and time are replaced, the text is kept.

    ``delta``: ``id_page, page_url, publication_date, page_raw_content``, ``id_page`` distinct.
    """
    keys = delta_keys(delta, "id_page")
    kept = _changed(stored, delta, "id_page", {
        "page_url": F.col("_d.page_url"),
        "publication_date": F.col("_d.publication_date"),
        "page_raw_content": F.col("_d.page_raw_content"),
        "fetched_at": moment(as_of),
    }, keys)
    new = _absent(delta, stored, "id_page", keys).withColumn("fetched_at", moment(as_of))
    return kept.unionByName(_filled(_with_new_ids(stored, new, "id", "id_page"), stored))


def content_update(stored: DataFrame, delta: DataFrame) -> DataFrame:
    """Set the text, and its length, of the pages in ``delta`` (``id_page, content``); no inserts."""
    return _changed(stored, delta, "id_page", {
        "content": F.col("_d.content"), "content_length": F.length("_d.content"),
    }, delta_keys(delta, "id_page"))


def error_flag_update(pages: DataFrame, delta: DataFrame) -> DataFrame:
    """Set the error flag of the pages in ``delta`` (``id_page, is_error``)."""
    return _changed(pages, delta, "id_page", {"is_error": F.col("_d.is_error")}, delta_keys(delta, "id_page"))


def freshness_update(sitemaps: DataFrame, delta: DataFrame, as_of: dt.datetime | Column) -> DataFrame:
    """Set freshness and processing time of the sitemaps in ``delta`` (``sitemap_url, is_fresh``)."""
    return _changed(sitemaps, delta, "sitemap_url", {
        "is_fresh": F.col("_d.is_fresh"), "processed_at": moment(as_of),
    }, delta_keys(delta, "sitemap_url"))


def embedding_upsert(stored: DataFrame, delta: DataFrame) -> DataFrame:
    """Insert or replace the vectors in ``delta`` (``id_page, embedding``), ``id_page`` distinct."""
    keys = delta_keys(delta, "id_page")
    kept = _changed(stored, delta, "id_page", {"embedding": F.col("_d.embedding")}, keys)
    new = _absent(delta, stored, "id_page", keys)
    return kept.unionByName(_filled(_with_new_ids(stored, new, "id", "id_page"), stored))
