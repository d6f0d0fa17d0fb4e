"""Joins among the crawl tables.

No side carries a broadcast hint: Spark broadcasts a side whose measured size is
under its threshold and shuffles otherwise. It also splits oversized partitions
when both sides come straight from a shuffle; where one side is a sum or a
distinct list it cannot, and ``spread_lookup`` does it beforehand for the keys
that a sketch of frequent items finds hot.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from presslake.functions.predicates import is_listing_sitemap
from presslake.operators.stored import raw_stored, text_not_empty
from presslake.session import materialize


MAX_BROADCAST_BYTES = 32 << 20


def key_bytes(df: DataFrame, key: str) -> int:
    """Size of a key column, with a little for each row.

    Measured, not estimated: estimates of joined or aggregated tables are mostly
    far too high, and a join re-planned at run time has by then shuffled the
    large side already.
    """
    return df.agg(F.sum(F.octet_length(F.col(key).cast("string")) + 16)).first()[0] or 0


def small_keys(df: DataFrame, key: str, max_bytes: int = MAX_BROADCAST_BYTES) -> DataFrame | None:
    """The keys of ``df`` marked for broadcast, or None when they are larger than ``max_bytes``."""
    return F.broadcast(df.select(key)) if key_bytes(df, key) <= max_bytes else None


def hot_keys(rows: DataFrame, key: str, share: int = 256) -> DataFrame:
    """The keys that hold more than one row in ``share``, as ``(key, _hot)``; at most twice ``share`` of them.

    A sketch of frequent items is kept by every task and merged, so no key is shuffled. With 64 counters for each key
    asked for it errs by less than a tenth of the share: every key over the share is found, none below half of it is named.
    """
    most = 2 * share
    items = rows.where(F.col(key).isNotNull()).agg(F.expr(f"approx_top_k(`{key}`, {most}, {32 * most})").alias("_top"), F.count("*").alias("_n"))
    named = items.select("_n", F.explode("_top").alias("_item")).where(F.col("_item.count") * most * 3 > F.col("_n") * 4)
    return named.select(F.col("_item.item").alias(key), F.lit(True).alias("_hot"))


def copied_entries(lookup: DataFrame, hot: DataFrame, key: str, ways: int) -> DataFrame:
    """The list with ``_way``: an entry of a hot key once for each of the ways, any other once."""
    copies = F.when(F.col("_hot"), F.sequence(F.lit(0), F.lit(ways - 1))).otherwise(F.array(F.lit(0)))
    return lookup.join(F.broadcast(hot), key, "left").withColumn("_way", F.explode(copies)).drop("_hot")


def spread_lookup(
    rows: DataFrame, lookup: DataFrame, key: str, spread: Column, ways: int = 256, max_bytes: int = MAX_BROADCAST_BYTES
) -> DataFrame:
    """Left join to a list with one short row per ``key``, however many rows share a key.

    A list within ``max_bytes`` is broadcast. Beyond that the rows of hot keys (``hot_keys``) are dealt into ``ways`` by
    the hash of ``spread``, and so are rows without a key, which would all meet in one task. Only hot entries of the
    list are there once for each of the ways. ``rows`` are read twice then.
    """
    if key_bytes(lookup, key) <= max_bytes:
        return rows.join(F.broadcast(lookup), key, "left")
    hot = materialize(hot_keys(rows, key, ways), "hot")  # at most 2 * ways short rows
    dealt = rows.join(F.broadcast(hot), key, "left").withColumn(
        "_way", F.when(F.col("_hot") | F.col(key).isNull(), F.pmod(F.xxhash64(spread), F.lit(ways)).cast("int")).otherwise(0)
    ).drop("_hot")
    return dealt.join(copied_entries(lookup, hot, key, ways), [key, "_way"], "left").drop("_way")


def sitemap_domains(sitemaps: DataFrame) -> DataFrame:
    return sitemaps.select("id_sitemap", "domain")


def pages_with_domain(pages: DataFrame, sitemaps: DataFrame) -> DataFrame:
    """Pages together with the domain of their sitemap."""
    return pages.join(sitemap_domains(sitemaps), "id_sitemap")


def pages_left_content(pages: DataFrame, content: DataFrame) -> DataFrame:
    """Pages whose raw content has not been stored yet.

    A content row without raw text counts as not stored; ``id_page`` is unique
    in the content table, so this is an anti join against the stored rows.
    """
    stored = content.where(raw_stored(content)).select("id_page")
    return pages.join(stored, "id_page", "left_anti")


def content_inner_chain(content: DataFrame, pages: DataFrame, sitemaps: DataFrame) -> DataFrame:
    """Content rows with ``domain`` and their page's URL, date and error flag."""
    page = pages.select(
        "id_page", "id_sitemap", "is_error",
        F.col("page_url").alias("found_url"), F.col("publication_date").alias("found_date"),
    )
    return content.join(page, "id_page").join(sitemap_domains(sitemaps), "id_sitemap")


def with_preferred_page_fields(chain: DataFrame) -> DataFrame:
    """URL and date of the content row where present, else those of the page."""
    return chain.withColumns({
        "page_url": F.coalesce("page_url", "found_url"),
        "publication_date": F.coalesce("publication_date", "found_date"),
    }).drop("found_url", "found_date")


def unembedded_anti(content: DataFrame, embeddings: DataFrame) -> DataFrame:
    """Content rows without an embedding."""
    return content.join(embeddings.select("id_page"), "id_page", "left_anti")


def pending_pages(registry: DataFrame) -> DataFrame:
    """Pages inside jobs that are still pending."""
    return registry.where("list_name = 'pending'").select(F.explode("page_ids").alias("id_page")).distinct()


def pending_anti(content: DataFrame, registry: DataFrame) -> DataFrame:
    """Content rows that are in no pending job."""
    return content.join(pending_pages(registry), "id_page", "left_anti")


def funnel_left_chain(sitemaps: DataFrame, pages: DataFrame, content: DataFrame, embeddings: DataFrame) -> DataFrame:
    """Every page with what is known of it at each later stage; one row per page."""
    fetched = content.select("id_page", F.lit(True).alias("is_fetched"), text_not_empty(content).alias("has_text"))
    embedded = embeddings.select("id_page", F.lit(True).alias("is_embedded"))
    return (
        pages.select("id_page", "id_sitemap", "publication_date")
        .join(fetched, "id_page", "left")
        .join(embedded, "id_page", "left")
        .join(sitemap_domains(sitemaps), "id_sitemap")
    )


def existing_key_lookup(delta: DataFrame, table: DataFrame, key: str, surrogate: str) -> DataFrame:
    """Adds the surrogate key already held by the natural key, or NULL."""
    return delta.join(table.select(key, surrogate), key, "left")


def known_domains(sitemaps: DataFrame) -> DataFrame:
    """``(domain, is_known)`` of every domain with a stored sitemap."""
    return sitemaps.select("domain").distinct().withColumn("is_known", F.lit(True))


def known_domain_semi(rows: DataFrame, sitemaps: DataFrame) -> DataFrame:
    """Adds ``is_new_domain``: no sitemap of that domain is stored."""
    spread = F.struct(*[F.col(c) for c in rows.columns])
    found = spread_lookup(rows, known_domains(sitemaps), "domain", spread)
    return found.withColumn("is_new_domain", F.col("is_known").isNull()).drop("is_known")


def sitemap_parent_child(sitemaps: DataFrame) -> DataFrame:
    """Each child sitemap next to its parent."""
    parent = sitemaps.select(F.col("id_sitemap").alias("parent_id"), F.col("sitemap_url").alias("parent_url"))
    return sitemaps.join(parent, "parent_id").select("id_sitemap", "sitemap_url", "parent_id", "parent_url")


def sitemap_url_exclude(df: DataFrame, url: str = "sitemap_url") -> DataFrame:
    """Without sitemaps of category and author listings."""
    return df.where(~is_listing_sitemap(F.col(url)))


def sitemap_stale_exclude(df: DataFrame, previous: DataFrame, url: str = "sitemap_url") -> DataFrame:
    """Without child sitemaps that an earlier run marked stale; unknown ones stay."""
    stale = previous.where(~F.col("is_master") & (F.col("is_fresh") == F.lit(False)))
    return df.join(stale.select(F.col("sitemap_url").alias(url)), url, "left_anti")
