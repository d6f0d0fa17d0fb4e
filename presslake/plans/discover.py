"""Discovery: sitemap bodies in, new sitemap and page tables out."""

from __future__ import annotations

import datetime as dt
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from presslake.functions.dates import min_date, parse_utc
from presslake.functions.urls import url_netloc
from presslake.operators.joins import known_domain_semi, sitemap_stale_exclude, sitemap_url_exclude, small_keys
from presslake.operators.merge import freshness_update, page_insert_new, sitemap_insert_new
from presslake.plans.reports import label_page_outcome, sitemap_freshness
from presslake.session import materialize
from presslake.sources.sitemaps import publication_date_pick, sitemap_index_scan, urlset_scan


class Discovery(NamedTuple):
    """Next tables, and one row per page seen: ``domain, sitemap_url, page_url, publication_date, outcome``."""

    sitemaps: DataFrame
    pages: DataFrame
    outcomes: DataFrame


def child_sitemaps(seeds: DataFrame, bodies: DataFrame, stored: DataFrame) -> DataFrame:
    """Children of the seed indexes worth reading: ``(sitemap_url, parent_url, last_mod)``.

    Left out are listings and those an earlier run found stale.
    """
    wanted = seeds.select(F.col("url").alias("sitemap_url"))
    keys = small_keys(wanted, "sitemap_url")
    masters = bodies.join(wanted if keys is None else keys, "sitemap_url", "left_semi")
    children = sitemap_index_scan(masters).select(
        F.col("child_url").alias("sitemap_url"), F.col("sitemap_url").alias("parent_url"),
        parse_utc(F.col("lastmod_text")).alias("last_mod"),
    )
    # A child listed by several indexes belongs to one of them.
    single = children.groupBy("sitemap_url").agg(F.min("parent_url").alias("parent_url"), F.max("last_mod").alias("last_mod"))
    return sitemap_stale_exclude(sitemap_url_exclude(single), stored)


def _with_parents(sitemaps: DataFrame, children: DataFrame) -> DataFrame:
    """Fill ``parent_id`` of children that have none yet."""
    ids = sitemaps.select(F.col("sitemap_url").alias("parent_url"), F.col("id_sitemap").alias("_parent"))
    known = children.select("sitemap_url", "parent_url").join(ids, "parent_url").select("sitemap_url", "_parent")
    filled = F.when(F.col("is_master"), F.col("parent_id")).otherwise(F.coalesce("parent_id", "_parent"))
    return sitemaps.join(known, "sitemap_url", "left").withColumn("parent_id", filled).select(*sitemaps.columns)


def _with_repeats(labelled: DataFrame, pages: DataFrame, keys: DataFrame | None) -> DataFrame:
    """Turns ``keep`` into ``existing`` for stored pages and for all but one row of a new page."""
    stored = pages.select("page_url")
    if keys is not None:
        stored = stored.join(keys, "page_url", "left_semi")
    new = labelled.where("outcome = 'keep'").join(stored, "page_url", "left_anti")
    # The earliest date is the one stored. Joining back by row keeps an often listed page spread out.
    chosen = new.groupBy("page_url").agg(F.min(F.struct("publication_date", "row_id")).alias("_c"))
    chosen = chosen.select(F.col("_c.row_id").alias("row_id"), F.lit(True).alias("_chosen"))
    repeat = (F.col("outcome") == "keep") & F.col("_chosen").isNull()
    return labelled.join(chosen, "row_id", "left").withColumn(
        "outcome", F.when(repeat, "existing").otherwise(F.col("outcome"))
    )


def discover(
    seeds: DataFrame, bodies: DataFrame, sitemaps: DataFrame, pages: DataFrame,
    as_of: dt.datetime | Column, months: int = 12,
) -> Discovery:
    """One discovery run.

    ``seeds``: ``url`` of the master sitemaps; ``bodies``: ``sitemap_url, body`` of
    masters and children. Whether a domain is new is judged by the stored table
    as it was before the run: a new domain's sitemaps are all fresh and its pages
    have no date floor. Pages of stale sitemaps are not read.

    The sitemap XML is parsed where it lies and only what came out of it is
    joined; it is written before it is used several times.
    """
    floor = min_date(as_of, months)
    children = materialize(child_sitemaps(seeds, bodies, sitemaps))
    wanted = children.select("sitemap_url")
    found = materialize(
        publication_date_pick(urlset_scan(bodies)).join(wanted, "sitemap_url", "left_semi").withColumns({
            "domain": url_netloc(F.col("sitemap_url")), "row_id": F.monotonically_increasing_id(),
        })
    )

    # Freshness of every child whose body came, pages or not.
    arrived = wanted.join(bodies.select("sitemap_url"), "sitemap_url", "left_semi").withColumn("domain", url_netloc(F.col("sitemap_url")))
    dated = sitemap_freshness(found, floor)
    judged = materialize(known_domain_semi(arrived, sitemaps).join(dated, "sitemap_url", "left").select(
        "sitemap_url", (F.col("is_new_domain") | F.coalesce("is_fresh", F.lit(False))).alias("is_fresh")
    ), "judged")

    masters = seeds.select(F.col("url").alias("sitemap_url")).withColumns({
        "is_master": F.lit(True), "parent_id": F.lit(None).cast("bigint"), "last_mod": F.lit(None).cast("timestamp"),
        "is_fresh": F.lit(True),
    })
    listed = children.select("sitemap_url", "last_mod").withColumns({
        "is_master": F.lit(False), "parent_id": F.lit(None).cast("bigint"), "is_fresh": F.lit(False),
    })
    merged = materialize(sitemap_insert_new(sitemaps, masters.unionByName(listed), as_of))
    next_sitemaps = materialize(freshness_update(_with_parents(merged, children), judged, as_of))

    fresh = judged.where("is_fresh").select("sitemap_url")
    labelled = materialize(label_page_outcome(found.join(fresh, "sitemap_url", "left_semi"), sitemaps, floor), "labelled")
    outcomes = _with_repeats(labelled, pages, small_keys(found, "page_url"))

    ids = next_sitemaps.select("sitemap_url", "id_sitemap")
    delta = labelled.where("outcome = 'keep'").join(ids, "sitemap_url").select("page_url", "id_sitemap", "publication_date")
    return Discovery(
        next_sitemaps, page_insert_new(pages, delta, as_of),
        outcomes.select("domain", "sitemap_url", "page_url", "publication_date", "outcome"),
    )
