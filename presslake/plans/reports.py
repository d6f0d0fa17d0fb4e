"""Reports.

Counts are first summed per sitemap, where the rows already lie by page, and
only those sums meet the sitemap table. A sitemap with a third of all pages is
then one row per task, not a long shuffle partition.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from presslake.functions.dates import moment, month_bucket
from presslake.functions.measures import (
    BATCH_DISCOUNT, PRICE_PER_MILLION_TOKENS, decimal_round, ratio, token_cost,
)
from presslake.functions.predicates import REPORT_DATE_FLOOR, on_or_after
from presslake.operators.joins import known_domains, sitemap_domains, spread_lookup
from presslake.operators.stored import text_not_empty, text_stored
from presslake.session import materialize

# Names of the report's columns.
FUNNEL_COUNTS = ["total_pages", "pages_in_news_pages_content", "pages_with_non_empty_content", "pages_with_embeddings"]


def _total(name: str) -> Column:
    return F.coalesce(F.sum(name), F.lit(0)).cast("bigint").alias(name)


def monthly_stats(
    sitemaps: DataFrame, pages: DataFrame, content: DataFrame, date_floor: dt.datetime = REPORT_DATE_FLOOR
) -> DataFrame:
    """Texts per domain and month: count, total size in MB, mean size; by domain, newest month first."""
    texts = content.where(text_stored(content) & on_or_after(F.col("publication_date"), date_floor)).select(
        "id_page", month_bucket(F.col("publication_date")).alias("month"), "content_length"
    )
    by_sitemap = texts.join(pages.select("id_page", "id_sitemap"), "id_page").groupBy("id_sitemap", "month").agg(
        F.count("*").alias("_texts"), F.count("content_length").alias("_sized"), F.sum("content_length").alias("_size")
    )
    size, sized = F.sum("_size"), F.sum("_sized")
    return (
        by_sitemap.join(sitemap_domains(sitemaps), "id_sitemap")
        .groupBy("domain", "month")
        .agg(
            F.sum("_texts").alias("content_count"),
            decimal_round(size / F.lit(1024 * 1024), 4).alias("total_content_mb"),
            decimal_round(size / sized, 2).alias("avg_content_bytes"),
        )
        .orderBy(F.asc("domain"), F.desc("month"))
    )


def _sitemap_funnel(sitemaps: DataFrame, pages: DataFrame, content: DataFrame, embeddings: DataFrame) -> DataFrame:
    """Per sitemap: pages, stored, with text, embedded, and the embedded pages' date range.

    All three tables meet on ``id_page``; counting per page first keeps the
    embedding count a distinct one without another shuffle.
    """
    stored = content.select("id_page", F.lit(1).alias("_stored"), text_not_empty(content).cast("int").alias("_text"))
    embedded = embeddings.select("id_page", F.lit(1).alias("_embedded"))
    by_page = (
        pages.select("id_page", "id_sitemap", "publication_date")
        .join(stored, "id_page", "left")
        .join(embedded, "id_page", "left")
        .groupBy("id_page", "id_sitemap")
        .agg(
            F.count("*").alias("_rows"), F.sum("_stored").alias("_stored"), F.sum("_text").alias("_text"),
            F.max("_embedded").alias("_embedded"),
            F.min("publication_date").alias("_first"), F.max("publication_date").alias("_last"),
        )
    )
    has_vector = F.col("_embedded").isNotNull()
    by_sitemap = by_page.groupBy("id_sitemap").agg(
        F.sum("_rows").alias("total_pages"),
        F.sum("_stored").alias("pages_in_news_pages_content"),
        F.sum("_text").alias("pages_with_non_empty_content"),
        F.count("_embedded").alias("pages_with_embeddings"),
        F.min(F.when(has_vector, F.col("_first"))).alias("_first"),
        F.max(F.when(has_vector, F.col("_last"))).alias("_last"),
    )
    return by_sitemap.join(sitemap_domains(sitemaps), "id_sitemap")


def _funnel_measures() -> list[Column]:
    return [_total(name) for name in FUNNEL_COUNTS] + [
        F.min("_first").cast("date").alias("min_publication_date"),
        F.max("_last").cast("date").alias("max_publication_date"),
    ]


def _per_domain(funnel: DataFrame) -> DataFrame:
    return funnel.groupBy("domain").agg(*_funnel_measures()).orderBy("domain")


def domain_stats(sitemaps: DataFrame, pages: DataFrame, content: DataFrame, embeddings: DataFrame) -> DataFrame:
    """Per domain how many pages reached each stage; dates are those of embedded pages."""
    return _per_domain(_sitemap_funnel(sitemaps, pages, content, embeddings))


def summary_stats(sitemaps: DataFrame, pages: DataFrame, content: DataFrame, embeddings: DataFrame) -> DataFrame:
    """The measures of ``domain_stats`` over everything, one row."""
    return _sitemap_funnel(sitemaps, pages, content, embeddings).agg(*_funnel_measures())


def report(sitemaps: DataFrame, pages: DataFrame, content: DataFrame, embeddings: DataFrame) -> dict[str, DataFrame]:
    """The three standing reports; the join of the large tables is made once for the last two."""
    funnel = materialize(_sitemap_funnel(sitemaps, pages, content, embeddings))
    return {
        "monthly": monthly_stats(sitemaps, pages, content),
        "domains": _per_domain(funnel),
        "summary": funnel.agg(*_funnel_measures()),
    }


# Discovery -----------------------------------------------------------------

def label_page_outcome(found: DataFrame, sitemaps: DataFrame, min_date: Column | dt.datetime) -> DataFrame:
    """Adds ``outcome``: ``keep``, ``too_old`` or ``no_date``.

    ``found``: ``page_url, domain, publication_date``. Pages of a domain without a
    stored sitemap are kept whatever their date.
    """
    floor = moment(min_date)
    old = F.col("is_known").isNotNull() & (F.col("publication_date") < floor)
    outcome = F.when(F.col("publication_date").isNull(), "no_date").when(old, "too_old").otherwise("keep")
    judged = spread_lookup(found, known_domains(sitemaps), "domain", F.col("page_url"))
    return judged.withColumn("outcome", outcome).drop("is_known")


def sitemap_freshness(found: DataFrame, min_date: Column | dt.datetime) -> DataFrame:
    """A sitemap is fresh when one of its pages is dated ``min_date`` or later."""
    floor = moment(min_date)
    fresh = F.coalesce(F.bool_or(F.col("publication_date") >= floor), F.lit(False))
    return found.groupBy("sitemap_url").agg(fresh.alias("is_fresh"))


def sitemap_no_date_alert(found: DataFrame, ratio: float = 0.9, min_n: int = 10) -> DataFrame:
    """Sitemaps with more than ``min_n`` pages of which over ``ratio`` have no date."""
    counts = found.groupBy("sitemap_url").agg(
        F.count("*").alias("pages"), F.count_if(F.col("publication_date").isNull()).alias("no_date")
    )
    return counts.where((F.col("no_date") > F.col("pages") * ratio) & (F.col("pages") > min_n))


def discovery_stats(found: DataFrame) -> DataFrame:
    """Per domain: sitemaps, pages added, skipped and undated, date range of added pages.

    ``found``: ``domain, sitemap_url, outcome, publication_date``.
    """
    added = F.col("outcome") == "keep"
    # Sitemaps are counted over one row each, so a long sitemap costs nothing extra.
    by_sitemap = found.groupBy("domain", "sitemap_url").agg(
        F.count_if(added).alias("_added"),
        F.count_if(F.col("outcome").isin("too_old", "existing")).alias("_skipped"),
        F.count_if(F.col("outcome") == "no_date").alias("_undated"),
        F.min(F.when(added, F.col("publication_date"))).alias("_first"),
        F.max(F.when(added, F.col("publication_date"))).alias("_last"),
    )
    return by_sitemap.groupBy("domain").agg(
        F.count("*").alias("sitemaps_processed"),
        F.sum("_added").alias("pages_added"),
        F.sum("_skipped").alias("pages_skipped"),
        F.sum("_undated").alias("pages_no_date"),
        F.min("_first").alias("min_date"),
        F.max("_last").alias("max_date"),
    )


def discovery_totals(found: DataFrame) -> DataFrame:
    """Domains, sitemaps and added pages of a run, one row."""
    return discovery_stats(found).agg(
        F.count("*").alias("domains"),
        F.coalesce(F.sum("sitemaps_processed"), F.lit(0)).alias("sitemaps"),
        F.coalesce(F.sum("pages_added"), F.lit(0)).alias("pages"),
    )


# Fetching and extraction ---------------------------------------------------

def fetch_run_stats(log: DataFrame) -> DataFrame:
    """Totals of a fetch run from ``ok, content_size, ts``; rates are 0 where nothing ran."""
    ok = F.col("ok")
    seconds = (F.unix_micros(F.max("ts").cast("timestamp")) - F.unix_micros(F.min("ts").cast("timestamp"))) / F.lit(1e6)
    totals = log.agg(
        F.count("*").alias("processed"),
        F.count_if(ok).alias("successful"),
        F.count_if(~ok).alias("failed"),
        F.coalesce(F.sum(F.when(ok, F.col("content_size"))), F.lit(0)).alias("total_bytes"),
        seconds.alias("_seconds"),
    )
    return totals.select(
        "processed", "successful", "failed",
        F.round(ratio(F.col("successful"), F.col("processed")) * 100, 2).alias("success_rate"),
        "total_bytes",
        F.round(ratio(F.col("total_bytes"), F.col("successful")), 2).alias("avg_bytes"),
        F.round(ratio(F.col("processed"), F.col("_seconds")), 6).alias("pages_per_second"),
    )


def fetch_domain_stats(log: DataFrame) -> DataFrame:
    """Fetch results per domain, in order of domain."""
    ok = F.col("ok")
    totals = log.groupBy("domain").agg(
        F.count_if(ok).alias("successful"),
        F.count_if(~ok).alias("failed"),
        F.coalesce(F.sum(F.when(ok, F.col("content_size"))), F.lit(0)).alias("total_bytes"),
    )
    rate = F.round(ratio(F.col("successful"), F.col("successful") + F.col("failed")) * 100, 2)
    return totals.select("domain", "successful", "failed", rate.alias("success_rate"), "total_bytes").orderBy("domain")


def extract_parser_stats(outcomes: DataFrame) -> DataFrame:
    """Extraction results per extractor from ``parser, ok``."""
    totals = outcomes.groupBy("parser").agg(
        F.count_if("ok").alias("successful"), F.count_if(~F.col("ok")).alias("failed"), F.count_if("ok").alias("parsed")
    )
    rate = F.round(ratio(F.col("successful"), F.col("successful") + F.col("failed")) * 100, 2)
    return totals.withColumn("success_rate", rate)


# Embedding -----------------------------------------------------------------

def embed_run_stats(
    outcomes: DataFrame, seconds: float = 1.0, price: float = PRICE_PER_MILLION_TOKENS, discount: float = 1.0
) -> DataFrame:
    """Totals of an embedding run from ``outcome, tokens, chars``.

    Tokens and characters count everything sent, failed texts included, while
    the mean divides by the successful texts only. ``truncated`` counts cut texts
    where the outcomes say so.
    """
    sent = F.col("outcome") != "skipped"
    cut = F.count_if("truncated") if "truncated" in outcomes.columns else F.lit(0).cast("bigint")
    totals = outcomes.agg(
        F.count("*").alias("total_texts"),
        F.count_if(F.col("outcome") == "ok").alias("successful"),
        F.count_if(F.col("outcome") == "failed").alias("failed"),
        F.count_if(F.col("outcome") == "skipped").alias("skipped"),
        cut.alias("truncated"),
        F.coalesce(F.sum(F.when(sent, F.col("tokens"))), F.lit(0)).alias("tokens_sent"),
        F.coalesce(F.sum(F.when(sent, F.col("chars"))), F.lit(0)).alias("chars_sent"),
    )
    return totals.withColumns({
        "avg_tokens_per_text": F.round(ratio(F.col("tokens_sent"), F.col("successful")), 4),
        "avg_chars_per_token": F.round(ratio(F.col("chars_sent"), F.col("tokens_sent")), 4),
        "cost": F.round(token_cost(F.col("tokens_sent"), price, discount), 6),
        "texts_per_second": F.round(F.col("successful") / F.greatest(F.lit(float(seconds)), F.lit(1.0)), 4),
    })


def embed_domain_stats(
    outcomes: DataFrame, price: float = PRICE_PER_MILLION_TOKENS, discount: float = 1.0
) -> DataFrame:
    """Embedding results per domain; tokens, characters and cost are those of successful texts."""
    ok = F.col("outcome") == "ok"
    totals = outcomes.groupBy("domain").agg(
        F.count_if(ok).alias("successful"),
        F.count_if(F.col("outcome") == "failed").alias("failed"),
        F.count_if(F.col("outcome") == "skipped").alias("skipped"),
        F.count("*").alias("total"),
        F.coalesce(F.sum(F.when(ok, F.col("tokens"))), F.lit(0)).alias("tokens"),
        F.coalesce(F.sum(F.when(ok, F.col("chars"))), F.lit(0)).alias("chars"),
    )
    return totals.withColumn("cost", F.round(token_cost(F.col("tokens"), price, discount), 6)).orderBy("domain")


def embed_batch_domain_stats(outcomes: DataFrame, price: float = PRICE_PER_MILLION_TOKENS) -> DataFrame:
    """``embed_domain_stats`` at the price of batch jobs."""
    return embed_domain_stats(outcomes, price, BATCH_DISCOUNT)


def label_empty_text(df: DataFrame) -> DataFrame:
    """Adds ``outcome``: ``skipped`` for an empty text, else ``queued``."""
    return df.withColumn("outcome", F.when(F.coalesce("content", F.lit("")) == "", "skipped").otherwise("queued"))
