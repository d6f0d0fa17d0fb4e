"""Work queues: which pages to fetch, extract and embed next."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from presslake.functions.predicates import MIN_CONTENT_LENGTH, not_an_error
from presslake.operators.joins import (
    content_inner_chain, pages_left_content, pages_with_domain, pending_anti, unembedded_anti,
    with_preferred_page_fields,
)
from presslake.operators.stored import raw_stored, text_at_least, text_stored
from presslake.session import materialize

PAGES_PER_DOMAIN = 5000
EMBED_LIMIT = 1000
#: Rows that the last task of a sort with a limit may get: the limit for each task before it.
ROWS_IN_ONE_TASK = 1_000_000


def newest_first() -> list[Column]:
    """Unknown dates come first; the key settles ties."""
    return [F.desc_nulls_first("publication_date"), F.asc("id_page")]


def top_per_group(df: DataFrame, group: str, order: list[Column], cap: int, spread: Column, ways: int = 256) -> DataFrame:
    """The first ``cap`` rows of every group.

    A group is first cut to ``cap`` rows in each of ``ways`` slices, then as a
    whole, so the last step sees at most ``ways * cap`` rows of it however large
    the group is. The slices are exact: a row among the first of its group is
    among the first of its slice. Both limits work before the shuffle; Spark does
    that up to a threshold, which is raised to ``cap`` here.
    """
    threshold = "spark.sql.optimizer.windowGroupLimitThreshold"
    if int(df.sparkSession.conf.get(threshold)) < cap:
        df.sparkSession.conf.set(threshold, str(cap))
    slice_ = F.pmod(F.xxhash64(spread), F.lit(ways))
    cut = df.withColumn("_slice", slice_)
    in_slice = F.row_number().over(Window.partitionBy(group, "_slice").orderBy(*order))
    in_group = F.row_number().over(Window.partitionBy(group).orderBy(*order))
    cut = cut.withColumn("_rank", in_slice).where(F.col("_rank") <= cap).drop("_slice", "_rank")
    return cut.withColumn("_rank", in_group).where(F.col("_rank") <= cap).drop("_rank")


def _reached(rows: DataFrame, value: Column, wanted: int, bins: int = 4096) -> tuple[int, int]:
    """The ``wanted``-th smallest ``value`` (whole numbers) and how many rows lie below it.

    A histogram over what is left, then one over the bin that holds it, until the bin has a single value. The driver
    sees one row for each bin.
    """
    left, below = rows.select(value.alias("_v")), 0
    low, high = left.agg(F.min("_v"), F.max("_v")).first()
    while low < high:
        width = -(-(high - low + 1) // bins)
        bin_ = F.expr(f"(_v - {low}L) div {width}L")
        counted = left.where(F.col("_v").between(low, high)).groupBy(bin_.alias("_b")).agg(
            F.count("*").alias("n"), F.min("_v").alias("low"), F.max("_v").alias("high")
        ).orderBy("_b").collect()
        for found in counted:
            if below + found.n >= wanted:
                break
            below += found.n
        low, high = found.low, found.high
    return low, below


def newest(rows: DataFrame, limit: int) -> DataFrame:
    """The first ``limit`` rows by ``newest_first``, for any limit; ``id_page`` is distinct.

    Sorting with a limit brings ``limit`` rows of every task into one. Here the date of the last row is found by
    histograms, then the last key of that date, and all tasks filter by them.
    """
    known = materialize(rows, "candidates")
    if limit <= 0 or known.count() <= limit:
        return known if limit > 0 else known.where(F.lit(False))
    # Unknown dates first, then falling: half the range of a long is more than any timestamp takes.
    falling = F.coalesce(-F.unix_micros("publication_date"), F.lit(-(1 << 61)))
    last, above = _reached(known, falling, limit)
    key, _ = _reached(known.where(falling == last), F.col("id_page"), limit - above)
    return known.where((falling < last) | ((falling == last) & (F.col("id_page") <= key)))


def fetch_frontier(
    sitemaps: DataFrame, pages: DataFrame, content: DataFrame, cap: int = PAGES_PER_DOMAIN, ordered: bool = True
) -> DataFrame:
    """Pages to fetch: not stored, not failed, at most the ``cap`` newest of a domain, newest first if ``ordered``."""
    open_pages = pages_left_content(
        pages.where(not_an_error(F.col("is_error"))).select("id_page", "id_sitemap", "page_url", "publication_date"),
        content,
    )
    ranked = top_per_group(pages_with_domain(open_pages, sitemaps), "domain", newest_first(), cap, F.col("id_page"))
    queue = ranked.select("id_page", "page_url", "domain", "publication_date")
    return queue.orderBy(*newest_first()) if ordered else queue


def extract_queue(sitemaps: DataFrame, pages: DataFrame, content: DataFrame) -> DataFrame:
    """Pages with stored HTML and no text yet; the HTML itself stays behind."""
    waiting = content.where(raw_stored(content) & ~text_stored(content))
    chain = content_inner_chain(
        waiting.select("id_page", "page_url", "publication_date"),
        pages.where(not_an_error(F.col("is_error"))),
        sitemaps,
    )
    queue = with_preferred_page_fields(chain).select("id_page", "page_url", "domain", "publication_date")
    return queue.orderBy(*newest_first())


def embed_candidates(
    sitemaps: DataFrame, pages: DataFrame, content: DataFrame, embeddings: DataFrame,
    registry: DataFrame | None = None, min_len: int = MIN_CONTENT_LENGTH,
) -> DataFrame:
    """``(id_page, domain, publication_date)`` of texts without embedding and in no pending job."""
    texts = content.where(text_at_least(content, min_len)).select("id_page", "publication_date")
    waiting = unembedded_anti(texts, embeddings)
    if registry is not None:
        waiting = pending_anti(waiting, registry)
    return pages_with_domain(
        waiting.join(pages.select("id_page", "id_sitemap"), "id_page"), sitemaps
    ).select("id_page", "domain", "publication_date")


def embed_queue(
    sitemaps: DataFrame, pages: DataFrame, content: DataFrame, embeddings: DataFrame,
    registry: DataFrame | None = None, min_len: int = MIN_CONTENT_LENGTH, limit: int = EMBED_LIMIT,
    bodies: DataFrame | None = None,
) -> DataFrame:
    """The newest ``limit`` texts to embed: ``(id_page, content, domain, publication_date)``.

    The choice is made on keys and dates; texts are joined to the chosen rows
    afterwards, from ``bodies`` when the content table is stored in two parts.
    Where the best rows of all tasks would be too many for one, they are selected
    by histograms (``newest``).
    """
    chosen = embed_candidates(sitemaps, pages, content, embeddings, registry, min_len)
    tasks = int(chosen.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    if limit * tasks > ROWS_IN_ONE_TASK:
        chosen = newest(chosen, limit)
    else:
        chosen = chosen.orderBy(*newest_first()).limit(limit)
    texts = (content if bodies is None else bodies).select("id_page", "content")
    return texts.join(chosen, "id_page").select("id_page", "content", "domain", "publication_date")
