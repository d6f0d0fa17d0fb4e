"""Fetching: the frontier and a log of responses in, new content and page tables out."""

from __future__ import annotations

import datetime as dt
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from presslake.operators.merge import error_flag_update, raw_upsert
from presslake.operators.queues import PAGES_PER_DOMAIN, fetch_frontier
from presslake.operators.redirects import MAX_REDIRECTS, redirect_chain_resolve
from presslake.session import materialize


class Fetched(NamedTuple):
    """Next tables, and one row per page tried: ``id_page, domain, outcome, ok, content_size, ts``."""

    content: DataFrame
    pages: DataFrame
    outcomes: DataFrame


def one_answer_per_url(log: DataFrame) -> DataFrame:
    """The response that counts of each URL: a good one before a bad one, then the latest.

    Tries of one URL are told apart by status, location, time and a digest of the
    body; the body itself stays where it is.
    """
    good = F.coalesce(F.col("status") < 400, F.lit(False))
    tries = log.select("url", F.struct(good.alias("good"), "ts", "status", "location", F.xxhash64("body").alias("digest")).alias("a"))
    return tries.where("url is not null").groupBy("url").agg(F.max("a").alias("a")).select("url", "a.ts", "a.status", "a.location", "a.digest")


def fetch_apply(
    sitemaps: DataFrame, pages: DataFrame, content: DataFrame, log: DataFrame,
    as_of: dt.datetime | Column, cap: int = PAGES_PER_DOMAIN, max_hops: int = MAX_REDIRECTS,
) -> Fetched:
    """Apply the responses in ``log`` (``url, status, location, body, ts``) to the pages of the frontier.

    A URL may have been tried several times: a good response counts before a bad
    one, a later before an earlier. A page without any response is left for the
    next run. A failed one is stored without HTML and flagged, so it is not tried
    again. Chains are resolved on URLs alone; bodies are joined to the resolved
    pages at the end, once, and written.
    """
    answers = materialize(one_answer_per_url(log), "answers")
    frontier = materialize(fetch_frontier(sitemaps, pages, content, cap, ordered=False), "frontier")
    chains = redirect_chain_resolve(
        answers.select("url", "status", "location"), frontier.select(F.col("page_url").alias("url")), max_hops
    )
    tried = chains.where("not (outcome = 'missing' and hops = 0)").withColumnRenamed("url", "page_url")
    found = answers.select(F.col("url").alias("final_url"), "ts", "status", "digest")
    resolved = materialize(frontier.join(tried, "page_url").join(found, "final_url", "left"), "resolved")

    # Only a successful page takes a body; a response that the log repeats in full gives it once.
    good = resolved.where("outcome = 'ok'").select("id_page", "final_url", "ts", "status", "digest")
    bodies = log.select(
        F.col("url").alias("_url"), F.col("ts").alias("_ts"), F.col("status").alias("_status"), F.xxhash64("body").alias("_digest"), "body"
    )
    same = (F.col("final_url") == F.col("_url")) & (F.col("digest") == F.col("_digest"))
    same &= F.col("ts").eqNullSafe(F.col("_ts")) & F.col("status").eqNullSafe(F.col("_status"))
    taken = good.join(bodies, same).groupBy("id_page").agg(F.first("body").alias("body"))
    rows = materialize(resolved.drop("status", "digest").join(taken, "id_page", "left"), "fetched")
    ok = F.coalesce((F.col("outcome") == "ok") & (F.col("body") != ""), F.lit(False))

    delta = rows.select(
        "id_page", F.col("final_url").alias("page_url"), "publication_date", F.col("body").alias("page_raw_content")
    )
    outcomes = rows.select(
        "id_page", "domain", "outcome", ok.alias("ok"),
        F.when(ok, F.length("body")).otherwise(0).cast("bigint").alias("content_size"),
        F.when(F.col("outcome") == "ok", F.col("ts")).alias("ts"),
    )
    failed = rows.where("outcome <> 'ok'").select("id_page", F.lit(True).alias("is_error"))
    return Fetched(raw_upsert(content, delta, as_of), error_flag_update(pages, failed), outcomes)
