"""Redirect chains in a crawl log ``(url, status, location)`` with one row per URL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from presslake.functions.urls import resolve_location, same_site
from presslake.session import materialize

MAX_REDIRECTS = 5

# Statuses that make a response with a Location a redirect.
REDIRECT_STATUSES = [301, 302, 303, 307, 308]


def is_redirect(status: Column, location: Column) -> Column:
    return status.isin(REDIRECT_STATUSES) & location.isNotNull()


def redirect_target_allowed(url: Column, target: Column) -> Column:
    """A redirect may be followed only to the same host, ``www.`` aside."""
    return same_site(url, target)


def redirect_chain_resolve(log: DataFrame, starts: DataFrame | None = None, max_hops: int = MAX_REDIRECTS) -> DataFrame:
    """Where each start URL ends: ``(url, final_url, hops, outcome)``.

    ``starts`` (column ``url``, distinct) defaults to all URLs of the log. Outcomes:
    ``ok``, ``cross_domain`` (blocked before the hop), ``too_many_redirects``,
    ``missing`` (the log has no such URL), ``http_error``.

    Hops that may be followed are a table of pointers, written once. Joined with itself
    it gives two hops at once, that one four, and so on, so a start takes its whole
    way in joins that grow with the logarithm of ``max_hops``, all of one plan.
    """
    redirected = is_redirect(F.col("status"), F.col("location"))
    answers = log.select(
        F.col("url").alias("_url"), F.col("status").alias("_status"),
        F.when(redirected, resolve_location(F.col("url"), F.col("location"))).alias("_target"),
    )
    # Allowed hops stay on one site, so what the last page allows the first one does too.
    allowed = F.col("_target").isNotNull() & redirect_target_allowed(F.col("_url"), F.col("_target"))
    pointers = materialize(answers.where(allowed).select(F.col("_url").alias("_at"), F.col("_target").alias("_to")), "pointers")
    ways = [] if max_hops < 1 or pointers.isEmpty() else [pointers]
    while ways and 2 ** len(ways) <= max_hops:
        then = ways[-1].select(F.col("_at").alias("_via"), F.col("_to").alias("_end"))
        ways.append(ways[-1].join(then, F.col("_to") == F.col("_via")).select("_at", F.col("_end").alias("_to")))
    state = (log if starts is None else starts).select("url", F.col("url").alias("final_url"), F.lit(0).alias("hops"))
    for power in reversed(range(len(ways))):
        fits = (F.col("final_url") == F.col("_at")) & (F.col("hops") + 2**power <= max_hops)
        hops = F.col("hops") + F.when(F.col("_to").isNotNull(), 2**power).otherwise(0)
        state = state.join(ways[power], fits, "left").select("url", F.coalesce("_to", "final_url").alias("final_url"), hops.alias("hops"))
    outcome = (
        F.when(F.col("_status").isNull(), "missing")
        .when(F.col("_target").isNotNull() & (F.col("hops") >= max_hops), "too_many_redirects")
        .when(F.col("_target").isNotNull(), "cross_domain")
        .when(F.col("_status") >= 400, "http_error")
        .otherwise("ok")
    )
    return state.join(answers, F.col("final_url") == F.col("_url"), "left").select("url", "final_url", "hops", outcome.alias("outcome"))
