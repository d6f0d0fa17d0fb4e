"""Embedding: directly, or through batch jobs that finish later."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence
from typing import NamedTuple

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from presslake.functions.dates import moment
from presslake.functions.measures import BATCH_DISCOUNT, PRICE_PER_MILLION_TOKENS, token_cost
from presslake.functions.predicates import MIN_CONTENT_LENGTH
from presslake.functions.tokens import MAX_TOKENS
from presslake.operators import batches
from presslake.operators.audit import EMBEDDING_DIM
from presslake.operators.merge import embedding_upsert
from presslake.operators.numbering import batch_assign
from presslake.operators.queues import EMBED_LIMIT, embed_queue, newest_first
from presslake.operators.text import token_truncate
from presslake.operators.vectors import embed_texts
from presslake.session import materialize

BATCH_SIZE = 100


class Embedded(NamedTuple):
    """Next embeddings table, and per text ``id_page, domain, outcome, tokens, chars, truncated``."""

    embeddings: DataFrame
    outcomes: DataFrame


class Created(NamedTuple):
    """Request lines, the registry with the new jobs, and the texts behind them."""

    requests: DataFrame
    registry: DataFrame
    texts: DataFrame


class Checked(NamedTuple):
    """Next embeddings and registry, failures, and counts per job."""

    embeddings: DataFrame
    registry: DataFrame
    failures: DataFrame
    counts: DataFrame


def embed_sync(
    sitemaps: DataFrame, pages: DataFrame, content: DataFrame, embeddings: DataFrame,
    fn: Callable[[list[str]], Sequence[Sequence[float]]] | None = None,
    min_len: int = MIN_CONTENT_LENGTH, limit: int = EMBED_LIMIT, max_tokens: int = MAX_TOKENS, dim: int = EMBEDDING_DIM,
    codec: Callable[[pd.Series, int], pd.DataFrame] | None = None,
) -> Embedded:
    """Embed the queue. Vectors are written once, so the model is not asked again for them.

    ``codec`` counts and cuts by the model's own tokens, see ``token_truncate``.
    """
    queue = materialize(embed_queue(sitemaps, pages, content, embeddings, None, min_len, limit))
    cut = token_truncate(queue, "id_page", "content", max_tokens, fn=codec)
    made = embed_texts(cut, "id_page", "content", fn, dim)
    fits = (F.col("outcome") != "ok") | (F.size("embedding") == dim)
    vectors = materialize(made.withColumn("outcome", F.when(fits, F.col("outcome")).otherwise("failed")), "vectors")
    outcomes = queue.select("id_page", "domain").join(cut.drop("content"), "id_page").join(
        vectors.select("id_page", "outcome"), "id_page"
    )
    good = vectors.where("outcome = 'ok'").select("id_page", "embedding")
    return Embedded(embedding_upsert(embeddings, good), outcomes)


def embed_batch_create(
    sitemaps: DataFrame, pages: DataFrame, content: DataFrame, embeddings: DataFrame, registry: DataFrame,
    as_of: dt.datetime | Column, run_id: str, min_len: int = MIN_CONTENT_LENGTH, limit: int = EMBED_LIMIT,
    size: int = BATCH_SIZE, max_tokens: int = MAX_TOKENS, model: str = batches.EMBEDDING_MODEL,
    codec: Callable[[pd.Series, int], pd.DataFrame] | None = None,
) -> Created:
    """Cut the queue, without pages of pending jobs, into jobs and enter them in the registry.

    Job ids are ``run_id`` and the batch number; a service's own ids can replace
    them once it has accepted the files.
    """
    queue = embed_queue(sitemaps, pages, content, embeddings, registry, min_len, limit)
    numbered = batch_assign(queue, newest_first(), size)
    cut = token_truncate(numbered, "id_page", "content", max_tokens, fn=codec)
    texts = materialize(numbered.select("id_page", "domain", "batch_no").join(cut, "id_page"))
    jobs = batches.job_manifest(texts).select(
        F.concat(F.lit(f"{run_id}-"), "batch_no").alias("batch_id"),
        F.concat(F.lit(f"{run_id}-requests-"), "batch_no").alias("input_file_id"),
        moment(as_of).alias("created_at"),
        F.lit("pending").alias("status"), "page_ids", "domain_tokens",
        F.lit(None).cast("timestamp").alias("completed_at"), F.lit(None).cast("bigint").alias("processed_count"),
        F.lit("pending").alias("list_name"),
    )
    return Created(batches.batch_requests(texts, model), registry.unionByName(jobs), texts)


def embed_batch_check(
    registry: DataFrame, statuses: DataFrame, results: DataFrame, errors: DataFrame | None,
    embeddings: DataFrame, as_of: dt.datetime | Column, dim: int | None = EMBEDDING_DIM,
) -> Checked:
    """Take in finished jobs.

    ``statuses``: ``batch_id, status``. Result rows, and lines of the error file,
    count when their page is in a pending job now reported as completed. A vector
    that hasn't ``dim`` values is a failure.
    """
    done = registry.where("list_name = 'pending'").join(
        statuses.where("status = 'completed'").select("batch_id"), "batch_id", "left_semi"
    )
    members = done.select("batch_id", F.explode("page_ids").alias("id_page"))
    mine = materialize(results.join(members, "id_page"))
    told = None if errors is None else errors.join(members.select("id_page").distinct(), "id_page", "left_semi")
    ok, failed = batches.batch_results_load(mine, told, dim)
    ok, failed = materialize(ok, "vectors"), materialize(failed, "failures")
    ended = ok.select("id_page", F.lit(True).alias("ok")).unionByName(failed.select("id_page", F.lit(False).alias("ok")))
    counts = materialize(ended.join(members, "id_page").groupBy("batch_id").agg(
        F.count_if("ok").alias("ok"), F.count_if(~F.col("ok")).alias("failed")
    ), "counts")
    moved = batches.job_registry_transition(
        registry, statuses, counts.select("batch_id", F.col("ok").alias("processed_count")), as_of
    )
    return Checked(embedding_upsert(embeddings, ok), moved, failed, counts)


def embed_batch_domains(registry: DataFrame, counts: DataFrame, price: float = PRICE_PER_MILLION_TOKENS) -> DataFrame:
    """Results of the jobs in ``counts`` per domain: ``(domain, jobs, successful, failed, tokens, cost)``.

    A job's counts are spread over its domains by their tokens, as its registry entry knows no more. A job without
    tokens by domain is in no row.
    """
    shares = registry.join(counts.select("batch_id"), "batch_id", "left_semi").select(
        F.col("batch_id").alias("batch_no"), F.explode("domain_tokens").alias("domain", "tokens")
    )
    spread = batches.job_domain_apportion(shares, counts.withColumnRenamed("batch_id", "batch_no"))
    totals = spread.groupBy("domain").agg(
        F.count("*").alias("jobs"), F.sum("ok").alias("successful"), F.sum("failed").alias("failed"), F.sum("tokens").alias("tokens")
    )
    return totals.withColumn("cost", F.round(token_cost(F.col("tokens"), price, BATCH_DISCOUNT), 6)).orderBy("domain")


def embed_batch_status(registry: DataFrame, as_of: dt.datetime | Column) -> dict[str, DataFrame]:
    """Jobs per list and the pending ones by age."""
    return {"counts": batches.job_status_counts(registry), "pending": batches.job_age_report(registry, as_of)}


def embed_batch_full(
    sitemaps: DataFrame, pages: DataFrame, content: DataFrame, embeddings: DataFrame, registry: DataFrame,
    statuses: DataFrame, results: DataFrame, errors: DataFrame | None, as_of: dt.datetime, run_id: str,
    dim: int | None = EMBEDDING_DIM, **limits,
) -> tuple[Created, Checked]:
    """Create new jobs, then take in those that have finished."""
    created = embed_batch_create(sitemaps, pages, content, embeddings, registry, as_of, run_id, **limits)
    return created, embed_batch_check(created.registry, statuses, results, errors, embeddings, as_of, dim)


__all__ = [
    "BATCH_SIZE", "Checked", "Created", "Embedded", "embed_batch_check", "embed_batch_create", "embed_batch_full",
    "embed_batch_domains", "embed_batch_status", "embed_sync",
]
