"""Embedding batch jobs: requests, manifests, results, registry."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from presslake.functions.dates import moment
from presslake.functions.predicates import result_ok
from presslake.operators.numbering import report_row_number

EMBEDDING_MODEL = "text-embedding-3-small"

# Job statuses that end a job.
TERMINAL_STATUSES = ["completed", "failed", "expired", "cancelled"]
LISTS = ["pending", "completed", "failed"]


def batch_requests(df: DataFrame, model: str = EMBEDDING_MODEL) -> DataFrame:
    """One request line per text: ``(batch_no, id_page, request)``; empty texts give none.

    ``df``: ``id_page, content, batch_no``.
    """
    body = F.struct(F.lit(model).alias("model"), F.col("content").alias("input"), F.lit("float").alias("encoding_format"))
    line = F.struct(
        F.col("id_page").cast("string").alias("custom_id"), F.lit("POST").alias("method"),
        F.lit("/v1/embeddings").alias("url"), body.alias("body"),
    )
    return df.where("content <> ''").select("batch_no", "id_page", F.to_json(line).alias("request"))


def write_batch_requests(requests: DataFrame, path: str) -> None:
    """Write request lines as text files, one folder per batch."""
    lines = requests.select("batch_no", F.col("request").alias("value"))
    lines.repartition("batch_no").write.mode("errorifexists").partitionBy("batch_no").text(path)


def job_domain_tokens(df: DataFrame) -> DataFrame:
    """``(batch_no, domain, tokens)`` summed from ``batch_no, domain, tokens``."""
    return df.groupBy("batch_no", "domain").agg(F.sum("tokens").alias("tokens"))


def job_manifest(df: DataFrame) -> DataFrame:
    """Per batch its page ids, tokens by domain and counts.

    ``df``: ``batch_no, id_page, domain, tokens``. A batch has at most its fixed
    number of texts, so the lists are short.
    """
    pages = df.groupBy("batch_no").agg(
        F.sort_array(F.collect_list("id_page")).alias("page_ids"),
        F.count("*").alias("texts"),
        F.sum("tokens").alias("tokens"),
    )
    shares = job_domain_tokens(df).groupBy("batch_no").agg(
        F.map_from_entries(F.sort_array(F.collect_list(F.struct("domain", "tokens")))).alias("domain_tokens")
    )
    return pages.join(shares, "batch_no")


def token_share(shares: DataFrame) -> DataFrame:
    """Adds ``share``: a domain's part of its job's tokens, 0 for a job without tokens."""
    total = F.sum("tokens").over(Window.partitionBy("batch_no"))
    return shares.withColumn("share", F.coalesce(F.try_divide(F.col("tokens").cast("double"), total.cast("double")), F.lit(0.0)))


def job_domain_apportion(shares: DataFrame, outcomes: DataFrame) -> DataFrame:
    """Spread each job's ``ok`` and ``failed`` counts over its domains by token share.

    Halves round to the even number.
    """
    def part(column: str) -> Column:
        return F.rint(F.col(column) * F.col("share")).cast("bigint").alias(column)

    return token_share(shares).join(outcomes.select("batch_no", "ok", "failed"), "batch_no").select(
        "batch_no", "domain", "tokens", part("ok"), part("failed")
    )


def job_domain_outcomes(results: DataFrame, pages: DataFrame) -> DataFrame:
    """Exact counterpart of the estimate: counts by domain from the result rows themselves.

    ``results``: ``id_page, error, status_code``; ``pages``: ``id_page, batch_no, domain``.
    """
    ok = result_ok(F.col("error"), F.col("status_code"))
    return results.withColumn("_ok", ok).join(pages.select("id_page", "batch_no", "domain"), "id_page").groupBy(
        "batch_no", "domain"
    ).agg(F.count_if("_ok").alias("ok"), F.count_if(~F.col("_ok")).alias("failed"))


def _good(results: DataFrame, dim: int | None) -> Column:
    """Whether a result line counts: no error, and a vector of ``dim`` values where that is given."""
    good = result_ok(F.col("error"), F.col("status_code"))
    return good if dim is None else good & F.coalesce(F.size("embedding") == dim, F.lit(False))


def results_ok(results: DataFrame, dim: int | None = None) -> DataFrame:
    """``(id_page, embedding)`` of good lines; of repeated pages the last line counts."""
    good = results.where(_good(results, dim))
    if "seq" not in results.columns:
        return good.select("id_page", "embedding")
    return good.groupBy("id_page").agg(F.max_by("embedding", "seq").alias("embedding"))


def results_failed(results: DataFrame, errors: DataFrame | None = None, dim: int | None = None) -> DataFrame:
    """``(id_page, status_code, message)`` of bad lines, with the error file's message where it has one.

    A page that only the error file names is a failure too; one that also has a
    good line is not. Repeated lines of the error file count once.
    """
    good = _good(results, dim)
    wrong = F.concat(F.lit("vector of "), F.size("embedding"), F.lit(" values"))
    stated = F.when(result_ok(F.col("error"), F.col("status_code")), wrong).otherwise(F.col("error"))
    bad = results.where(~good).select("id_page", "status_code", stated.alias("error"))
    if errors is None:
        return bad.withColumnRenamed("error", "message")
    told = errors.where("id_page is not null").groupBy("id_page").agg(F.min("message").alias("message"))
    told = told.join(results.where(good).select("id_page"), "id_page", "left_anti")
    return bad.join(told, "id_page", "full").select(
        "id_page", "status_code", F.coalesce("message", "error").alias("message")
    )


def batch_results_load(
    results: DataFrame, errors: DataFrame | None = None, dim: int | None = None
) -> tuple[DataFrame, DataFrame]:
    """Split result rows into embeddings to store and failures to report."""
    return results_ok(results, dim), results_failed(results, errors, dim)


def job_registry_transition(
    registry: DataFrame, statuses: DataFrame, results: DataFrame, as_of: dt.datetime | Column
) -> DataFrame:
    """Move pending jobs whose reported status is final to the completed or failed list.

    ``statuses``: ``batch_id, status``; ``results``: ``batch_id, processed_count``.
    Jobs without a report, or still running, stay as they are.
    """
    reported = statuses.select("batch_id", F.col("status").alias("_status"))
    counted = results.select("batch_id", F.col("processed_count").alias("_count"))
    ends = (F.col("list_name") == "pending") & F.coalesce(F.col("_status").isin(TERMINAL_STATUSES), F.lit(False))
    done = ends & (F.col("_status") == "completed")
    return registry.join(reported, "batch_id", "left").join(counted, "batch_id", "left").withColumns({
        "status": F.when(ends, F.col("_status")).otherwise(F.col("status")),
        "completed_at": F.when(ends, moment(as_of)).otherwise(F.col("completed_at")),
        "processed_count": F.when(done, F.coalesce("_count", F.lit(0))).otherwise(F.col("processed_count")),
        "list_name": F.when(done, "completed").when(ends, "failed").otherwise(F.col("list_name")),
    }).select(*registry.columns)


def job_status_counts(registry: DataFrame) -> DataFrame:
    """Jobs per list, lists without jobs included."""
    named = registry.sparkSession.createDataFrame([(n,) for n in LISTS], "list_name string")
    counts = registry.groupBy("list_name").agg(F.count("*").alias("jobs"))
    return named.join(counts, "list_name", "left").select("list_name", F.coalesce("jobs", F.lit(0)).alias("jobs"))


def job_age_report(registry: DataFrame, as_of: dt.datetime | Column) -> DataFrame:
    """Pending jobs, oldest first: ``(row_no, batch_id, age_hours, pages)``."""
    age = (F.unix_micros(moment(as_of)) - F.unix_micros("created_at")) / F.lit(3_600_000_000.0)
    pending = registry.where("list_name = 'pending'").select(
        "batch_id", "created_at", F.round(age, 1).alias("age_hours"), F.size("page_ids").cast("bigint").alias("pages")
    )
    return report_row_number(pending, [F.asc("created_at"), F.asc("batch_id")]).drop("created_at")
