"""Files of the embedding batch jobs: results, errors and the job registry."""

from __future__ import annotations

from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from presslake.schemas import ERROR_LINE, REGISTRY, REGISTRY_FILE, RESULT_LINE

def result_rows(lines: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Flat ``(id_page, error, status_code, embedding)`` from parsed result lines, and columns to ``keep``."""
    return lines.where("custom_id is not null").select(
        F.col("custom_id").try_cast("bigint").alias("id_page"),
        "error",
        F.col("response.status_code").alias("status_code"),
        F.get(F.col("response.body.data"), F.lit(0))["embedding"].alias("embedding"),
        *(keep or []),
    )


def batch_result_scan(spark: SparkSession, path: str) -> DataFrame:
    """Result lines with ``seq``, their place in the file set, to tell repeats apart."""
    place = F.struct("_metadata.file_name", "_metadata.file_block_start", F.monotonically_increasing_id().alias("n"))
    lines = spark.read.schema(RESULT_LINE).json(path)
    return result_rows(lines.select("custom_id", "error", "response", place.alias("seq")), keep=["seq"])


def batch_error_scan(spark: SparkSession, path: str) -> DataFrame:
    """``(id_page, message)`` of an error file; structured errors stay JSON text."""
    return spark.read.schema(ERROR_LINE).json(path).where("custom_id is not null").select(
        F.col("custom_id").try_cast("bigint").alias("id_page"), F.col("error").alias("message")
    )


def job_registry_scan(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """All jobs of a registry file, one row each, with the list they stand in.

    A missing or unreadable file is an empty registry. A registry kept as one
    JSON object per line (``multi_line=False``) is read in parallel.
    """
    try:
        file = spark.read.schema(REGISTRY_FILE).option("multiLine", multi_line).json(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], REGISTRY)
    parts = [
        file.select(F.explode(name).alias("j"), F.lit(name).alias("list_name")).select("j.*", "list_name")
        for name in ("pending", "completed", "failed")
    ]
    jobs = reduce(DataFrame.unionByName, parts)
    return jobs.withColumns({name: F.col(name).try_cast("timestamp") for name in ("created_at", "completed_at")})
