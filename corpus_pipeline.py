"""From raw documents to packed sequences: toxicity, exact dedup, near-dedup, mixing, packing.

Every stage takes ``(spark, docs, sf_dir)``, works on all rows its predecessor kept and returns a DataFrame, which
is written as Parquet and read again as the next one's ``docs``. All but the last return the columns of ``documents``.
What a stage wrote for itself is removed when the next one starts: by then its result is written.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from presslake import configure, scratch_path
from presslake.llm.common import table
from presslake.llm.mixing import mix_sources
from presslake.llm.power_packing import pack_by_powers
from presslake.llm.simhash import keep_one_of_each
from presslake.llm.toxicity import fit_chain, score
from presslake.llm.trie_dedup import exact_owners
from presslake.session import ScratchNotes, remove_path

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
_notes = ScratchNotes()


def _stage(run: Stage) -> Stage:
    @wraps(run)
    def with_own_scratch(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        _notes.clear(configure(spark))
        with _notes:
            return run(spark, docs, sf_dir)
    return with_own_scratch


@_stage
def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the chain doesn't reject. It is fitted on the labelled rows of ``documents``."""
    model = fit_chain(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    names = [F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(docs.columns)]
    text = f"c{docs.columns.index('text')}"
    kept = score(docs.select(*names), model, text).where(~F.col("rejected"))
    return kept.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(docs.columns)])


@_stage
def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document of smallest identifier."""
    return exact_owners(docs).kept()


@_stage
def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of texts whose fingerprints link the document of smallest identifier."""
    return keep_one_of_each(docs)


@_stage
def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: a document once for each pass that takes words of it, cut to those words."""
    mixed = mix_sources(docs).documents()
    if "n_chars" in docs.columns:
        mixed = mixed.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return mixed


@_stage
def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of powers of two, a sequence each."""
    return pack_by_powers(docs)


STAGES = [
    ("toxicity", toxicity), ("exact dedup", exact_dedup), ("near dedup", near_dedup), ("mixing", mixing), ("packing", packing),
]

#: Classifiers, hashes and tokenizers have no SQL; the tests hold every stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs, before = table(configure(spark), sf_dir, "documents"), None
    for name, stage in STAGES:
        path = scratch_path(spark, name.replace(" ", "-"))
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        if before is not None:
            remove_path(spark, before)
        before = path
    _notes.clear(spark)
    return docs
