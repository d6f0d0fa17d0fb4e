"""Repeated blocks and token limits."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from presslake.functions.tokens import MAX_TOKENS, TOKEN_PATTERN, WORD_PATTERN, count_tokens, tokens
from presslake.operators.key_filters import FilteredTable, absent_filtered
from presslake.session import materialize

#: Bytes of text that meet the places of their lines in one task.
TASK_BYTES = 32 << 20


def text_dedup_blocks(
    df: DataFrame, id_col: str, text_col: str, seen: FilteredTable | None = None, run: int | None = None,
) -> DataFrame:
    """Keep every line only where it first occurs in the corpus: ``(id, text)``.

    Lines are trimmed and empty ones dropped; first means the smallest id, then
    the place in the text. A document all of whose lines occur earlier keeps an
    empty text.

    Only a digest, the id and the place of a line are shuffled. A line that
    stands in very many documents shrinks to one row per task beforehand. Texts
    are joined back once, by id, in as many tasks as their bytes ask for
    (``TASK_BYTES``), which are counted first.

    With ``seen`` (see ``lines_seen``) lines of earlier runs count as well: what a
    run below ``run`` has kept goes from every later one. The lines of this run are
    added when its texts are known, so a run that broke off may run again under its
    number and gives the same texts.
    """
    trimmed = F.transform(F.split(text_col, "\n"), lambda line: F.btrim(line, F.lit(" \t\r")))
    lines = F.array_distinct(F.filter(trimmed, lambda line: line != ""))
    docs = df.select(id_col, lines.alias("_lines"))
    # The outer form: for the plain one Spark would build the lines again to test for empty lists.
    placed = docs.select(id_col, F.posexplode_outer("_lines").alias("_place", "_line")).where("_line is not null")
    # A document holds a line once, so the smallest id has exactly one place.
    first = placed.groupBy(F.unhex(F.md5("_line")).alias("_digest")).agg(
        F.min(id_col).alias(id_col), F.min_by("_place", id_col).alias("_place")
    )
    if seen is not None:
        earlier = seen.before(run)
        named = first.select(F.hex("_digest").alias("digest"), id_col, "_place")
        first = materialize(absent_filtered(named, earlier), "new-lines")
        earlier.append(first.select("digest", F.col(id_col).cast("bigint").alias("id")))
    size = df.agg(F.sum(F.octet_length(text_col))).first()[0] or 0
    tasks = max(df.sparkSession.sparkContext.defaultParallelism, -(-size // TASK_BYTES))
    # The hash deals texts without an id over all tasks. It also keeps a union of runs from reading the same part of each
    # run in one task, as Spark does where results are known to lie by the same key.
    key = [id_col, "_hash"]
    own = F.xxhash64(id_col)
    placed_texts = docs.withColumn("_hash", F.when(F.col(id_col).isNull(), F.xxhash64("_lines")).otherwise(own)).repartition(tasks, *key)
    places = first.select(id_col, "_place", own.alias("_hash")).repartition(tasks, *key)
    kept = places.groupBy(*key).agg(F.sort_array(F.collect_list("_place")).alias("_places"))
    text = F.array_join(F.transform("_places", lambda place: F.get(F.col("_lines"), place)), "\n")
    return placed_texts.join(kept, key, "left").select(id_col, F.coalesce(text, F.lit("")).alias(text_col))


def lines_seen(spark: SparkSession, path: str, buckets: int = 1024, lines_per_bucket: int = 65_536) -> FilteredTable:
    """The digests of lines that earlier runs kept, with filters, so a run reads few of them."""
    return FilteredTable(spark, path, "digest", "id", buckets, lines_per_bucket)


def token_count(
    df: DataFrame, id_col: str, text_col: str, pattern: str = WORD_PATTERN,
    fn: Callable[[pd.Series], pd.Series] | None = None,
) -> DataFrame:
    """``(id, tokens, chars)``; ``fn`` counts with a codec of one's own, texts in, numbers out."""
    if fn is None:
        return df.select(
            id_col, count_tokens(F.col(text_col), pattern).alias("tokens"),
            F.length(text_col).cast("bigint").alias("chars"),
        )

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({
                id_col: batch[id_col], "tokens": fn(batch[text_col]), "chars": batch[text_col].str.len(),
            })

    id_type = df.schema[id_col].dataType.simpleString()
    return df.select(id_col, text_col).mapInPandas(run, f"{id_col} {id_type}, tokens bigint, chars bigint")


def token_truncate(
    df: DataFrame, id_col: str, text_col: str, limit: int = MAX_TOKENS, pattern: str = TOKEN_PATTERN,
    fn: Callable[[pd.Series, int], pd.DataFrame] | None = None,
) -> DataFrame:
    """Cut texts of ``limit`` tokens and more to the first ``limit - 1``: ``(id, text, tokens, chars, truncated)``.

    ``fn`` cuts with a codec of one's own: texts and the number of tokens to keep in, columns ``text`` (cut) and
    ``tokens`` (before the cut) out, row by row. Null texts don't reach it. A null text stays null, with null counts.
    """
    keep = limit - 1
    if fn is None:
        found = df.select(id_col, text_col, tokens(F.col(text_col), pattern).alias("_tokens"))
        cut = F.size("_tokens") > keep
        text = F.when(cut, F.array_join(F.slice("_tokens", 1, keep), "")).otherwise(F.col(text_col))
        return (
            found.select(id_col, text.alias(text_col), F.when(cut, keep).otherwise(F.size("_tokens")).cast("bigint").alias("tokens"), cut.alias("truncated"))
            .select(id_col, text_col, "tokens", F.length(text_col).cast("bigint").alias("chars"), "truncated")
        )

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            made = pd.DataFrame({"id": batch["id"], "text": None, "tokens": pd.array([None] * len(batch), dtype="Int64")})
            there = batch["text"].notna()
            if there.any():
                given = fn(batch.loc[there, "text"].reset_index(drop=True), keep)
                made.loc[there, "text"] = given["text"].to_numpy()
                made.loc[there, "tokens"] = given["tokens"].to_numpy()
            yield made

    id_type = df.schema[id_col].dataType.simpleString()
    named = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return named.mapInPandas(run, f"id {id_type}, text string, tokens bigint").select(
        F.col("id").alias(id_col), F.col("text").alias(text_col), F.when(F.col("tokens") > keep, F.lit(keep).cast("bigint")).otherwise(F.col("tokens")).alias("tokens"),
        F.length("text").cast("bigint").alias("chars"), (F.col("tokens") > keep).alias("truncated"),
    )
