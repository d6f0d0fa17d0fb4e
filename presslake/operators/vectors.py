"""Making vectors from texts and finding near ones."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Sequence
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.feature import HashingTF, Normalizer, RegexTokenizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from presslake.functions.vectors import METRICS
from presslake.operators.audit import EMBEDDING_DIM, vector_dim_check

__all__ = ["embed_texts", "semantic_topk", "semantic_topk_many", "vector_dim_check"]

# Rows and queries that meet in one matrix product.
ROW_BLOCK, QUERY_BLOCK = 8192, 1024
# Numbers in the queries that one task holds, about.
QUERY_NUMBERS = 1 << 24


def embed_texts(
    df: DataFrame, id_col: str, text_col: str,
    fn: Callable[[list[str]], Sequence[Sequence[float]]] | None = None, dim: int = EMBEDDING_DIM,
) -> DataFrame:
    """``(id, outcome, embedding)`` with outcome ``ok``, ``failed`` or ``skipped`` (empty text).

    ``fn`` maps a list of texts to vectors. When it fails on a batch the texts are
    tried one by one, so a bad text fails alone. Without ``fn`` hashed word counts
    of unit length stand in for a model.
    """
    rows = df.select(id_col, F.coalesce(text_col, F.lit("")).alias(text_col))
    if fn is None:
        words = RegexTokenizer(inputCol=text_col, outputCol="_words", pattern=r"[\p{L}\p{N}]+", gaps=False)
        counts = HashingTF(inputCol="_words", outputCol="_counts", numFeatures=dim)
        unit = Normalizer(inputCol="_counts", outputCol="_unit", p=2.0)
        made = reduce(lambda d, stage: stage.transform(d), [words, counts, unit], rows)
        outcome = F.when(F.col(text_col) == "", "skipped").otherwise("ok")
        vector = F.when(outcome == "ok", vector_to_array("_unit", "float32"))
        return made.select(id_col, outcome.alias("outcome"), vector.alias("embedding"))

    def one(text: str) -> tuple[str, list[float] | None]:
        try:
            return "ok", [float(x) for x in fn([text])[0]]
        except Exception:
            return "failed", None

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            filled = batch[text_col] != ""
            made: list[tuple[str, list[float] | None]] = [("skipped", None)] * len(batch)
            spots, texts = np.flatnonzero(filled), list(batch[text_col][filled])
            try:
                answers = [("ok", [float(x) for x in v]) for v in fn(texts)] if texts else []
                if len(answers) != len(texts):
                    raise ValueError("a vector is missing")
            except Exception:
                answers = [one(text) for text in texts]
            for spot, answer in zip(spots, answers):
                made[spot] = answer
            yield pd.DataFrame({
                id_col: batch[id_col], "outcome": [m[0] for m in made], "embedding": [m[1] for m in made],
            })

    id_type = df.schema[id_col].dataType.simpleString()
    return rows.mapInPandas(run, f"{id_col} {id_type}, outcome string, embedding array<float>")


def semantic_topk(
    df: DataFrame, query: Sequence[float] | Column, k: int, metric: str = "cosine",
    id_col: str = "id_page", vector_col: str = "embedding",
) -> DataFrame:
    """The ``k`` rows nearest to one query vector: ``(id, score)``.

    One scan; every task keeps its best ``k``. ``query`` is a list of numbers or
    a column, e.g. a scalar subquery over another table. NULL vectors are passed
    over; one of another length than the query is an error.
    """
    score, larger = METRICS[metric]
    vector = query if isinstance(query, Column) else F.array(*[F.lit(float(x)) for x in query])
    scored = df.select(id_col, vector_col).withColumn("_query", vector)
    other = F.size(vector_col) != F.size("_query")
    checked = F.when(other, F.raise_error(F.lit("vectors of different lengths"))).otherwise(F.col(vector_col))
    scored = scored.select(id_col, score(checked, F.col("_query")).alias("score")).where("score is not null")
    return scored.orderBy(F.desc("score") if larger else F.asc("score"), F.asc(id_col)).limit(k)


class _Vectors:
    """Vectors in double precision, their lengths, and the form whose products stand for the metric."""

    def __init__(self, whole: np.ndarray, metric: str) -> None:
        self.whole, self.lengths = whole, np.sqrt((whole * whole).sum(axis=1))
        with np.errstate(all="ignore"):
            self.form = (whole / self.lengths[:, None]).astype("float32") if metric == "cosine" else whole
        self.apt = np.isfinite(self.form).all(axis=1) if metric == "cosine" else np.ones(len(whole), dtype=bool)


class _Nearest:
    """For the queries of a task the ``k`` best rows so far, as blocks of rows pass by.

    One matrix product a block gives ranks (larger is nearer) with a bound on their error; pairs that may be among the
    best are scored again one by one in double precision, so equal vectors have equal scores wherever they lie.
    """

    def __init__(self, queries: np.ndarray, k: int, metric: str, sizes: tuple[int, int]) -> None:
        self.k, self.metric, self.larger, self.sizes = k, metric, METRICS[metric][1], sizes
        self.asked = _Vectors(queries, metric)
        # Rank of the k-th best, once there is one; what has no direction takes no part.
        self.least = np.where(self.asked.apt, -np.inf, np.inf)
        self.best = pd.DataFrame({"q": np.zeros(0, "int64"), "score": np.zeros(0), "id": []})

    def _ranks(self, q: slice, rows: _Vectors) -> tuple[np.ndarray, np.ndarray]:
        near, dim = self.asked.form[q] @ rows.form.T, self.asked.whole.shape[1]
        if self.metric == "cosine":
            return near, np.full((len(near), 1), np.float32((dim + 8) * 2.0**-23))
        ours, theirs = self.asked.lengths[q, None], rows.lengths
        if self.metric == "ip":
            return near, (dim + 8) * 2.0**-50 * ours * theirs.max()
        return 2 * near - ours**2 - theirs**2, (dim + 8) * 2.0**-50 * (ours + theirs.max()) ** 2

    def _scored(self, q: np.ndarray, rows: _Vectors, r: np.ndarray) -> np.ndarray:
        scores, step = np.empty(len(q)), max(1, (1 << 21) // max(1, rows.whole.shape[1]))
        for at in range(0, len(q), step):
            a, b = q[at : at + step], r[at : at + step]
            left, right = self.asked.whole[a], rows.whole[b]
            if self.metric == "l2":
                scores[at : at + step] = np.sqrt(((left - right) ** 2).sum(axis=1))
            else:
                scores[at : at + step] = (left * right).sum(axis=1)
                if self.metric == "cosine":
                    scores[at : at + step] /= self.asked.lengths[a] * rows.lengths[b]
        return scores

    def _top(self, found: pd.DataFrame) -> pd.DataFrame:
        ordered = found.sort_values(["q", "score", "id"], ascending=[True, not self.larger, True], ignore_index=True)
        return ordered[ordered.groupby("q", sort=False).cumcount() < self.k]

    def meet(self, whole: np.ndarray, ids: pd.Series) -> None:
        """Bring rows to all queries."""
        for start in range(0, len(whole), self.sizes[1]):
            part = slice(start, start + self.sizes[1])
            with np.errstate(all="ignore"):
                self._meet_block(_Vectors(whole[part], self.metric), ids[part].reset_index(drop=True))

    def _meet_block(self, rows: _Vectors, ids: pd.Series) -> None:
        found = [self.best]
        for at in range(0, len(self.least), self.sizes[0]):
            q = slice(at, at + self.sizes[0])
            near, bound = self._ranks(q, rows)
            least = self.least[q]
            if self.k <= near.shape[1] and np.isneginf(least).any():
                # The k-th best of the block, less its error, holds for a query as well. NaN sorts last: it must not count.
                sure = np.where(np.isnan(near), -np.inf, near)
                least = np.maximum(least, np.partition(sure, -self.k, axis=1)[:, -self.k] - bound[:, 0])
            pairs = ~(near < (least[:, None] - bound).astype(near.dtype)) & rows.apt & self.asked.apt[q, None]
            who, row = np.nonzero(pairs)
            scores = self._scored(who + at, rows, row)
            fine = ~np.isnan(scores)
            if fine.any():
                found.append(self._top(pd.DataFrame({"q": who[fine] + at, "score": scores[fine], "id": ids.take(row[fine]).to_numpy()})))
        if len(found) == 1:
            return
        self.best = self._top(pd.concat([f for f in found if len(f)], ignore_index=True))
        last = self.best[self.best.groupby("q", sort=False).cumcount() == self.k - 1]
        rank = last["score"].to_numpy()
        self.least[last["q"].to_numpy()] = rank if self.larger else -(rank**2)


def _numbers(column: pa.Array, dim: int | None = None) -> np.ndarray:
    lengths = set(pc.unique(pc.list_value_length(column)).to_pylist()) | ({dim} if dim is not None else set())
    if len(lengths) > 1:
        raise ValueError("vectors of different lengths")
    return column.flatten().to_numpy(zero_copy_only=False).astype("float64").reshape(len(column), -1)


def _search(k: int, metric: str, sizes: tuple[int, int], kinds: tuple[pa.DataType, pa.DataType]):
    """Rows ``(turn, query_id, id, vector)`` in order, ``turn`` being twice the cell and one more for rows: a cell's
    queries are held, its rows pass by."""
    def found(nearest: _Nearest, names: pa.Array) -> Iterator[pa.RecordBatch]:
        best = nearest.best
        for at in range(0, len(best), 1 << 16):
            part = best[at : at + (1 << 16)]
            yield pa.RecordBatch.from_arrays([
                names.take(pa.array(part["q"].to_numpy())).cast(kinds[0]), pa.array(part["id"].tolist(), kinds[1]), pa.array(part["score"].to_numpy()),
            ], names=["query_id", "id", "score"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, waiting, nearest, names = None, [], None, None
        for batch in batches:
            turns = batch.column(0).to_numpy()
            cuts = [0, *(np.flatnonzero(np.diff(turns)) + 1).tolist(), len(turns)]
            for a, b in zip(cuts, cuts[1:]):
                if a == b:
                    continue
                (here, is_row), part = divmod(int(turns[a]), 2), batch.slice(a, b - a)
                if here != cell:
                    if nearest is not None:
                        yield from found(nearest, names)
                    cell, waiting, nearest = here, [], None
                if not is_row:
                    waiting.append(part)
                    continue
                if nearest is None:
                    if not waiting:
                        continue
                    names = pa.concat_arrays([w.column(1) for w in waiting])
                    nearest, waiting = _Nearest(_numbers(pa.concat_arrays([w.column(3) for w in waiting])), k, metric, sizes), []
                ids = part.column(2).to_pandas(integer_object_nulls=True)
                nearest.meet(_numbers(part.column(3), nearest.asked.whole.shape[1]), ids)
        if nearest is not None:
            yield from found(nearest, names)
    return run


def semantic_topk_many(
    df: DataFrame, queries: DataFrame, k: int, metric: str = "cosine",
    id_col: str = "id_page", vector_col: str = "embedding", query_col: str = "query_id",
) -> DataFrame:
    """The ``k`` nearest rows of each query: ``(query_id, id, score)``, for any number of queries.

    ``queries`` has ``query_id`` and the vector column. Queries and rows are dealt
    over a grid that has a few tasks for each core, whatever the size of the
    tables; only where a task would hold more than ``QUERY_NUMBERS`` numbers are
    there more lines of it. A task holds its queries and lets its rows pass, in
    blocks that meet by one matrix product each; it hands on the best ``k`` per
    query. NULL vectors are passed over; vectors of different lengths are an
    error.
    """
    spark, larger = df.sparkSession, METRICS[metric][1]
    kind = "array<float>" if all(d.schema[vector_col].dataType.simpleString() == "array<float>" for d in (df, queries)) else "array<double>"
    rows, asked = (
        d.select(F.col(c).alias("_key"), F.col(vector_col).cast(kind).alias("_vector")).where("_vector is not null")
        for d, c in ((df, id_col), (queries, query_col))
    )
    n = rows.count()
    n_asked, dim = asked.agg(F.count("*"), F.max(F.size("_vector"))).first()
    tasks = 2 * spark.sparkContext.defaultParallelism
    lines = max(1, -(-n_asked * (dim or 1) // QUERY_NUMBERS), min(math.ceil(tasks**0.5), -(-n_asked // QUERY_BLOCK)))
    columns = max(1, min(-(-tasks // lines), -(-n // QUERY_BLOCK)))
    types = [d.schema[c].dataType for d, c in ((queries, query_col), (df, id_col))]

    def dealt(side: DataFrame, is_row: int) -> DataFrame:
        own = F.pmod(F.xxhash64("_key"), F.lit(columns if is_row else lines))
        every = F.explode(F.sequence(F.lit(0).cast("long"), F.lit((lines if is_row else columns) - 1).cast("long")))
        placed = side.withColumn("_own", own).withColumn("_every", every)
        cell = F.col("_every") * columns + F.col("_own") if is_row else F.col("_own") * columns + F.col("_every")
        names = [F.lit(None).cast(types[0]), F.col("_key")] if is_row else [F.col("_key"), F.lit(None).cast(types[1])]
        return placed.select((2 * cell + is_row).alias("_turn"), names[0].alias("_query"), names[1].alias("_id"), "_vector")

    grid = dealt(asked, 0).unionByName(dealt(rows, 1)).repartitionById(lines * columns, F.expr("_turn div 2").cast("int"))
    scored = grid.sortWithinPartitions("_turn").mapInArrow(
        _search(k, metric, (QUERY_BLOCK, ROW_BLOCK), tuple(to_arrow_type(t) for t in types)),
        f"{query_col} {types[0].simpleString()}, {id_col} {types[1].simpleString()}, score double",
    )
    order = [F.desc("score") if larger else F.asc("score"), F.asc(id_col)]
    rank = F.row_number().over(Window.partitionBy(query_col).orderBy(*order))
    return scored.withColumn("_rank", rank).where(F.col("_rank") <= k).drop("_rank")
