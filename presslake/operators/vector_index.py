"""Nearest neighbours by a stored index: an inverted file with product quantisation.

Vectors are dealt to the nearest of some centres; what is left of a vector after its centre is cut into parts, and
each part is replaced by the number of the nearest of up to 256 part centres, one byte. Centres are fitted on a
bounded sample of rows (``SAMPLE_ROWS``, ``SAMPLE_NUMBERS``); every row is coded and stored in the folder of its
centre.

A search brings a query to the codes of its nearest centres only, gets its distances to what the codes stand for by
matrix products, keeps rows within a margin of the k-th best, and scores just these by their whole vectors. Queries and
codes are dealt over a grid of tasks, so a task knows a k-th best over many centres and hands on little more than what
will be scored. Number of centres to probe and margin come from
the sample, such that the wanted share of true neighbours is found there; clustered vectors need few probes, vectors
without structure need most of them and gain by the codes alone. What was coded and scored is part of the result.
"""

from __future__ import annotations

import io
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from presslake.functions.vectors import METRICS
from presslake.session import materialize

#: Rows that centres are fitted on, at most, and numbers in them; those with the least hash of their id.
SAMPLE_ROWS, SAMPLE_NUMBERS = 65_536, 1 << 22
#: Sample rows that serve as queries when probes and margin are set.
TRIAL_QUERIES = 256
MOST_CENTRES, MOST_CODES, PART_WIDTH = 4096, 256, 4
#: Coded rows of a centre written by one task, or decoded at once in a search; queries that choose centres at once.
CELL_ROWS, CELL_QUERIES = 65_536, 2_048
#: Numbers that the queries of a task take at most, distances held at once there, and bytes of rows found that wait.
QUERY_NUMBERS, BLOCK_NUMBERS, WAITING_BYTES = 1 << 24, 1 << 20, 1 << 25


@dataclass
class Model:
    """Centres, part centres by part, and what a search needs to know beforehand."""

    metric: str
    centres: np.ndarray
    parts: np.ndarray  # part, code, number
    probes: int
    margin: float

    def prepared(self, vectors: np.ndarray) -> np.ndarray:
        """Vectors of unit length where only the direction counts, padded to whole parts."""
        if self.metric == "cosine":
            vectors = vectors / np.sqrt((vectors * vectors).sum(axis=1))[:, None]
        return np.pad(vectors, ((0, 0), (0, self.centres.shape[1] - vectors.shape[1])))

    def nearest_centres(self, vectors: np.ndarray, n: int) -> np.ndarray:
        return np.argsort(_distances(vectors, self.centres), axis=1, kind="stable")[:, :n]

    def codes(self, rests: np.ndarray) -> np.ndarray:
        """One byte for each part of what centres have left."""
        cut = rests.reshape(len(rests), len(self.parts), -1)
        return np.stack([_nearest(cut[:, p], c) for p, c in enumerate(self.parts)], axis=1).astype(np.uint8)

    def decoded(self, own: np.ndarray, codes: np.ndarray) -> np.ndarray:
        """The vectors that centres and codes stand for."""
        rests = np.stack([c[codes[:, p]] for p, c in enumerate(self.parts)], axis=1)
        return self.centres[own] + rests.reshape(len(codes), -1)

    def tables(self, rests: np.ndarray) -> np.ndarray:
        """Squared distances of queries (less a centre) to all part centres: query, part, code."""
        cut = rests.reshape(len(rests), len(self.parts), -1)
        return np.stack([_distances(cut[:, p], c) for p, c in enumerate(self.parts)], axis=1)

    def near(self, tables: np.ndarray, codes: np.ndarray) -> np.ndarray:
        """Squared distances by code: query, row; those to ``decoded`` rows are the same."""
        out = np.zeros((len(tables), len(codes)))
        for p in range(tables.shape[1]):
            out += tables[:, p, codes[:, p]]
        return out


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.maximum((a * a).sum(axis=1)[:, None] - 2 * (a @ b.T) + (b * b).sum(axis=1)[None, :], 0.0)


def _nearest(rows: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """The nearest centre of each row, a block of rows at a time that stays in the processor's memory."""
    squares, turned = (centres * centres).sum(axis=1), -2 * centres.T
    out, step = np.empty(len(rows), dtype=np.int64), max(1, (1 << 16) // len(centres))
    for at in range(0, len(rows), step):
        near = rows[at : at + step] @ turned
        near += squares
        out[at : at + step] = near.argmin(axis=1)
    return out


def _means(rows: np.ndarray, n: int, dice: np.random.Generator, rounds: int = 10) -> np.ndarray:
    """k-means; a centre that lost its rows stays where it was."""
    centres = rows[dice.choice(len(rows), n, replace=False)].copy()
    rows = np.ascontiguousarray(rows)
    for _ in range(rounds):
        own = _nearest(rows, centres)
        sums = np.stack([np.bincount(own, rows[:, i], minlength=n) for i in range(rows.shape[1])], axis=1)
        counts = np.bincount(own, minlength=n)
        centres[counts > 0] = sums[counts > 0] / counts[counts > 0, None]
    return centres


def fit(sample: np.ndarray, metric: str, n_centres: int, recall: float, k: int) -> Model:
    """Fit on the sample, and set probes and margin so that the share ``recall`` of its ``k`` nearest is found."""
    dice = np.random.default_rng(0)
    n_parts = -(-sample.shape[1] // PART_WIDTH)
    model = Model(metric, np.zeros((1, n_parts * PART_WIDTH)), np.zeros((n_parts, 1, PART_WIDTH)), 1, 0.0)
    rows = model.prepared(sample)
    model.centres = _means(rows, max(1, min(n_centres, len(rows) // 16)), dice)
    own = _nearest(rows, model.centres)
    rests = (rows - model.centres[own]).reshape(len(rows), n_parts, -1)
    n_codes = min(MOST_CODES, len(rows))
    model.parts = np.stack([_means(rests[:, p], n_codes, dice) for p in range(n_parts)])
    if len(rows) < 2:
        return model

    coded, place, misses = model.decoded(own, model.codes(rests.reshape(len(rows), -1))), [], []
    asked = dice.choice(len(rows), min(TRIAL_QUERIES, len(rows)), replace=False)
    order = model.nearest_centres(rows[asked], len(model.centres))
    for at in range(0, len(asked), 16):
        some = asked[at : at + 16]
        for q, by, true, near in zip(some.tolist(), order[at:], _distances(rows[some], rows), _distances(rows[some], coded)):
            true[q] = near[q] = np.inf
            found = np.argsort(true, kind="stable")[: min(k, len(rows) - 1)]
            rank = np.empty(len(by), dtype=np.int64)
            rank[by] = np.arange(len(by))
            place += rank[own[found]].tolist()
            misses += (near[found] - np.partition(near, len(found) - 1)[len(found) - 1]).tolist()
    share = 1 - (1 - recall) / 4
    model.probes = int(np.quantile(place, share, method="higher")) + 1
    model.margin = max(0.0, float(np.quantile(misses, share, method="higher")))
    return model


def _usable(vector: str) -> Column:
    wide = F.transform(vector, lambda x: x.cast("double"))
    fine = F.forall(wide, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(fine & F.exists(wide, lambda x: x != 0), F.lit(False))


class VectorIndex:
    """A stored index: folder ``model`` (one row) and folder ``rows`` with a folder for each centre."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path
        kept = spark.read.parquet(f"{path}/model").first()
        arrays = np.load(io.BytesIO(bytes(kept.arrays)), allow_pickle=False)
        self.model = Model(kept.metric, arrays["centres"], arrays["parts"], kept.probes, kept.margin)
        self.dim, self.id_col = kept.dim, kept.id_col

    def rows(self) -> DataFrame:
        """``centre, id, code, vector``; a filter on ``centre`` reads its folders only."""
        return self.spark.read.parquet(f"{self.path}/rows")

    def sizes(self) -> DataFrame:
        """Rows of each centre."""
        return self.spark.read.parquet(f"{self.path}/sizes")


def _code_rows(model: Model, dim: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            vectors = batch.column(1).flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)
            rows = model.prepared(vectors)
            own = _nearest(rows, model.centres)
            codes = model.codes(rows - model.centres[own])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(own, pa.int32()), pa.array([c.tobytes() for c in codes], pa.binary()), batch.column(1)],
                names=["id", "centre", "code", "vector"],
            )
    return run


def write_vector_index(
    df: DataFrame, path: str, metric: str = "cosine", id_col: str = "id_page", vector_col: str = "embedding",
    n_centres: int | None = None, recall: float = 0.95, k: int = 10,
) -> VectorIndex:
    """Fit and store an index of all rows under ``path``.

    ``metric`` is cosine or l2. Vectors that are null, zero, or hold null or non-finite numbers are left out; all
    others must have one length. ``n_centres`` is the square root of the number of rows, within bounds, if not given.
    """
    if metric not in ("cosine", "l2"):
        raise ValueError("an index serves cosine and l2")
    spark = df.sparkSession
    given = df.select(F.col(id_col).alias("id"), F.transform(vector_col, lambda x: x.cast("float")).alias("vector")).where(_usable("vector"))
    n, least, dim = given.agg(F.count("*"), F.min(F.size("vector")), F.max(F.size("vector"))).first()
    if n == 0 or least != dim:
        raise ValueError("no vectors" if n == 0 else "vectors of different lengths")
    limit = min(SAMPLE_ROWS, max(MOST_CODES, SAMPLE_NUMBERS // dim))
    sample = given.orderBy(F.xxhash64("id"), "id").limit(limit).select("vector").toArrow()["vector"].combine_chunks()
    rows = sample.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)
    centres = n_centres or max(1, min(MOST_CENTRES, round(n**0.5)))
    model = fit(rows, metric, centres, recall, k)
    kind = df.schema[id_col].dataType.simpleString()
    coded = given.mapInArrow(_code_rows(model, dim), f"id {kind}, centre int, code binary, vector array<float>")
    # A centre with very many rows is written by several tasks.
    spread = F.pmod(F.xxhash64("id"), F.lit(max(1, n // (CELL_ROWS * len(model.centres)))))
    coded.repartition("centre", spread).write.mode("overwrite").partitionBy("centre").parquet(f"{path}/rows")
    stored = spark.read.parquet(f"{path}/rows")
    stored.groupBy("centre").agg(F.count("*").alias("n")).write.mode("overwrite").parquet(f"{path}/sizes")
    arrays = io.BytesIO()
    np.savez(arrays, centres=model.centres, parts=model.parts)
    spark.createDataFrame(
        [(metric, dim, id_col, model.probes, model.margin, bytearray(arrays.getvalue()))],
        "metric string, dim int, id_col string, probes int, margin double, arrays binary",
    ).write.mode("overwrite").parquet(f"{path}/model")
    return VectorIndex(spark, path)


class _Probing:
    """The queries of a task: which centres each probes, and its ``k`` least distances as coded rows pass by.

    Distances come from a matrix product, without the query's own square, in single precision for unit vectors; ``slack``
    bounds their error. What is handed on is computed again one by one in double precision.
    """

    def __init__(self, model: Model, vectors: np.ndarray, k: int, n_probes: int) -> None:
        self.model, self.k, self.vectors = model, k, model.prepared(vectors)
        single = model.metric == "cosine"
        self.form = (-2 * self.vectors).astype("float32" if single else "float64")
        self.lengths, self.unit = np.sqrt((self.vectors * self.vectors).sum(axis=1)), 2.0 ** (-23 if single else -50) * (vectors.shape[1] + 8)
        probed = np.zeros((len(model.centres), len(vectors)), dtype=bool)
        for at in range(0, len(vectors), CELL_QUERIES):
            chosen = model.nearest_centres(self.vectors[at : at + CELL_QUERIES], n_probes)
            probed[chosen, np.arange(at, at + len(chosen))[:, None]] = True
        self.probed = probed
        self.best = np.full((len(vectors), k), np.inf, dtype=self.form.dtype)
        self.last = np.full(len(vectors), np.inf)  # k-th best

    def meet(self, centre: int, codes: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """Rows of one centre: ``(query, row, distance, slack)`` of those within the margin so far, by blocks."""
        asked = np.flatnonzero(self.probed[centre])
        if not len(asked):
            return
        rows = self.model.decoded(np.full(len(codes), centre), codes)
        squares = (rows * rows).sum(axis=1)
        turned, added, longest = rows.T.astype(self.form.dtype), squares.astype(self.form.dtype), np.sqrt(squares.max())
        step = max(1, BLOCK_NUMBERS // len(codes))
        for at in range(0, len(asked), step):
            q = asked[at : at + step]
            near = self.form[q] @ turned
            near += added
            least = near.min(axis=1)
            better = np.flatnonzero(least < self.last[q])
            if len(better):
                both = np.concatenate([self.best[q[better]], near[better]], axis=1)
                self.best[q[better]] = np.partition(both, self.k - 1, axis=1)[:, : self.k]
                self.last[q[better]] = self.best[q[better]].max(axis=1)
            slack = self.unit * (self.lengths[q] + longest) ** 2
            limit = self.last[q] + self.model.margin + 2 * slack
            some = np.flatnonzero(least <= limit)
            who, row = np.nonzero(near[some] <= limit[some, None])
            yield q[some[who]], row, near[some[who], row].astype("float64"), slack[some[who]]


class _Found:
    """Coded rows found that wait until the k-th best is known better."""

    def __init__(self, probing: _Probing, names: pa.Array, kinds: tuple[pa.DataType, pa.DataType]) -> None:
        self.probing, self.names, self.kinds, self.parts, self.n = probing, names, kinds, [], 0
        self.most = max(1 << 14, WAITING_BYTES // (len(probing.model.parts) + 48))

    def add(self, centre: int, ids: pa.Array, codes: np.ndarray) -> Iterator[pa.RecordBatch]:
        for q, row, near, slack in self.probing.meet(centre, codes):
            self.parts.append((q, near, slack, np.full(len(q), centre), codes[row], ids.take(pa.array(row))))
            self.n += len(q)
        if self.n > self.most:
            self.thin()
            if self.n > self.most // 2:
                yield from self.given()

    def thin(self) -> None:
        """Drop what is beyond the margin by now."""
        kept, self.n = [], 0
        for part in self.parts:
            q, near, slack = part[:3]
            on = np.flatnonzero(near <= self.probing.last[q] + self.probing.model.margin + 2 * slack)
            if len(on):
                kept.append((*(x[on] for x in part[:5]), part[5].take(pa.array(on))))
                self.n += len(on)
        self.parts = [(*(np.concatenate(x) for x in list(zip(*kept))[:5]), pa.concat_arrays([x[5] for x in kept]))] if kept else []

    def given(self) -> Iterator[pa.RecordBatch]:
        self.thin()
        for q, _, _, own, codes, ids in self.parts:
            for at in range(0, len(q), 1 << 14):
                part = slice(at, at + (1 << 14))
                near = ((self.probing.vectors[q[part]] - self.probing.model.decoded(own[part], codes[part])) ** 2).sum(axis=1)
                yield pa.RecordBatch.from_arrays([
                    self.names.take(pa.array(q[part])).cast(self.kinds[0]), ids[part].cast(self.kinds[1]), pa.array(own[part], pa.int32()), pa.array(near),
                ], names=["query_id", "id", "centre", "near"])
        self.parts, self.n = [], 0


def _near_rows(model: Model, dim: int, k: int, n_probes: int, kinds: tuple[pa.DataType, pa.DataType]):
    """Rows ``(turn, centre, query_id, id, vector, code)`` in order, ``turn`` being twice the cell and one more for rows: a
    cell's queries are held, its coded rows pass by. Gives ``(query_id, id, centre, near)`` within the margin of the
    cell's own k-th best."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, waiting, found = None, [], None
        for batch in batches:
            turns, centres = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            cuts = [0, *(np.flatnonzero((np.diff(turns) != 0) | (np.diff(centres) != 0)) + 1).tolist(), len(turns)]
            for a, b in zip(cuts, cuts[1:]):
                if a == b:
                    continue
                (here, is_row), part = divmod(int(turns[a]), 2), batch.slice(a, b - a)
                if here != cell:
                    if found is not None:
                        yield from found.given()
                    cell, waiting, found = here, [], None
                if not is_row:
                    waiting.append(part)
                    continue
                if found is None:
                    if not waiting:
                        continue
                    asked = np.concatenate([w.column(4).flatten().to_numpy(zero_copy_only=False) for w in waiting]).reshape(-1, dim)
                    found, waiting = _Found(_Probing(model, asked, k, n_probes), pa.concat_arrays([w.column(2) for w in waiting]), kinds), []
                codes = np.frombuffer(b"".join(part.column(5).to_pylist()), dtype=np.uint8).reshape(len(part), -1)
                yield from found.add(int(centres[a]), part.column(3), codes)
        if found is not None:
            yield from found.given()
    return run


def semantic_topk_index(
    index: VectorIndex, queries: DataFrame, k: int = 10, query_col: str = "query_id", vector_col: str = "embedding", probes: int | None = None,
) -> DataFrame:
    """The ``k`` nearest found of each query: ``query_id, id, score, rows_coded, rows_scored``.

    Nearest first by exact score, ties by id. ``rows_coded`` are the rows whose codes were read for the query and
    ``rows_scored`` those whose vectors were. Query identifiers are distinct; unusable query vectors give no rows, those of another length than the
    index are an error.
    """
    from pyspark.sql.pandas.types import to_arrow_type

    model, dim = index.model, index.dim
    score, larger = METRICS[model.metric]
    asked = queries.select(F.col(query_col).alias("query_id"), F.transform(vector_col, lambda x: x.cast("double")).alias("asked")).where(_usable("asked"))
    fits = F.when(F.size("asked") != dim, F.raise_error(F.lit("vectors of different lengths"))).otherwise(F.col("asked"))
    asked = materialize(asked.select("query_id", fits.alias("asked")), "asked")
    n_probes = min(probes or model.probes, len(model.centres))

    sizes = np.zeros(len(model.centres), dtype=np.int64)
    for row in index.sizes().collect():  # a row for each centre
        sizes[row.centre] = row.n

    def probed(vectors: pa.Array) -> pa.Array:
        rows = model.prepared(vectors.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim))
        return pa.array([int(sizes[model.nearest_centres(rows[at : at + 1], n_probes)].sum()) for at in range(len(rows))], pa.int64())

    coded = asked.select("query_id", F.arrow_udf(probed, "long")("asked").alias("rows_coded"))
    stored = index.rows()
    n, n_asked, tasks = int(sizes.sum()), asked.count(), 2 * queries.sparkSession.sparkContext.defaultParallelism
    lines = max(1, -(-n_asked * (dim + len(sizes)) // QUERY_NUMBERS), min(math.ceil(tasks**0.5), -(-n_asked // 1024)))
    columns = max(1, min(-(-tasks // lines), -(-n // 1024)))
    kinds = [d.schema[c].dataType for d, c in ((asked, "query_id"), (stored, "id"))]
    none = [F.lit(None).cast(k) for k in kinds]

    def dealt(side: DataFrame, is_row: int, key: str) -> DataFrame:
        own = F.pmod(F.xxhash64(key), F.lit(columns if is_row else lines))
        every = F.explode(F.sequence(F.lit(0).cast("long"), F.lit((lines if is_row else columns) - 1).cast("long")))
        placed = side.withColumn("_own", own).withColumn("_every", every)
        cell = F.col("_every") * columns + F.col("_own") if is_row else F.col("_own") * columns + F.col("_every")
        return placed.select((2 * cell + is_row).alias("turn"), "centre", "query_id", "id", "vector", "code")

    left = asked.select(F.lit(-1).alias("centre"), "query_id", none[1].alias("id"), F.col("asked").alias("vector"), F.lit(None).cast("binary").alias("code"))
    right = stored.select("centre", none[0].alias("query_id"), "id", F.lit(None).cast("array<double>").alias("vector"), "code")
    grid = dealt(left, 0, "query_id").unionByName(dealt(right, 1, "id")).repartitionById(lines * columns, F.expr("turn div 2").cast("int"))
    names = [t.simpleString() for t in kinds]
    near = grid.sortWithinPartitions("turn", "centre").mapInArrow(
        _near_rows(model, dim, k, n_probes, tuple(to_arrow_type(t) for t in kinds)), f"query_id {names[0]}, id {names[1]}, centre int, near double"
    )
    # Over all cells of a query the k-th best is better than in any one of them.
    place = F.row_number().over(Window.partitionBy("query_id").orderBy("near", "id"))
    whole = Window.partitionBy("query_id")
    kept = near.withColumn("place", place).withColumn("bound", F.max(F.when(F.col("place") <= k, F.col("near"))).over(whole) + F.lit(model.margin))
    kept = kept.where("near <= bound").select("query_id", "id", "centre")
    vectors = stored.select("centre", "id", "vector")
    scored = kept.join(vectors, ["centre", "id"]).join(asked, "query_id").select("query_id", "id", score(F.col("vector"), F.col("asked")).alias("score"))
    order = [F.desc("score") if larger else F.asc("score"), F.asc("id")]
    ranked = scored.withColumns({
        "rows_scored": F.count("*").over(whole), "_rank": F.row_number().over(whole.orderBy(*order)),
    }).where(F.col("_rank") <= k)
    return ranked.join(coded, "query_id").select("query_id", "id", "score", "rows_coded", "rows_scored")
