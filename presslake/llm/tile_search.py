"""Nearest neighbours by a block matrix join of int8 products with error bounds.

Every vector is scaled to unit length and rounded to int8 steps of its own size; what rounding took away is known by
its length. A tile of int8 products then gives cosines with a bound on their error, pair by pair: with ``u = a + r``
and ``v = b + s`` (``a``, ``b`` the rounded ones) ``|u.v - a.b| <= |r| + |a||s|``. Pairs whose upper bound lies below
the k-th best known of their query are out for certain; the others are computed again in double precision and go into
the query's heap of ``k``. So the result is that of comparing everything, ties included.

Queries and rows are dealt over a grid of groups by hash; a task holds one group of queries and streams one group of
rows past it. Heaps of a query meet in a last step, ``k`` entries from each group of rows.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from presslake.llm.common import table, written
from presslake.llm.registry import query

#: Queries that one task holds at most, about, and rows that it streams past them.
QUERY_GROUP = 65_536
ROW_GROUP = 1 << 20
#: Least rows of a group, so that small tables aren't cut to crumbs.
LEAST_GROUP = 4_096
#: Rows and queries of one tile, and pairs computed again at once.
TILE_ROWS, TILE_QUERIES, PAIRS_AT_ONCE = 4_096, 1_024, 1 << 18
#: Products of int8 sum without rounding in single precision over so many numbers.
EXACT_WIDTH = 1_024
#: More than single precision can lose in scaling a product, as cosines are at most about one.
SLACK = 4e-6


class Rounded:
    """Unit vectors in double precision with their int8 form, step, and lengths of the form and of what is left."""

    def __init__(self, vectors: np.ndarray) -> None:
        # Powers of two scale without rounding, so no square overflows.
        scaled = np.ldexp(vectors, -np.frexp(np.abs(vectors).max(axis=1))[1][:, None])
        self.scaled, self.lengths = scaled, np.sqrt((scaled * scaled).sum(axis=1))
        unit = scaled / self.lengths[:, None]
        step = np.abs(unit).max(axis=1) / 127
        self.codes = np.rint(unit / step[:, None]).astype(np.int8)
        form = self.codes * step[:, None]
        self.step, self.form = step.astype(np.float32), np.sqrt((form * form).sum(axis=1)).astype(np.float32)
        rest = unit - form
        self.rest = np.sqrt((rest * rest).sum(axis=1)).astype(np.float32)


def tile(asked: Rounded, q: slice, rows: Rounded, r: slice) -> tuple[np.ndarray, np.ndarray]:
    """Cosines of the int8 forms and the bound on their error, for queries ``q`` and rows ``r``."""
    left, right = asked.codes[q], rows.codes[r]
    wide = left.shape[1] > EXACT_WIDTH
    products = np.zeros((len(left), len(right)), dtype=np.float64 if wide else np.float32)
    for at in range(0, left.shape[1], EXACT_WIDTH):  # whole numbers below 2**24 in each
        products += left[:, at : at + EXACT_WIDTH].astype(np.float32) @ right[:, at : at + EXACT_WIDTH].astype(np.float32).T
    products *= asked.step[q, None] * rows.step[None, r]
    return products, asked.rest[q, None] + asked.form[q, None] * rows.rest[None, r] + np.float32(SLACK)


def exact(asked: Rounded, q: np.ndarray, rows: Rounded, r: np.ndarray) -> np.ndarray:
    """Cosines of pairs in double precision."""
    out = np.empty(len(q))
    for at in range(0, len(q), PAIRS_AT_ONCE):
        a, b = q[at : at + PAIRS_AT_ONCE], r[at : at + PAIRS_AT_ONCE]
        out[at : at + PAIRS_AT_ONCE] = (asked.scaled[a] * rows.scaled[b]).sum(axis=1) / (asked.lengths[a] * rows.lengths[b])
    return out


class Heaps:
    """For each query of a group the ``k`` best rows so far; worst first, so that one is replaced."""

    def __init__(self, own: np.ndarray, k: int) -> None:
        self.k, self.own, self.heaps = k, own, [[] for _ in own]
        self.least = np.full(len(own), -np.inf)  # the k-th best, once there is one
        self.pairs = self.again = 0

    def add(self, q: int, entry: tuple) -> None:
        heap = self.heaps[q]
        if len(heap) < self.k:
            heapq.heappush(heap, entry)
        elif entry > heap[0]:
            heapq.heapreplace(heap, entry)
        if len(heap) == self.k:
            self.least[q] = heap[0][0]

    def meet(self, asked: Rounded, rows: Rounded, numbers: np.ndarray, ids: list) -> None:
        """Bring a block of rows to all queries, a tile at a time."""
        n, m = len(self.own), len(numbers)
        for at in range(0, n, TILE_QUERIES):
            q = slice(at, min(n, at + TILE_QUERIES))
            for start in range(0, m, TILE_ROWS):
                r = slice(start, min(m, start + TILE_ROWS))
                near, bound = tile(asked, q, rows, r)
                other = numbers[None, r] != self.own[q, None]
                self.pairs += int(other.sum())
                low = np.where(other, near - bound, -np.inf)
                # The k-th best lower bound of the tile holds for the query as well.
                floor = np.partition(low, -self.k, axis=1)[:, -self.k] if low.shape[1] >= self.k else np.full(len(low), -np.inf)
                least = np.maximum(self.least[q], floor)
                who, which = np.nonzero(other & (near + bound >= least[:, None]))
                self.again += len(who)
                scores = exact(asked, who + at, rows, which + start)
                good = scores >= self.least[q][who]
                for a, b, s in zip((who[good] + at).tolist(), (which[good] + start).tolist(), scores[good].tolist(), strict=True):
                    self.add(a, (s, _low(ids[b]), -int(numbers[b]), ids[b]))


def _low(identifier: int | None) -> float | int:
    """Greater for smaller identifiers; least for none."""
    return -np.inf if identifier is None else -identifier


def _vectors(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1)


def _search(k: int, kind: pa.DataType):
    """Rows ``(column, line, dim, is_row, id, number, vector)`` in order: queries of a tile of the grid, then its rows."""
    def found(heaps: Heaps, query_ids: list) -> Iterator[pa.RecordBatch]:
        out = [(i, own, e[3], -e[2], e[0]) for i, own, h in zip(query_ids, heaps.own.tolist(), heaps.heaps, strict=True) for e in h]
        columns = list(zip(*out, strict=True)) or [[]] * 5
        arrays = [pa.array(c, t) for c, t in zip(columns, (kind, pa.int64(), kind, pa.int64(), pa.float64()), strict=True)]
        tally = [pa.array([0] * len(out), pa.int64())] * 2
        if out:
            tally = [pa.array([x] + [0] * (len(out) - 1), pa.int64()) for x in (heaps.pairs, heaps.again)]
        yield pa.RecordBatch.from_arrays([*arrays, *tally], names=["query_id", "own", "vec_id", "number", "score", "pairs", "again"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, waiting, heaps, asked, query_ids = None, [], None, None, []
        for batch in batches:
            keys = np.stack([c.to_numpy() for c in batch.columns[:4]])
            turns = np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1
            for a, b in zip([0, *turns.tolist()], [*turns.tolist(), batch.num_rows], strict=True):
                part, here = batch.slice(a, b - a), tuple(keys[:3, a].tolist())
                if here != place:
                    if heaps is not None:
                        yield from found(heaps, query_ids)
                    place, waiting, heaps = here, [], None
                if not keys[3, a]:
                    waiting.append(part)
                    continue
                if heaps is None:
                    if not waiting:
                        continue  # rows of a length that no query has
                    query_ids = [i for w in waiting for i in w.column(4).to_pylist()]
                    asked = Rounded(np.concatenate([_vectors(w.column(6)) for w in waiting]))
                    heaps, waiting = Heaps(np.concatenate([w.column(5).to_numpy() for w in waiting]), k), []
                heaps.meet(asked, Rounded(_vectors(part.column(6))), part.column(5).to_numpy(), part.column(4).to_pylist())
        if heaps is not None:
            yield from found(heaps, query_ids)
    return run


def _goodness(row: tuple) -> tuple:
    return row[4], _low(row[2]), -row[3]


def _merge(k: int, kind: pa.DataType):
    """The best ``k`` of each query from rows ``(own, query_id, vec_id, number, score)`` that come query by query."""
    def best(rows: list[tuple]) -> list[tuple]:
        top = heapq.nlargest(k, rows, key=_goodness)
        return [(r[1], rank, r[2], r[4]) for rank, r in enumerate(top, 1)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[tuple] = []
        for batch in batches:
            out: list[tuple] = []
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if waiting and row[0] != waiting[0][0]:
                    out += best(waiting)
                    waiting = []
                waiting.append(row)
                if len(waiting) > 64 * k:  # many groups of rows: keep the heap's entries only
                    waiting = heapq.nlargest(k, waiting, key=_goodness)
            yield _ranked(out, kind)
        yield _ranked(best(waiting), kind)
    return run


def _ranked(rows: list[tuple], kind: pa.DataType) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [[]] * 4
    types = (kind, pa.int32(), kind, pa.float64())
    return pa.RecordBatch.from_arrays(
        [pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=["query_id", "rank", "vec_id", "score"]
    )


def usable(vector: str) -> Column:
    """A vector with numbers other than zero, all of them finite."""
    wide = F.transform(vector, lambda x: x.cast("double"))
    fine = F.forall(wide, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(fine & F.exists(wide, lambda x: x != 0), F.lit(False))


def _up_to(n: int) -> Column:
    return F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long"))


class Search:
    """A search laid out over tasks: ``nearest()`` gives the rows, ``work()`` what it took, from one written table."""

    def __init__(self, heaps: DataFrame, k: int, kind: str, arrow: pa.DataType) -> None:
        self._heaps, self._k, self._kind, self._arrow = heaps, k, kind, arrow

    def nearest(self) -> DataFrame:
        """``query_id, rank, vec_id, score``: nearest first, ties to the smaller identifier."""
        near = self._heaps.select("own", "query_id", "vec_id", "number", "score")
        return near.repartition("own").sortWithinPartitions("own").mapInArrow(
            _merge(self._k, self._arrow), f"query_id {self._kind}, rank int, vec_id {self._kind}, score double"
        )

    def work(self) -> DataFrame:
        """``pairs`` compared by their int8 forms and ``again``, those computed in double precision."""
        return self._heaps.agg(F.coalesce(F.sum("pairs"), F.lit(0)).alias("pairs"), F.coalesce(F.sum("again"), F.lit(0)).alias("again"))


def tile_search(
    rows: DataFrame, is_query: Column, k: int = 5, key: str = "vec_id", vector: str = "embedding",
    query_group: int = QUERY_GROUP, row_group: int = ROW_GROUP, least_group: int = LEAST_GROUP,
) -> Search:
    """The ``k`` rows of largest cosine for each row where ``is_query`` holds, itself left out.

    Vectors that are null, empty, zero, or hold null or non-finite numbers take no part; those of different lengths
    never meet. Identifiers are whole numbers. Rows that repeat an identifier are rows of their own: each is a candidate to the others, and each a
    query if one is. A null identifier can be found (last among ties). Fewer candidates give fewer rows, an empty
    table none. Other columns of the input aren't read.
    """
    from pyspark.sql.pandas.types import to_arrow_type

    spark, kind = rows.sparkSession, rows.schema[key].dataType
    asked = F.coalesce(is_query, F.lit(False))
    given = rows.select(F.col(key).alias("id"), F.col(vector).alias("vector"), asked.alias("asks")).where(usable("vector"))
    given = written(given.select(
        "id", "asks", F.monotonically_increasing_id().alias("number"), F.transform("vector", lambda x: x.cast("double")).alias("vector"),
    ), "vectors")
    n, n_queries = given.agg(F.count("*"), F.count_if("asks")).first()
    lines = max(1, -(-n_queries // query_group))
    spread = max(1, 2 * spark.sparkContext.defaultParallelism // lines)
    columns = max(-(-n // row_group), min(spread, -(-n // least_group)), 1)
    mixed, dim = F.xxhash64("number"), F.size("vector").alias("dim")
    found = given.select(
        F.pmod(mixed, F.lit(columns)).cast("long").alias("column"), F.explode(_up_to(lines)).alias("line"),
        dim.cast("long"), F.lit(1).cast("long").alias("is_row"), "id", "number", "vector",
    )
    asks = given.where("asks").select(
        F.explode(_up_to(columns)).alias("column"), F.pmod(mixed, F.lit(lines)).cast("long").alias("line"),
        dim.cast("long"), F.lit(0).cast("long").alias("is_row"), "id", "number", "vector",
    )
    cell = (F.col("line") * columns + F.col("column")) % 100_000
    grid = found.unionByName(asks).repartitionById(min(lines * columns, 100_000), cell.cast("int"))
    ordered = grid.sortWithinPartitions("column", "line", "dim", "is_row")
    name, arrow = kind.simpleString(), to_arrow_type(kind)
    heaps = ordered.mapInArrow(
        _search(k, arrow), f"query_id {name}, own long, vec_id {name}, number long, score double, pairs long, again long"
    )
    return Search(written(heaps, "heaps"), k, name, arrow)


@query("op11_tile_search", """
with good as (
    select vec_id, list_transform(embedding, lambda x: x::double) as v from embeddings
    where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
        and len(list_filter(embedding, lambda x: x <> 0)) > 0
), scored as (
    select q.vec_id as query_id, c.vec_id, list_dot_product(q.v, c.v) / sqrt(list_dot_product(q.v, q.v)) / sqrt(list_dot_product(c.v, c.v)) as score
    from good q join good c on q.vec_id <> c.vec_id and len(q.v) = len(c.v) where q.vec_id % 50 = 0
), ranked as (
    select query_id, (row_number() over (partition by query_id order by score desc, vec_id))::int as rank, vec_id, score from scored
)
select * from ranked where rank <= 5
""")
def op11_tile_search(spark, sf_dir):
    return tile_search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0).nearest()
