"""Bloom filters stored beside a large keyed table.

Keys are dealt to buckets by hash; the table is stored in a folder for each bucket and each bucket has a split-block
Bloom filter: blocks of eight 32-bit words, a key sets one bit in each word of one block. A filter says "surely not
here" or "maybe". A delta asks the filters first, and only the buckets of keys that are maybe there are read.

Filters are sums: that of a union is the bitwise or, so tasks make partial filters and a version's filters come from
those of the version before and the new keys alone.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from presslake.session import materialize

#: Bits for each key that a filter is laid out for; about one key in 500 that isn't there is taken for maybe.
BITS_PER_KEY = 16
#: Buckets whose folders are listed one by one; with more of them hit the bucket column is joined instead.
LISTED_BUCKETS = 4096

# Odd multipliers that choose the bit in each of a block's words.
_SALTS = np.array(
    [0x47B6137B, 0x44974D91, 0x8824AD5B, 0xA2B7289D, 0x705495C7, 0x2DF1424B, 0x9EFC4947, 0x5C6BFB31], dtype=np.uint32
)
_SCHEMA = "bucket int, n_keys bigint, words binary"


def key_hash(key: str) -> Column:
    """The hash that buckets, blocks and bits come from."""
    return F.xxhash64(F.col(key).cast("string"), F.lit(17))


def bucket_of(hashed: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(hashed), F.lit(buckets)).cast("int")


def _bits(hashes: np.ndarray, blocks: int) -> tuple[np.ndarray, np.ndarray]:
    """Block of each hash, and the bit of each of its words as masks."""
    h = hashes.view(np.uint64)
    block = ((h >> np.uint64(32)) * np.uint64(blocks)) >> np.uint64(32)
    low = (h & np.uint64(0xFFFFFFFF)).astype(np.uint32)
    return block.astype(np.int64), np.uint32(1) << ((low[:, None] * _SALTS) >> np.uint32(27))


def partial_filter(hashes: np.ndarray, blocks: int) -> np.ndarray:
    words = np.zeros((blocks, 8), dtype=np.uint32)
    block, masks = _bits(hashes, blocks)
    for i in range(8):
        np.bitwise_or.at(words[:, i], block, masks[:, i])
    return words


def maybe_there(hashes: np.ndarray, words: np.ndarray) -> np.ndarray:
    block, masks = _bits(hashes, len(words))
    return ((words[block] & masks) == masks).all(axis=1)


def key_filters(keys: DataFrame, key: str, buckets: int, keys_per_bucket: int) -> DataFrame:
    """``bucket, n_keys, words`` of the keys given; null keys are in no filter."""
    blocks = max(1, -(-keys_per_bucket * BITS_PER_KEY // 256))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Rows come bucket by bucket, so a task holds one filter at a time.
        own, n, words = None, 0, None
        for batch in batches:
            bucket, hashes = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            turns = np.flatnonzero(np.diff(bucket)) + 1
            for a, b in zip([0, *turns.tolist()], [*turns.tolist(), len(bucket)], strict=True):
                if a == b:
                    continue
                if bucket[a] != own:
                    if own is not None:
                        yield _rows([own], [n], [words])
                    own, n, words = int(bucket[a]), 0, np.zeros((blocks, 8), dtype=np.uint32)
                words |= partial_filter(hashes[a:b], blocks)
                n += b - a
        if own is not None:
            yield _rows([own], [n], [words])

    hashed = keys.where(F.col(key).isNotNull()).select(key_hash(key).alias("_h"))
    dealt = hashed.select(bucket_of(F.col("_h"), buckets).alias("bucket"), "_h").repartition("bucket").sortWithinPartitions("bucket")
    return dealt.mapInArrow(run, _SCHEMA)


def _rows(buckets: list[int], counts: list[int], filters: list[np.ndarray]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(buckets, pa.int32()), pa.array(counts, pa.int64()), pa.array([w.astype("<u4").tobytes() for w in filters], pa.binary())],
        names=["bucket", "n_keys", "words"],
    )


def merged_filters(*parts: DataFrame) -> DataFrame:
    """One filter for each bucket, the bitwise or of all; ``n_keys`` add up."""
    every = parts[0]
    for part in parts[1:]:
        every = every.unionByName(part)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, n, words = None, 0, None
        for batch in batches:
            for bucket, count, raw in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                one = np.frombuffer(raw, dtype="<u4").reshape(-1, 8)
                if bucket == own:
                    words, n = words | one, n + count
                    continue
                if own is not None:
                    yield _rows([own], [n], [words])
                own, n, words = bucket, count, one
        if own is not None:
            yield _rows([own], [n], [words])

    return every.select("bucket", "n_keys", "words").repartition("bucket").sortWithinPartitions("bucket").mapInArrow(run, _SCHEMA)


def with_maybe(rows: DataFrame, key: str, filters: DataFrame, buckets: int) -> DataFrame:
    """``rows`` with ``_bucket`` and ``_maybe``: false if the key is surely not among those of the filters.

    Rows and filters meet by bucket, the filter first, so a task holds one filter at a time. Rows without a key are
    surely not there.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, words = None, None
        for batch in batches:
            bucket, hashes = batch.column(0).to_numpy(), batch.column(1)
            found = np.zeros(len(bucket), dtype=bool)
            turns = np.flatnonzero(np.diff(bucket)) + 1
            for a, b in zip([0, *turns.tolist()], [*turns.tolist(), len(bucket)], strict=True):
                if a == b:
                    continue
                if bucket[a] != own:
                    own, words = bucket[a], None
                raw = batch.column(2)[a].as_py()
                if raw is not None:
                    words, a = np.frombuffer(raw, dtype="<u4").reshape(-1, 8), a + 1
                if words is not None and a < b:
                    found[a:b] = maybe_there(hashes.slice(a, b - a).to_numpy(), words)
            keep = np.flatnonzero(found)
            yield pa.RecordBatch.from_arrays([pa.array(bucket[keep]), hashes.take(pa.array(keep))], names=["_bucket", "_h"])

    hashed = key_hash(key)
    asked = rows.where(F.col(key).isNotNull()).select(bucket_of(hashed, buckets).alias("bucket"), hashed.alias("_h"), F.lit(None).cast("binary").alias("words"))
    known = filters.select("bucket", F.lit(0).cast("bigint").alias("_h"), "words")
    ordered = known.unionByName(asked.distinct()).repartition("bucket").sortWithinPartitions("bucket", F.col("words").isNull())
    hits = ordered.mapInArrow(run, "_bucket int, _h bigint").distinct()
    with_hash = rows.withColumn("_h", hashed)
    return with_hash.join(hits, "_h", "left").withColumn("_maybe", F.col("_bucket").isNotNull()).drop("_h")


class FilteredTable:
    """A keyed table under ``path``: ``rows/version=V/bucket=B`` holds what version V added, ``filters/version=V`` the
    filters of all versions up to V. A version counts once its filters are there; they are written last."""

    def __init__(
        self, spark: SparkSession, path: str, key: str, surrogate: str, buckets: int, keys_per_bucket: int, below: int | None = None,
    ) -> None:
        self.spark, self.path, self.key, self.surrogate = spark, path.rstrip("/"), key, surrogate
        self.buckets, self.keys_per_bucket, self.below = buckets, keys_per_bucket, below

    def before(self, version: int) -> FilteredTable:
        """The table as it was before a version."""
        return FilteredTable(self.spark, self.path, self.key, self.surrogate, self.buckets, self.keys_per_bucket, version)

    def version(self) -> int | None:
        """The latest whole version."""
        try:
            whole = self.spark.read.schema(f"{_SCHEMA}, version int").parquet(f"{self.path}/filters").select("version")
            return (whole if self.below is None else whole.where(F.col("version") < self.below)).agg(F.max("version")).first()[0]
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
        return None

    def filters(self) -> DataFrame:
        return self.spark.read.schema(_SCHEMA).parquet(f"{self.path}/filters/version={self.version()}")

    def rows(self) -> DataFrame:
        """All rows, with ``version`` and ``bucket``; a filter on ``bucket`` reads its folders only."""
        return self.spark.read.parquet(f"{self.path}/rows").where(F.col("version") <= F.lit(self.version()))

    def append(self, rows: DataFrame) -> int:
        """Add rows of new keys as the next version; as it was ``before`` a version, as that version, again if need be."""
        before = self.version()
        now = self.below if self.below is not None else 0 if before is None else before + 1
        bucket = bucket_of(key_hash(self.key), self.buckets)
        folder = f"{self.path}/rows/version={now}"
        rows.withColumn("bucket", bucket).repartition("bucket").sortWithinPartitions("bucket", self.key).write.mode("overwrite").partitionBy("bucket").parquet(folder)
        stored = self.spark.read.schema(rows.schema).parquet(folder)  # may hold no file
        added = key_filters(stored, self.key, self.buckets, self.keys_per_bucket)
        made = added if before is None else merged_filters(self.filters(), added)
        highest = stored.agg(F.max(self.surrogate).cast("bigint").alias("top"))
        highest.write.mode("overwrite").parquet(f"{self.path}/tops/version={now}")
        made.write.mode("overwrite").parquet(f"{self.path}/filters/version={now}")
        return now

    def top(self) -> Column:
        """The highest surrogate key, from a row for each version."""
        tops = self.spark.read.schema("top bigint, version int").parquet(f"{self.path}/tops").where(F.col("version") <= self.version())
        return tops.agg(F.coalesce(F.max("top"), F.lit(0))).scalar()

    def stored_hits(self, delta: DataFrame) -> tuple[DataFrame, DataFrame]:
        """``(asked, near)``: the delta with ``_maybe``, written once, and the stored rows of buckets that hold a key
        which is maybe there."""
        asked = materialize(with_maybe(delta, self.key, self.filters(), self.buckets), "asked")
        hit = asked.where("_maybe").select(F.col("_bucket").alias("bucket")).distinct()
        listed = [r.bucket for r in hit.limit(LISTED_BUCKETS + 1).collect()]
        if not listed:
            near = asked.where(F.lit(False)).select(self.key, F.lit(None).cast("bigint").alias(self.surrogate))
        elif len(listed) > LISTED_BUCKETS:
            near = self.rows().join(hit, "bucket", "left_semi")
        else:
            near = self.rows().where(F.col("bucket").isin(listed))
        return asked.drop("_bucket"), near


def existing_key_lookup_filtered(delta: DataFrame, table: FilteredTable) -> DataFrame:
    """``existing_key_lookup`` that reads only what the filters let through."""
    asked, near = table.stored_hits(delta)
    known = near.select(F.col(table.key).alias("_k"), table.surrogate)
    return asked.join(known, F.col("_maybe") & (F.col(table.key) == F.col("_k")), "left").drop("_k", "_maybe")


def absent_filtered(delta: DataFrame, table: FilteredTable) -> DataFrame:
    """Delta rows whose key is not stored."""
    if table.version() is None:
        return delta
    asked, near = table.stored_hits(delta)
    maybe = asked.where("_maybe").join(near.select(table.key), table.key, "left_anti")
    return asked.where("not _maybe").unionByName(maybe.select(*asked.columns)).drop("_maybe")
