"""Token ids in binary shard files with a minimal perfect hash index.

Documents stand in ascending order of their key, dealt by range into shards. A shard file holds

    magic | raw ids, little-endian | keys, document ends, index | length of that part | magic

The index maps each key to a slot without gaps: keys fall into small buckets, each bucket has a displacement that
sends its keys to free slots. A slot holds a fingerprint of its key and the key's first document. A lookup hashes
twice and reads one displacement and one slot, however many documents there are. Documents without a key come first in
the file and are found without the index. A key that very many documents have may span shards; its shards are those
whose range of keys holds it. Files are read by their end and by ranges, so they may have any size.
"""

from __future__ import annotations

import io
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from presslake.llm.common import table, whole_text, written
from presslake.llm.registry import query
from presslake.llm.tokens import Encoder, tokenizer_path
from presslake.session import scratch_path

MAGIC = b"IDSHARD1"
END_ID = 1
#: Bytes of text per shard, about.
SHARD_TEXT_BYTES = 32 << 20
_BUCKET_KEYS = 2
_MASK = (1 << 64) - 1
_GOLDEN = 0x9E3779B97F4A7C15
#: Bytes of ids read at once.
READ_BYTES = 16 << 20


def _mixed(x: np.ndarray, seed: int) -> np.ndarray:
    """A 64-bit mix of each key with a seed."""
    x = x.astype(np.uint64) + np.uint64((seed * _GOLDEN) & _MASK)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _slot(h: int, displacement: int, n: int) -> int:
    x = (h + displacement * _GOLDEN) & _MASK
    x = ((x ^ (x >> 32)) * 0xD6E8FEB86659FD93) & _MASK
    return (x ^ (x >> 32)) % n


class PerfectHash:
    """Maps ``n`` distinct 64-bit keys onto ``0 .. n - 1``; a key that was not given is told by its fingerprint."""

    def __init__(self, seed: int, displacements: np.ndarray, fingerprints: np.ndarray) -> None:
        self.seed, self.displacements, self.fingerprints = seed, displacements, fingerprints

    @classmethod
    def build(cls, keys: np.ndarray) -> PerfectHash:
        seed = 1
        while (made := cls._try(keys, seed)) is None:
            seed += 1
        return made

    @classmethod
    def _try(cls, keys: np.ndarray, seed: int) -> PerfectHash | None:
        n = len(keys)
        buckets = max(1, -(-n // _BUCKET_KEYS))
        hashes = _mixed(keys, seed)
        bucket = (hashes % np.uint64(buckets)).astype(np.int64)
        second = _mixed(keys, seed + 1000).tolist()
        prints = (_mixed(keys, seed + 2000) >> np.uint64(32)).astype("<u4")
        order = np.argsort(bucket, kind="stable")
        sizes = np.bincount(bucket, minlength=buckets)
        ends = np.cumsum(sizes)
        displacements, taken = np.zeros(buckets, dtype="<i8"), bytearray(n)
        stored, free = np.zeros(n, dtype="<u4"), 0
        for b in np.argsort(-sizes, kind="stable").tolist():
            size = int(sizes[b])
            if size == 0:
                break
            mine = order[ends[b] - size : ends[b]].tolist()
            if size == 1:  # any free slot does: kept as a negative number
                while taken[free]:
                    free += 1
                slots, displacements[b] = [free], -free - 1
            else:
                for d in range(1, 1_000_000):
                    slots = [_slot(second[i], d, n) for i in mine]
                    if len(set(slots)) == size and not any(taken[s] for s in slots):
                        displacements[b] = d
                        break
                else:
                    return None
            for i, s in zip(mine, slots, strict=True):
                taken[s], stored[s] = 1, prints[i]
        return cls(seed, displacements, stored)

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """The slot of each key, or -1 where the fingerprint tells that it isn't there."""
        n = len(self.fingerprints)
        if not n or not len(keys):
            return np.full(len(keys), -1, dtype=np.int64)
        d = self.displacements[(_mixed(keys, self.seed) % np.uint64(len(self.displacements))).astype(np.int64)]
        x = _mixed(keys, self.seed + 1000) + np.maximum(d, 0).astype(np.uint64) * np.uint64(_GOLDEN)
        x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
        found = np.where(d < 0, -d - 1, ((x ^ (x >> np.uint64(32))) % np.uint64(n)).astype(np.int64))
        prints = (_mixed(keys, self.seed + 2000) >> np.uint64(32)).astype("<u4")
        return np.where(self.fingerprints[found] == prints, found, -1)

    def slot(self, key: int) -> int | None:
        found = int(self.slots(np.asarray([key & _MASK], dtype=np.uint64))[0])
        return None if found < 0 else found


def index_bytes(shard: int, width: int, keys: list[int | None], ends: list[int]) -> bytes:
    """Keys of the documents in order, where each ends, and the index."""
    first = np.asarray([i for i, k in enumerate(keys) if k is not None and (i == 0 or k != keys[i - 1])], dtype="<i8")
    hashed = np.asarray([keys[i] & _MASK for i in first], dtype=np.uint64)
    index, slots = PerfectHash.build(hashed), np.zeros(len(first), dtype="<i8")
    slots[index.slots(hashed)] = first
    out = io.BytesIO()
    np.savez(
        out, shard=shard, width=width, seed=index.seed, displacements=index.displacements,
        fingerprints=index.fingerprints, first=slots, keys=np.asarray([k or 0 for k in keys], dtype="<i8"),
        null=np.asarray([k is None for k in keys], dtype=bool), ends=np.asarray(ends, dtype="<i8"),
    )
    return out.getvalue()


class Shard:
    """A shard file, open for reading: its end is in memory, ids are read by ranges."""

    def __init__(self, file: pa.NativeFile) -> None:
        self.file, size = file, file.size()
        end = self._read(size - 16, 16) if size >= 24 else b""
        if self._read(0, 8) != MAGIC or end[8:] != MAGIC:
            raise ValueError("not a whole shard file")
        tail = int.from_bytes(end[:8], "little")
        self.parts = dict(np.load(io.BytesIO(self._read(size - 16 - tail, tail)), allow_pickle=False))
        self.width, self.number = int(self.parts["width"]), int(self.parts["shard"])
        self.index = PerfectHash(int(self.parts["seed"]), self.parts["displacements"], self.parts["fingerprints"])
        self.n_null = int(self.parts["null"].sum())

    def _read(self, at: int, n: int) -> bytes:
        self.file.seek(at)
        return self.file.read(n)

    def __len__(self) -> int:
        return len(self.parts["keys"])

    def key(self, i: int) -> int | None:
        return None if self.parts["null"][i] else int(self.parts["keys"][i])

    def lookup(self, key: int | None) -> range:
        """Numbers of the documents with this key; empty if there is none."""
        if key is None:
            return range(self.n_null)
        slot = self.index.slot(key)
        if slot is None or self.key(i := int(self.parts["first"][slot])) != key:
            return range(0)
        return range(i, i + int(np.searchsorted(self.parts["keys"][i:], key, side="right")))

    def span(self, i: int) -> tuple[int, int]:
        return int(self.parts["ends"][i - 1]) if i else 0, int(self.parts["ends"][i])

    def ids(self, i: int) -> np.ndarray:
        return next(self.ids_of(range(i, i + 1)))

    def ids_of(self, documents: range) -> Iterator[np.ndarray]:
        """Ids of consecutive documents; about ``READ_BYTES`` are in memory at once, or one document."""
        i = documents.start
        while i < documents.stop:
            first = self.span(i)[0]
            last = int(np.searchsorted(self.parts["ends"], first + READ_BYTES // self.width, side="right"))
            last = min(max(last, i + 1), documents.stop)
            raw = self._read(8 + first * self.width, (self.span(last - 1)[1] - first) * self.width)
            whole = np.frombuffer(raw, dtype=f"<u{self.width}")
            for j in range(i, last):
                a, b = self.span(j)
                yield whole[a - first : b - first]
            i = last


def write_shards(
    docs: DataFrame, folder: str, text: str = "text", key: str = "doc_id", end_id: int = END_ID,
    path: str | None = None, shard_text_bytes: int = SHARD_TEXT_BYTES,
) -> DataFrame:
    """Write shard files under ``folder`` (any store that pyarrow opens) and return one row per file.

    A task writes its file under a name of its own and moves it in place when it is whole, so a task that runs
    again replaces it. Documents of equal key follow one another, in order of a hash of their text, over as many
    shards as they need. Null keys come first; null and empty texts hold the end id alone. An empty table gives no
    files.
    """
    path = path or tokenizer_path()
    rows = docs.select(F.col(key).cast("bigint").alias("key"), whole_text(text).alias("text"))
    total = rows.agg(F.sum(F.octet_length("text") + 64)).first()[0] or 0
    order = [F.col("key").asc_nulls_first(), F.xxhash64("text")]
    dealt = rows.repartitionByRange(max(1, -(-total // shard_text_bytes)), *order)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs as stores

        task = TaskContext.get()
        store, root = stores.FileSystem.from_uri(folder)
        encoder, end = Encoder.of(path), np.asarray([end_id], dtype="<u4").tobytes()
        width = 2 if max(encoder.tokenizer.get_vocab_size(), end_id + 1) <= 1 << 16 else 4
        name, own = f"{root}/shard-{task.partitionId():08d}.ids", f"{root}/_own-{task.taskAttemptId()}-{uuid.uuid4().hex}"
        keys, ends, at, out = [], [], 0, None
        for batch in batches:
            for k, whole in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                if out is None:
                    store.create_dir(root, recursive=True)
                    out = store.open_output_stream(own)
                    out.write(MAGIC)
                ids = np.frombuffer(encoder.ids(whole.as_py()) + end, dtype="<u4")
                out.write(ids.astype(f"<u{width}").tobytes())
                at += len(ids)
                keys.append(k)
                ends.append(at)
        if out is not None:
            tail = index_bytes(task.partitionId(), width, keys, ends)
            out.write(tail + len(tail).to_bytes(8, "little") + MAGIC)
            out.close()
            store.move(own, name)
            yield pa.RecordBatch.from_pydict({
                "shard": pa.array([task.partitionId()], pa.int64()), "file": [f"{folder}/shard-{task.partitionId():08d}.ids"],
                "n_docs": pa.array([len(keys)], pa.int64()), "n_tokens": pa.array([at], pa.int64()),
                "least_key": pa.array([keys[0]], pa.int64()), "greatest_key": pa.array([keys[-1]], pa.int64()),
            })

    ordered = dealt.sortWithinPartitions(*order, "text")
    shape = "shard long, file string, n_docs long, n_tokens long, least_key long, greatest_key long"
    return written(ordered.mapInArrow(write, shape), "id-shards")


def shards_of_key(files: DataFrame, key: int | None) -> DataFrame:
    """The files that may hold documents of a key."""
    if key is None:
        return files.where("least_key is null")
    return files.where((F.col("greatest_key") >= key) & (F.col("least_key").isNull() | (F.col("least_key") <= key)))


def read_shards(spark: SparkSession, files: DataFrame) -> DataFrame:
    """Every document of the shard files, found by its key: ``doc_id, start, n_tokens, ids_crc32``."""
    names = ["shard", "doc_id", "place", "n_tokens", "ids_crc32"]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs as stores

        for batch in batches:
            for name in batch.column(0).to_pylist():
                store, path = stores.FileSystem.from_uri(name)
                with store.open_input_file(path) as file:
                    shard = Shard(file)
                    keys, null = shard.parts["keys"], shard.parts["null"]
                    # Each document is where the index says its key begins, or follows one that is.
                    slots = shard.index.slots(keys.astype(np.int64).view(np.uint64))
                    begins = np.where(null, 0, np.where(slots < 0, -1, shard.parts["first"][slots] if len(shard.parts["first"]) else -1))
                    begins = np.where(np.concatenate(([True], (keys[1:] != keys[:-1]) | (null[1:] != null[:-1]))), begins, -2)
                    if not ((begins == -2) | (begins == np.arange(len(keys)))).all():
                        raise ValueError(f"{name}: the index doesn't lead to its documents")
                    ends, sums = shard.parts["ends"], []
                    for ids in shard.ids_of(range(len(shard))):
                        sums.append(zlib.crc32(ids.astype("<u4").tobytes()))
                    starts = np.concatenate(([0], ends[:-1]))
                    columns = [np.full(len(keys), shard.number), keys, starts, ends - starts, np.asarray(sums)]
                    arrays = [pa.array(c.astype(np.int64), mask=null if i == 1 else None) for i, c in enumerate(columns)]
                    yield pa.RecordBatch.from_arrays(arrays, names=names)

    each = files.select("file").repartition(max(1, files.count()), "file")
    rows = each.mapInArrow(read, "shard long, doc_id long, place long, n_tokens long, ids_crc32 long")
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    starts = files.select("shard", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)).alias("base"))
    placed = rows.join(starts, "shard")
    return placed.select("doc_id", (F.col("base") + F.col("place")).alias("start"), "n_tokens", "ids_crc32")


@query("op7_id_shards")
def op7_id_shards(spark, sf_dir):
    folder = scratch_path(spark, "ids")
    folder = folder if ":/" in folder else f"file://{folder}"
    files = write_shards(table(spark, sf_dir, "documents"), folder)
    return read_shards(spark, files)
