"""Near-duplicates by SimHash and pigeonhole blocks.

A fingerprint of 64 bits is cut into six blocks. Two that differ in at most three bits agree in at least three
whole blocks, so they share one of the twenty keys made of three blocks. Equal fingerprints are one node from the
start. Within a key, candidates are compared with their neighbours in sorted order, never written out as pairs;
a task gives only links that connect what it has not connected yet. A key with very many fingerprints is cut again
in the same way by the bits that are left, after which a key holds at most 65,536 values however large the corpus.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from presslake.llm.common import table, whole_text, written
from presslake.llm.components import components
from presslake.llm.registry import query

SHINGLE_WORDS = 3
MAX_BITS = 3
SEED = 42
#: A key with more fingerprints than this is cut a second time.
WIDE_KEY = 2048
#: Widths of the blocks, from the highest bits down, and of those within the bits outside a key.
_BLOCKS = [11, 11, 11, 11, 10, 10]
_SHINGLES_AT_ONCE = 1 << 17


def fingerprint(text: str, width: int = SHINGLE_WORDS) -> int:
    """Bits set in over half of the shingles' hashes; zero if there is no word."""
    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    n = max(1, len(words) - width + 1)
    counts, digest = np.zeros(64, dtype=np.int64), xxhash.xxh64_intdigest
    last = ends[-1:] if len(words) < width else ends[width - 1 :]
    for at in range(0, n, _SHINGLES_AT_ONCE):
        pairs = zip(starts[at : min(n, at + _SHINGLES_AT_ONCE)].tolist(), last[at : at + _SHINGLES_AT_ONCE].tolist(), strict=True)
        hashes = np.fromiter((digest(joined[a:b], SEED) for a, b in pairs), np.uint64)
        bits = np.unpackbits(hashes.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
        counts += bits.sum(axis=0, dtype=np.int64)
    return int("".join("1" if 2 * c > n else "0" for c in counts), 2)


def with_fingerprints(docs: DataFrame, text: str = "text", width: int = SHINGLE_WORDS) -> DataFrame:
    """Adds ``__fp`` (the fingerprint as a signed long); a null text has no words."""
    def scan(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            found = [fingerprint(t.as_py(), width) for t in batch]
            yield pa.array(np.array(found, dtype=np.uint64).view(np.int64))

    scan.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return docs.withColumn("__fp", F.arrow_udf(scan, "long")(whole_text(text)))


def _cut(widths: list[int]) -> list[tuple[int, list[tuple[int, int]]]]:
    """For every choice of half the blocks: its number and the ``(shift, mask)`` of each block."""
    shifts = [sum(widths[i + 1 :]) for i in range(len(widths))]
    blocks = [(s, (1 << w) - 1) for s, w in zip(shifts, widths, strict=True)]
    return [(n, list(c)) for n, c in enumerate(combinations(blocks, len(widths) // 2))]


def _key(fp: Column, blocks: list[tuple[int, int]]) -> Column:
    """The blocks' bits side by side."""
    key = F.lit(0).cast("bigint")
    for shift, mask in blocks:
        key = F.shiftleft(key, mask.bit_length()).bitwiseOR(F.shiftrightunsigned(fp, shift).bitwiseAND(F.lit(mask)))
    return key


def _keyed(fps: DataFrame) -> DataFrame:
    keys = [F.struct(F.lit(n).alias("choice"), _key(F.col("fp"), blocks).alias("key")) for n, blocks in _cut(_BLOCKS)]
    return fps.select("fp", F.explode(F.array(*keys)).alias("k")).select("k.choice", "k.key", "fp")


def _keyed_again(wide: DataFrame) -> DataFrame:
    """Cut the bits outside each key into six blocks again."""
    every, choices = [(sum(_BLOCKS[i + 1 :]), (1 << w) - 1) for i, w in enumerate(_BLOCKS)], _cut(_BLOCKS)
    rest = F.lit(None).cast("bigint")
    for n, blocks in choices:
        rest = F.when(F.col("choice") == n, _key(F.col("fp"), [b for b in every if b not in blocks])).otherwise(rest)
    bits = 64 - min(sum(m.bit_length() for _, m in blocks) for _, blocks in choices)
    widths = [bits // 6 + (i < bits % 6) for i in range(6)]
    keys = [F.struct(F.lit(n).alias("again"), _key(F.col("rest"), blocks).alias("more")) for n, blocks in _cut(widths)]
    cut = wide.withColumn("rest", rest).select("choice", "key", "fp", F.explode(F.array(*keys)).alias("k"))
    return cut.select("choice", "key", "k.again", "k.more", "fp")


class _Sets:
    """Sets of linked values, for one task."""

    def __init__(self) -> None:
        self.parent: dict[int, int] = {}

    def find(self, x: int) -> int:
        root = x
        while (up := self.parent.get(root, root)) != root:
            root = up
        while (up := self.parent.get(x, x)) != root:
            self.parent[x], x = root, up
        return root

    def link(self, a: int, b: int) -> bool:
        a, b = self.find(a), self.find(b)
        if a != b:
            self.parent[max(a, b)] = min(a, b)
        return a != b


def _links(max_bits: int, columns: int):
    """Links between rows ``(key columns ..., fp)`` that come in key order, as a forest per task."""
    def forest(keys: np.ndarray, fps: np.ndarray, sets: _Sets) -> Iterator[pa.RecordBatch]:
        for lag in range(1, len(fps)):
            same = np.ones(len(fps) - lag, dtype=bool)
            for column in keys:
                same &= column[lag:] == column[:-lag]
            if not same.any():
                break
            near = np.flatnonzero(same)
            near = near[np.bitwise_count((fps[near] ^ fps[near + lag]).view(np.uint64)) <= max_bits]
            found = [(a, b) for a, b in zip(fps[near].tolist(), fps[near + lag].tolist(), strict=True) if sets.link(a, b)]
            if found:
                a, b = zip(*found, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sets, open_rows = _Sets(), None
        for batch in batches:
            rows = np.stack([c.to_numpy(zero_copy_only=False).astype(np.int64) for c in batch.columns])
            rows = rows if open_rows is None else np.concatenate([open_rows, rows], axis=1)
            is_last = (rows[:columns] == rows[:columns, -1:]).all(axis=0)  # its key may go on
            yield from forest(rows[:columns, ~is_last], rows[columns, ~is_last], sets)
            open_rows = rows[:, is_last]
            if len(sets.parent) > 1_000_000:
                sets = _Sets()
        if open_rows is not None:
            yield from forest(open_rows[:columns], open_rows[columns], sets)
    return run


def fingerprint_links(fps: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """``(a, b)``: links that connect all distinct ``fp`` that chains of pairs within ``max_bits`` connect."""
    if not 0 <= max_bits <= 3:
        raise ValueError("six blocks of which three must agree find up to three differing bits")
    keyed = _keyed(fps).withColumn("m", F.count("*").over(Window.partitionBy("choice", "key")))
    shared = keyed.where("m > 1")
    plain = shared.where(F.col("m") <= WIDE_KEY).select("choice", "key", "fp")
    first = plain.repartition("choice", "key").sortWithinPartitions("choice", "key").mapInArrow(_links(max_bits, 2), "a long, b long")
    again = _keyed_again(shared.where(F.col("m") > WIDE_KEY)).repartition("choice", "key", "again", "more")
    second = again.sortWithinPartitions("choice", "key", "again", "more").mapInArrow(_links(max_bits, 4), "a long, b long")
    return first.unionByName(second)


def near_groups(docs: DataFrame, text: str = "text", key: str = "doc_id", max_bits: int = MAX_BITS, carry: bool = False) -> DataFrame:
    """Every input row with ``__fp`` and ``component_id``, the smallest identifier in its component.

    Rows link when their fingerprints differ in at most ``max_bits`` bits. Texts without a word have fingerprint
    zero and link like any other; null identifiers count only where a component has no other. ``carry`` keeps all
    columns of the input and adds ``__first``, true for one row of each component, one with that identifier.
    """
    rows = with_fingerprints(docs if carry else docs.select(F.col(key).alias("__id"), text), text)
    rows = rows.withColumn("__id", F.col(key)) if carry else rows.drop(text)
    rows = written(rows.withColumn("__row", F.monotonically_increasing_id()), "fingerprints")
    fps = written(rows.groupBy(F.col("__fp").alias("fp")).agg(
        F.min("__id").alias("least"), F.min(F.struct(F.col("__id").isNull(), "__id", "__row")).alias("first")
    ), "distinct-fingerprints")
    roots = written(components(fingerprint_links(fps.select("fp"), max_bits)), "roots")
    rooted = fps.join(roots, fps["fp"] == roots["node"], "left").select(
        "fp", "least", "first", F.coalesce("root", "fp").alias("root")
    )
    owners = rooted.groupBy("root").agg(F.min("least").alias("component_id"), F.min("first").alias("first"))
    labels = rooted.select("fp", "root").join(owners, "root").select("fp", "component_id", F.col("first")["__row"].alias("__owner"))
    found = rows.join(labels, rows["__fp"] == labels["fp"]).drop("fp")
    return found.withColumn("__first", F.col("__row") == F.col("__owner")).drop("__row", "__owner")


def keep_one_of_each(docs: DataFrame, text: str = "text", key: str = "doc_id", max_bits: int = MAX_BITS) -> DataFrame:
    """The rows of ``docs`` that stay when each group of near-duplicates keeps the one of smallest identifier."""
    names = {f"c{i}": c for i, c in enumerate(docs.columns)}
    plain = docs.toDF(*names)
    back = {c: n for n, c in names.items()}
    kept = near_groups(plain, back[text], back[key], max_bits, carry=True).where("__first")
    return kept.select(*[F.col(n).alias(c) for n, c in names.items()])


@query("op8_simhash_near_dedup")
def op8_simhash_near_dedup(spark, sf_dir):
    found = near_groups(table(spark, sf_dir, "documents"))
    shown = F.lpad(F.lower(F.hex("__fp")), 16, "0")
    return found.select(F.col("__id").alias("doc_id"), shown.alias("fingerprint"), "component_id")
