"""Exact dedup by owners in Patricia tries.

Texts are dealt by length and content hash. Each task inserts whole byte strings into a compressed radix trie;
a terminal node holds the owner of its text, the row that stays. It works in two steps:

1. Every batch of input rows gets a trie of its own. Of equal texts in a batch only the owner keeps its bytes, so a
   text that a third of all rows repeat goes through the shuffle once a batch.
2. The bytes that are left meet by length and hash in key order. The trie's top levels are length and hash, so when
   the key moves on, all earlier subtrees are complete. They leave memory as soon as the trie is over its budget;
   what has not been read yet lies in Spark's own sorted spill files.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from presslake.llm.common import table, whole_text, written
from presslake.llm.registry import query

#: Bytes of text a task's trie may hold before complete subtrees leave it.
TRIE_BYTES = 32 << 20


class Node:
    """A trie node: the label of the edge into it, children by first byte, and what is stored if a key ends here."""

    __slots__ = ("children", "label", "owner")

    def __init__(self, label: bytes, owner=None) -> None:
        self.label, self.owner, self.children = label, owner, {}


class Patricia:
    """A compressed radix trie of byte strings. ``insert`` gives the terminal node of a key."""

    def __init__(self) -> None:
        self.root, self.bytes = Node(b""), 0

    def insert(self, key: bytes) -> Node:
        node, at = self.root, 0
        while at < len(key):
            child = node.children.get(key[at])
            if child is None:
                child = Node(key[at:])
                node.children[key[at]] = child
                self.bytes += len(child.label)
                return child
            if key.startswith(child.label, at):
                node, at = child, at + len(child.label)
                continue
            shared = _shared(child.label, key, at)
            upper = Node(child.label[:shared])
            child.label = child.label[shared:]
            upper.children[child.label[0]] = child
            node.children[key[at]] = upper
            node, at = upper, at + shared
        return node

    def terminals(self) -> Iterator[Node]:
        waiting = [self.root]
        while waiting:
            node = waiting.pop()
            if node.owner is not None:
                yield node
            waiting.extend(node.children.values())


def _shared(label: bytes, key: bytes, at: int) -> int:
    """Length of the common start of ``label`` and ``key[at:]``, by halving."""
    low, high = 0, min(len(label), len(key) - at)
    while low < high:
        middle = (low + high + 1) // 2
        if label[low:middle] == key[at + low : at + middle]:
            low = middle
        else:
            high = middle - 1
    return low


def _better(a, b, largest: bool) -> bool:
    """Whether identifier ``a`` wins over ``b``; any identifier wins over null."""
    if a is None or b is None:
        return a is not None
    return a > b if largest else a < b


def _own_batches(largest: bool, names: list[str], schema: pa.Schema):
    """Step 1: rows with the entry they belong to; only an entry's owner keeps its text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = TaskContext.get().partitionId() << 33
        for batch in batches:
            trie, entries, entry_of, digests = Patricia(), [], [], []
            ids = batch.column(names.index("__id")).to_pylist()
            for row, text in enumerate(batch.column(names.index("__text"))):
                raw = text.as_buffer().to_pybytes()
                node = trie.insert(raw)
                if node.owner is None:
                    node.owner = len(entries)
                    entries.append([row, 0, hashlib.sha256(raw).hexdigest()])
                entry = entries[node.owner]
                entry[1] += 1
                if row != entry[0] and _better(ids[row], ids[entry[0]], largest):
                    entry[0] = row
                entry_of.append(node.owner)
                digests.append(entry[2])
            owns = [entries[e][0] == row for row, e in enumerate(entry_of)]
            mask = pa.array(owns)
            columns = {n: batch.column(i) for i, n in enumerate(names)}
            columns["__text"] = pc.if_else(mask, columns["__text"], pa.scalar(None, pa.binary()))
            columns["__entry"] = pa.array([first + e for e in entry_of], pa.int64())
            columns["__owns"] = mask
            columns["__copies"] = pa.array([entries[e][1] for e in entry_of], pa.int64())
            columns["__sha256"] = pa.array(digests, pa.string())
            yield pa.RecordBatch.from_arrays([columns[f.name].cast(f.type) for f in schema], schema=schema)
            first += len(entries)
    return run


def _own_entries(largest: bool, trie_bytes: int, key_type: pa.DataType):
    """Step 2: entries in key order to ``entry, keep entry, keep_id, group_size``."""
    schema = pa.schema([
        ("__entry", pa.int64()), ("__winner", pa.int64()), ("__keep", key_type), ("__size", pa.int64()),
    ])

    def flushed(trie: Patricia) -> pa.RecordBatch:
        rows = []
        for node in trie.terminals():
            keep, winner, size, members = node.owner
            rows += [(m, winner, keep, size) for m in members]
        columns = list(zip(*rows, strict=True)) or [[], [], [], []]
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie, last = Patricia(), None
        for batch in batches:
            sizes, hashes, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)
            for i, (entry, keep, copies) in enumerate(zip(*(batch.column(k).to_pylist() for k in (3, 4, 5)), strict=True)):
                top = sizes[i].to_bytes(8, "big") + (hashes[i] & (1 << 64) - 1).to_bytes(8, "big")
                if top != last and trie.bytes > trie_bytes:
                    yield flushed(trie)
                    trie = Patricia()
                last = top
                node = trie.insert(top + texts[i].as_buffer().to_pybytes())
                if node.owner is None:
                    node.owner = [keep, entry, 0, []]
                owner = node.owner
                if _better(keep, owner[0], largest) or keep == owner[0] and entry < owner[1]:
                    owner[0], owner[1] = keep, entry
                owner[2] += copies
                owner[3].append(entry)
        yield flushed(trie)
    return run


class Owners:
    """What ``exact_owners`` found: ``rows`` (every input row with its entry) and ``entries`` (entry to owner)."""

    def __init__(self, rows: DataFrame, entries: DataFrame, columns: list[str], text: str) -> None:
        self._rows, self._entries, self._columns, self._text = rows, entries, columns, text

    def decisions(self) -> DataFrame:
        """One row per input row: ``doc_id, keep_id, group_size, kept, text_sha256``."""
        kept = F.col("__owns") & (F.col("__entry") == F.col("__winner"))
        return self._rows.select("__id", "__entry", "__owns", "__sha256").join(self._entries, "__entry").select(
            F.col("__id").alias("doc_id"), F.col("__keep").alias("keep_id"), F.col("__size").alias("group_size"),
            kept.alias("kept"), F.col("__sha256").alias("text_sha256"),
        )

    def kept(self) -> DataFrame:
        """The rows that stay, with the columns of the input. A null text stays null."""
        winners = self._entries.where(F.col("__entry") == F.col("__winner")).select("__entry")
        rows = self._rows.where("__owns").join(winners, "__entry", "left_semi")
        whole = F.when(~F.col("__null"), F.col("__text").cast("string"))
        return rows.select(*[whole.alias(c) if c == self._text else F.col(f"c{i}").alias(c) for i, c in enumerate(self._columns)])


def exact_owners(
    docs: DataFrame, text: str = "text", key: str = "doc_id", largest: bool = False, columns: list[str] | None = None,
    trie_bytes: int = TRIE_BYTES,
) -> Owners:
    """Find the owner of each text: the row with the smallest (or ``largest``) identifier, one row even where rows
    repeat both text and identifier.

    Null texts equal empty ones. A null identifier owns a text only if all its rows have none. An empty table gives
    no rows. ``columns`` are carried along for ``kept()``, all by default; names of theirs may be any.
    """
    columns = docs.columns if columns is None else columns
    carried = [F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(columns) if c != text]
    whole = whole_text(text)
    shaped = docs.select(
        *carried, F.col(key).alias("__id"), F.col(text).isNull().alias("__null"), F.octet_length(whole).alias("__length"),
        F.xxhash64(whole).alias("__hash"), whole.cast("binary").alias("__text"),
    )
    extra = [
        T.StructField("__entry", T.LongType()), T.StructField("__owns", T.BooleanType()),
        T.StructField("__copies", T.LongType()), T.StructField("__sha256", T.StringType()),
    ]
    out = T.StructType([T.StructField(f.name, f.dataType) for f in [*shaped.schema, *extra]])
    rows = written(shaped.mapInArrow(_own_batches(largest, shaped.columns, _arrow(out)), out), "owned-rows")
    entries = rows.where("__owns").select("__length", "__hash", "__text", "__entry", "__id", "__copies")
    ordered = entries.repartition("__length", "__hash").sortWithinPartitions("__length", "__hash")
    kind = shaped.schema["__id"].dataType
    shape = f"__entry long, __winner long, __keep {kind.simpleString()}, __size long"
    found = ordered.mapInArrow(_own_entries(largest, trie_bytes, _arrow(T.StructType([shaped.schema["__id"]]))[0].type), shape)
    return Owners(rows, found, columns, text)


def _arrow(schema: T.StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(schema)


@query("op1_trie_dedup", """
select doc_id, max(doc_id) over (partition by coalesce(text, '')) as keep_id,
    count(*) over (partition by coalesce(text, ''))::bigint as group_size,
    doc_id = max(doc_id) over (partition by coalesce(text, '')) as kept, sha256(coalesce(text, '')) as text_sha256
from documents
""")
def op1_trie_dedup(spark, sf_dir):
    return exact_owners(table(spark, sf_dir, "documents"), largest=True, columns=[]).decisions()
