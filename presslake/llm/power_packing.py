"""Packing by power-of-two decomposition.

The token ids of each document are cut into pieces whose lengths are powers of two: as many of the longest as fit,
then the binary digits of the rest. Pieces of equal length stand together in one bucket, each is a sequence of its
own, so no sequence crosses documents and none needs padding.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from presslake.llm.common import table, whole_text, written
from presslake.llm.registry import query
from presslake.llm.tokens import Encoder, tokenizer_path
from presslake.operators.numbering import report_row_number

LONGEST = 4096
END_ID = 2


def piece_lengths(n: int, longest: int = LONGEST) -> Iterator[int]:
    """Powers of two, not rising, that sum to ``n``."""
    for _ in range(n // longest):
        yield longest
    rest = n % longest
    while rest:
        top = 1 << (rest.bit_length() - 1)
        yield top
        rest -= top


def cut_documents(
    docs: DataFrame, text: str = "text", key: str = "doc_id", longest: int = LONGEST, end_id: int = END_ID,
    path: str | None = None, with_ids: bool = False,
) -> DataFrame:
    """One row per piece: ``doc_id, start, length, ids_crc32, doc_tokens`` and, if asked for, ``ids``."""
    if longest & (longest - 1) or longest < 1:
        raise ValueError("the longest piece must be a power of two")
    path = path or tokenizer_path()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, end = Encoder.of(path), np.asarray([end_id], dtype="<u4").tobytes()
        for batch in batches:
            keys, out = batch.column(0), ([], [], [], [], [], [])
            for row, whole in enumerate(batch.column(1)):
                raw = encoder.ids(whole.as_py()) + end
                start, n = 0, len(raw) // 4
                for length in piece_lengths(n, longest):
                    part = raw[4 * start : 4 * (start + length)]
                    values = (row, start, length, zlib.crc32(part), n, np.frombuffer(part, "<i4") if with_ids else None)
                    for column, value in zip(out, values, strict=True):
                        column.append(value)
                    start += length
            arrays = [keys.take(pa.array(out[0], pa.int64())), *(pa.array(v, pa.int64()) for v in out[1:5])]
            names = ["key", "start", "length", "ids_crc32", "doc_tokens"]
            if with_ids:
                arrays.append(pa.array(out[5], pa.list_(pa.int32())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    kind = docs.schema[key].dataType.simpleString()
    schema = f"key {kind}, start long, length long, ids_crc32 long, doc_tokens long" + ", ids array<int>" * with_ids
    rows = docs.select(F.col(key).alias("key"), whole_text(text).alias("text"))
    return rows.mapInArrow(cut, schema).withColumnRenamed("key", "doc_id")


def pack_by_powers(
    docs: DataFrame, text: str = "text", key: str = "doc_id", longest: int = LONGEST, end_id: int = END_ID,
    path: str | None = None, with_ids: bool = False,
) -> DataFrame:
    """Pieces with ``sequence_id`` and ``offset``; longer sequences have smaller numbers.

    Null and empty texts give one piece that holds the end id alone. Documents of equal id are packed each for
    itself; their pieces of equal length are told apart by start and checksum, and full ties are alike. An empty
    table gives no rows. Other columns of the input aren't read.
    """
    cut = written(cut_documents(docs, text, key, longest, end_id, path, with_ids), "pieces")
    order = [F.col("length").desc(), F.col("doc_id").asc_nulls_first(), F.col("start"), F.col("ids_crc32")]
    numbered = report_row_number(cut, order, "sequence_id")
    placed = numbered.withColumns({"sequence_id": F.col("sequence_id") - 1, "offset": F.lit(0).cast("bigint")})
    return placed.select(*[c for c in cut.columns if c != "ids"], "sequence_id", "offset", *["ids"] * with_ids)


@query("op6_power_packing")
def op6_power_packing(spark, sf_dir):
    return pack_by_powers(table(spark, sf_dir, "documents"))
