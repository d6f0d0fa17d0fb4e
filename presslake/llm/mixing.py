"""Mixing sources to target weights.

The words of each source, document after document, are one long row that is cut into blocks of fixed length. Every
slot of an output shard draws a source, so a shard's counts of the sources are multinomial; a source's slots, numbered over all shards, go through a
pseudorandom permutation of its block numbers, a new one for each pass over the source; slots then meet the blocks
by number. What the draws leave over or short of a source's target is dropped or made up in last shards, and a
source's last block is cut, so each source gives just the words of its target, rounded down.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from presslake.llm.common import SPACE, WORD, running_start, table, whole_text, written
from presslake.llm.registry import query
from presslake.operators.numbering import report_row_number

BLOCK_WORDS = 512
SHARD_SLOTS = 1024
WEIGHTS = (1, 2, 3)
MOST_PASSES = 3
SEED = 42
#: Documents of a source whose place is counted in one task.
CHUNK_DOCS = 4096
#: Least number of cells that all slots are cut into to find the source of a draw.
LEAST_CELLS = 4096
_MASK = (1 << 64) - 1


def _round(x: np.ndarray, key: np.ndarray, number: int) -> np.ndarray:
    x = (x + key) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(number * 0xBF58476D1CE4E5B9 & _MASK)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(32))


def _walk(x: np.ndarray, n: np.ndarray, key: np.ndarray, back: bool) -> np.ndarray:
    """Four Feistel rounds on the least square domain that holds ``n``, again for whatever falls outside ``n``."""
    half = np.maximum(1, np.ceil(np.log2(np.maximum(n, 2).astype(np.float64)) / 2)).astype(np.uint64)
    half += (np.uint64(1) << (np.uint64(2) * half) < n).astype(np.uint64)
    mask, out, todo = (np.uint64(1) << half) - np.uint64(1), x.copy(), np.arange(len(x))
    while len(todo):
        left, right = out[todo] >> half[todo], out[todo] & mask[todo]
        for number in (3, 2, 1, 0) if back else range(4):
            if back:
                left, right = right ^ (_round(left, key[todo], number) & mask[todo]), left
            else:
                left, right = right, left ^ (_round(right, key[todo], number) & mask[todo])
        out[todo] = (left << half[todo]) | right
        todo = todo[out[todo] >= n[todo]]
    return out


def _keys(source: np.ndarray, passes: np.ndarray, seed: int) -> np.ndarray:
    return _round(source.astype(np.uint64) * np.uint64(64) + passes.astype(np.uint64), np.full(len(source), seed, np.uint64), 9)


def permuted(k, n, source, passes, seed: int = SEED) -> np.ndarray:
    """Block number of the ``k``-th slot of a pass over ``n`` blocks."""
    k, n, source, passes = (np.asarray(v, dtype=np.int64) for v in (k, n, source, passes))
    return _walk(k.astype(np.uint64), n.astype(np.uint64), _keys(source, passes, seed), False).astype(np.int64)


def place_of(block, n, source, passes, seed: int = SEED) -> np.ndarray:
    """The slot that ``permuted`` sends to this block."""
    block, n, source, passes = (np.asarray(v, dtype=np.int64) for v in (block, n, source, passes))
    return _walk(block.astype(np.uint64), n.astype(np.uint64), _keys(source, passes, seed), True).astype(np.int64)


def source_targets(sizes: DataFrame, weights=WEIGHTS, most_passes: int = MOST_PASSES) -> DataFrame:
    """``sizes(source, source_size, n_docs)`` with ``source_no``, ``weight`` and ``target``.

    Sources in code point order, null last, take the weights in turn. All targets sum to all sizes; a target stops
    at ``most_passes`` times its source, and what is over goes to the others by weight: the share of a unit of weight
    rises round by round until no further source stops. The driver sees sums over all sources only.
    """
    listed = F.array(*[F.lit(float(w)) for w in weights])
    numbered = report_row_number(sizes, [F.col("source").asc_nulls_last()], "source_no")
    number = (F.col("source_no") - 1).cast("long")
    weighed = written(numbered.withColumns({
        "source_no": number, "weight": F.get(listed, (number % len(weights)).cast("int")), "most": most_passes * F.col("source_size"),
    }), "weighed-sources")
    everything, weight, most = weighed.agg(F.sum("source_size"), F.sum("weight"), F.max(F.col("most") / F.col("weight"))).first()
    share, stopped = (everything or 0) / (weight or 1), None
    while True:
        stops = F.col("most") <= F.col("weight") * F.lit(share)
        n, taken, open_weight = weighed.agg(
            F.count_if(stops), F.coalesce(F.sum(F.when(stops, F.col("most"))), F.lit(0)), F.sum(F.when(~stops, F.col("weight")))
        ).first()
        if n == stopped:
            break
        stopped = n
        share = (everything - taken) / open_weight if open_weight else float(most or 0)
    target = F.when(F.col("most") <= F.col("weight") * F.lit(share), F.col("most").cast("double")).otherwise(F.col("weight") * F.lit(share))
    return weighed.withColumn("target", target).drop("most")


class Mix:
    """A mix: ``rows`` (documents with their place in their source), ``sources`` and ``slots``."""

    def __init__(self, docs: DataFrame, text: str, source: str, key: str, weights, block_words: int, shard_slots: int, seed: int, carry: bool) -> None:
        self.names = docs.columns if carry else []
        self.text, self.block_words = text, block_words
        whole = whole_text(text)
        # The words are counted and the rows numbered once; texts lie here until the mix is read.
        self.base = written(docs.select(
            *[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(self.names)], F.col(key).alias("doc_id"),
            F.col(source).alias("source"), F.regexp_count(whole, F.lit(WORD)).cast("bigint").alias("size"),
            F.xxhash64(whole).alias("hash"), F.monotonically_increasing_id().alias("row"),
        ), "sized")
        narrow = self.base.select("row", "doc_id", "source", "size", "hash")
        sums = narrow.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n_docs"))
        self.sources = written(_planned(source_targets(sums, weights), block_words, seed), "sources")
        named = self.sources.select(F.col("source").alias("named"), "source_no", "source_size", "target", "n_docs")
        rows = narrow.join(named, F.col("source").eqNullSafe(F.col("named"))).drop("named", "source")
        chunk = F.pmod(F.xxhash64("doc_id", "hash"), F.ceil(F.col("n_docs") / CHUNK_DOCS)).cast("bigint")
        placed = running_start(rows.withColumn("chunk", chunk), ["source_no"], "chunk", [F.col("doc_id"), F.col("size"), F.col("hash")], "size", "start")
        self.rows = written(placed.drop("chunk", "hash", "n_docs"), "placed")
        self.slots = _slots(self.sources, shard_slots, block_words, seed)

    def parts(self) -> DataFrame:
        """``row, source_no, block, doc_start, first, last``: where a block holds words of a document."""
        b = self.block_words
        blocks = F.sequence(F.floor(F.col("start") / b), F.floor((F.col("start") + F.col("size") - 1) / b))
        cut = self.rows.where("size > 0").select("row", "source_no", F.col("start").alias("doc_start"), "size", F.explode(blocks).alias("block"))
        first = F.greatest("doc_start", F.col("block") * b)
        return cut.select(
            "row", "source_no", "block", "doc_start", first.alias("first"),
            F.least(F.col("doc_start") + F.col("size"), (F.col("block") + 1) * b).alias("last"),
        )

    def pieces(self) -> DataFrame:
        """``shard, slot, pass, row, source_no, block, doc_start, first, last``: what each slot takes, by document."""
        met = self.slots.join(self.parts(), ["source_no", "block"])
        last = F.least("last", F.col("block") * self.block_words + F.col("words"))
        return met.withColumn("last", last).where("last > first").drop("words")

    def taken(self) -> DataFrame:
        """One row per document: ``doc_id, size, source_size, target, taken``."""
        sums = self.pieces().groupBy("row").agg(F.sum(F.col("last") - F.col("first")).alias("taken"))
        return self.rows.join(sums, "row", "left").select(
            "doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("bigint").alias("taken")
        )

    def documents(self) -> DataFrame:
        """The mix as documents: for each pass over a source, each document cut to the words taken, if any."""
        spans = self.pieces().groupBy("row", "pass").agg(
            F.sort_array(F.collect_list(F.struct((F.col("first") - F.col("doc_start")).alias("a"), (F.col("last") - F.col("doc_start")).alias("b")))).alias("spans")
        )
        met = self.base.join(spans, "row")
        cut = F.arrow_udf(_words_of_spans, "string")(f"c{self.names.index(self.text)}", "spans")
        return met.select(*[(cut if c == self.text else F.col(f"c{i}")).alias(c) for i, c in enumerate(self.names)])


def _words_of_spans(texts: pa.Array, spans: pa.Array) -> pa.Array:
    """The text from the first to the last word of each span; spans that touch are one."""
    word, out = re.compile(rf"[^{SPACE}]+"), []
    for text, cut in zip(texts.to_pylist(), spans.to_pylist(), strict=True):
        merged = []
        for span in cut:
            if merged and span["a"] <= merged[-1][1]:
                merged[-1][1] = span["b"]
            else:
                merged.append([span["a"], span["b"]])
        places = [m.span() for m in word.finditer(text)]
        whole = merged == [[0, len(places)]]
        out.append(text if whole else " ".join(text[places[a][0] : places[b - 1][1]] for a, b in merged))
    return pa.array(out, pa.string())


def _planned(sources: DataFrame, block_words: int, seed: int) -> DataFrame:
    """Adds to each source: blocks ``n``, words of the last one (``tail``), ``slots`` in all, ``full`` passes, words of
    the pass that is cut (``rest``) and the ``place`` of the last block in it."""
    added = ["n", "tail", "full", "rest", "place", "slots"]

    def plan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size, target, number = (batch.column(c).to_numpy() for c in ("source_size", "target", "source_no"))
            words = np.minimum(np.floor(target).astype(np.int64), MOST_PASSES * size)
            one = np.maximum(size, 1)
            n, full, rest = -(-size // block_words), words // one, words % one
            tail = size - (n - 1) * block_words
            place = place_of(np.maximum(n - 1, 0), np.maximum(n, 1), number, full, seed)
            k = -(-rest // block_words)
            k = np.where(k <= place, k, -(-(rest + block_words - tail) // block_words))
            made = [n, tail, full, rest, place, full * n + np.where(rest > 0, k, 0)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *map(pa.array, made)], names=[*batch.schema.names, *added])

    kinds = [f"`{f.name}` {f.dataType.simpleString()}" for f in sources.schema.fields]
    return sources.mapInArrow(plan, ", ".join([*kinds, *[f"{c} long" for c in added]]))


def _drawn(sources: DataFrame, total: int, shard_slots: int, seed: int) -> DataFrame:
    """``shard, source_no, drawn``: each slot draws a place among the slots of all sources, and with it a source.

    Places and sources meet by cells of equal width, so neither has to be small.
    """
    chunked = sources.where("slots > 0").select("source_no", "slots", F.floor(F.col("source_no") / CHUNK_DOCS).alias("chunk"))
    ranges = running_start(chunked, [], "chunk", [F.col("source_no")], "slots", "from").drop("chunk")
    width = max(1, total // max(LEAST_CELLS, ranges.count()))
    cells = F.sequence(F.floor(F.col("from") / width), F.floor((F.col("from") + F.col("slots") - 1) / width))
    ranges = ranges.select("source_no", "from", (F.col("from") + F.col("slots")).alias("to"), F.explode(cells).alias("cell"))
    places = sources.sparkSession.range(total).select(
        F.floor(F.col("id") / shard_slots).alias("shard"), F.pmod(F.xxhash64("id", F.lit(seed)), F.lit(total)).alias("at"),
    ).withColumn("cell", F.floor(F.col("at") / width))
    met = places.join(ranges, "cell").where((F.col("at") >= F.col("from")) & (F.col("at") < F.col("to")))
    return written(met.groupBy("shard", "source_no").agg(F.count("*").alias("drawn")), "draws")


def _slots(sources: DataFrame, shard_slots: int, block_words: int, seed: int) -> DataFrame:
    """``shard, slot, pass, source_no, block, words`` of every slot of the mix."""
    total = sources.agg(F.sum("slots")).first()[0] or 0
    shards = -(-total // shard_slots)
    planned = ["n", "tail", "full", "rest", "place"]

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            shard, source, k, n, tail, full, rest, place = (c.to_numpy() for c in batch.columns)
            passes, j = k // n, k % n
            block = permuted(j, n, source, passes, seed)
            size = np.where(block == n - 1, tail, block_words)
            before = j * block_words - (block_words - tail) * (j > place)
            words = np.where(passes < full, size, np.minimum(size, rest - before))
            yield pa.RecordBatch.from_arrays(
                [pa.array(x.astype(t)) for x, t in ((shard, "i8"), (k, "i8"), (passes, "i4"), (source, "i8"), (block, "i8"), (words, "i8"))],
                names=["shard", "slot", "pass", "source_no", "block", "words"],
            )

    drawn = _drawn(sources, total, shard_slots, seed)
    chunked = drawn.withColumn("chunk", F.floor(F.col("shard") / CHUNK_DOCS))
    first = running_start(chunked, ["source_no"], "chunk", [F.col("shard")], "drawn", "first")
    numbers = F.sequence(F.col("first"), F.col("first") + F.col("drawn") - 1)
    dealt = first.select("shard", "source_no", F.explode(numbers).alias("k"))
    # Sources that the draws left short make it up in shards after the last; what they drew too often goes.
    sums = drawn.groupBy("source_no").agg(F.sum("drawn").alias("have"))
    short = sources.join(sums, "source_no", "left").select("source_no", F.coalesce("have", F.lit(0)).alias("have"), "slots").where("have < slots")
    made_up = short.select("source_no", "have", F.explode(F.sequence(F.col("have"), F.col("slots") - 1)).alias("k")).select(
        (F.lit(shards) + F.floor((F.col("k") - F.col("have")) / shard_slots)).alias("shard"), "source_no", "k"
    )
    every = dealt.unionByName(made_up).join(sources.select("source_no", "slots", *planned), "source_no").where("k < slots")
    return every.select("shard", "source_no", "k", *planned).mapInArrow(
        look_up, "shard long, slot long, pass int, source_no long, block long, words long"
    )


def mix_sources(
    docs: DataFrame, text: str = "text", source: str = "source", key: str = "doc_id", weights=WEIGHTS,
    block_words: int = BLOCK_WORDS, shard_slots: int = SHARD_SLOTS, seed: int = SEED, carry: bool = True,
) -> Mix:
    """Mix the words of ``docs``; see ``Mix`` for what can be asked of it.

    Null texts count as empty; documents without a word take no part and show ``taken`` 0. Null is a source of its
    own, and there may be any number of them. Documents that repeat an identifier, or have none, are told apart by their
    words. An empty table gives no rows. The same rows give the same mix, however they are split into files.
    """
    return Mix(docs, text, source, key, weights, block_words, shard_slots, seed, carry)


@query("op9_source_mixing")
def op9_source_mixing(spark, sf_dir):
    return mix_sources(table(spark, sf_dir, "documents"), carry=False).taken()
