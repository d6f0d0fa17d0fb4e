"""Periodic runs of words, by a suffix automaton with link-cut access.

The suffix links of the automaton of a word sequence form a tree; the path from the root to the state of a prefix
holds all suffixes of that prefix. Every node remembers where its strings ended last. The tree is kept as splay
trees of path segments whose nodes ended last at the same word (a link-cut tree): appending word ``i`` is an access
to the state of the prefix, which meets the segments on its path and recolours them to ``i``. A segment of longest
string ``n`` that ended last at ``e`` gives the period ``d = i - e`` of the suffix of ``n + d`` words, and, where
``d <= n``, a square. Consecutive words carry a square on: same start, same period, a later end. The last end is the
end of the run. A document of ``n`` words costs ``O(n log n)`` steps.

Before that, a sieve that loses nothing: a run of ``length >= max(24, 3 * period)`` repeats each of its eight-word
windows at the distance of its period. Only stretches of words under windows that come back that near are run
through the automaton; which stretches there are is decided by numpy over the whole document.
"""

from __future__ import annotations

import hashlib
import zlib
from array import array
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from presslake.llm.common import table
from presslake.llm.registry import query

#: A run has at least so many words and so many periods.
LEAST_WORDS = 24
LEAST_PERIODS = 3

Run = tuple[int, int, int]  # start, length, period


class SuffixLinks:
    """The suffix automaton of a sequence of small integers: longest lengths, suffix links, states of prefixes.

    Most states have one way on, kept in two arrays; only further ways take a dictionary.
    """

    def __init__(self, symbols: list[int]) -> None:
        length, link = array("i", [0]), array("i", [-1])
        symbol, to = array("i", [-1]), array("i", [-1])
        more: dict[int, dict[int, int]] = {}
        prefixes, last = array("i"), 0
        for c in symbols:
            new = len(length)
            length.append(length[last] + 1)
            link.append(0)
            symbol.append(-1)
            to.append(-1)
            p = last
            while p >= 0:
                if symbol[p] == c:
                    q = to[p]
                    break
                ways = more.get(p)
                if ways is not None and c in ways:
                    q = ways[c]
                    break
                if symbol[p] < 0:
                    symbol[p], to[p] = c, new
                elif ways is None:
                    more[p] = {c: new}
                else:
                    ways[c] = new
                p = link[p]
            if p >= 0:
                if length[q] == length[p] + 1:
                    link[new] = q
                else:
                    clone = len(length)
                    length.append(length[p] + 1)
                    link.append(link[q])
                    symbol.append(symbol[q])
                    to.append(to[q])
                    if q in more:
                        more[clone] = dict(more[q])
                    link[q] = link[new] = clone
                    while p >= 0:
                        if symbol[p] == c and to[p] == q:
                            to[p] = clone
                        elif p in more and more[p].get(c) == q:
                            more[p][c] = clone
                        else:
                            break
                        p = link[p]
            prefixes.append(new)
            last = new
        self.length, self.link, self.prefixes = length, link, prefixes


class LastEnds:
    """The tree of suffix links as splay trees of segments with one last end each (link-cut access).

    A splay tree holds a downward path in order of depth; its root carries the end. Above its top node hangs the
    segment of that node's parent in the tree of links.
    """

    def __init__(self, link: array) -> None:
        n = len(link)
        self.up = array("i", link)
        self.left, self.right, self.end = array("i", [-1]) * n, array("i", [-1]) * n, array("i", [-1]) * n

    def _splay(self, x: int) -> None:
        up, left, right, end = self.up, self.left, self.right, self.end
        p = up[x]
        while p >= 0 and (left[p] == x or right[p] == x):
            g = up[p]
            inside = g >= 0 and (left[g] == p or right[g] == p)
            end[x] = end[g if inside else p]  # right once the root has been passed
            if inside:
                self._rotate(p if (left[g] == p) == (left[p] == x) else x)
            self._rotate(x)
            p = up[x]

    def _rotate(self, x: int) -> None:
        up, left, right = self.up, self.left, self.right
        p = up[x]
        g = up[p]
        if left[p] == x:
            inner = right[x]
            left[p], right[x] = inner, p
        else:
            inner = left[x]
            right[p], left[x] = inner, p
        if inner >= 0:
            up[inner] = p
        up[p], up[x] = x, g
        if g >= 0:
            if left[g] == p:
                left[g] = x
            elif right[g] == p:
                right[g] = x

    def access(self, x: int, at: int) -> Iterator[tuple[int, int]]:
        """Make the path from the root to ``x`` one segment that ended last at ``at``; gives the ``(node, end)`` of
        each segment met: its deepest node on the path and its end before."""
        up, right, end = self.up, self.right, self.end
        below, node = -1, x
        while node >= 0:
            self._splay(node)
            if end[node] >= 0:
                yield node, end[node]
            cut = right[node]
            if cut >= 0:
                end[cut] = end[node]  # deeper nodes keep their end, as a segment of their own
            right[node] = below
            below, node = node, up[node]
        self._splay(x)
        end[x] = at


def automaton_runs(symbols: list[int], least: int = LEAST_WORDS, periods: int = LEAST_PERIODS) -> list[Run]:
    """All maximal runs ``(start, length, period)`` of at least ``max(least, periods * period)`` symbols."""
    if periods < 2:
        raise ValueError("a run has two periods at least")
    links = SuffixLinks(symbols)
    tree, length = LastEnds(links.link), links.length
    ends: dict[tuple[int, int], int] = {}
    for i, state in enumerate(links.prefixes):
        for node, before in tree.access(state, i):
            period, whole = i - before, length[node] + i - before
            if whole >= periods * period and whole >= least:
                ends[i - whole + 1, period] = i
    return sorted((start, end - start + 1, period) for (start, period), end in ends.items())


def near_stretches(hashes: np.ndarray, least: int = LEAST_WORDS, periods: int = LEAST_PERIODS) -> Iterator[tuple[int, int]]:
    """Ranges ``(from, to)`` of words outside of which no run has a word; runs lie within one range each.

    Windows are compared by hash, so a collision may add a range and none is lost. A window of a run comes back at
    the distance of the period, at most a ``periods``-th of the run; ranges are cut again until that holds.
    """
    # Within a run of n words and period q <= n / periods every window of w words has another at distance q if
    # 2 * q <= n - w + 1.
    width = max(1, min(8, least - 2 * (least // periods)))
    n = len(hashes) - width + 1
    if n <= 0 or len(hashes) < least:
        return
    rolled, have = hashes, 1
    while have < width:
        step = min(have, width - have)
        kept = len(rolled) - step
        rolled = rolled[:kept] * np.uint64(0x9E3779B97F4A7C15) + rolled[step:] * np.uint64(0xC2B2AE3D27D4EB4F) + (rolled[:kept] >> np.uint64(29))
        have += step
    order = np.argsort(rolled, kind="stable")
    placed = rolled[order]
    again = placed[1:] == placed[:-1]
    if not again.any():
        return
    gaps = np.where(again, order[1:] - order[:-1], n)
    nearest = np.full(n, n, dtype=np.int64)
    nearest[order[1:]] = gaps
    nearest[order[:-1]] = np.minimum(nearest[order[:-1]], gaps)
    open_ranges = [(0, n)]
    while open_ranges:
        a, b = open_ranges.pop()
        most = (b - a + width - 1) // periods
        near = np.concatenate(([False], nearest[a:b] <= most, [False]))
        turns = np.flatnonzero(near[1:] != near[:-1]).reshape(-1, 2) + a
        for c, d in turns.tolist():
            if d - c + width - 1 < least:
                continue
            if (c, d) == (a, b):
                yield a, b + width - 1
            else:
                open_ranges.append((c, d))


def word_runs(words: list[bytes], least: int = LEAST_WORDS, periods: int = LEAST_PERIODS) -> list[Run]:
    """All maximal periodic runs of a word sequence, by start and period."""
    if len(words) < least:
        return []
    hashes = np.fromiter(map(hash, words), np.int64, len(words)).view(np.uint64)
    found = []
    for a, b in near_stretches(hashes, least, periods):
        numbers: dict[bytes, int] = {}
        symbols = [numbers.setdefault(w, len(numbers)) for w in words[a:b]]
        found += [(a + start, n, period) for start, n, period in automaton_runs(symbols, least, periods)]
    return sorted(found, key=lambda r: (r[0], r[2]))


def collapsed(words: list[bytes], runs: list[Run]) -> list[bytes]:
    """The words without those that a run holds after its first period."""
    if not runs:
        return words
    keep = np.ones(len(words), dtype=bool)
    for start, n, period in runs:
        keep[start + period : start + n] = False
    return [words[i] for i in np.flatnonzero(keep).tolist()]


Prepare = Callable[[object, list[bytes]], list[bytes]]


def periodic_runs(
    docs: DataFrame, text: str = "text", key: str = "doc_id", prepare: Prepare | None = None, with_text: bool = True,
) -> DataFrame:
    """One row per document: ``doc_id``, ``runs`` (start, length and period in words, by start, then period),
    ``collapsed`` (the text without the repeated periods, words joined by one space; if asked for) and its SHA-256.

    Null and empty texts have no words, no runs and an empty collapsed text. Repeated rows and repeated or null
    identifiers are judged each alone; an empty table gives no rows; other columns of the input aren't read. A text
    is held by one task, with some 60 bytes for each word of the longest stretch that repeats. ``prepare(key, words)``
    may change the words first.
    """
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, texts, digests = [], [], []
            for at, whole in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                words = whole.as_buffer().to_pybytes().split() if whole.is_valid else []
                if prepare is not None:
                    words = prepare(at, words)
                runs = word_runs(words)
                rest = b" ".join(collapsed(words, runs))
                found.append([{"start": s, "length": n, "period": p} for s, n, p in runs])
                texts.append(rest.decode("utf-8", "replace") if with_text else None)
                digests.append(hashlib.sha256(rest).hexdigest())
            kind = pa.list_(pa.struct([(n, pa.int64()) for n in ("start", "length", "period")]))
            arrays = [batch.column(0), pa.array(found, kind), pa.array(digests, pa.string())]
            names = ["doc_id", "runs", "collapsed_sha256"]
            if with_text:
                arrays.append(pa.array(texts, pa.string()))
                names.append("collapsed")
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    kind = docs.schema[key].dataType.simpleString()
    schema = f"doc_id {kind}, runs array<struct<start: long, length: long, period: long>>, collapsed_sha256 string"
    return docs.select(key, text).mapInArrow(scan, schema + ", collapsed string" * with_text)


def repeat_tail(key: object, words: list[bytes]) -> list[bytes]:
    """A tenth of the documents, by checksum of the identifier, go on from some word by repeating a stretch.

    Documents without identifier stay as they are.
    """
    n = len(words)
    if n == 0 or key is None:
        return words
    h = zlib.crc32(str(key).encode())
    if h % 10:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + (words[a : a + p] * ((n - a) // p + 1))[: n - a]


@query("op13_periodic_runs")
def op13_periodic_runs(spark, sf_dir):
    found = periodic_runs(table(spark, sf_dir, "documents"), prepare=repeat_tail, with_text=False)
    return digests(found)


def digests(found: DataFrame) -> DataFrame:
    """What the query shows of ``periodic_runs``: the number of runs, the greatest and digests."""
    # Of two runs the one of more periods is greater; exactly, by products of whole numbers.
    first = F.aggregate(
        "runs", F.col("runs")[0],
        lambda best, r: F.when(r["length"] * best["period"] > best["length"] * r["period"], r).otherwise(best),
    )
    line = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    shown = found.withColumn("best", F.when(F.size("runs") > 0, first))
    return shown.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), F.col("best.start").alias("start"),
        F.col("best.length").alias("length"), F.col("best.period").alias("period"),
        F.floor(1000 * F.col("best.length") / F.col("best.period")).cast("long").alias("exponent_milli"),
        F.sha2(F.array_join(line, ""), 256).alias("runs_sha256"), "collapsed_sha256",
    )
