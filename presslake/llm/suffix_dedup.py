"""Removal of repeated passages: bytes in a string of 200 bytes that also starts anywhere else.

Every string of 200 bytes has an anchor, the place of its least hash among its pieces of 40 bytes, which is the same
wherever the string stands. So equal strings meet under their anchor's hash:

1. Each text gives its anchors (about one in 80 bytes) with the run of strings that each stands for. Anchors whose
   hash occurs once are dropped.
2. The texts that are left give the bytes around their anchors.
3. Per anchor hash, equal surroundings are one. Different ones are suffix-sorted, to the right of the anchor and to
   the left of it: prefix polynomial hashes and binary search give the common extension of two, so a comparison in
   the merge sort takes logarithmic time. The order and its extensions are then verified byte by byte; on a hash
   collision the bytes themselves are sorted. Two strings are equal if they share enough on both sides.

One task sorts at most ``TOGETHER`` surroundings. An anchor hash that has more is split further: the strings around it
start within 160 bytes before it, and those of either half of that range share the bytes in the middle, so each half is
a group of its own for every such piece, again and again until groups are small enough. At the latest a group has one
string. Surroundings are cut to what their strings can use each time and equal ones fall together, so a passage that
very many texts quote shrinks, and rows grow with their number only. All groups then go through the same sort.

Long runs of a short period would have an anchor at every period. Their strings repeat the two periods before, so
only those are searched for; the rest is found again in the text when it is cut.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator
from functools import cmp_to_key
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from presslake.llm.common import table, whole_text, written
from presslake.llm.registry import query

LENGTH, GRAM = 200, 40
#: Periods up to this are treated as runs.
PERIODS = 16
#: Surroundings that one task sorts together at most.
TOGETHER = 256
_PIECE = 1 << 20
_BASE = 0x5DEECE66D1CE4E5B | 1
_MASK = (1 << 64) - 1
_ZERO = np.zeros(1, dtype=np.uint64)


class _Powers:
    """Powers of the base and of its inverse modulo 2^64, made once in a process."""

    up = down = np.zeros(0, dtype=np.uint64)

    @classmethod
    def of(cls, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(cls.up) < n:
            cls.up, cls.down = (
                np.cumprod(np.asarray([1] + [b] * (n - 1), dtype=np.uint64), dtype=np.uint64)
                for b in (_BASE, pow(_BASE, -1, 1 << 64))
            )
        return cls.up[:n], cls.down[:n]


def _gram_hashes(data: np.ndarray) -> np.ndarray:
    """A mixed polynomial hash of the ``GRAM`` bytes from each place."""
    up, down = _Powers.of(len(data) + 1)
    prefix = np.concatenate((_ZERO, np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:-1], dtype=np.uint64)))
    x = (prefix[GRAM:] - prefix[:-GRAM]) * down[: len(prefix) - GRAM]
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(29))


def _window_anchors(hashes: np.ndarray) -> np.ndarray:
    """For each string of ``LENGTH`` bytes the place of its anchor: the least hash, the leftmost of equal ones."""
    width = LENGTH - GRAM + 1
    least = (hashes & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(hashes), dtype=np.uint64)
    have = 1
    while 2 * have <= width:
        least = np.minimum(least[:-have], least[have:])
        have *= 2
    if have < width:
        least = np.minimum(least[: len(least) - (width - have)], least[width - have :])
    return (least & np.uint64(0xFFFFFFFF)).astype(np.int64)


def _in_run(data: np.ndarray, period: int) -> np.ndarray:
    """For each string, whether it equals the one a period before it."""
    same = np.zeros(len(data) + 1, dtype=np.int32)
    np.cumsum(data[period:] == data[:-period], out=same[period + 1 :])
    return (same[LENGTH:] - same[:-LENGTH] == LENGTH) & (np.arange(len(data) - LENGTH + 1) >= period)


def run_strings(data: np.ndarray) -> np.ndarray:
    """For each string, whether it is equal to one or more within ``PERIODS`` bytes before or after it."""
    found = np.zeros(max(0, len(data) - LENGTH + 1), dtype=bool)
    for period in range(1, PERIODS + 1):
        if len(data) >= LENGTH + period:
            run = _in_run(data, period)
            found |= run
            found[: len(run) - period] |= run[period:]
    return found


def _skipped(data: np.ndarray) -> np.ndarray:
    """Strings that equal both the one a period before and the one two periods before."""
    found = np.zeros(len(data) - LENGTH + 1, dtype=bool)
    for period in range(1, PERIODS + 1):
        if len(data) >= LENGTH + 2 * period:
            run = _in_run(data, period)
            found[period:] |= run[period:] & run[:-period]
    return found


def _pieces(texts: list[bytes]) -> Iterator[list[tuple[int, int, bytes]]]:
    """Groups of ``(row, offset, bytes)`` of bounded size; pieces of a long text overlap by ``LENGTH - 1``."""
    group, size = [], 0
    for row, text in enumerate(texts):
        for at in range(0, len(text) - LENGTH + 1, _PIECE):
            part = text[at : at + _PIECE + LENGTH - 1]
            if size and size + len(part) > _PIECE:
                yield group
                group, size = [], 0
            group.append((row, at, part))
            size += len(part)
    if group:
        yield group


def anchors(texts: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """``(row, hash, packed)`` arrays; ``packed`` is ``place << 16 | before << 8 | strings - 1``.

    ``before`` is how far the first string starts before the anchor's place in its text.
    """
    for group in _pieces(texts):
        data = np.frombuffer(b"".join(p for _, _, p in group), dtype=np.uint8)
        hashes = _gram_hashes(data)
        place = _window_anchors(hashes)
        lengths = np.asarray([len(p) for _, _, p in group], dtype=np.int64)
        starts = np.cumsum(lengths) - lengths
        inside = np.zeros(len(place), dtype=bool)
        for start, length in zip(starts.tolist(), lengths.tolist(), strict=True):
            inside[start : start + length - LENGTH + 1] = True
            own = place[start : start + length - LENGTH + 1]
            if 30 * (np.count_nonzero(np.diff(own)) + 1) > length:
                inside[start : start + length - LENGTH + 1] &= ~_skipped(data[start : start + length])
        string = np.flatnonzero(inside)
        if not len(string):
            continue
        anchor = place[string]
        new = np.concatenate(([True], (np.diff(anchor) != 0) | (np.diff(string) != 1)))
        first = np.flatnonzero(new)
        last = np.concatenate((first[1:], [len(string)])) - 1
        piece = np.searchsorted(starts, string[first], side="right") - 1
        rows = np.asarray([r for r, _, _ in group], dtype=np.int64)[piece]
        offset = np.asarray([o for _, o, _ in group], dtype=np.int64)[piece] - starts[piece]
        packed = ((anchor[first] + offset) << 16) | ((anchor[first] - string[first]) << 8) | (string[last] - string[first])
        yield rows, hashes[anchor[first]].view(np.int64), packed


class Surroundings:
    """Distinct surroundings of one anchor hash: bytes, and where the anchor's place is in them."""

    def __init__(self, items: list[tuple[bytes, int]]) -> None:
        self.items = items
        data = np.frombuffer(b"".join(b for b, _ in items), dtype=np.uint8).astype(np.uint64) + np.uint64(1)
        lengths = np.asarray([len(b) for b, _ in items], dtype=np.int64)
        self.starts = (np.cumsum(lengths) - lengths).tolist()
        local = np.arange(len(data)) - np.repeat(self.starts, lengths)
        self.powers = _Powers.of(1024)[0].tolist()
        if lengths.max() >= 1024:
            self.powers = _Powers.of(int(lengths.max()) + 1)[0].tolist()
        terms = data * np.asarray(self.powers, dtype=np.uint64)[local]
        self.prefix = np.concatenate((_ZERO, np.cumsum(terms, dtype=np.uint64))).tolist()

    def _equal(self, i: int, a: int, j: int, b: int, n: int) -> bool:
        """Whether ``n`` bytes from ``a`` in item ``i`` have the hash of those from ``b`` in item ``j``."""
        x, y = self.starts[i] + a, self.starts[j] + b
        one, two = self.prefix[x + n] - self.prefix[x], self.prefix[y + n] - self.prefix[y]
        return ((one * self.powers[b - a] - two) if b >= a else (one - two * self.powers[a - b])) & _MASK == 0

    def right(self, i: int, j: int) -> int:
        """Bytes that two items share from the anchor on."""
        (x, a), (y, b) = self.items[i], self.items[j]
        low, high = 0, min(len(x) - a, len(y) - b)
        while low < high:
            middle = (low + high + 1) // 2
            if self._equal(i, a, j, b, middle):
                low = middle
            else:
                high = middle - 1
        return low

    def left(self, i: int, j: int) -> int:
        """Bytes that two items share up to the anchor."""
        (_, a), (_, b) = self.items[i], self.items[j]
        low, high = 0, min(a, b)
        while low < high:
            middle = (low + high + 1) // 2
            if self._equal(i, a - middle, j, b - middle, middle):
                low = middle
            else:
                high = middle - 1
        return low

    def order(self, on_right: bool) -> tuple[list[int], list[int]]:
        """Items in order of the bytes from the anchor (or back from it), and what neighbours share."""
        sides = [b[a:] if on_right else b[:a][::-1] for b, a in self.items]
        shared = self.right if on_right else self.left

        def compare(i: int, j: int) -> int:
            n = shared(i, j)
            x, y = sides[i][n : n + 1], sides[j][n : n + 1]
            return (x > y) - (x < y)

        order = sorted(range(len(sides)), key=cmp_to_key(compare))
        common = [shared(i, j) for i, j in zip(order, order[1:], strict=False)]
        for i, j, n in zip(order, order[1:], common, strict=False):
            x, y = sides[i], sides[j]
            if x[:n] != y[:n] or (x[n : n + 1] >= y[n : n + 1] and len(x) + len(y) > 2 * n):  # a collision: go by bytes
                order = sorted(range(len(sides)), key=sides.__getitem__)
                common = [_shared(sides[i], sides[j]) for i, j in zip(order, order[1:], strict=False)]
                break
        return order, common

    def repeated(self) -> list[set[int]]:
        """For each item, how far before the anchor strings start that another item has too."""
        m = len(self.items)
        found: list[set[int]] = [set() for _ in range(m)]
        right, left = self.order(True), self.order(False)
        if m <= 8:
            reach_r, reach_l = _reach(*right), _reach(*left)
            for pair in combinations(range(m), 2):
                for before in range(max(0, LENGTH - reach_r[pair]), min(reach_l[pair], LENGTH - 1) + 1):
                    found[pair[0]].add(before)
                    found[pair[1]].add(before)
            return found
        (r_order, r_common), (l_order, l_common) = (tuple(map(np.asarray, side)) for side in (right, left))
        for before in range(LENGTH - GRAM + 1):
            ranks = np.zeros((2, m), dtype=np.int64)
            ranks[0, r_order[1:]] = np.cumsum(r_common < LENGTH - before)
            ranks[1, l_order[1:]] = np.cumsum(l_common < before)
            there = np.asarray([a >= before and len(b) - a >= LENGTH - before for b, a in self.items])
            places = np.flatnonzero(there)
            _, inverse, counts = np.unique(ranks[0, places] * m + ranks[1, places], return_inverse=True, return_counts=True)
            for i in places[counts[inverse] > 1].tolist():
                found[i].add(before)
        return found


def _reach(order: list[int], common: list[int]) -> dict[tuple[int, int], int]:
    """What each pair shares: the least between neighbours from one to the other."""
    out = {}
    for p in range(len(order)):
        least = 1 << 30
        for q in range(p + 1, len(order)):
            least = min(least, common[q - 1])
            out[min(order[p], order[q]), max(order[p], order[q])] = least
    return out


def _shared(x: bytes, y: bytes) -> int:
    low, high = 0, min(len(x), len(y))
    while low < high:
        middle = (low + high + 1) // 2
        if x[low:middle] == y[low:middle]:
            low = middle
        else:
            high = middle - 1
    return low


def _runs(numbers: set[int]) -> Iterator[tuple[int, int]]:
    """First and last of each run of whole numbers."""
    first = last = None
    for n in sorted(numbers):
        if last is not None and n == last + 1:
            last = n
            continue
        if first is not None:
            yield first, last
        first = last = n
    if first is not None:
        yield first, last


def group_intervals(members: list[tuple[bytes, int, int]]) -> Iterator[tuple[int, int, int]]:
    """``(member, start, end)`` of repeated bytes; a member is ``(bytes, anchor in them, where they start)``."""
    seen: dict[tuple[bytes, int], list[int]] = {}
    for number, (raw, anchor, _) in enumerate(members):
        seen.setdefault((raw, anchor), []).append(number)
    items = list(seen)
    partial = Surroundings(items).repeated() if len(items) > 1 and any(len(v) == 1 for v in seen.values()) else None
    for number, item in enumerate(items):
        raw, anchor = item
        if len(seen[item]) > 1:
            for member in seen[item]:
                yield member, members[member][2], members[member][2] + len(raw)
        elif partial is not None:
            member = seen[item][0]
            # The strings of this item start at 0 to len - LENGTH: other places belong to other anchors.
            mine = {anchor - before for before in partial[number] if 0 <= anchor - before <= len(raw) - LENGTH}
            for a, b in _runs(mine):
                yield member, members[member][2] + a, members[member][2] + b + LENGTH


def _anchor_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [t.as_buffer().to_pybytes() for t in batch.column(2)]
        for rows, hashes, packed in anchors(texts):
            take = pa.array(rows)
            yield pa.RecordBatch.from_arrays(
                [pa.array(hashes), batch.column(0).take(take), batch.column(1).take(take), pa.array(packed)],
                names=["h", "id", "th", "packed"],
            )


def _surrounding_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Surroundings with the places they stand at. Equal ones of a batch are one row, so a passage that very many
    texts share goes through the shuffle once a batch."""
    for batch in batches:
        places: dict[tuple[int, int, bytes], list[tuple[int, int]]] = {}
        for number, found in enumerate(batch.column(3).to_pylist()):
            text = batch.column(2)[number].as_buffer().to_pybytes()
            for one in found:
                place, before, more = one["packed"] >> 16, one["packed"] >> 8 & 255, one["packed"] & 255
                part = text[place - before : place - before + more + LENGTH]
                places.setdefault((one["h"], before, part), []).append((number, place - before))
        members = [m for each in places.values() for m in each]
        take = pa.array([number for number, _ in members], pa.int64())
        where = pa.StructArray.from_arrays(
            [batch.column(0).take(take), batch.column(1).take(take), pa.array([first for _, first in members], pa.int64())], names=["id", "th", "first"]
        )
        ends = np.cumsum([0, *map(len, places.values())]).astype(np.int32)
        columns = list(zip(*places, strict=True)) or [(), (), ()]
        yield pa.RecordBatch.from_arrays(
            [pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.binary()), pa.ListArray.from_arrays(pa.array(ends), where)],
            names=["h", "anchor", "part", "members"],
        )


def _halves(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows ``(h, low, high, anchor, part, members)`` whose strings start ``low`` to ``high`` bytes before the anchor, for
    either half of that range: keyed by the bytes that all strings of the half have, cut to what they can use."""
    for batch in batches:
        found: dict[tuple, list[dict]] = {}
        for h, low, high, anchor, part, members in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            middle = (low + high) // 2
            for a, b in ((low, middle), (middle + 1, high)):
                first, last = max(a, anchor - (len(part) - LENGTH)), min(b, anchor)
                if a > b or first > last:
                    continue
                start = anchor - last
                shared = part[anchor - a : anchor + LENGTH - b]
                key = xxhash.xxh64_intdigest(struct.pack("<qhh", h, a, b) + shared) - (1 << 63)
                cut = (key, a, b, last, part[start : anchor - first + LENGTH])
                found.setdefault(cut, []).extend({**m, "first": m["first"] + start} for m in members)
        columns = list(zip(*found, strict=True)) or [()] * 5
        kinds = (pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.binary())
        arrays = [pa.array(c, t) for c, t in zip(columns, kinds, strict=True)]
        yield pa.RecordBatch.from_arrays([*arrays, pa.array(list(found.values()), batch.schema.field("members").type)], names=batch.schema.names)


def _content_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows ``(h, anchor, part, n)``, all different, that come in order of ``h``: those with repeated strings, and the
    runs of bytes under these."""
    def done(h: int, rows: list[tuple[int, bytes, int]]) -> Iterator[tuple]:
        members = [(part, anchor, 0) for anchor, part, n in rows for _ in range(min(n, 2))]
        owner = [i for i, (_, _, n) in enumerate(rows) for _ in range(min(n, 2))]
        runs: dict[int, set[tuple[int, int]]] = {}
        for member, a, b in group_intervals(members):
            runs.setdefault(owner[member], set()).add((a, b))
        for i, found in runs.items():
            yield h, rows[i][0], rows[i][1], [{"a": a, "b": b} for a, b in sorted(found)]

    def shown(out: list[tuple]) -> pa.RecordBatch:
        kinds = (pa.int64(), pa.int64(), pa.binary(), pa.list_(pa.struct([("a", pa.int64()), ("b", pa.int64())])))
        columns = list(zip(*out, strict=True)) or [()] * 4
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=["h", "anchor", "part", "runs"])

    own, rows = None, []
    for batch in batches:
        out: list[tuple] = []
        for h, anchor, part, n in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if h != own:
                out += done(own, rows) if rows else []
                own, rows = h, []
            rows.append((anchor, part, n))
        yield shown(out)
    if rows:
        yield shown(list(done(own, rows)))


def _wide_intervals(wide: DataFrame) -> DataFrame:
    """Repeated bytes around anchors that may have very many surroundings: ``id, th, start, end``."""
    names = ["h", "low", "high", "anchor", "part", "members"]
    state = written(wide.withColumns({"low": F.lit(0), "high": F.lit(LENGTH - GRAM)}).select(*names), "wide-surroundings")
    settled = []
    while True:
        # How many different ones, by hash: this only decides where they are sorted.
        each = state.groupBy("h", F.xxhash64("anchor", "part").alias("c")).agg(F.sum(F.size("members")).alias("n"))
        sizes = each.groupBy("h").agg(F.count("*").alias("different"), F.sum("n").alias("all")).where(F.col("all") > 1)
        sized = state.join(sizes, "h")
        settled.append(sized.where(F.col("different") <= TOGETHER).select(*names))
        more = written(sized.where(F.col("different") > TOGETHER).select(*names).mapInArrow(_halves, state.schema), "wide-surroundings")
        if more.isEmpty():
            break
        state = more
    few = settled[0]
    for other in settled[1:]:
        few = few.unionByName(other)
    few = written(few.select("h", "anchor", "part", "members"), "settled-surroundings")
    contents = few.groupBy("h", "anchor", "part").agg(F.sum(F.size("members")).cast("bigint").alias("n"))
    ordered = contents.repartition("h").sortWithinPartitions("h")
    runs = ordered.mapInArrow(_content_runs, "h long, anchor long, part binary, runs array<struct<a: bigint, b: bigint>>")
    places = few.join(runs, ["h", "anchor", "part"]).select(F.explode("members").alias("m"), "runs").select("m", F.explode("runs").alias("r"))
    return places.select("m.id", "m.th", (F.col("m.first") + F.col("r.a")).alias("start"), (F.col("m.first") + F.col("r.b")).alias("end"))


def _interval_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Groups of equal ``h`` that come in order of ``h``; the last one of a batch may go on in the next."""
    def done(rows: pa.Table) -> pa.RecordBatch:
        h, lists = rows["h"].to_numpy(), rows["members"].combine_chunks()
        counts = np.diff(np.asarray(lists.offsets))
        where = lists.flatten()
        row_of = np.repeat(np.arange(len(h)), counts)
        first = where.field("first").to_pylist()
        parts, anchor = rows["part"].to_pylist(), rows["anchor"].to_pylist()
        ends = np.concatenate(([0], np.cumsum(counts)))
        cut = [0, *(np.flatnonzero(np.diff(h)) + 1).tolist(), len(h)]
        out = []
        for a, b in zip(ends[cut].tolist(), ends[cut[1:]].tolist(), strict=False):
            members = [(parts[r], anchor[r], first[a + i]) for i, r in enumerate(row_of[a:b].tolist())]
            out += [(a + m, s, e) for m, s, e in group_intervals(members)]
        members, starts, stops = (list(c) for c in zip(*out, strict=True)) if out else ([], [], [])
        take = pa.array(members, pa.int64())
        ids, hashes = (where.field(c).take(take) for c in ("id", "th"))
        return pa.RecordBatch.from_arrays([ids, hashes, pa.array(starts, pa.int64()), pa.array(stops, pa.int64())], names=["id", "th", "start", "end"])

    waiting: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        h = batch.column(0).to_numpy()
        goes_on = int(np.searchsorted(h, h[-1], side="left"))
        if goes_on == 0 and waiting and waiting[-1].column(0)[0].as_py() == h[0]:
            waiting.append(batch)
            continue
        whole = pa.Table.from_batches([*waiting, batch.slice(0, goes_on)])
        waiting = [batch.slice(goes_on)]
        if whole.num_rows:
            yield done(whole)
    if waiting:
        yield done(pa.Table.from_batches(waiting))


def _merged(spans: list[tuple[int, int]]) -> list[list[int]]:
    out: list[list[int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([start, end])
    return out


def _cut_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    span = pa.struct([("start", pa.int64()), ("end", pa.int64())])
    for batch in batches:
        spans, digests = [], []
        for number, found in enumerate(batch.column(3).to_pylist()):
            text = batch.column(2)[number].as_buffer().to_pybytes()
            places = [(x["start"], x["end"]) for x in found or []]
            runs = np.flatnonzero(run_strings(np.frombuffer(text, dtype=np.uint8)))
            if len(runs):
                breaks = np.flatnonzero(np.diff(runs) != 1)
                firsts, lasts = np.concatenate((runs[:1], runs[breaks + 1])), np.concatenate((runs[breaks], runs[-1:]))
                places += [(a, b + LENGTH) for a, b in zip(firsts.tolist(), lasts.tolist(), strict=True)]
            merged, kept, at = _merged(places), hashlib.sha256(), 0
            for start, end in merged:
                kept.update(text[at:start])
                at = end
            kept.update(text[at:])
            spans.append([{"start": a, "end": b} for a, b in merged])
            digests.append(kept.hexdigest())
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(spans, pa.list_(span)), pa.array(digests, pa.string())], names=["id", "th", "spans", "kept_sha256"]
        )


def repeated_bytes(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """One row per document: ``doc_id, n_bytes, spans`` (start and end of each maximal removed run) and
    ``kept_sha256`` of the bytes that stay.

    Null and empty texts have nothing to remove. Rows that repeat identifier and text are each other's repeats.
    Texts shorter than 200 bytes lose nothing; an empty table gives no rows. Other columns aren't read.
    """
    kind = docs.schema[key].dataType.simpleString()
    whole = whole_text(text)
    rows = docs.select(F.col(key).alias("id"), F.unhex(F.md5(whole.cast("binary"))).alias("th"), whole.cast("binary").alias("text"))
    long = rows.where(F.octet_length("text") >= LENGTH)
    found = written(long.mapInArrow(_anchor_rows, f"h long, id {kind}, th binary, packed long"), "anchors")
    counts = found.groupBy("h").agg(F.count("*").alias("n")).where("n > 1").select("h", (F.col("n") > TOGETHER).alias("wide"))
    twice = found.join(counts, "h")
    # Rows that repeat identifier and text have the same anchors and spans: sets, so that n of them stay n.
    by_text = twice.groupBy("id", "th").agg(F.collect_set(F.struct("h", "packed", "wide")).alias("found")).select(F.col("id").alias("i"), F.col("th").alias("t"), "found")
    same = F.col("id").eqNullSafe(F.col("i")) & (F.col("th") == F.col("t"))
    affected = written(long.join(by_text, same).select("id", "th", "text", "found"), "repeating-texts")

    def around(wide: bool) -> DataFrame:
        some = affected.withColumn("found", F.filter("found", lambda x: x["wide"] == F.lit(wide))).where(F.size("found") > 0)
        return some.mapInArrow(_surrounding_rows, f"h long, anchor long, part binary, members array<struct<id: {kind}, th: binary, first: bigint>>")

    ordered = around(False).repartition("h").sortWithinPartitions("h")
    intervals = ordered.mapInArrow(_interval_rows, f"id {kind}, th binary, start long, end long").unionByName(_wide_intervals(around(True)))
    per_text = intervals.groupBy("id", "th").agg(F.collect_set(F.struct("start", "end")).alias("places")).select(F.col("id").alias("i"), F.col("th").alias("t"), "places")
    met = affected.join(per_text, same).select("id", "th", "text", "places")
    cut = met.mapInArrow(_cut_rows, f"id {kind}, th binary, spans array<struct<start: bigint, end: bigint>>, kept_sha256 string")
    cut = cut.dropDuplicates(["id", "th"]).select(F.col("id").alias("i"), F.col("th").alias("t"), "spans", "kept_sha256")
    plain = rows.select("id", "th", F.octet_length("text").cast("bigint").alias("n_bytes"), F.sha2("text", 256).alias("sha"))
    none = F.array().cast("array<struct<start: bigint, end: bigint>>")
    return plain.join(cut, same, "left").select(
        F.col("id").alias("doc_id"), "n_bytes", F.coalesce("spans", none).alias("spans"), F.coalesce("kept_sha256", "sha").alias("kept_sha256")
    )


@query("op4_suffix_dedup")
def op4_suffix_dedup(spark, sf_dir):
    found = repeated_bytes(table(spark, sf_dir, "documents"))
    removed = F.aggregate("spans", F.lit(0).cast("bigint"), lambda a, s: a + s["end"] - s["start"])
    return found.select("doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("bigint").alias("n_spans"), "kept_sha256")
