"""Repair of conversation structure by Hirschberg's divide and conquer.

A repaired conversation reads, by the first letters of its roles, ``(s?(ua)+)?``: nothing yet (0), after a system
turn (1), after a user turn (2), after an assistant turn (3). Rows are kept, given another role, deleted, or turns are
inserted before them. The costs from the start to each of the four states after a row form a forward vector, those
from each state to the end a backward vector. Both are computed with four numbers in memory; where they meet in the
middle, the cheapest crossing is chosen, of equally cheap ones that with the least audit, and both halves are solved
in the same way. The forward vector carries the order of its four audits beside the costs: after a row, audits end
with the letter of that row, so none is the start of another and their order is settled by what came before.

Rows are numbered over the whole table and cut into blocks of bounded size, whatever conversation they belong to. A
conversation that spans several blocks is first summed up block by block (costs and order from each state to each
state); a pass over these sums fixes the crossings at the cuts, and every block is solved alone. So a conversation
that holds a third of all rows is spread like any other.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from presslake.llm.common import SPACE, table, written
from presslake.llm.registry import query
from presslake.operators.numbering import report_row_number

#: Rows of one block.
BLOCK_ROWS = 2_048

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 2, 3, 2, 1
#: What follows each state when a turn is added as user or assistant, and the states a conversation may end in.
NEXT = (2, 2, 3, 2)
ENDS = (0, 3)
ROLE = {2: "user", 3: "assistant"}
FAR = 1 << 60

Step = tuple[int, str, int]  # cost, letters, state after
Row = tuple[str, bool, bool]  # role's first letter, must go, is truncated


def _turn(state: int, row: Row) -> Iterator[Step]:
    """What may become of a row in a state, without insertions."""
    yield DELETE, "D", state
    initial, must_go, truncated = row
    if not must_go:
        extra = TRUNCATED * truncated
        if initial == "s" and state == 0:
            yield KEEP + extra, "K", 1
        elif (initial == "u" and state != 2) or (initial == "a" and state == 2):
            yield KEEP + extra, "K", NEXT[state]
        yield REROLE + extra, "R", NEXT[state]


def _steps(rows: tuple[Row, ...] | list[Row]) -> dict[Row, list[list[Step]]]:
    """For each kind of row the cheapest, least steps from each state to each, up to two insertions first."""
    made = {}
    for row in set(rows):
        each = []
        for state in range(4):
            best: dict[int, tuple[int, str]] = {}
            at = state
            for inserted in range(3):
                for cost, letter, after in _turn(at, row):
                    step = (cost + INSERT * inserted, "I" * inserted + letter)
                    best[after] = min(best.get(after, step), step)
                at = NEXT[at]
            each.append([(cost, letters, after) for after, (cost, letters) in best.items()])
        made[row] = each
    return made


def _tail(state: int) -> list[Step]:
    """Insertions after the last row."""
    found, at = [], state
    for inserted in range(3):
        if at in ENDS:
            found.append((INSERT * inserted, "I" * inserted, at))
        at = NEXT[at]
    return found


Vector = list[tuple[int, int]]  # cost and place in the order of audits, by state


def only(state: int) -> Vector:
    return [(0, 0) if s == state else (FAR, 0) for s in range(4)]


def _forward(vector: Vector, steps: list[list[Step]]) -> Vector:
    best: list[tuple | None] = [None] * 4
    for state, (cost, place) in enumerate(vector):
        if cost < FAR:
            for more, letters, after in steps[state]:
                found = (cost + more, place, letters)
                if best[after] is None or found < best[after]:
                    best[after] = found
    order = sorted({b[1:] for b in best if b is not None})
    return [(FAR, 0) if b is None else (b[0], order.index(b[1:])) for b in best]


def _backward(costs: list[int], steps: list[list[Step]]) -> list[int]:
    return [min(more + costs[after] for more, _, after in steps[s]) for s in range(4)]


def meet(rows: list[Row], start: int, end: int, steps: dict[Row, list[list[Step]]] | None = None) -> Iterator[tuple[str, int]]:
    """For each row its letters and the state after it, on the cheapest way from ``start`` to ``end``, least audit."""
    steps = _steps(rows) if steps is None else steps
    todo = [(0, len(rows), start, end)]
    while todo:
        low, high, s, e = todo.pop()
        if high - low == 1:
            _, letters = min((cost, letters) for cost, letters, after in steps[rows[low]][s] if after == e)
            yield letters, e
        elif high > low:
            middle = (low + high) // 2
            front = only(s)
            for i in range(low, middle):
                front = _forward(front, steps[rows[i]])
            back = [0 if x == e else FAR for x in range(4)]
            for i in range(high - 1, middle - 1, -1):
                back = _backward(back, steps[rows[i]])
            _, _, crossing = min((cost + back[x], place, x) for x, (cost, place) in enumerate(front))
            todo += [(middle, high, crossing, e), (low, middle, s, crossing)]


def summed_up(rows: list[Row]) -> list[Vector]:
    """The forward vector of a block from each of the four states."""
    steps, sums = _steps(rows), []
    for state in range(4):
        vector = only(state)
        for row in rows:
            vector = _forward(vector, steps[row])
        sums.append(vector)
    return sums


def crossings(sums: list[list[Vector]]) -> tuple[list[int], str, int]:
    """States before, between and after consecutive blocks on the cheapest way, the letters of insertions after the
    last, and the cost."""
    vector, backs = only(0), []
    for block in sums:
        best: list[tuple | None] = [None] * 4
        for state, (cost, place) in enumerate(vector):
            for after, (more, within) in enumerate(block[state]):
                if cost < FAR and more < FAR:
                    found = (cost + more, place, within, state)
                    if best[after] is None or found < best[after]:
                        best[after] = found
        order = sorted({b[1:3] for b in best if b is not None})
        vector = [(FAR, 0) if b is None else (b[0], order.index(b[1:3])) for b in best]
        backs.append([None if b is None else b[3] for b in best])
    cost, _, letters, state = min(
        (cost + more, place, letters, state) for state, (cost, place) in enumerate(vector) if cost < FAR for more, letters, _ in _tail(state)
    )
    states = [state]
    for back in reversed(backs):
        states.append(back[states[-1]])
    return states[::-1], letters, cost


# Spark: rows in order, blocks, sums of blocks, edits.

def faults(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """Rows in order with ``pos`` (over the whole table), and, apart from the texts, their ``block`` and faults.

    The order within a conversation is by turn (nulls first), then role and text. A role or text that is null counts
    as one space. ``duplicate`` marks rows whose role and text an earlier row of the conversation has.
    """
    given = rows.select(F.col(conv).alias("conv"), F.col(turn).alias("turn"), *[
        F.coalesce(F.col(c), F.lit(" ")).alias(name) for c, name in ((role, "role"), (text, "text"))
    ])
    order = [F.asc_nulls_first("conv"), F.asc_nulls_first("turn"), F.asc("role"), F.asc("text")]
    numbered = report_row_number(given, order, "pos")
    signs = F.regexp_extract(F.col("text"), rf"([^{SPACE}])[{SPACE}]*\z", 1)
    marked = written(numbered.withColumns({
        "block": F.floor((F.col("pos") - 1) / BLOCK_ROWS).cast("long"), "initial": F.substring("role", 1, 1),
        "blank": signs == "", "truncated": ~signs.isin("", ".", "!", "?"),
        "same": F.sha2(F.concat(F.octet_length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text")), 256),
    }), "turns")
    # The first row of each text, by partial aggregates; its position is a key of its own, so no text makes a hot one.
    narrow = marked.drop("role", "text")
    first = narrow.where("not blank").groupBy("conv", "same").agg(F.min("pos").alias("first")).select("first")
    found = narrow.join(first, F.col("pos") == F.col("first"), "left")
    repeats = ~F.col("blank") & F.col("first").isNull()
    flags = found.withColumns({"duplicate": repeats, "truncated": F.col("truncated") & ~repeats}).drop("first", "same")
    return marked.select("conv", "pos", "role", "text"), flags


def _pieces(solve):
    """Calls ``solve(keys, rows)`` for each stretch of rows that agree in the first two columns, in order."""
    def made(out: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*out, strict=True)) or [[]] * len(solve.types)
        arrays = [pa.array(c, t) for c, t in zip(columns, solve.types, strict=True)]
        return pa.RecordBatch.from_arrays(arrays, names=[f"c{i}" for i in range(len(arrays))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, rows = None, []
        for batch in batches:
            out: list[tuple] = []
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if row[:2] != key:
                    out += solve(key, rows) if rows else []
                    key, rows = row[:2], []
                rows.append(row[2:])
            yield made(out)
        yield made(solve(key, rows) if rows else [])
    return run


def _sum_up(kind: pa.DataType):
    def solve(key: tuple, rows: list[tuple]) -> list[tuple]:
        initials = [r[1] for r in rows]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
        sums = [x for vector in summed_up([r[1:] for r in rows]) for pair in vector for x in pair]
        return [(*key, sums, initials[0], initials[-1], illegal)]

    solve.types = (kind, pa.int64(), pa.list_(pa.int64()), pa.string(), pa.string(), pa.int64())
    return solve


def _cross(kind: pa.DataType):
    """All blocks of a conversation, in order: states at their cuts and the totals of the conversation."""
    def solve(key: tuple, rows: list[tuple]) -> list[tuple]:
        sums = [[[tuple(r[1][8 * s + 2 * e : 8 * s + 2 * e + 2]) for e in range(4)] for s in range(4)] for r in rows]
        states, letters, cost = crossings(sums)
        seams = sum(a[3] + b[2] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
        last = len(rows) - 1
        return [
            (key[0], r[0], states[i], states[i + 1], letters if i == last else "", cost if i == last else 0, r[4] + (seams if i == last else 0))
            for i, r in enumerate(rows)
        ]

    solve.types = (kind, pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64())
    return solve


def _edit(key: tuple, rows: list[tuple]) -> list[tuple]:
    """Rows of a block with the states at its ends: ``(pos, at, letter, role)`` for each edit, the role if it is new."""
    start, end, tail = rows[0][1:4]
    out, state = [], start
    for (pos, *_), (letters, after) in zip(rows, meet([r[4:] for r in rows], start, end), strict=True):
        for at, letter in enumerate(letters):
            if letter == "I":
                state = NEXT[state]
            out.append((pos, at, letter, ROLE[state] if letter == "I" else ROLE[after] if letter == "R" else None))
        state = after
    for at in range(len(tail)):
        state = NEXT[state]
        out.append((rows[-1][0], 8 + at, "I", ROLE[state]))
    return out


_edit.types = (pa.int64(), pa.int64(), pa.string(), pa.string())


class Repair:
    """A repair of all conversations: ``turns`` (rows in order), ``flags`` (their faults), ``blocks`` (states and sums)."""

    def __init__(self, turns: DataFrame, flags: DataFrame, blocks: DataFrame, name: str, kind: pa.DataType) -> None:
        self.turns, self.flags, self.blocks, self._name, self._kind = turns, flags, blocks, name, kind

    def edits(self) -> DataFrame:
        """``conv, pos, at, edit, role, text``: every edit, in order of ``pos`` and ``at``, with the turn that it keeps
        or makes; a deleted row shows none."""
        states = self.blocks.select(F.col("conv").alias("__conv"), F.col("block").alias("__block"), "start", "end", "tail")
        same = F.col("conv").eqNullSafe(F.col("__conv")) & (F.col("block") == F.col("__block"))
        rows = _narrow(self.flags.join(states, same), "start", "end", "tail")
        made = rows.repartition("block").sortWithinPartitions("block", "pos").mapInArrow(
            _pieces(_edit), "edited long, at long, edit string, new_role string"
        )
        met = made.join(self.turns, F.col("edited") == F.col("pos"))
        stays = F.col("edit") != "D"
        return met.select(
            "conv", "pos", "at", "edit", F.when(stays, F.coalesce("new_role", "role")).alias("role"),
            F.when(F.col("edit") == "I", "").when(stays, F.col("text")).alias("text"),
        )

    def report(self) -> DataFrame:
        """One row per conversation with rows: gaps, faults, cost and ``illegal`` neighbours."""
        counts = self.flags.groupBy("conv").agg(
            F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn"), F.lit(0)).cast("long").alias("gaps"),
            *[F.count_if(c).alias(c) for c in ("blank", "duplicate", "truncated")],
        )
        sums = self.blocks.groupBy(F.col("conv").alias("__conv")).agg(F.sum("illegal").alias("illegal"), F.sum("cost").alias("cost"))
        return counts.join(sums, F.col("conv").eqNullSafe(F.col("__conv"))).drop("__conv")

    def digests(self) -> DataFrame:
        """``conv, audit, repaired_sha256``. A conversation's turns pass through one task in order, a batch at a
        time: that is in the nature of a digest over all of its turns."""
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            open_conv, audit, digest, begun = None, [], None, False
            for batch in batches:
                out = []
                for conv, edit, role, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                    if digest is None or conv != open_conv:
                        if digest is not None:
                            out.append((open_conv, "".join(audit), digest.hexdigest()))
                        open_conv, audit, digest, begun = conv, [], hashlib.sha256(), False
                    audit.append(edit)
                    if role is not None:
                        digest.update(f"{chr(10) * begun}{role}:{text}".encode())
                        begun = True
                yield shown(out)
            if digest is not None:
                yield shown([(open_conv, "".join(audit), digest.hexdigest())])

        kind = self._kind

        def shown(rows: list[tuple]) -> pa.RecordBatch:
            columns = list(zip(*rows, strict=True)) or [[]] * 3
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, (kind, pa.string(), pa.string()), strict=True)], names=["conv", "audit", "sha"]
            )

        ordered = self.edits().repartition("conv").sortWithinPartitions("conv", "pos", "at")
        return ordered.select("conv", "edit", "role", "text").mapInArrow(run, f"conv {self._name}, audit string, repaired_sha256 string")


def repair_turns(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> Repair:
    """Find the cheapest edits that make every conversation well-formed, of equally cheap ones the least audit.

    Rows of a null conversation form one. Blank rows and repeats are always deleted; rows that break off stay at a
    cost. Rows that repeat whole are duplicates of one another. An empty table has no conversations; other columns
    aren't read.
    """
    from pyspark.sql.pandas.types import to_arrow_type

    kind = rows.schema[conv].dataType
    name, arrow = kind.simpleString(), to_arrow_type(kind)
    turns, flags = faults(rows, conv, turn, role, text)
    flags = written(flags, "flags")
    sums = _narrow(flags).repartition("block").sortWithinPartitions("block", "pos").mapInArrow(
        _pieces(_sum_up(arrow)), f"conv {name}, block long, sums array<long>, first string, last string, illegal long"
    )
    by_conv = sums.select("conv", F.lit(0).cast("long").alias("all"), "block", "sums", "first", "last", "illegal")
    blocks = by_conv.repartition("conv").sortWithinPartitions("conv", "block").mapInArrow(
        _pieces(_cross(arrow)), f"conv {name}, block long, start long, end long, tail string, cost long, illegal long"
    )
    return Repair(turns, flags, written(blocks, "blocks"), name, arrow)


def _narrow(flags: DataFrame, *more: str) -> DataFrame:
    """What decides on a row."""
    gone = (F.col("blank") | F.col("duplicate")).alias("gone")
    return flags.select("conv", "block", "pos", *more, "initial", gone, "truncated")


def damaged(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """A fifth to a quarter of the rows damaged, by checksum of conversation and turn: dropped, emptied, without
    sentence ends, repeated, or given to the user. Nulls count as one space."""
    shown = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in (conv, turn)]
    case = F.crc32(F.concat(shown[0], F.lit(":"), shown[1])) % 20
    said, by = (F.coalesce(F.col(c), F.lit(" ")) for c in (text, role))
    changed = rows.select(
        F.col(conv).alias("conv_id"), F.col(turn).alias("turn"), F.when(case == 4, "user").otherwise(by).alias("role"),
        F.when(case == 1, "").when(case == 2, F.regexp_replace(said, "[.!?]", "")).otherwise(said).alias("text"), case.alias("case"),
    ).where("case <> 0")
    copies = F.explode(F.when(F.col("case") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1))))
    return changed.withColumn("copy", copies).drop("case", "copy")


@query("op12_turn_repair")
def op12_turn_repair(spark, sf_dir):
    given = table(spark, sf_dir, "conversations")
    repair = repair_turns(damaged(given))
    found = repair.report().join(repair.digests().withColumnRenamed("conv", "__conv"), F.col("conv").eqNullSafe(F.col("__conv"))).drop("__conv")
    everyone = given.select("conv_id").distinct()
    counted = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    return everyone.join(found, F.col("conv_id").eqNullSafe(F.col("conv")), "left").select(
        "conv_id", *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in counted], F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"),
    )
