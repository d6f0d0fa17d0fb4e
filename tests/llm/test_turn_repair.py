"""Conversation repair against a search over whole audits."""

import hashlib
import heapq
import random
import re
import zlib
from collections import defaultdict

from presslake.llm import turn_repair
from presslake.llm.turn_repair import crossings, damaged, meet, op12_turn_repair, repair_turns, summed_up

SF = "/root/testdata/sf0.01"
LEGAL = re.compile(r"(s?(ua)+)?")


def plain_repair(rows):
    """``rows``: (role, text, must go, truncated). Cheapest edits, least audit, by uniform-cost search over prefixes."""
    heap, seen = [(0, "", 0, "", ())], set()
    while heap:
        cost, audit, i, shown, kept = heapq.heappop(heap)
        state = (i, {"": 0, "s": 1}.get(shown, 2 if shown.endswith("u") else 3), i == len(rows) and bool(LEGAL.fullmatch(shown)))
        if i == len(rows) and LEGAL.fullmatch(shown):
            return cost, audit, list(kept)
        if state in seen:
            continue
        seen.add(state)

        def go(more, letter, step, initial, turn):
            after = shown + initial
            if re.fullmatch(r"s?(ua)*u?", after):
                heapq.heappush(heap, (cost + more, audit + letter, i + step, after, kept + turn))

        for name in ("user", "assistant"):
            go(2, "I", 0, name[0], ((name, ""),))
        if i < len(rows):
            role, text, gone, cut = rows[i]
            go(3, "D", 1, "", ())
            if not gone:
                go(cut, "K", 1, role[:1], ((role, text),)) if role[:1] in ("s", "u", "a") else None
                for name in ("user", "assistant"):
                    go(2 + cut, "R", 1, name[0], ((name, text),))
    raise AssertionError


def plain_query(rows):
    convs, out = defaultdict(list), []
    for c, t, role, text in rows:
        show = [" " if x is None else str(x) for x in (c, t)]
        role, text = (" " if x is None else x for x in (role, text))
        case = zlib.crc32(f"{show[0]}:{show[1]}".encode()) % 20
        convs[c]
        if case == 0:
            continue
        text = "" if case == 1 else re.sub("[.!?]", "", text) if case == 2 else text
        convs[c] += [(t, "user" if case == 4 else role, text)] * (2 if case == 3 else 1)
    for c, all_rows in convs.items():
        all_rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        seen, marked, counts = set(), [], {"blank": 0, "duplicate": 0, "truncated": 0}
        for _, role, text in all_rows:
            signs = re.sub(r"[\x20\x09-\x0D]", "", text)
            fault = "blank" if not signs else "duplicate" if (role, text) in seen else "truncated" if signs[-1] not in ".!?" else None
            if fault:
                counts[fault] += 1
            seen.add((role, text))
            marked.append((role, text, fault in ("blank", "duplicate"), int(fault == "truncated")))
        turns = [t for t, *_ in all_rows if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        initials = [r[0][:1] for r in marked]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
        cost, audit, kept = plain_repair(marked)
        sha = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in kept).encode()).hexdigest()
        out.append((c, gaps, *counts.values(), illegal, cost, audit, sha))
    return sorted(out, key=repr)


def test_halves_meet_on_the_least_audit():
    dice = random.Random(11)
    for _ in range(600):
        rows = [(dice.choice(["s", "u", "u", "a", "a", "t", ""]), dice.random() < 0.2, dice.random() < 0.3) for _ in range(dice.randrange(1, 12))]
        rows = [(r, g, c and not g) for r, g, c in rows]
        cost, audit, _ = plain_repair([(r, "x", g, int(c)) for r, g, c in rows])
        cuts = sorted({0, len(rows), *(dice.randrange(len(rows) + 1) for _ in range(dice.randrange(4)))})
        blocks = [rows[a:b] for a, b in zip(cuts, cuts[1:])]
        states, tail, found = crossings([summed_up(b) for b in blocks])
        made = "".join(letters for b, s, e in zip(blocks, states, states[1:]) for letters, _ in meet(b, s, e)) + tail
        assert (found, made) == (cost, audit)


def test_rows_of_every_kind(spark, monkeypatch):
    dice = random.Random(2)
    texts = ["", " \n", "Done.", "Done.", "no end", "What? ", "é!", "x" * 5000 + "."]
    rows = [(c, dice.choice([None, *range(12)]), dice.choice([None, "system", "user", "assistant", "assistant", "tool", ""]), dice.choice([None, *texts])) for c in [None, *range(60)] for _ in range(dice.randrange(1, 9))]
    rows += [(99, t, ["user", "assistant"][t % 2], f"turn {t}.") for t in range(300)] + [(98, 1, "user", "again.")] * 50
    schema = "conv_id long, turn long, role string, text string, block int, pos string"
    df = spark.createDataFrame([(*r, 1, "s") for r in rows], schema).repartition(3)
    monkeypatch.setattr(turn_repair, "table", lambda *_: df)
    wanted = plain_query(rows)
    for size in (2048, 37):
        monkeypatch.setattr(turn_repair, "BLOCK_ROWS", size)
        assert sorted(map(tuple, op12_turn_repair(spark, SF).collect()), key=repr) == wanted
    assert repair_turns(damaged(df.limit(0))).edits().count() == 0
    monkeypatch.setattr(turn_repair, "table", lambda *_: df.limit(0))
    assert op12_turn_repair(spark, SF).count() == 0


def test_edits_of_a_conversation(spark):
    rows = [(1, 0, "user", "Hi."), (1, 1, "user", "Hi."), (1, 2, "user", "Once more?"), (1, 3, "assistant", "Yes.")]
    made = repair_turns(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).edits().orderBy("pos", "at")
    assert [(r.edit, r.role, r.text) for r in made.collect()] == [
        ("K", "user", "Hi."), ("D", None, None), ("I", "assistant", ""), ("K", "user", "Once more?"), ("K", "assistant", "Yes."),
    ]


def test_given_conversations(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert sorted(map(tuple, op12_turn_repair(spark, SF).collect()), key=repr) == plain_query(rows)
