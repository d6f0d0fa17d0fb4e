"""Removed bytes against counting all strings of 200 bytes."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from presslake.llm import suffix_dedup
from presslake.llm.suffix_dedup import Surroundings, repeated_bytes

ROWS = "doc_id long, text string, spans string, n_bytes int"


def plain(texts):
    """Removed spans and digest of each text, by counting."""
    raw = [(t or "").encode() for t in texts]
    count = Counter(r[i : i + 200] for r in raw for i in range(len(r) - 199))
    out = []
    for r in raw:
        gone = bytearray(len(r))
        for i in range(len(r) - 199):
            if count[r[i : i + 200]] > 1:
                gone[i : i + 200] = b"\1" * 200
        spans, kept = [], bytearray()
        for i, g in enumerate(gone):
            if g and (i == 0 or not gone[i - 1]):
                spans.append([i, i])
            if g:
                spans[-1][1] = i + 1
            else:
                kept.append(r[i])
        out.append((len(r), [tuple(s) for s in spans], hashlib.sha256(kept).hexdigest()))
    return out


def made(dice):
    def prose(n):
        return "".join(dice.choices("abcdé fgh\n", k=n))

    passage, other, base = prose(420), prose(205), prose(1500)
    texts = [None, "", "short", prose(300), prose(199), "x" * 150, "x" * 200, "y" * 900, "z" * 201, "ab" * 300, "a" + "ba" * 250, "abc" * 110 + prose(100)]
    texts += [prose(dice.randint(0, 300)) + passage + prose(dice.randint(0, 300)) for _ in range(4)]
    texts += [passage[:260] + prose(50), prose(30) + passage[150:], passage[100:340], other, prose(10) + other + prose(9), base, base]
    for _ in range(12):  # near copies, so one anchor has many surroundings
        at = dice.randrange(1400)
        texts.append(base[:at] + prose(2) + base[at + dice.randint(0, 4) :])
    texts += [prose(240) * 2, passage + prose(100) + passage, "line of text " * 60, "line of text " * 40 + prose(20), prose(17) * 40]
    dice.shuffle(texts)
    return texts


def check(spark, texts, ids=None):
    ids = list(range(len(texts))) if ids is None else ids
    docs = spark.createDataFrame([(i, t, "s", 1) for i, t in zip(ids, texts, strict=True)], ROWS).repartition(3)
    got = sorted(((r.doc_id, r.n_bytes, [tuple(s) for s in r.spans], r.kept_sha256) for r in repeated_bytes(docs).collect()), key=repr)
    assert got == sorted(((i, *p) for i, p in zip(ids, plain(texts), strict=True)), key=repr)


def test_removed_bytes(spark):
    check(spark, made(random.Random(2)))


def test_texts_in_pieces(spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "_PIECE", 350)
    texts = made(random.Random(4))
    found = {(row, int(p)) for rows, _, packed in suffix_dedup.anchors([(t or "").encode() for t in texts]) for row, p in zip(rows.tolist(), (packed >> 16) - (packed >> 8 & 255), strict=True)}
    monkeypatch.undo()
    whole = {(row, int(p)) for rows, _, packed in suffix_dedup.anchors([(t or "").encode() for t in texts]) for row, p in zip(rows.tolist(), (packed >> 16) - (packed >> 8 & 255), strict=True)}
    assert whole - found == set() or len(found) >= len(whole)


def test_repeated_rows_and_identifiers(spark):
    text = "".join(random.Random(9).choices("qwertyuiop", k=400))
    check(spark, [text, text, text[:399], None, "tail " * 5], [1, 1, 1, None, None])


def test_empty_table(spark):
    assert repeated_bytes(spark.createDataFrame([], ROWS)).count() == 0


@pytest.mark.parametrize("collide", [False, True])
def test_suffix_order(monkeypatch, collide):
    dice = random.Random(3)
    items = list({(bytes(dice.choices(b"ab", k=dice.randint(10, 14))), dice.randint(2, 8)) for _ in range(30)})
    found = Surroundings(items)
    if collide:  # every hash is equal: the bytes decide
        found.prefix = [0] * len(found.prefix)
    for on_right in (True, False):
        sides = [b[a:] if on_right else b[:a][::-1] for b, a in items]
        order, common = found.order(on_right)
        assert [sides[i] for i in order] == sorted(sides)
        for i, j, n in zip(order, order[1:], common, strict=False):
            assert sides[i][:n] == sides[j][:n] and (sides[i][n : n + 1] != sides[j][n : n + 1] or n == len(sides[i]) == len(sides[j]))


def test_long_runs_have_few_anchors():
    rows = sum(len(r) for r, _, _ in suffix_dedup.anchors([b"x" * 500_000, b"ab" * 250_000]))
    assert rows < 400 and suffix_dedup.run_strings(np.frombuffer(b"ab" * 200, dtype=np.uint8)).all()


@pytest.mark.parametrize("together", [1, 4])
def test_strings_of_wide_anchors(spark, monkeypatch, together):
    monkeypatch.setattr(suffix_dedup, "TOGETHER", together)
    check(spark, made(random.Random(6)))


def test_many_different_surroundings_never_meet(spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "TOGETHER", 20)
    real = suffix_dedup._interval_rows

    def bounded(batches):
        def counted():
            sizes = Counter()
            for batch in batches:
                sizes.update(batch.column(0).to_pylist())
                assert max(sizes.values(), default=0) <= 20
                yield batch
        return real(counted())

    monkeypatch.setattr(suffix_dedup, "_interval_rows", bounded)
    dice = random.Random(7)
    passage = "".join(dice.choices("abcdefgh", k=500))
    check(spark, ["".join(dice.choices("ijkl", k=dice.randint(90, 300))) + passage + "".join(dice.choices("mnop", k=250)) for _ in range(60)])


def test_rows_that_repeat_stay_linear(spark):
    dice = random.Random(12)
    text, other = ("".join(dice.choices("qwertyuiop", k=4000)) for _ in range(2))
    texts = [text] * 300 + [other] * 300 + [text[1000:1500] + "!", "?" * 100 + other[:199], other[:200]]
    check(spark, texts, [1] * 300 + [None] * 300 + [2, 3, None])


@pytest.mark.parametrize("together", [1, 8])
def test_a_passage_in_very_many_texts(spark, monkeypatch, together):
    monkeypatch.setattr(suffix_dedup, "TOGETHER", together)
    dice = random.Random(13)
    passage = "".join(dice.choices("abcdefgh", k=700))
    texts = ["".join(dice.choices("ijkl", k=dice.randint(0, 300))) + passage[dice.choice([0, 0, 0, 40]) :] + "".join(dice.choices("mnop", k=250)) for _ in range(200)]
    check(spark, texts)
