"""Periodic runs against plain comparison of all words at all distances."""

import hashlib
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from presslake.llm.periodic_runs import automaton_runs, collapsed, digests, near_stretches, op13_periodic_runs, periodic_runs, word_runs

SF = "/root/testdata/sf0.001"


def plain_runs(words, least=24, periods=3):
    found, n = {}, len(words)
    for q in range(1, n // periods + 1):
        i = q
        while i < n:
            j = i
            while j < n and words[j] == words[j - q]:
                j += 1
            start, length = i - q, j - i + q
            if length >= max(least, periods * q) and (start, length) not in found:
                found[start, length] = q  # the smallest period comes first
            i = j + 1
    return sorted(((s, n, q) for (s, n), q in found.items()), key=lambda r: (r[0], r[2]))


def odd_sequences():
    dice = random.Random(7)
    for _ in range(400):
        parts = []
        for _ in range(dice.randrange(1, 6)):
            unit = [b"%d" % dice.randrange(dice.choice([1, 2, 3, 50])) for _ in range(dice.randrange(1, 14))]
            parts += (unit * dice.randrange(1, 9))[: dice.randrange(1, 90)]
        yield parts
    a, b = [b"a"], [b"a", b"b"]
    for _ in range(9):
        a, b = b, b + a
    yield b  # Fibonacci words hold many runs
    yield [b"x"] * 300
    yield []


def test_runs_of_odd_sequences():
    for words in odd_sequences():
        assert word_runs(words) == plain_runs(words)


def test_the_automaton_alone_and_other_bounds():
    for words in odd_sequences():
        symbols = [hash(w) % 1009 for w in words]
        for least, periods in ((1, 2), (4, 2), (10, 5)):
            wanted = plain_runs(symbols, least, periods)
            assert sorted(automaton_runs(symbols, least, periods)) == sorted(wanted)
            assert word_runs(words, least, periods) == plain_runs(words, least, periods)
    with pytest.raises(ValueError):
        automaton_runs([1, 1], 1, 1)


def test_the_sieve_passes_over_far_repeats():
    import numpy as np

    line, other = list(range(100, 160)), list(range(1000, 3000))
    hashes = np.array(line + other + line, dtype=np.uint64)
    assert list(near_stretches(hashes)) == []


def test_a_long_text():
    words = [b"%d" % (i % 997) for i in range(60_000)]
    assert word_runs(words) == [(0, 60_000, 997)]
    assert collapsed(words, word_runs(words)) == words[:997]


def test_rows_of_every_kind(spark):
    unit = "one two three four five six seven eight "
    rows = [(1, unit * 5, "x"), (1, unit * 5, "x"), (None, unit * 3 + "end", "y"), (2, None, None), (3, "", ""), (4, " \t\n", "z"), (5, "no run here", "w")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, runs string")
    got = sorted((r.doc_id or 0, [tuple(x) for x in r.runs], r.collapsed) for r in periodic_runs(docs).collect())
    once = unit.strip()
    assert got == [(0, [(0, 24, 8)], once + " end"), (1, [(0, 40, 8)], once), (1, [(0, 40, 8)], once), (2, [], ""), (3, [], ""), (4, [], ""), (5, [], "no run here")]
    assert periodic_runs(docs.limit(0)).count() == 0 and digests(periodic_runs(docs.limit(0))).count() == 0
    shown = {r.doc_id: r for r in digests(periodic_runs(docs)).collect()}
    assert (shown[1].n_runs, shown[1].start, shown[1].length, shown[1].period, shown[1].exponent_milli) == (1, 0, 40, 8, 5000)
    assert shown[2].n_runs == 0 and shown[2].start is None and shown[2].exponent_milli is None
    assert shown[2].runs_sha256 == shown[2].collapsed_sha256 == hashlib.sha256(b"").hexdigest()


def test_query_against_plain_comparison(spark):
    got = {r.doc_id: r for r in op13_periodic_runs(spark, SF).collect()}
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    assert len(got) == len(docs) and sum(r.n_runs for r in got.values()) > 5
    for r in docs:
        words = re.findall(r"[^\x20\x09-\x0D]+", r.text or "")
        h, n = zlib.crc32(str(r.doc_id).encode()), len(words)
        if h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
        runs = plain_runs(words)
        gone = {i for s, k, q in runs for i in range(s + q, s + k)}
        rest = " ".join(w for i, w in enumerate(words) if i not in gone)
        lines = "".join(f"{s},{k},{q}\n" for s, k, q in runs)
        best = min(runs, key=lambda x: (-x[1] / x[2], x[0], x[2]), default=(None, None, None))
        milli = 1000 * best[1] // best[2] if runs else None
        sha = [hashlib.sha256(x.encode()).hexdigest() for x in (lines, rest)]
        assert tuple(got[r.doc_id]) == (r.doc_id, len(runs), *best, milli, *sha)
    assert spark.read.parquet(f"{SF}/documents.parquet").where(F.crc32(F.col("doc_id").cast("string")) % 10 == 0).count() > 5
