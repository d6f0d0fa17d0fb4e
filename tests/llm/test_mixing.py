"""Targets by repeated resharing; words taken, counted document by document."""

import random
import re

import numpy as np
import pytest

from presslake.llm.mixing import mix_sources, permuted, place_of, source_targets


def plain_targets(sizes, weights=(1, 2, 3)):
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, stopped = sum(sizes.values()), {}
    while True:
        open_ = [s for s in names if s not in stopped]
        left, all_open = total - sum(stopped.values()), sum(weight[o] for o in open_)
        target = {s: left * weight[s] / all_open for s in open_}
        over = {s: 3 * sizes[s] for s in open_ if target[s] > 3 * sizes[s]}
        if not over:
            return {**target, **{s: float(v) for s, v in stopped.items()}}
        stopped |= over


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


@pytest.mark.parametrize("n", [1, 2, 3, 17, 64, 1000])
def test_permutations(n):
    k = np.arange(n)
    for source, passes in ((0, 0), (5, 2)):
        moved = permuted(k, np.full(n, n), np.full(n, source), np.full(n, passes))
        assert sorted(moved.tolist()) == k.tolist()
        assert place_of(moved, np.full(n, n), np.full(n, source), np.full(n, passes)).tolist() == k.tolist()
    if n > 20:
        assert (permuted(k, np.full(n, n), 0 * k, 0 * k) != permuted(k, np.full(n, n), 0 * k, 0 * k + 1)).any()


def test_targets(spark):
    dice = random.Random(3)
    for trial in range(4):
        sizes = {s: dice.choice([0, 1, 10, 1000, 100000]) for s in [*"zebraéA", "", None][: 3 + 2 * trial]} | {"b": 50_000}
        rows = source_targets(spark.createDataFrame([(s, n, 1) for s, n in sizes.items()], "source string, source_size long, n_docs long")).collect()
        expected = plain_targets(sizes)
        assert {r.source: pytest.approx(r.target) for r in rows} == expected
        assert sum(r.target for r in rows) == pytest.approx(sum(sizes.values()))


def corpus(spark):
    dice = random.Random(8)
    rows = []
    for i in range(300):
        source = dice.choice(["a", "a", "a", "a", "b", "c", None, "d"])
        rows.append((i, " ".join(f"w{i}.{j}" for j in range(dice.choice([0, 1, 5, 40, 300]))), source))
    rows += [(7, None, "a"), (8, rows[8][1], rows[8][2]), (None, "no id here", "b"), (901, "tiny", "e"), (902, " lone\tword ", "f"), (903, "", "g")]
    return rows, spark.createDataFrame([(*r, 3, "x") for r in rows], "doc_id long, text string, source string, size int, target string")


def test_mix(spark):
    rows, docs = corpus(spark)
    found = mix_sources(docs.repartition(4), block_words=32, shard_slots=16, carry=False).taken().collect()
    again = mix_sources(docs.repartition(2), block_words=32, shard_slots=16, carry=False).taken().collect()
    assert sorted(found, key=repr) == sorted(again, key=repr) and len(found) == len(rows)
    sizes = {}
    for _, t, s in rows:
        sizes[s] = sizes.get(s, 0) + len(words(t))
    expected = plain_targets(sizes)
    assert sorted((r.doc_id or -1, r.size) for r in found) == sorted((i or -1, len(words(t))) for i, t, _ in rows)
    assert all(r.taken <= 3 * r.size for r in found)
    by_target = {}
    for r in found:
        by_target[round(r.target, 6)] = by_target.get(round(r.target, 6), 0) + r.taken
    wanted = {}
    for t in expected.values():
        wanted[round(t, 6)] = wanted.get(round(t, 6), 0) + int(t + 1e-9)
    assert by_target == wanted


def test_documents_of_the_mix_hold_the_words_taken(spark):
    rows, docs = corpus(spark)
    mix = mix_sources(docs, block_words=32, shard_slots=16)
    out = mix.documents()
    assert out.columns == docs.columns
    got, taken = {}, {}
    for r in out.collect():
        assert r.text and r.size == 3
        got[r.doc_id] = got.get(r.doc_id, 0) + len(words(r.text))
        assert any(set(words(r.text)) <= set(words(t)) for i, t, _ in rows if i == r.doc_id)
    for r in mix.taken().collect():
        taken[r.doc_id] = taken.get(r.doc_id, 0) + r.taken
    assert got == {k: v for k, v in taken.items() if v}


def test_empty_and_wordless_tables(spark):
    _, docs = corpus(spark)
    assert mix_sources(docs.limit(0)).taken().count() == 0 and mix_sources(docs.limit(0)).documents().count() == 0
    none = mix_sources(spark.createDataFrame([(1, None, None), (2, " ", "a")], "doc_id long, text string, source string"))
    assert sorted((r.doc_id, r.taken, r.target) for r in none.taken().collect()) == [(1, 0, 0.0), (2, 0, 0.0)]


def test_any_number_of_sources(spark):
    docs = spark.range(150_000).selectExpr("id as doc_id", "concat('s', lpad(id, 6, '0')) as source", "repeat('w ', cast(id % 5 as int)) as text")
    got = mix_sources(docs, block_words=2, carry=False).taken().collect()
    targets = plain_targets({f"s{i:06d}": i % 5 for i in range(150_000)})
    assert len(got) == 150_000
    for r in got:
        assert abs(r.target - targets[f"s{r.doc_id:06d}"]) < 1e-6 and r.taken == int(r.target + 1e-9)
