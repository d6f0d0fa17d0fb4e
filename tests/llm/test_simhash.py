"""Fingerprints, links and components against brute force."""

import random
from itertools import combinations

import numpy as np
import pytest
import xxhash

from presslake.llm import simhash
from presslake.llm.components import components
from presslake.llm.simhash import fingerprint, fingerprint_links, keep_one_of_each, near_groups


def plain_fingerprint(text):
    words = "".join(c.lower() if c.isascii() else c for c in text or "").encode().split()
    shingles = [b" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([b" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_groups(fps):
    group = {f: {f} for f in fps}
    for a, b in combinations(set(fps), 2):
        if (a ^ b).bit_count() <= 3 and group[a] is not group[b]:
            group[a] |= group[b]
            for x in group[b]:
                group[x] = group[a]
    return {f: min(g) for f, g in group.items()}


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def test_fingerprints(spark):
    texts = ["", " \t", "One", "one TWO", "a b c d a b c", "Été ÉTÉ straße Ünï", "x " * 500 + "y", "nul \x00 in", "a\x85b c\x1cd e"]
    for text in texts:
        assert fingerprint(text) == plain_fingerprint(text)
    many = "w v u " * 100_000
    assert fingerprint(many) == plain_fingerprint(many)


@pytest.mark.parametrize("wide", [2048, 3])
def test_links_connect_what_brute_force_connects(spark, monkeypatch, wide):
    monkeypatch.setattr(simhash, "WIDE_KEY", wide)
    dice = random.Random(5)
    fps = [0, (1 << 64) - 1, 7, 15]
    for _ in range(60):
        base = dice.getrandbits(64)
        for _ in range(dice.choice([1, 2, 9])):
            fps.append(base)
            for _ in range(dice.randint(0, 5)):
                base ^= 1 << dice.randrange(64)
    fps = sorted(set(fps))
    table = spark.createDataFrame([(signed(f),) for f in fps], "fp long").repartition(3)
    links = [(r.a, r.b) for r in fingerprint_links(table).collect()]
    assert all(((a ^ b) & (1 << 64) - 1).bit_count() <= 3 for a, b in links)
    found = {r.node: r.root for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    expected = plain_groups([signed(f) & (1 << 64) - 1 for f in fps])
    groups = {}
    for f in fps:
        groups.setdefault(found.get(signed(f), signed(f)), set()).add(f)
    brute = {}
    for f, root in expected.items():
        brute.setdefault(root, set()).add(f)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, brute.values()))


def test_components_of_a_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(100, 160)] + [(500, i) for i in range(501, 560)] + [(7, 7)]
    found = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == {**{i: 100 for i in range(100, 161)}, **{i: 500 for i in range(500, 560)}}


def test_groups_of_documents(spark):
    dice = random.Random(1)
    words = ["".join(dice.choices("abcdefgh", k=6)) for _ in range(400)]
    base = " ".join(words)
    rows = [(9, base), (4, base), (6, base + " tail"), (5, " ".join(dice.sample(words, 300))), (2, ""), (3, None), (None, base), (4, base), (8, "lone words here now")]
    docs = spark.createDataFrame([(*r, 1, "z") for r in rows], "doc_id long, text string, component_id int, fp string").repartition(3)
    fps = [plain_fingerprint(t) for _, t in rows]
    roots = plain_groups(fps)
    least = {}
    for (i, _), f in zip(rows, fps, strict=True):
        if i is not None:
            least[roots[f]] = min(i, least.get(roots[f], i))
    found = sorted(((r["__id"], r["__fp"], r.component_id) for r in near_groups(docs).collect()), key=repr)
    assert found == sorted(((i, signed(f), least[roots[f]]) for (i, _), f in zip(rows, fps, strict=True)), key=repr)
    kept = keep_one_of_each(docs)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == sorted(least.values())
    assert near_groups(docs.limit(0)).count() == 0 and keep_one_of_each(docs.limit(0)).count() == 0
