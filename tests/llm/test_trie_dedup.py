"""Owners of equal texts against a dictionary."""

import hashlib

import pytest
from hypothesis import given
from hypothesis import strategies as st

from presslake.llm.trie_dedup import Patricia, exact_owners

ROWS = [
    (1, "a text", "x"), (5, "a text", "y"), (3, "a text ", "z"), (4, None, None), (2, "", "e"), (None, "lone", "n"),
    (None, "a text", "n"), (7, "twin", "t"), (7, "twin", "t"), (8, "é" * 3000, "l"), (9, "é" * 3000 + "!", "l"), (10, "é" * 3000, "m"),
]


@given(st.lists(st.binary(max_size=8)))
def test_trie_tells_keys_apart(keys):
    trie, owners = Patricia(), {}
    for key in keys:
        node = trie.insert(key)
        assert node.owner == owners.get(key)
        node.owner = owners.setdefault(key, len(owners))
    assert sorted(n.owner for n in trie.terminals()) == sorted(owners.values())


@pytest.mark.parametrize("largest", [False, True])
@pytest.mark.parametrize("parts", [1, 4])
def test_owners(spark, largest, parts):
    docs = spark.createDataFrame([(*r, 1, "q") for r in ROWS], "doc_id long, text string, lang string, kept int, `group.size` string")
    found = exact_owners(docs.repartition(parts), largest=largest, trie_bytes=10)
    decided, kept = found.decisions().collect(), found.kept()
    groups = {}
    for i, t, _ in ROWS:
        groups.setdefault(t or "", []).append(i)
    keep = {t: (max if largest else min)((i for i in ids if i is not None), default=None) for t, ids in groups.items()}
    sha = {hashlib.sha256(t.encode()).hexdigest(): t for t in groups}
    assert sorted((r.doc_id, sha[r.text_sha256], r.keep_id, r.group_size) for r in decided if r.doc_id is not None) == sorted(
        (i, t or "", keep[t or ""], len(groups[t or ""])) for i, t, _ in ROWS if i is not None
    )
    for t in groups:
        stays = [r for r in decided if sha[r.text_sha256] == t and r.kept]
        assert len(stays) == 1 and stays[0].doc_id == keep[t]
    assert kept.columns == docs.columns
    assert sorted((r.text or "", r.doc_id) for r in kept.collect()) == sorted(keep.items())
    assert {r.text for r in kept.collect()} <= {t for _, t, _ in ROWS}


def test_empty_table(spark):
    found = exact_owners(spark.createDataFrame([], "doc_id long, text string"))
    assert found.decisions().count() == 0 and found.kept().count() == 0
