"""Packing and shard files against the tokenizer itself."""

import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

import pyarrow as pa
from presslake.llm.id_shards import PerfectHash, Shard, read_shards, shards_of_key, write_shards
from presslake.llm.power_packing import pack_by_powers, piece_lengths
from presslake.llm.tokens import Encoder, pieces, tokenizer_path

TEXTS = [
    (3, "It's a plain text, don't you'LL see: 42 items & more!!"), (1, ""), (2, None), (5, "Été ÀÖ straße ÉÈ İstanbul Σίσυφος ΟΔΟΣ"),
    (4, "áë \x1c!\x1d! ​ zero width　x <|endoftext|>end <|startoftext|>"), (7, "word " * 9000),
    (6, "x" * 5000), (6, "x" * 5000), (None, "no id"), (9, "漢字かな交じり文 and \U0001f600 emoji 3½"), (8, " \t\n\r\x0b\x0c "),
]


@pytest.fixture(scope="module")
def plain():
    return Tokenizer.from_file(tokenizer_path())


def expected(plain, text, end):
    return np.asarray([*plain.encode(text or "", add_special_tokens=False).ids, end], dtype="<u4")


def docs(spark):
    return spark.createDataFrame([(*r, "odd", 1) for r in TEXTS], "doc_id long, text string, start string, key int").repartition(3)


@settings(max_examples=150, deadline=None)
@given(st.text(max_size=60) | st.text("aZ'sl 1.<|endoftext>\nÉ", max_size=60))
def test_cached_words_give_the_ids_of_the_tokenizer(text):
    encoder = Encoder.of(tokenizer_path())
    assert encoder.ids(text) == expected(encoder.tokenizer, text, 0).tobytes()[:-4]


def test_long_texts_are_cut_at_white_space_only():
    text = "ab cd" * 100 + "x" * 80
    assert "".join(pieces(text, 7)) == text and all(p[:1] in ("a", " ") for p in pieces(text, 7))


@given(st.integers(1, 20000))
def test_piece_lengths(n):
    found = list(piece_lengths(n, 4096))
    assert sum(found) == n and found == sorted(found, reverse=True) and all(x & (x - 1) == 0 for x in found)
    assert len({x for x in found if x < 4096}) == sum(x < 4096 for x in found)


def test_pieces_tile_each_document(spark, plain):
    rows = pack_by_powers(docs(spark), with_ids=True).collect()
    assert sorted(r.sequence_id for r in rows) == list(range(len(rows)))
    assert [r.length for r in sorted(rows, key=lambda r: r.sequence_id)] == sorted((r.length for r in rows), reverse=True)
    whole = sorted([(k, expected(plain, t, 2).tolist()) for k, t in TEXTS], key=repr)
    got = []
    for key in {k for k, _ in TEXTS}:
        mine = sorted((r for r in rows if r.doc_id == key), key=lambda r: r.start)
        copies = sum(r.start == 0 for r in mine)
        got += [(key, [i for r in mine[::copies] for i in r.ids])] * copies
    assert sorted(got, key=repr) == whole
    for r in rows:
        assert r.offset == 0 and r.ids_crc32 == zlib.crc32(np.asarray(r.ids, "<u4").tobytes()) and len(r.ids) == r.length


def test_empty_tables(spark, tmp_path):
    none = docs(spark).limit(0)
    assert pack_by_powers(none).count() == 0
    folder = f"file://{tmp_path}/none"
    assert read_shards(spark, write_shards(none, folder)).count() == 0


def test_shard_files_round_trip(spark, plain, tmp_path):
    folder = f"file://{tmp_path}/ids"
    files = write_shards(docs(spark), folder, shard_text_bytes=20_000)
    assert files.count() > 1
    rows = sorted(read_shards(spark, files).collect(), key=lambda r: r.start)
    order = sorted(TEXTS, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    ids = [expected(plain, t, 1) for _, t in order]
    starts = np.cumsum([0, *map(len, ids)])
    assert [(r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in rows] == [
        (k, s, len(i), zlib.crc32(i.tobytes())) for (k, _), s, i in zip(order, starts.tolist(), ids, strict=False)
    ]
    for file in tmp_path.glob("ids/*.ids"):
        shard = Shard(pa.BufferReader(file.read_bytes()))
        assert len(shard.lookup(10**12)) == 0
        assert all(i in shard.lookup(shard.key(i)) for i in range(len(shard.parts["keys"])))


def test_null_and_hot_keys(spark, plain, tmp_path):
    null_like = 0x5851F42D4C957F2D
    rows = [(None, f"none {i}") for i in range(60)] + [(null_like, "a key")] + [(7, f"text number {i} " * 20) for i in range(400)] + [(3, "three"), (9, "nine")]
    folder = f"file://{tmp_path}/ids"
    files = write_shards(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), folder, shard_text_bytes=20_000)
    spread = [r.shard for r in shards_of_key(files, 7).collect()]
    assert len(spread) >= 3 and len(shards_of_key(files, None).collect()) >= 1 and shards_of_key(files, 10**19 // 2).count() <= 1
    got = sorted(read_shards(spark, files).collect(), key=lambda r: r.start)
    assert Counter(r.doc_id for r in got) == Counter(k for k, _ in rows)
    assert [r.start for r in got] == np.cumsum([0, *[r.n_tokens for r in got]])[:-1].tolist()
    assert Counter((r.doc_id, r.ids_crc32) for r in got) == Counter((k, zlib.crc32(expected(plain, t, 1).tobytes())) for k, t in rows)
    found = {7: 0, None: 0, null_like: 0, 8: 0}
    for file in tmp_path.glob("ids/*.ids"):
        shard = Shard(pa.BufferReader(file.read_bytes()))
        for key in found:
            found[key] += len(shard.lookup(key))
            assert all(shard.key(i) == key for i in shard.lookup(key))
    assert found == {7: 400, None: 60, null_like: 1, 8: 0}


@settings(max_examples=20, deadline=None)
@given(st.sets(st.integers(0, 2**64 - 1), min_size=1, max_size=500))
def test_perfect_hash_is_minimal(keys):
    index = PerfectHash.build(np.asarray(sorted(keys), dtype=np.uint64))
    assert {index.slot(k) for k in keys} == set(range(len(keys)))
