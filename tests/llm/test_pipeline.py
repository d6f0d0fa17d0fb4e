"""Each stage of the pipeline against a brute-force version, on its predecessor's rows."""

import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from presslake.llm.tokens import tokenizer_path

from .test_mixing import plain_targets
from .test_simhash import plain_fingerprint, plain_groups

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), []
    odd = [(900_001, None, "en", None, 0), (900_002, "", None, "src0", 0), (None, "no id at all", "en", "src1", 12)]
    odd += [(900_003, "the same text twice", "en", "zz", 19)] * 2
    docs = docs.unionByName(spark.createDataFrame(odd, docs.schema))
    out.append(docs)
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        path = str(tmp_path_factory.mktemp("stages") / str(i))
        stage(spark, docs, SF).write.parquet(path)
        docs = spark.read.parquet(path)
        out.append(docs)
    return out


def rows(df):
    return [tuple(r) for r in df.select("doc_id", "text", "lang", "source", "n_chars").collect()]


def test_columns_stay(stages):
    assert all(s.columns == stages[0].columns for s in stages[:-1])


def test_toxicity_takes_toxic_documents_only(spark, stages):
    before, after = Counter(rows(stages[0])), Counter(rows(stages[1]))
    assert not after - before
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    gone = [r[0] for r in (before - after).elements()]
    assert all(labels.get(i) != 0 for i in gone)


def test_exact_dedup(stages):
    best = {}
    for r in rows(stages[1]):
        t = r[1] or ""
        if t not in best or (r[0] is not None and (best[t] is None or r[0] < best[t])):
            best[t] = r[0]
    after = rows(stages[2])
    assert sorted((r[1] or "", r[0] or 0) for r in after) == sorted((t, i or 0) for t, i in best.items())
    assert not Counter(after) - Counter(rows(stages[1]))


def test_near_dedup(stages):
    before, after = rows(stages[2]), rows(stages[3])
    roots = plain_groups([plain_fingerprint(r[1]) for r in before])
    least = defaultdict(list)
    for r in before:
        least[roots[plain_fingerprint(r[1])]].append(r[0])
    wanted = [min((i for i in ids if i is not None), default=None) for ids in least.values()]
    assert sorted(r[0] or 0 for r in after) == sorted(i or 0 for i in wanted) and not Counter(after) - Counter(before)


def test_mixing(stages):
    word = re.compile(r"[^\x20\x09-\x0D]+")
    sizes, got, own = Counter(), Counter(), {}
    for i, t, _, s, _ in rows(stages[3]):
        n = len(word.findall(t or ""))
        sizes[s] += n
        own[i] = own.get(i, 0) + n
    each = Counter()
    for i, t, _, s, n_chars in rows(stages[4]):
        got[s] += len(word.findall(t))
        each[i] += len(word.findall(t))
        assert n_chars == len(t)
    assert {s: got[s] for s in sizes} == {s: int(t + 1e-9) for s, t in plain_targets(dict(sizes)).items()}
    assert all(each[i] <= 3 * own[i] for i in each)


def test_packing(stages):
    plain = Tokenizer.from_file(tokenizer_path())
    lengths = Counter(len(plain.encode(r[1] or "", add_special_tokens=False).ids) + 1 for r in rows(stages[4]))
    pieces = stages[5].collect()
    assert Counter(r.doc_tokens for r in pieces if r.start == 0) == lengths
    assert len({r.sequence_id for r in pieces}) == len(pieces) and sum(r.length for r in pieces) == sum(k * v for k, v in lengths.items())


def test_run_gives_the_last_stage(spark):
    done = corpus_pipeline.run(spark, SF)
    assert done.columns[:6] == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id"]
    assert done.agg(F.count("*")).first()[0] > 0


def test_empty_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, SF).count() == 0
