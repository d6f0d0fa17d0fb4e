"""Properties that hold for any input, one dominant key included."""

import datetime as dt
import random
import re

import numpy as np
import pandas as pd
import pytest
from conftest import rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from presslake.operators import merge, queues, vectors
from presslake.operators.audit import constraint_audit
from presslake.operators.numbering import batch_assign, report_row_number, surrogate_keys
from presslake.operators.text import text_dedup_blocks

AS_OF = dt.datetime(2025, 1, 1)
FEW = settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))


def skewed(n=3000, seed=1):
    """Rows of which a third belong to one domain; some dates unknown, many equal."""
    pick = random.Random(seed)
    return [
        (i, "hot.com" if i % 3 == 0 else f"d{pick.randrange(40)}.com",
         None if pick.random() < 0.05 else dt.datetime(2024, 1, 1) + dt.timedelta(days=pick.randrange(30)))
        for i in range(n)
    ]


def newest_first(row):
    return (row[2] is not None, -row[2].timestamp() if row[2] else 0, row[0])


@pytest.mark.parametrize("cap", [1, 7, 400])
def test_top_per_group_is_exact_under_skew(spark, cap):
    data = skewed()
    df = spark.createDataFrame(data, "id_page bigint, domain string, publication_date timestamp").repartition(8)
    got = queues.top_per_group(df, "domain", queues.newest_first(), cap, F.col("id_page"), ways=16)
    expected = []
    for domain in {d[1] for d in data}:
        expected += sorted((d for d in data if d[1] == domain), key=newest_first)[:cap]
    assert rows(got, "id_page") == sorted(((d[0],) for d in expected), key=repr)


def test_row_numbers_and_batches_follow_the_order(spark):
    data = skewed(1000)
    df = spark.createDataFrame(data, "id_page bigint, domain string, publication_date timestamp").repartition(5)
    ordered = sorted(data, key=newest_first)
    numbered = report_row_number(df, queues.newest_first())
    assert {r.id_page: r.row_no for r in numbered.collect()} == {d[0]: i for i, d in enumerate(ordered, 1)}
    batched = batch_assign(df, queues.newest_first(), 30)
    assert {r.id_page: r.batch_no for r in batched.collect()} == {d[0]: i // 30 for i, d in enumerate(ordered)}


def test_surrogate_keys_are_dense_and_do_not_depend_on_partitions(spark):
    df = spark.range(5000).select(F.concat(F.lit("u"), "id").alias("url"))
    first = {r.url: r.k for r in surrogate_keys(df.repartition(7), "url", "k", after=9, buckets=64).collect()}
    second = {r.url: r.k for r in surrogate_keys(df.repartition(3, "url"), "url", "k", after=9, buckets=64).collect()}
    assert first == second and sorted(first.values()) == list(range(10, 5010))


@given(
    st.dictionaries(st.integers(0, 20), st.floats(0, 1, width=32)), st.dictionaries(st.integers(0, 20), st.floats(0, 1, width=32)))
@FEW
def test_embedding_upsert_is_idempotent_and_keeps_keys_unique(spark, old, new):
    schema = "id bigint, id_page bigint, embedding array<float>"
    stored = spark.createDataFrame([(100 + i, k, [v]) for i, (k, v) in enumerate(old.items())], schema)
    delta = spark.createDataFrame([(k, [v]) for k, v in new.items()], "id_page bigint, embedding array<float>")
    once = merge.embedding_upsert(stored, delta)
    assert {r.id_page: r.embedding[0] for r in once.collect()} == {**old, **new}
    assert constraint_audit({"content_embeddings": once}, dim=1).count() == 0
    assert rows(merge.embedding_upsert(once, delta), "*") == rows(once, "*")


@given(st.lists(st.lists(st.sampled_from("abcdef "), max_size=6), max_size=8))
@FEW
def test_every_line_survives_once(spark, docs):
    df = spark.createDataFrame([(i, "\n".join(lines)) for i, lines in enumerate(docs)], "id bigint, t string")
    kept = {r.id: [line for line in r.t.split("\n") if line] for r in text_dedup_blocks(df, "id", "t").collect()}
    seen, expected = set(), {}
    for i, lines in enumerate(docs):
        expected[i] = []
        for line in lines:
            if line.strip() and line not in seen:
                seen.add(line)
                expected[i].append(line)
    assert kept == expected


def test_queue_and_finished_work_do_not_meet(spark):
    import __spark_entry__ as entry
    from crosscheck.registry import Tables

    t = Tables(spark, "/root/testdata/sf0.001")
    queue = entry.queries()["embed_queue"](spark, t.sf_dir)
    assert queue.join(t("v_content_embeddings"), "id_page").count() == 0
    assert queue.groupBy("id_page").count().where("count > 1").count() == 0


def corpus(spark, n=400, dim=16):
    rng = np.random.default_rng(3)
    values = rng.normal(size=(n, dim)).astype("float32")
    values[5] = values[6]
    values[9] = 0
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(values)], "id_page bigint, embedding array<float>")
    return df.repartition(5), values.astype("float64")


@pytest.mark.parametrize("metric", ["cosine", "ip", "l2"])
def test_many_queries_match_brute_force_and_single_queries(spark, metric):
    df, values = corpus(spark)
    queries = df.where("id_page in (5, 77, 120)").withColumnRenamed("id_page", "query_id")
    got = vectors.semantic_topk_many(df, queries, 12, metric)
    by_query = {}
    for r in got.collect():
        by_query.setdefault(r.query_id, []).append((r.id_page, r.score))
    for q in (5, 77, 120):
        if metric == "l2":
            score = np.linalg.norm(values - values[q], axis=1)
        else:
            score = values @ values[q]
            if metric == "cosine":
                with np.errstate(divide="ignore", invalid="ignore"):
                    score = score / (np.linalg.norm(values, axis=1) * np.linalg.norm(values[q]))
        usable = [i for i in range(len(values)) if not np.isnan(score[i])]
        expected = sorted(usable, key=lambda i: (round(score[i] if metric == "l2" else -score[i], 6), i))[:12]
        assert sorted(i for i, _ in by_query[q]) == sorted(expected)
        single = vectors.semantic_topk(df, values[q].tolist(), 12, metric)
        assert sorted(r.id_page for r in single.collect()) == sorted(expected)


def test_any_number_of_queries_in_blocks(spark, monkeypatch):
    df, _ = corpus(spark, 60)
    monkeypatch.setattr(vectors, "QUERY_BLOCK", 7)
    monkeypatch.setattr(vectors, "ROW_BLOCK", 11)
    asked = df.withColumnRenamed("id_page", "query_id")
    got = rows(vectors.semantic_topk_many(df, asked, 3, "l2"), "query_id", "id_page")
    monkeypatch.undo()
    assert got == rows(vectors.semantic_topk_many(df, asked, 3, "l2"), "query_id", "id_page")
    assert vectors.semantic_topk_many(df.limit(0), asked, 3).count() == vectors.semantic_topk_many(df, asked.limit(0), 3).count() == 0


def test_vectors_of_another_length_are_an_error(spark):
    df = spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0]), (3, None)], "id_page bigint, embedding array<float>")
    asked = df.where("id_page = 1").withColumnRenamed("id_page", "query_id")
    with pytest.raises(Exception, match="different lengths"):
        vectors.semantic_topk(df, [1.0, 2.0], 3).collect()
    with pytest.raises(Exception, match="different lengths"):
        vectors.semantic_topk_many(df, asked, 3).collect()
    assert rows(vectors.semantic_topk(df.where("id_page <> 2"), [1.0, 2.0], 3), "id_page") == [(1,)]


def test_embedding_isolates_failures_and_repeats_itself(spark):
    df = spark.createDataFrame([(1, "good text"), (2, ""), (3, "bad text"), (4, None), (5, "more good")], "id bigint, t string")

    def model(texts):
        if any("bad" in t for t in texts):
            raise RuntimeError("refused")
        return [[float(len(t)), 1.0] for t in texts]

    got = vectors.embed_texts(df.coalesce(1), "id", "t", fn=model)
    assert rows(got, "id", "outcome", "embedding") == [
        (1, "ok", [9.0, 1.0]), (2, "skipped", None), (3, "failed", None), (4, "skipped", None), (5, "ok", [9.0, 1.0])]
    stand_in = vectors.embed_texts(df, "id", "t", dim=32)
    assert rows(stand_in, "*") == rows(vectors.embed_texts(df.repartition(3), "id", "t", dim=32), "*")


def test_vectors_are_copied_a_bounded_number_of_times(spark):
    values = np.random.default_rng(1).normal(size=(30_000, 2)).astype("float32")
    df = spark.createDataFrame(pd.DataFrame({"id_page": range(len(values)), "embedding": values.tolist()}), "id_page bigint, embedding array<float>")
    asked = df.withColumnRenamed("id_page", "query_id")
    found = vectors.semantic_topk_many(df, asked, 2)
    copies = [int(n) for n in re.findall(r"sequence\((?:cast\()?0(?: as bigint\))?, (?:cast\()?(\d+)", found._jdf.queryExecution().analyzed().toString())]
    assert copies and all(n + 1 <= 2 * spark.sparkContext.defaultParallelism for n in copies)
    assert found.count() == 60_000


@pytest.mark.parametrize("metric", ["cosine", "ip", "l2"])
def test_equal_vectors_tie_by_id_in_any_block(spark, monkeypatch, metric):
    dice = np.random.default_rng(4)
    one, rest = dice.normal(size=33).astype("float32"), dice.normal(size=(90, 33)).astype("float32")
    values = [(one * (3 if metric == "ip" else 1)).tolist()] * 40 + rest.tolist() + [[0.0] * 33]
    df = spark.createDataFrame(list(enumerate(values)), "id_page bigint, embedding array<float>").repartition(3)
    asked = df.where("id_page < 40").withColumnRenamed("id_page", "query_id")
    monkeypatch.setattr(vectors, "QUERY_BLOCK", 6)
    monkeypatch.setattr(vectors, "ROW_BLOCK", 7)
    got = rows(vectors.semantic_topk_many(df, asked, 5, metric), "query_id", "id_page")
    assert got == sorted(((q, i) for q in range(40) for i in range(5)), key=repr)
