"""The chain on held-out documents, and its parts against plain versions."""

import numpy as np
from pyspark.sql import functions as F

from presslake.llm.toxicity import CHAIN, THRESHOLD, fit_chain, fit_linear, labelled_sample, score, tokens

SF = "/root/testdata/sf0.01"


def test_linear_model_is_at_its_optimum():
    dice = np.random.default_rng(1)
    x = dice.random((300, 12)) < 0.3
    dense, y = dice.random((300, 2)), (dice.random(300) < 0.2 + 0.6 * x[:, 3]).astype(float)
    rows, columns = np.nonzero(x)
    w = fit_linear(rows, columns, 12, dense, y, 1.0)
    p = 1 / (1 + np.exp(-(np.column_stack([x, dense, np.ones(300)]) @ w)))
    slope = np.column_stack([x, dense, np.ones(300)]).T @ (p - y)
    slope[:-1] += w[:-1]
    assert np.abs(slope).max() < 0.2


def test_held_out_documents(spark):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    held = F.pmod(F.xxhash64("doc_id", F.lit("held")), F.lit(3)) == 0
    found = score(docs, fit_chain(docs, labels.where(~held))).join(labels.where(held), "doc_id")
    rows = found.where(F.col("lang") == "en").select("rejected", "toxic").collect()
    toxic = [r.rejected for r in rows if r.toxic]
    clean = [r.rejected for r in rows if not r.toxic]
    assert sum(toxic) >= 0.9 * len(toxic) > 0 and sum(clean) <= 0.01 * len(clean)


def test_scores_are_those_of_the_chain_by_hand(spark):
    rows = [(i, ("bad thing " if i % 3 == 0 else "good thing ") + f"w{i % 5}", 1, int(i % 3 == 0)) for i in range(60)]
    docs = spark.createDataFrame([(a, b, "s", 0.5) for a, b, *_ in rows] + [(None, None, "s", 1.0), (99, "", None, None), (3, "bad", "s", 0.1)], "doc_id long, text string, rejected string, p_toxic double")
    labels = spark.createDataFrame([(a, q, t) for a, _, q, t in rows] + [(None, 1, 1), (3, None, None), (12345, 1, 1)], "doc_id long, quality int, toxic int")
    model = fit_chain(docs, labels)
    out = score(docs, model).collect()
    assert len(out) == 63 and set(out[0].asDict()) == {"doc_id", "text", "rejected", *(f"p_{n}" for n in CHAIN)}
    for r in out:
        earlier = []
        for w in model.weights:
            shown = [model.vocabulary[t] for t in tokens(r.text or "") if t in model.vocabulary]
            z = w[-1] + sum(w[i] for i in shown) + sum(a * b for a, b in zip(w[len(model.vocabulary):-1], earlier, strict=True))
            earlier.append(1 / (1 + np.exp(-z)))
        assert np.allclose([r[f"p_{n}"] for n in CHAIN], earlier)
        assert r.rejected == (earlier[1] >= THRESHOLD and bool(tokens(r.text or ""))) == ("bad" in (r.text or ""))


def test_no_labels_and_no_documents(spark):
    docs = spark.createDataFrame([(1, "a text")], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert [r.rejected for r in score(docs, fit_chain(docs, none)).collect()] == [False]
    assert score(docs.limit(0), fit_chain(docs.limit(0), none)).count() == 0


def test_the_sample_is_bounded(spark):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    assert len(fit_chain(docs, labels, limit=40).weights) == len(CHAIN)


def test_a_labelled_document_that_repeats_counts_once(spark):
    docs = spark.range(500).selectExpr("7L as doc_id", "concat('text ', id) as text").unionByName(spark.createDataFrame([(8, None), (9, "x" * 300_000)], "doc_id long, text string"))
    labels = spark.createDataFrame([(7, 1, 1), (8, 0, 0), (9, 1, 0), (9, 0, 1)], "doc_id long, quality int, toxic int")
    assert labelled_sample(docs, labels, "text", "doc_id", CHAIN, 2).count() == 2
    whole = labelled_sample(docs, labels, "text", "doc_id", CHAIN, 10).orderBy("k").select("k", "y0", "y1", "y2").collect()
    assert list(map(tuple, whole)) == [(7, 0, 1, 0), (8, 1, 0, 0), (9, 1, 1, 1)]
    judged = score(docs, fit_chain(docs, labels))
    assert judged.count() == 502 and judged.where("text is null").first().rejected is False
