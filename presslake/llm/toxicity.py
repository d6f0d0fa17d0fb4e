"""Toxicity by a classifier chain.

Categories are predicted one after the other by linear models over the presence of words. The probabilities of
earlier categories are features of later models; in training they come from models that have not seen the row
(out-of-fold), so a later model learns how far it can trust them.

Models are fitted on a bounded sample of labelled rows (``LABELLED_ROWS``); every document is then scored whole.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from presslake.llm.common import table, whole_text, written
from presslake.llm.registry import query

#: Most labelled rows that the models are fitted on; those with the least hash of their identifier.
LABELLED_ROWS = 20_000
#: Features kept, those whose presence tells most about any category, and the least rows that must show one.
FEATURES = 2048
LEAST_ROWS = 3
#: Least chi-square of a feature; chance gives a token this much about once in 130,000 times.
LEAST_CHI = 20.0
FOLDS = 3
PENALTY = 0.01
PREFIX = 5

#: The chain: categories in order with their label. The last word on a document is that of ``DECIDES``.
CHAIN = {"junk": "quality = 0", "toxic": "toxic = 1", "toxic_junk": "toxic = 1 and quality = 0"}
DECIDES = "toxic"
THRESHOLD = 0.3

_TOKEN = re.compile(r"[^\W\d_]+|[^\w\s]{2,8}")


def tokens(text: str) -> set[str]:
    """Words in lower case, runs of signs, and the starts of longer words (marked)."""
    found = set(_TOKEN.findall(text.lower()))
    return found | {"^" + w[:PREFIX] for w in found if len(w) > PREFIX}


@dataclass
class Chain:
    """Fitted models: weights of the words, of earlier probabilities and the intercept, by category."""

    names: list[str]
    vocabulary: dict[str, int]
    weights: list[np.ndarray] = field(default_factory=list)

    def probabilities(self, text: str) -> list[float]:
        """By category, and at last 1 if the text has tokens, else 0."""
        whole = tokens(text)
        shown = [self.vocabulary[t] for t in whole & self.vocabulary.keys()]
        found: list[float] = []
        for w in self.weights:
            n = len(self.vocabulary)
            found.append(float(_sigmoid(w[-1] + w[shown].sum() + np.dot(w[n:-1], found))))
        return [*found, float(bool(whole))]


def _sigmoid(z):
    return 1.0 / (1.0 + np.exp(-np.clip(z, -35, 35)))


def fit_linear(rows: np.ndarray, columns: np.ndarray, n_columns: int, dense: np.ndarray, y: np.ndarray, penalty: float = PENALTY) -> np.ndarray:
    """Logistic regression with an L2 penalty by L-BFGS. ``rows, columns``: which row shows which feature.

    Gives the weights of the features, of the ``dense`` columns, and the intercept. With one class only, an
    intercept by the smoothed share of that class.
    """
    n = len(y)
    w = np.zeros(n_columns + dense.shape[1] + 1)
    share = (y.sum() + 0.5) / (n + 1.0) if n else 0.01
    w[-1] = np.log(share / (1 - share))
    if n == 0 or y.min() == y.max():
        return w

    def loss(w):
        z = np.bincount(rows, w[columns], minlength=n) + dense @ w[n_columns:-1] + w[-1]
        p = _sigmoid(z)
        r = p - y
        value = (np.logaddexp(0, z) - y * z).sum() + penalty / 2 * (w[:-1] ** 2).sum()
        slope = np.concatenate([np.bincount(columns, r[rows], minlength=n_columns), dense.T @ r, [r.sum()]])
        slope[:-1] += penalty * w[:-1]
        return value, slope

    value, slope = loss(w)
    past: list[tuple[np.ndarray, np.ndarray]] = []
    for _ in range(60):
        step = -slope
        kept = []
        for s, d in reversed(past):
            a = (s @ step) / (s @ d)
            kept.append(a)
            step = step - a * d
        if past:
            s, d = past[-1]
            step = step * ((s @ d) / (d @ d))
        else:
            step = step / max(1.0, np.abs(slope).max())
        for (s, d), a in zip(past, reversed(kept), strict=True):
            step = step + s * (a - (d @ step) / (s @ d))
        size, down = 1.0, slope @ step
        while size > 1e-8:
            new_value, new_slope = loss(w + size * step)
            if new_value <= value + 1e-4 * size * down:
                break
            size /= 2
        else:
            break
        moved, turned = size * step, new_slope - slope
        if moved @ turned > 1e-12:
            past = [*past[-7:], (moved, turned)]
        done = value - new_value < 1e-6 * max(1.0, abs(value))
        w, value, slope = w + moved, new_value, new_slope
        if done:
            break
    return w


def labelled_sample(docs: DataFrame, labels: DataFrame, text: str, key: str, chain: dict[str, str], limit: int) -> DataFrame:
    """At most ``limit`` labelled documents: ``fold_of`` (a hash), ``y0, y1, ...`` and ``shown`` (distinct tokens).

    Labels of an identifier that repeats are joined: a category holds if one of its rows says so. Unknown is no. Of
    documents that repeat an identifier the one of least text hash counts.
    """
    holds = [F.max(F.coalesce(F.expr(c), F.lit(False)).cast("int")).alias(f"y{i}") for i, c in enumerate(chain.values())]
    one = labels.where("doc_id is not null").groupBy(F.col("doc_id").alias("k")).agg(*holds)
    with_text = docs.select(F.col(key).alias("k"), whole_text(text).alias("text"))
    picked = one.orderBy(F.xxhash64("k"), "k").limit(limit)

    def split(texts: pa.Array) -> pa.Array:
        return pa.array([sorted(tokens(t)) for t in texts.to_pylist()], pa.list_(pa.string()))

    shown = F.arrow_udf(split, "array<string>")("text").alias("shown")
    met = with_text.join(F.broadcast(picked), "k")  # at most ``limit`` short rows
    met = met.groupBy("k", *[f"y{i}" for i in range(len(chain))]).agg(F.min_by("text", F.struct(F.xxhash64("text"), "text")).alias("text"))
    return met.select("k", F.pmod(F.xxhash64("k", F.lit("fold")), F.lit(1 << 20)).alias("fold_of"), *[f"y{i}" for i in range(len(chain))], shown)


def choose_features(sample: DataFrame, n_categories: int, total: list[int], most: int = FEATURES) -> list[str]:
    """Tokens by their greatest chi-square with a category; ties by token."""
    n = total[0]
    each = sample.select(F.explode("shown").alias("t"), *[f"y{i}" for i in range(n_categories)])
    counts = each.groupBy("t").agg(F.count("*").alias("a"), *[F.sum(f"y{i}").alias(f"s{i}") for i in range(n_categories)])

    def chi(i: int) -> Column:
        a, s, pos = F.col("a").cast("double"), F.col(f"s{i}").cast("double"), F.lit(float(total[i + 1]))
        gap = s * n - a * pos
        return F.coalesce(F.try_divide(gap * gap * n, a * (n - a) * pos * (n - pos)), F.lit(0.0))

    scored = counts.where(F.col("a") >= LEAST_ROWS).select("t", F.greatest(*[chi(i) for i in range(n_categories)], F.lit(0.0)).alias("chi"))
    return [r.t for r in scored.where(F.col("chi") >= LEAST_CHI).orderBy(F.col("chi").desc(), "t").limit(most).collect()]


def fit_chain(
    docs: DataFrame, labels: DataFrame, text: str = "text", key: str = "doc_id", chain: dict[str, str] | None = None,
    limit: int = LABELLED_ROWS, folds: int = FOLDS,
) -> Chain:
    """Fit the chain on at most ``limit`` labelled rows. Without labels every probability is 0.01 or below."""
    chain = CHAIN if chain is None else chain
    spark, k = docs.sparkSession, len(chain)
    sample = written(labelled_sample(docs, labels, text, key, chain, limit), "labelled")
    total = [x or 0 for x in sample.agg(F.count("*"), *[F.sum(f"y{i}") for i in range(k)]).first()]
    vocabulary = {t: i for i, t in enumerate(choose_features(sample, k, total) if total[0] else [])}

    # At most ``limit`` rows of at most ``FEATURES`` short numbers: this is what the models are fitted on.
    def numbered(shown: pa.Array) -> pa.Array:
        return pa.array([[vocabulary[t] for t in row if t in vocabulary] for row in shown.to_pylist()], pa.list_(pa.int32()))

    rows = sample.select("k", "fold_of", *[f"y{i}" for i in range(k)], F.arrow_udf(numbered, "array<int>")("shown").alias("x"))
    data = rows.toArrow().sort_by([("fold_of", "ascending"), ("k", "ascending")])
    x = data["x"].combine_chunks() if data.num_rows else pa.array([], pa.list_(pa.int32()))
    lengths = np.asarray([len(v) for v in x], dtype=np.int64)
    row_of, column_of = np.repeat(np.arange(len(lengths)), lengths), np.asarray(x.flatten(), dtype=np.int64)
    fold = np.asarray(data["fold_of"], dtype=np.int64) % folds
    model, earlier = Chain(list(chain), vocabulary), np.zeros((len(fold), 0))
    sent = spark.sparkContext.broadcast((row_of, column_of, fold))
    for i in range(k):
        y = np.asarray(data[f"y{i}"], dtype=np.float64)
        fitted = _fit_folds(spark, sent, len(vocabulary), earlier, y, folds)
        model.weights.append(fitted[folds])
        out = np.zeros(len(y))
        for f in range(folds):
            w = fitted[f]
            z = np.bincount(row_of, w[column_of], minlength=len(y)) + earlier @ w[len(vocabulary) : -1] + w[-1]
            out[fold == f] = _sigmoid(z)[fold == f]
        earlier = np.column_stack([earlier, out])
    sent.unpersist()
    return model


def _fit_folds(spark, sent, n_columns: int, earlier: np.ndarray, y: np.ndarray, folds: int) -> dict[int, np.ndarray]:
    """Models without each fold, and (as number ``folds``) the one of all rows, a task each."""
    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row_of, column_of, fold = sent.value
        for batch in batches:
            for f in batch.column(0).to_pylist():
                use = fold != f
                keep, place = use[row_of], np.cumsum(use) - 1
                w = fit_linear(place[row_of[keep]], column_of[keep], n_columns, earlier[use], y[use])
                yield pa.RecordBatch.from_arrays([pa.array([f], pa.int64()), pa.array([w.tolist()])], names=["fold", "w"])

    found = spark.range(0, folds + 1, 1, folds + 1).mapInArrow(fit, "fold long, w array<double>").collect()
    return {r.fold: np.asarray(r.w) for r in found}


def score(docs: DataFrame, model: Chain, text: str = "text", threshold: float = THRESHOLD, decides: str = DECIDES) -> DataFrame:
    """Every row of ``docs`` with ``p_<category>`` and ``rejected``; other columns of those names are replaced.

    Null and empty texts, and any other without a token, have the probabilities of the intercepts and are never
    rejected. Repeated rows are judged each alike; an empty table gives no rows.
    """
    names, place = model.names, model.names.index(decides)
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def judge(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        chain = sent.value
        for texts in batches:
            yield pa.array([chain.probabilities(t.as_py()) for t in texts], pa.list_(pa.float64()))

    judge.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    taken = {f"p_{n}" for n in names} | {"rejected"}
    scored = docs.withColumn("__p", F.arrow_udf(judge, "array<double>")(whole_text(text)))
    shown = [F.col("__p")[i].alias(f"p_{n}") for i, n in enumerate(names)]
    rest = [F.col(f"`{c}`") for c in docs.columns if c.lower() not in taken]
    rejected = (F.col("__p")[place] >= threshold) & (F.col("__p")[len(names)] > 0)
    return scored.select(*rest, *shown, rejected.alias("rejected"))


@query("op10_toxicity_chain")
def op10_toxicity_chain(spark, sf_dir):
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    scored = score(docs.select("doc_id", "text"), fit_chain(docs, labels))
    return scored.drop("text").withColumn("kept", ~F.col("rejected")).withColumnRenamed("rejected", "toxic")
