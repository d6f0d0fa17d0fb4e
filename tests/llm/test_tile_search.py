"""The tile search against comparing every pair in double precision."""

import math
import random

import numpy as np
from pyspark.sql import functions as F

from presslake.llm.tile_search import Rounded, op11_tile_search, tile, tile_search

SF = "/root/testdata/sf0.01"
SCHEMA = "vec_id long, embedding array<double>, score string, number int"


def plain(rows, asks, k):
    fine = [(n, i, v) for n, (i, v, *_) in enumerate(rows) if v and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    fine = [(n, i, np.array(v) / np.abs(v).max()) for n, i, v in fine]
    out = []
    for n, i, v in fine:
        if i is None or not asks(i):
            continue
        scored = [(float(v @ w) / math.sqrt(v @ v) / math.sqrt(w @ w), j) for m, j, w in fine if m != n and len(w) == len(v)]
        scored.sort(key=lambda s: (-round(s[0], 12), math.inf if s[1] is None else s[1]))
        out += [(i, rank, j, s) for rank, (s, j) in enumerate(scored[:k], 1)]
    return sorted(out, key=repr)


def same(got, wanted):
    assert len(got) == len(wanted)
    for a, b in zip(sorted(map(tuple, got), key=repr), wanted, strict=True):
        assert a[:3] == b[:3] and math.isclose(a[3], b[3], abs_tol=1e-12)


def test_error_bound_holds():
    dice = np.random.default_rng(3)
    for width in (1, 7, 64, 2500):
        a, b = dice.standard_normal((40, width)) * dice.choice([1e-200, 1, 1e200]), dice.standard_cauchy((70, width))
        x, y = Rounded(a), Rounded(b)
        near, bound = tile(x, slice(0, 40), y, slice(0, 70))
        true = (x.scaled / x.lengths[:, None]) @ (y.scaled / y.lengths[:, None]).T
        assert (np.abs(near - true) <= bound).all()


def test_rows_of_every_kind(spark):
    dice = random.Random(5)
    rows = [(i, [dice.gauss(0, 1) for _ in range(6)], "s", 1) for i in range(120)]
    rows += [(200 + i, [float(dice.randrange(-1, 2)) for _ in range(3)], "s", 1) for i in range(150)]  # many ties
    rows += [(500, [1.0, 2.0, 3.0], None, None)] * 7 + [(None, [2.0, 4.0, 6.0], "s", None)]
    rows += [(600, None, "s", 1), (601, [], "s", 1), (602, [0.0, 0.0], "s", 1), (603, [1.0, None], "s", 1), (604, [math.nan, 1.0], "s", 1), (605, [math.inf, 1.0], "s", 1)]
    rows += [(700, [1e300, -1e300, 5e299, 1.0], "s", 1), (701, [-1e-300, 1e-300, 0.0, 0.0], "s", 1), (702, [1.0] * 2000, "s", 1)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    for group in (1000, 16):
        found = tile_search(df, F.col("vec_id") % 10 == 0, 4, query_group=group, row_group=60, least_group=20)
        same(found.nearest().collect(), plain(rows, lambda i: i % 10 == 0, 4))
    assert tile_search(df.limit(0), F.col("vec_id") % 10 == 0).nearest().count() == 0
    assert tile_search(df, F.lit(False)).nearest().count() == 0


def test_given_vectors_and_pairs_computed_again(spark):
    docs = spark.read.parquet(f"{SF}/embeddings.parquet")
    rows = [(r.vec_id, [float(x) for x in r.embedding]) for r in docs.collect()]
    same(op11_tile_search(spark, SF).collect(), plain(rows, lambda i: i % 50 == 0, 5))
    work = tile_search(docs, F.col("vec_id") % 50 == 0).work().first()
    assert work.pairs == 10 * 499 and work.again < work.pairs / 5
