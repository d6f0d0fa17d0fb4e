"""The stored vector index against exact searches."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from presslake.operators import vector_index
from presslake.operators.vector_index import VectorIndex, fit, semantic_topk_index, write_vector_index
from presslake.operators.vectors import semantic_topk_many

from conftest import plan


def frame(spark, vectors, first=0):
    return spark.createDataFrame([(first + i, [float(x) for x in v]) for i, v in enumerate(vectors)], "id_page long, embedding array<float>")


@pytest.fixture(scope="module")
def clustered(spark):
    dice = np.random.default_rng(4)
    centres = dice.standard_normal((20, 12))
    return centres[dice.integers(0, 20, 4000)] + 0.15 * dice.standard_normal((4000, 12))


def recall(found, exact):
    got = {(r.query_id, r.id) for r in found}
    return sum((r.query_id, r.id_page) in got for r in exact) / len(exact)


@pytest.mark.parametrize("metric", ["cosine", "l2"])
def test_clustered_vectors_need_few_probes(spark, clustered, tmp_path, metric, monkeypatch):
    rows = frame(spark, clustered).repartition(5)
    index = write_vector_index(rows, str(tmp_path / "index"), metric, n_centres=20)
    assert index.model.probes <= 4
    asked = rows.where("id_page % 40 = 0").select(F.col("id_page").alias("query_id"), "embedding")
    exact = semantic_topk_many(rows, asked, 10, metric).collect()
    for cell in (vector_index.CELL_ROWS, 37):  # large centres are dealt over several tasks
        monkeypatch.setattr(vector_index, "CELL_ROWS", cell)
        found = semantic_topk_index(VectorIndex(spark, str(tmp_path / "index")), asked, 10).collect()
        assert recall(found, exact) >= 0.95 and len(found) == len(exact)
        assert max(r.rows_coded for r in found) < 2000 and max(r.rows_scored for r in found) < 800
    score = {(r.query_id, r.id_page): r.score for r in exact}
    assert all(abs(score.get((r.query_id, r.id), r.score) - r.score) < 1e-6 for r in found)


def test_only_probed_folders_are_read(spark, clustered, tmp_path):
    index = write_vector_index(frame(spark, clustered), str(tmp_path / "index"), n_centres=20)
    assert "PartitionFilters: [isnotnull(centre" in plan(index.rows().where("centre = 3").select("id", "code"))
    assert sorted(r.n for r in index.sizes().collect()) == sorted(r["count"] for r in index.rows().groupBy("centre").count().collect())


def test_odd_vectors(spark, tmp_path):
    dice = np.random.default_rng(1)
    fine = frame(spark, dice.standard_normal((200, 6)))
    odd = spark.createDataFrame([(900, None), (901, [0.0] * 6), (902, [float("nan")] * 6), (903, [1.0, None, 0.0, 0.0, 0.0, 0.0])], fine.schema)
    same = frame(spark, [[1, 2, 3, 4, 5, 6]] * 30, 1000)
    rows = fine.unionByName(odd).unionByName(same)
    index = write_vector_index(rows, str(tmp_path / "a"))
    assert index.rows().count() == 230
    asked = spark.createDataFrame([(1, [2.0, 4.0, 6.0, 8.0, 10.0, 12.0]), (2, None), (3, [0.0] * 6)], "query_id long, embedding array<double>")
    found = semantic_topk_index(index, asked, 5).collect()
    assert [r.id for r in sorted(found, key=lambda r: (-r.score, r.id))] == [1000, 1001, 1002, 1003, 1004]  # ties by id
    with pytest.raises(Exception, match="different lengths"):
        semantic_topk_index(index, spark.createDataFrame([(1, [1.0])], asked.schema), 5).collect()
    with pytest.raises(ValueError, match="different lengths"):
        write_vector_index(fine.unionByName(frame(spark, [[1, 2]], 5000)), str(tmp_path / "b"))
    with pytest.raises(ValueError, match="no vectors"):
        write_vector_index(odd, str(tmp_path / "c"))
    with pytest.raises(ValueError, match="cosine and l2"):
        write_vector_index(fine, str(tmp_path / "d"), "ip")
    alone = write_vector_index(frame(spark, [[1.0, 2.0]]), str(tmp_path / "e"))
    assert [r.id for r in semantic_topk_index(alone, spark.createDataFrame([(7, [1.0, 0.0])], asked.schema), 3).collect()] == [0]


def test_codes_stand_for_vectors():
    dice = np.random.default_rng(2)
    rows = dice.standard_normal((3000, 8))
    model = fit(rows, "l2", 8, 0.95, 10)
    own = model.nearest_centres(rows, 1)[:, 0]
    rests = rows - model.centres[own]
    cut = model.codes(rests)
    back = np.concatenate([model.parts[p][cut[:, p]] for p in range(len(model.parts))], axis=1)
    assert ((rests - back) ** 2).sum(axis=1).mean() < 0.2 * (rests**2).sum(axis=1).mean()
    q = rows[:5] - model.centres[own[7]]
    mine = own == own[7]
    assert np.allclose(model.near(model.tables(q), cut[mine]), ((q[:, None] - back[None, mine]) ** 2).sum(axis=2))


def test_setting_probes_takes_no_step_for_each_query_and_centre(monkeypatch):
    rows, calls = np.random.default_rng(3).standard_normal((2000, 8)), []
    distances = vector_index._distances
    monkeypatch.setattr(vector_index, "_distances", lambda a, b: calls.append(1) or distances(a, b))
    fit(rows, "cosine", 60, 0.95, 10)
    assert len(calls) < 2000  # 256 queries and 60 centres


def test_tasks_take_and_give_few_rows(spark, tmp_path, monkeypatch):
    """Vectors without structure, most centres probed: neither queries nor rows found are copied for each centre."""
    rows = frame(spark, np.random.default_rng(6).standard_normal((6000, 16)))
    asked = rows.where("id_page % 40 = 0").select(F.col("id_page").alias("query_id"), "embedding")
    index = write_vector_index(rows, str(tmp_path / "index"))
    taken, given, near_rows = spark.sparkContext.accumulator(0), spark.sparkContext.accumulator(0), vector_index._near_rows

    def counted(*settings):
        inner = near_rows(*settings)

        def run(batches):
            def counting(passing, total):
                for batch in passing:
                    total.add(batch.num_rows)
                    yield batch
            return counting(inner(counting(batches, taken)), given)
        return run

    monkeypatch.setattr(vector_index, "_near_rows", counted)
    found = semantic_topk_index(index, asked, 10).collect()
    assert index.model.probes > 20 and recall(found, semantic_topk_many(rows, asked, 10).collect()) >= 0.95
    scored = sum({r.query_id: r.rows_scored for r in found}.values())
    assert taken.value <= 6000 + 8 * 150 and given.value <= 4 * scored, (taken.value, given.value, scored)
    # With little room rows are handed on earlier, and the result is the same.
    monkeypatch.setattr(vector_index, "_near_rows", near_rows)
    monkeypatch.setattr(vector_index, "WAITING_BYTES", 0)
    monkeypatch.setattr(vector_index, "BLOCK_NUMBERS", 100)
    assert sorted(found) == sorted(semantic_topk_index(index, asked, 10).collect())
