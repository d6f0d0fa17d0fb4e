"""Folded folders: the same rows before, during and after, and few folders."""

import datetime as dt
import json

import pytest
from conftest import rows
from presslake.plans import reports
from presslake.schemas import NEWS_PAGES
from presslake.streaming import generations, incremental

AS_OF = dt.datetime(2025, 6, 30)
VECTORS = "id_page bigint, embedding array<float>"


def put(spark, root, stream, batch_id, made):
    incremental._write_part(spark.createDataFrame(made, VECTORS).coalesce(1), root, stream, batch_id)


def newest(df):
    return incremental._newest(df, "id_page")


def folders(root):
    return [f"{s}/{b}" for s in root.iterdir() if s.is_dir() for b in [x.name for x in s.iterdir() if x.is_dir()]]


def test_fifty_micro_batches_leave_few_folders_and_the_same_rows(spark, tmp_path):
    root, expected, most = tmp_path / "vectors", {}, 0
    for n in range(50):
        made = [(n % 7, [float(n)]), (100 + n, [0.5])]
        put(spark, str(root), "5-a", n, made)
        expected |= dict(made)
        generations.fold(spark, str(root), VECTORS, newest, every=4)
        most = max(most, len(folders(root)))
        if n % 10 == 9:
            assert rows(incremental.current_embeddings(spark, str(root)), "id_page", "embedding") == sorted(expected.items(), key=repr)
    # Of four and five: those to be folded next, and those that an older reader may still read.
    assert most <= 9
    last = generations.latest(spark, str(root))
    assert last.covers == {"5-a": 47} and sum(n for _, n in last.segments) == 48 and len(last.segments) <= 4
    assert len(list((tmp_path / "vectors-generations" / "rows").iterdir())) <= 8
    assert rows(incremental.current_embeddings(spark, str(root)), "id_page", "embedding") == sorted(expected.items(), key=repr)


def test_a_reader_that_began_before_a_fold_ends_with_the_same_rows(spark, tmp_path):
    root = str(tmp_path / "vectors")
    for n in range(4):
        put(spark, root, "5-a", n, [(n, [1.0]), (0, [float(n)])])
    before = incremental.current_embeddings(spark, root)
    wanted = [(0, [3.0]), (1, [1.0]), (2, [1.0]), (3, [1.0])]
    assert generations.fold(spark, root, VECTORS, newest, every=2) == 1
    assert rows(before, "id_page", "embedding") == wanted
    assert rows(incremental.current_embeddings(spark, root), "id_page", "embedding") == wanted
    assert generations.fold(spark, root, VECTORS, newest, every=2) is None


def test_the_newest_folder_of_each_stream_may_be_written_again(spark, tmp_path):
    root = str(tmp_path / "vectors")
    for n in range(3):
        put(spark, root, "5-a", n, [(1, [float(n)])])
    put(spark, root, "6-b", 0, [(2, [1.0])])
    assert generations.fold(spark, root, VECTORS, newest, every=1) == 1
    put(spark, root, "5-a", 2, [(1, [9.0])])
    put(spark, root, "6-b", 0, [(2, [8.0])])
    assert rows(incremental.current_embeddings(spark, root), "id_page", "embedding") == [(1, [9.0]), (2, [8.0])]


def test_of_two_folds_one_gives_way_and_a_broken_note_is_passed_over(spark, tmp_path):
    root = str(tmp_path / "vectors")
    for n in range(3):
        put(spark, root, "5-a", n, [(n, [1.0])])

    def overtaken(df):
        assert generations.fold(spark, root, VECTORS, newest, every=1) == 1
        return newest(df)

    assert generations.fold(spark, root, VECTORS, overtaken, every=1) is None
    assert len(list((tmp_path / "vectors-generations" / "rows").iterdir())) == 1
    (tmp_path / "vectors-generations" / "notes" / "0000000002.json").write_text('{"number": 2, "cov')
    assert generations.latest(spark, root).number == 1
    put(spark, root, "5-a", 3, [(3, [1.0])])
    assert generations.fold(spark, root, VECTORS, newest, every=1) == 3
    assert rows(incremental.current_embeddings(spark, root), "id_page") == [(0,), (1,), (2,), (3,)]
    notes = sorted(p.name for p in (tmp_path / "vectors-generations" / "notes").glob("*.json"))
    assert notes[-1] == "0000000003.json" and not generations.create_once(spark, f"{root}-generations/notes/{notes[-1]}", "")


@pytest.mark.parametrize("every", [1, 2])
def test_streams_fold_as_they_run(spark, tmp_path, every):
    source, vectors = tmp_path / "in", str(tmp_path / "vectors")
    source.mkdir()
    for i in range(5):
        body = {"status_code": 200, "body": {"data": [{"embedding": [float(i)]}]}}
        lines = [json.dumps({"custom_id": str(p), "error": None, "response": body}) for p in (i, 99)]
        (source / f"{i}.jsonl").write_text("\n".join(lines))
        incremental.stream_batch_results(spark, str(source), vectors, str(tmp_path / "v"), fold_every=every).awaitTermination(120)
    assert generations.latest(spark, vectors).number >= 2
    assert rows(incremental.current_embeddings(spark, vectors), "id_page", "embedding") == sorted([(i, [float(i)]) for i in range(5)] + [(99, [4.0])], key=repr)

    schema, log, totals = "domain string, ok boolean, content_size bigint", str(tmp_path / "log"), str(tmp_path / "totals")
    found, pages_in, pages = "page_url string, id_sitemap bigint, publication_date timestamp", str(tmp_path / "found"), str(tmp_path / "pages")
    incremental.write_base(spark.createDataFrame([(50, 1, "u0", None, True, None)], NEWS_PAGES), pages)
    for i in range(4):
        spark.createDataFrame([("a", True, i), (f"d{i}", False, 1)], schema).coalesce(1).write.parquet(f"{log}/wave={i}")
        stream = spark.readStream.schema(schema).option("recursiveFileLookup", "true").parquet(log)
        incremental.stream_fetch_stats(stream, totals, str(tmp_path / "t"), every).awaitTermination(120)
        spark.createDataFrame([("u0", 1, None), ("u1", 1, None), (f"w{i}", 1, None)], found).coalesce(1).write.parquet(f"{pages_in}/wave={i}")
        stream = spark.readStream.schema(found).option("recursiveFileLookup", "true").parquet(pages_in)
        incremental.stream_page_discovery(stream, pages, str(tmp_path / "p"), AS_OF, fold_every=every).awaitTermination(120)
    whole = spark.read.schema(schema).option("recursiveFileLookup", "true").parquet(log)
    assert rows(incremental.current_fetch_stats(spark, totals), "*") == rows(reports.fetch_domain_stats(whole), "*")
    got = incremental.current_pages(spark, pages)
    assert rows(got, "page_url") == [(u,) for u in sorted(["u0", "u1", "w0", "w1", "w2", "w3"])]
    assert rows(got, "id_page") == [(i,) for i in range(50, 56)]
    # A new checkpoint knows the folded pages too.
    incremental.stream_page_discovery(stream, pages, str(tmp_path / "p2"), AS_OF, fold_every=every).awaitTermination(120)
    assert incremental.current_pages(spark, pages).count() == 6
