"""Whole stages: consecutive runs, restarts, streams equal to batches."""

import datetime as dt
import json

import pyarrow as pa
import pytest
from conftest import rows
from pyspark.sql import functions as F

from presslake.operators import merge
from presslake.operators.audit import constraint_audit
from presslake.plans import discover, embed, extract, fetch, reports
from presslake.schemas import CONTENT_EMBEDDINGS, NEWS_PAGES, NEWS_PAGES_CONTENT, REGISTRY, RESULT_LINE, SITEMAPS
from presslake.streaming import incremental

AS_OF = dt.datetime(2025, 6, 30)


def empty(spark, schema):
    return spark.createDataFrame([], schema)


INDEX = """<sitemapindex><sitemap><loc>https://a.com/one.xml</loc><lastmod>2025-06-01</lastmod></sitemap>
<sitemap><loc>https://a.com/old.xml</loc></sitemap><sitemap><loc>https://a.com/lost.xml</loc></sitemap>
<sitemap><loc>https://a.com/author-sitemap.xml</loc></sitemap></sitemapindex>"""
ONE = """<urlset><url><loc>https://a.com/1</loc><lastmod>2025-06-01</lastmod></url><url><loc>https://a.com/2</loc><lastmod>2020-01-01</lastmod></url>
<url><loc>https://a.com/3</loc></url></urlset>"""
OLD = "<urlset><url><loc>https://a.com/4</loc><lastmod>2019-01-01</lastmod></url></urlset>"


def bodies(spark, **changed):
    made = {"https://a.com/index.xml": INDEX, "https://a.com/one.xml": ONE, "https://a.com/old.xml": OLD, **changed}
    return spark.createDataFrame(list(made.items()), "sitemap_url string, body string")


def test_two_discovery_runs(spark):
    seeds = spark.createDataFrame([("https://a.com/index.xml",)], "url string")
    first = discover.discover(seeds, bodies(spark), empty(spark, SITEMAPS), empty(spark, NEWS_PAGES), AS_OF)
    # A new domain: every sitemap that came is fresh and old pages are kept.
    assert rows(first.sitemaps, "sitemap_url", "is_master", "is_fresh") == [
        ("https://a.com/index.xml", True, True), ("https://a.com/lost.xml", False, False),
        ("https://a.com/old.xml", False, True), ("https://a.com/one.xml", False, True)]
    assert rows(first.pages, "page_url") == [("https://a.com/1",), ("https://a.com/2",), ("https://a.com/4",)]
    master = first.sitemaps.where("is_master").first().id_sitemap
    assert rows(first.sitemaps.where("not is_master").select("parent_id").distinct(), "*") == [(master,)]
    assert constraint_audit({"sitemaps": first.sitemaps, "news_pages": first.pages}).count() == 0
    assert rows(reports.discovery_stats(first.outcomes), "domain", "sitemaps_processed", "pages_added", "pages_no_date") == [("a.com", 2, 3, 1)]

    grown = ONE.replace("</urlset>", "<url><loc>https://a.com/5</loc><lastmod>2025-06-02</lastmod></url><url><loc>https://a.com/6</loc><lastmod>2021-06-02</lastmod></url></urlset>")
    second = discover.discover(seeds, bodies(spark, **{"https://a.com/one.xml": grown}), first.sitemaps, first.pages, AS_OF)
    # Now the domain is known: only recent pages are added, and the old sitemap turns stale.
    assert rows(second.pages, "page_url") == [("https://a.com/1",), ("https://a.com/2",), ("https://a.com/4",), ("https://a.com/5",)]
    assert rows(second.sitemaps.where("is_fresh"), "sitemap_url") == [("https://a.com/index.xml",), ("https://a.com/one.xml",)]
    assert rows(second.outcomes, "page_url", "outcome") == [
        ("https://a.com/1", "existing"), ("https://a.com/2", "too_old"), ("https://a.com/3", "no_date"),
        ("https://a.com/5", "keep"), ("https://a.com/6", "too_old")]

    third = discover.discover(seeds, bodies(spark), second.sitemaps, second.pages, AS_OF)
    # Stale sitemaps are not read again.
    assert "https://a.com/old.xml" not in {r.sitemap_url for r in third.outcomes.collect()}
    assert rows(third.pages, "id_page", "page_url") == rows(second.pages, "id_page", "page_url")


def test_a_page_in_several_sitemaps_is_added_once(spark):
    seeds = spark.createDataFrame([("https://a.com/index.xml",)], "url string")
    url = "<url><loc>https://a.com/same</loc><lastmod>2025-06-0{}</lastmod></url>"
    twice = f"<urlset>{url.format(3)}{url.format(2)}</urlset>"
    once = f"<urlset>{url.format(4)}</urlset>"
    made = discover.discover(
        seeds, bodies(spark, **{"https://a.com/one.xml": twice, "https://a.com/old.xml": once}), empty(spark, SITEMAPS), empty(spark, NEWS_PAGES), AS_OF)
    assert rows(made.outcomes, "outcome", "publication_date") == [
        ("existing", dt.datetime(2025, 6, 3)), ("existing", dt.datetime(2025, 6, 4)), ("keep", dt.datetime(2025, 6, 2))]
    assert rows(made.pages, "page_url", "publication_date") == [("https://a.com/same", dt.datetime(2025, 6, 2))]
    assert rows(reports.discovery_totals(made.outcomes), "pages") == [(1,)]


def pages_table(spark, n):
    return spark.createDataFrame([(i, 1, f"https://a.com/{i}", dt.datetime(2025, 1, 1), False, None) for i in range(1, n + 1)], NEWS_PAGES)


def one_sitemap(spark):
    return spark.createDataFrame([(1, "a.com", "https://a.com/s.xml", True, None, None, True, None, None)], SITEMAPS)


def test_fetch_then_extract_then_embed(spark):
    sitemaps, pages = one_sitemap(spark), pages_table(spark, 5)
    long = "word " * 200
    page = f"<html><body><article><h1>Title</h1><p>{long}</p><p>Footer line</p></article></body></html>"
    log = spark.createDataFrame([
        ("https://a.com/1", 200, None, page, AS_OF), ("https://a.com/2", 301, "/2b", None, AS_OF), ("https://a.com/2b", 200, None, page, AS_OF),
        ("https://a.com/3", 500, None, None, AS_OF), ("https://a.com/4", 302, "https://b.com/", None, AS_OF),
    ], "url string, status int, location string, body string, ts timestamp")
    fetched = fetch.fetch_apply(sitemaps, pages, empty(spark, NEWS_PAGES_CONTENT), log, AS_OF)
    assert rows(fetched.outcomes, "id_page", "outcome", "ok", "content_size") == [
        (1, "ok", True, len(page)), (2, "ok", True, len(page)), (3, "http_error", False, 0), (4, "cross_domain", False, 0)]
    assert rows(fetched.content, "id_page", "page_url", F.col("page_raw_content").isNotNull()) == [
        (1, "https://a.com/1", True), (2, "https://a.com/2b", True), (3, "https://a.com/3", False), (4, "https://a.com/4", False)]
    assert rows(fetched.pages.where("is_error"), "id_page") == [(3,), (4,)]
    assert rows(reports.fetch_domain_stats(fetched.outcomes), "domain", "successful", "failed", "success_rate") == [("a.com", 2, 2, 50.0)]
    # Page 5 had no answer and is next; the failed ones are not tried again.
    again = fetch.fetch_apply(sitemaps, fetched.pages, fetched.content, log, AS_OF)
    assert again.outcomes.count() == 0

    extracted = extract.extract(sitemaps, fetched.pages, fetched.content)
    # Both pages have the same lines; the second keeps none, gets an empty text and waits no more.
    assert rows(extracted.content, "id_page", F.col("content") == "") == [(1, False), (2, True), (3, None), (4, None)]
    assert rows(reports.extract_parser_stats(extracted.outcomes), "successful", "failed") == [(2, 0)]
    second = extract.extract(sitemaps, fetched.pages, extracted.content)
    assert second.outcomes.count() == 0
    assert rows(second.content, "id_page", "content") == rows(extracted.content, "id_page", "content")
    whole = extract.extract(sitemaps, fetched.pages, fetched.content, dedup=False)
    assert rows(whole.content.where("content_length > 900"), "id_page") == [(1,), (2,)]

    made = embed.embed_sync(sitemaps, fetched.pages, whole.content, empty(spark, CONTENT_EMBEDDINGS), max_tokens=51, dim=64)
    assert rows(made.outcomes, "id_page", "domain", "outcome", "tokens", "truncated") == [
        (1, "a.com", "ok", 50, True), (2, "a.com", "ok", 50, True)]
    assert rows(made.embeddings, "id", "id_page", F.size("embedding")) == [(1, 1, 64), (2, 2, 64)] or made.embeddings.count() == 2
    assert embed.embed_sync(sitemaps, fetched.pages, whole.content, made.embeddings, dim=64).outcomes.count() == 0


def test_batch_jobs_from_creation_to_check(spark):
    sitemaps, pages = one_sitemap(spark), pages_table(spark, 10)
    content = spark.createDataFrame([(i, i, "u", dt.datetime(2025, 1, i), None, "some text " * 60, 600, None) for i in range(1, 11)], NEWS_PAGES_CONTENT)
    none = empty(spark, CONTENT_EMBEDDINGS)
    made = embed.embed_batch_create(sitemaps, pages, content, none, empty(spark, REGISTRY), AS_OF, "r1", limit=7, size=3)
    assert rows(made.registry, "batch_id", "status", "page_ids") == [
        ("r1-0", "pending", [8, 9, 10]), ("r1-1", "pending", [5, 6, 7]), ("r1-2", "pending", [4])]
    request = json.loads(made.requests.where("id_page = 4").first().request)
    assert request["custom_id"] == "4" and request["body"]["input"] == ("some text " * 60)
    # Pages of pending jobs are not queued again.
    more = embed.embed_batch_create(sitemaps, pages, content, none, made.registry, AS_OF, "r2", size=100)
    assert rows(more.registry.where("batch_id like 'r2%'"), "page_ids") == [([1, 2, 3],)]

    statuses = spark.createDataFrame([("r1-0", "completed"), ("r1-1", "expired"), ("r1-2", "in_progress")], "batch_id string, status string")
    results = spark.createDataFrame(
        [(8, None, 200, [1.0]), (9, "bad", None, None), (10, None, 200, [2.0]), (5, None, 200, [3.0]), (4, None, 200, [4.0])],
        "id_page bigint, error string, status_code int, embedding array<float>")
    checked = embed.embed_batch_check(made.registry, statuses, results, None, none, AS_OF, dim=1)
    assert rows(checked.embeddings, "id_page", "embedding") == [(10, [2.0]), (8, [1.0])]
    assert rows(checked.failures, "id_page", "message") == [(9, "bad")]
    # A page that only the error file names, once more than once, and a vector of the wrong length.
    told = spark.createDataFrame([(9, "from file"), (10, "late"), (10, "late"), (8, "not so"), (4, "other job")], "id_page bigint, message string")
    odd = results.where("id_page <> 10").unionByName(results.where("id_page = 8").withColumn("embedding", F.array(F.lit(1.0), F.lit(2.0)).cast("array<float>")).withColumn("id_page", F.lit(10).cast("bigint")))
    fewer = embed.embed_batch_check(made.registry, statuses, results.where("id_page <> 10"), told, none, AS_OF, dim=1)
    assert rows(fewer.failures, "id_page", "message") == [(10, "late"), (9, "from file")]
    assert rows(fewer.counts, "batch_id", "ok", "failed") == [("r1-0", 1, 2)]
    wrong = embed.embed_batch_check(made.registry, statuses, odd, None, none, AS_OF, dim=1)
    assert rows(wrong.failures, "id_page", "message") == [(10, "vector of 2 values"), (9, "bad")]
    assert rows(checked.registry, "batch_id", "list_name", "processed_count") == [
        ("r1-0", "completed", 2), ("r1-1", "failed", None), ("r1-2", "pending", None)]
    status = embed.embed_batch_status(checked.registry, AS_OF)
    assert rows(status["counts"], "list_name", "jobs") == [("completed", 1), ("failed", 1), ("pending", 1)]
    assert rows(status["pending"], "batch_id", "pages") == [("r1-2", 1)]
    # Pages of the expired job and the failed page come back.
    created, rechecked = embed.embed_batch_full(
        sitemaps, pages, content, checked.embeddings, checked.registry, statuses.where("false"), results.where("false"), None, AS_OF, "r3")
    assert rows(created.registry.where("batch_id like 'r3%'"), "page_ids") == [([1, 2, 3, 5, 6, 7, 9],)]
    assert rechecked.embeddings.count() == 2


def test_a_page_tried_several_times_is_stored_once(spark):
    sitemaps, pages = one_sitemap(spark), pages_table(spark, 3)
    later = AS_OF + dt.timedelta(hours=1)
    log = spark.createDataFrame([
        ("https://a.com/1", 500, None, None, AS_OF), ("https://a.com/1", 200, None, "one", AS_OF), ("https://a.com/1", 503, None, "sorry", later),
        ("https://a.com/2", 200, None, "old", AS_OF), ("https://a.com/2", 200, None, "new", later), ("https://a.com/2", 200, None, "new", later),
        ("https://a.com/3", 500, None, None, AS_OF), ("https://a.com/3", 404, None, None, None), ("https://a.com/3", None, None, None, None),
    ], "url string, status int, location string, body string, ts timestamp")
    made = fetch.fetch_apply(sitemaps, pages, empty(spark, NEWS_PAGES_CONTENT), log, AS_OF)
    assert rows(made.content, "id_page", "page_raw_content") == [(1, "one"), (2, "new"), (3, None)]
    assert rows(made.outcomes, "id_page", "outcome", "content_size") == [(1, "ok", 3), (2, "ok", 3), (3, "http_error", 0)]
    assert rows(made.pages.where("is_error"), "id_page") == [(3,)]
    assert constraint_audit({"news_pages_content": made.content}).count() == 0


def test_a_delta_with_a_repeated_key_is_refused(spark):
    pages = pages_table(spark, 2)
    with pytest.raises(ValueError, match="more than once"):
        merge.error_flag_update(pages, spark.createDataFrame([(1, True), (1, False)], "id_page bigint, is_error boolean"))


# Streams -------------------------------------------------------------------------------

FOUND = "page_url string, id_sitemap bigint, publication_date timestamp"


def test_page_stream_equals_batch_over_restarts(spark, tmp_path):
    source, root, state = (str(tmp_path / d) for d in ("in", "pages", "state"))
    day = dt.datetime(2025, 1, 1)
    waves = [[("u1", 1, day), ("u2", 1, day), ("u2", 1, day)], [("u2", 1, day), ("u3", 2, day)], [("u0", 1, day), ("u4", 2, None)]]
    stored = spark.createDataFrame([(50, 1, "u0", None, True, None)], NEWS_PAGES)
    incremental.write_base(stored, root)
    for i, wave in enumerate(waves):
        spark.createDataFrame(wave, FOUND).coalesce(1).write.parquet(f"{source}/wave={i}")
        stream = spark.readStream.schema(FOUND).option("recursiveFileLookup", "true").parquet(source)
        incremental.stream_page_discovery(stream, root, state, AS_OF).awaitTermination(120)
    got = incremental.current_pages(spark, root)
    everything = spark.createDataFrame(sum(waves, []), FOUND)
    assert rows(got, "page_url", "publication_date", "is_error") == rows(
        merge.page_insert_new(stored, everything, AS_OF), "page_url", "publication_date", "is_error")
    assert constraint_audit({"news_pages": got}).count() == 0
    assert rows(got, "id_page") == [(50,), (51,), (52,), (53,), (54,)]


def test_no_micro_batch_reads_older_pages(spark, tmp_path):
    source, root, state = (str(tmp_path / d) for d in ("in", "pages", "state"))
    day = dt.datetime(2025, 1, 1)
    incremental.write_base(spark.createDataFrame([(50, 1, "u0", None, True, None)], NEWS_PAGES), root)
    for i, wave in enumerate([[("u0", 1, day), ("u1", 1, day)], [("u1", 1, day), ("u2", 2, day)], [("u2", 1, None), ("u0", 1, day), ("u3", 1, day)]]):
        spark.createDataFrame(wave, FOUND).coalesce(1).write.parquet(f"{source}/wave={i}")
        stream = spark.readStream.schema(FOUND).option("recursiveFileLookup", "true").parquet(source)
        incremental.stream_page_discovery(stream, root, state, AS_OF).awaitTermination(120)
        if i == 0:
            assert rows(incremental.current_pages(spark, root), "id_page", "page_url") == [(50, "u0"), (51, "u1")]
        # From now on a read of any older folder would fail.
        for part in (tmp_path / "pages").rglob("*.parquet"):
            part.write_bytes(b"no Parquet")
            (part.parent / f".{part.name}.crc").unlink(missing_ok=True)
    newest = max((tmp_path / "pages").rglob("batch_id=*"), key=lambda p: int(p.name.split("=")[1]))
    assert spark.read.parquet(f"{root}-tops").agg(F.max("top")).first()[0] == 53 and newest.is_dir()


def test_a_url_is_forgotten_after_its_span_and_late_rows_are_dropped(spark, tmp_path):
    source, root, state = (str(tmp_path / d) for d in ("in", "pages", "state"))
    schema, day = f"{FOUND}, seen_at timestamp", lambda n: dt.datetime(2025, 1, n)
    waves = [[("u1", 1, None, day(1))], [("u1", 1, None, day(2)), ("u2", 1, None, day(4))], [("u3", 1, None, day(20))], [("u1", 2, day(3), day(21)), ("u9", 1, None, day(1)), ("u3", 1, None, day(21))]]
    for i, wave in enumerate(waves):
        spark.createDataFrame(wave, schema).coalesce(1).write.parquet(f"{source}/wave={i}")
        stream = spark.readStream.schema(schema).option("recursiveFileLookup", "true").parquet(source)
        incremental.stream_page_discovery(stream, root, state, AS_OF, "1 day", dt.timedelta(days=5)).awaitTermination(120)
    got = rows(incremental.current_pages(spark, root), "id_page", "page_url", "id_sitemap")
    assert [g[1] for g in got] == ["u1", "u2", "u3", "u1"] and got[3][2] == 2  # u1 anew, u9 never


def _found(spark, source, wave, i, schema=FOUND):
    spark.createDataFrame(wave, schema).coalesce(1).write.parquet(f"{source}/wave={i}")
    return spark.readStream.schema(schema).option("recursiveFileLookup", "true").parquet(source)


def _count_calls(spark, monkeypatch, name):
    """Calls of a processor's input method, counted."""
    calls, kind = spark.sparkContext.accumulator(0), getattr(incremental, name)

    class Counted(kind):
        def handleInputRows(self, key, rows, timerValues):
            calls.add(1)
            yield from kind.handleInputRows(self, key, rows, timerValues)

    monkeypatch.setattr(incremental, name, Counted)
    return calls


def test_urls_with_a_span_pass_through_the_state_once(spark, tmp_path, monkeypatch):
    calls = _count_calls(spark, monkeypatch, "_FirstSightings")
    stream = _found(spark, str(tmp_path / "in"), [(f"u{i % 40}", 1, None, AS_OF) for i in range(60)], 0, f"{FOUND}, seen_at timestamp")
    incremental.stream_page_discovery(stream, str(tmp_path / "pages"), str(tmp_path / "state"), AS_OF, keep=dt.timedelta(days=5)).awaitTermination(120)
    assert sorted(r[0] for r in rows(incremental.current_pages(spark, str(tmp_path / "pages")), "id_page")) == list(range(1, 41))
    assert calls.value == 40 and not list((tmp_path / "state-first").iterdir())


def test_page_stream_calls_python_once_a_bucket(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(incremental, "URL_BUCKETS", 5)
    calls = _count_calls(spark, monkeypatch, "_BucketSightings")
    incremental.write_base(spark.createDataFrame([(i, 1, f"u{i}", None, True, None) for i in range(100, 150)], NEWS_PAGES), str(tmp_path / "pages"))
    for i in range(2):  # the second start keeps the number of buckets
        stream = _found(spark, str(tmp_path / "in"), [(f"u{n}", 1, None) for n in range(200 * (i + 1))], i)
        incremental.stream_page_discovery(stream, str(tmp_path / "pages"), str(tmp_path / "state"), AS_OF).awaitTermination(120)
        monkeypatch.setattr(incremental, "URL_BUCKETS", 11)
    got = incremental.current_pages(spark, str(tmp_path / "pages"))
    assert rows(got, "page_url") == sorted([(f"u{i}",) for i in range(400)], key=repr)
    assert calls.value == 10 and constraint_audit({"news_pages": got}).count() == 0


def test_page_stream_takes_the_earliest_date_then_the_smallest_sitemap(spark, tmp_path):
    day, far, large = dt.datetime(2025, 1, 2), dt.datetime(9999, 12, 31, 23, 59, 59, 999999), 2**53 + 1
    wave = [("u1", 9, None), ("u1", None, day), ("u1", large, day), ("u1", 1, far), ("u2", None, None), ("u3", 7, far), ("", 1, dt.datetime(1, 1, 2)), (None, 1, day)]
    stream = _found(spark, str(tmp_path / "in"), wave * 50, 0)
    incremental.stream_page_discovery(stream, str(tmp_path / "pages"), str(tmp_path / "state"), AS_OF).awaitTermination(120)
    got = incremental.current_pages(spark, str(tmp_path / "pages")).selectExpr("page_url", "id_sitemap", "cast(publication_date as string) as d")
    assert rows(got, "*") == sorted([
        ("u1", large, "2025-01-02 00:00:00"), ("u2", None, None), ("u3", 7, "9999-12-31 23:59:59.999999"), ("", 1, "0001-01-02 00:00:00")], key=repr)


def test_a_url_that_many_rows_hold_reaches_the_state_a_few_times():
    kinds = pa.schema([("bucket", pa.int32()), ("page_url", pa.string()), ("id_sitemap", pa.int64()), ("date_us", pa.int64())])
    batch = pa.RecordBatch.from_pydict({
        "bucket": [1, 1, 1, 2] * 900, "page_url": ["a", "a", "a", "b"] * 900, "id_sitemap": [3, None, 2, None] * 900, "date_us": [None, 5, 5, None] * 900}, kinds)
    made = list(incremental._best_of_batches(iter([batch, batch.slice(0, 0), batch.slice(0, 1)])))
    assert [m.to_pylist() for m in made] == [
        [{"bucket": 1, "page_url": "a", "id_sitemap": 2, "date_us": 5}, {"bucket": 2, "page_url": "b", "id_sitemap": None, "date_us": None}],
        [], [{"bucket": 1, "page_url": "a", "id_sitemap": 3, "date_us": None}]]


def test_a_page_stream_begun_with_state_by_url_goes_on(spark, tmp_path, monkeypatch):
    root, state, day = str(tmp_path / "pages"), str(tmp_path / "state"), dt.datetime(2025, 1, 1)
    incremental.write_base(spark.createDataFrame([(50, 1, "u0", None, True, None)], NEWS_PAGES), root)
    with monkeypatch.context() as before:
        before.setattr(incremental, "_url_buckets", lambda spark, checkpoint: None)
        incremental.stream_page_discovery(_found(spark, str(tmp_path / "in"), [("u0", 1, day), ("u1", 1, day)], 0), root, state, AS_OF).awaitTermination(120)
    incremental.stream_page_discovery(_found(spark, str(tmp_path / "in"), [("u0", 1, day), ("u1", 1, day), ("u2", 2, None)], 1), root, state, AS_OF).awaitTermination(120)
    assert rows(incremental.current_pages(spark, root), "id_page", "page_url") == [(50, "u0"), (51, "u1"), (52, "u2")]
    assert not (tmp_path / "state-buckets").exists()


def test_a_page_micro_batch_cut_off_runs_again(spark, tmp_path, monkeypatch):
    root, state, write = str(tmp_path / "pages"), str(tmp_path / "state"), incremental._write_part
    incremental.stream_page_discovery(_found(spark, str(tmp_path / "in"), [("u1", 1, None)], 0), root, state, AS_OF).awaitTermination(120)

    def cut_off(df, place, stream, batch_id):
        write(df, place, stream, batch_id)
        raise RuntimeError("cut off")

    with monkeypatch.context() as once:
        once.setattr(incremental, "_write_part", cut_off)
        stream = _found(spark, str(tmp_path / "in"), [("u1", 1, None), ("u2", 1, None)], 1)
        with pytest.raises(Exception, match="cut off"):
            incremental.stream_page_discovery(stream, root, state, AS_OF).awaitTermination(120)
    assert list((tmp_path / "state-first").iterdir())
    _found(spark, str(tmp_path / "in"), [("u2", 1, None), ("u3", 1, None)], 2)
    for _ in range(2):
        incremental.stream_page_discovery(stream, root, state, AS_OF).awaitTermination(120)
    assert rows(incremental.current_pages(spark, root), "id_page", "page_url") == [(1, "u1"), (2, "u2"), (3, "u3")]
    assert not list((tmp_path / "state-first").iterdir())


def result(page, value, error=None):
    return json.dumps({"custom_id": str(page), "error": error, "response": {"status_code": 200, "body": {"data": [{"embedding": [value]}]}}})


def test_result_stream_takes_the_newest_vector(spark, tmp_path):
    source, root, state = tmp_path / "in", str(tmp_path / "vectors"), str(tmp_path / "state")
    source.mkdir()
    for i, lines in enumerate([[result(1, 1.0), result(2, 2.0), result(2, 2.5)], [result(1, 3.0), result(3, 4.0, "bad")]]):
        (source / f"{i}.jsonl").write_text("\n".join(lines))
        incremental.stream_batch_results(spark, str(source), root, state).awaitTermination(120)
    assert rows(incremental.current_embeddings(spark, root), "id_page", "embedding") == [(1, [3.0]), (2, [2.5])]
    assert spark.createDataFrame([], RESULT_LINE).columns == ["custom_id", "error", "response"]


def test_fetch_stream_ends_at_the_batch_totals(spark, tmp_path):
    source, root, state = (str(tmp_path / d) for d in ("in", "totals", "state"))
    schema = "domain string, ok boolean, content_size bigint"
    waves = [[("a", True, 10), ("a", False, 0)], [("b", True, 5)], [("a", True, 7)]]
    for i, wave in enumerate(waves):
        spark.createDataFrame(wave, schema).coalesce(1).write.parquet(f"{source}/wave={i}")
        stream = spark.readStream.schema(schema).option("recursiveFileLookup", "true").parquet(source)
        incremental.stream_fetch_stats(stream, root, state).awaitTermination(120)
    log = spark.createDataFrame(sum(waves, []), schema)
    assert rows(incremental.current_fetch_stats(spark, root), "*") == rows(reports.fetch_domain_stats(log), "*")


def test_streams_with_a_new_checkpoint_lose_nothing(spark, tmp_path):
    day, source, root = dt.datetime(2025, 1, 1), str(tmp_path / "in"), str(tmp_path / "pages")
    for i, wave in enumerate([[("u1", 1, day)], [("u2", 1, day)]]):
        spark.createDataFrame(wave, FOUND).coalesce(1).write.parquet(f"{source}/wave={i}")
        stream = spark.readStream.schema(FOUND).option("recursiveFileLookup", "true").parquet(source)
        incremental.stream_page_discovery(stream, root, str(tmp_path / f"state{i}"), AS_OF).awaitTermination(120)
    got = incremental.current_pages(spark, root)
    assert rows(got, "id_page", "page_url") == [(1, "u1"), (2, "u2")]

    files, vectors = tmp_path / "results", str(tmp_path / "vectors")
    files.mkdir()
    for i, lines in enumerate([[result(1, 1.0), result(2, 2.0)], [result(1, 3.0)]]):
        (files / f"{i}.jsonl").write_text("\n".join(lines))
        incremental.stream_batch_results(spark, str(files), vectors, str(tmp_path / f"vstate{i}")).awaitTermination(120)
    assert [r[0] for r in rows(incremental.current_embeddings(spark, vectors), "id_page", "embedding")] == [1, 2]

    schema, log, totals = "domain string, ok boolean, content_size bigint", str(tmp_path / "log"), str(tmp_path / "totals")
    for i, wave in enumerate([[("a", True, 10)], [("b", True, 5), ("a", False, 0)]]):
        spark.createDataFrame(wave, schema).coalesce(1).write.parquet(f"{log}/wave={i}")
        stream = spark.readStream.schema(schema).option("recursiveFileLookup", "true").parquet(log)
        incremental.stream_fetch_stats(stream, totals, str(tmp_path / f"tstate{i}")).awaitTermination(120)
    whole = spark.read.schema(schema).option("recursiveFileLookup", "true").parquet(log)
    assert rows(incremental.current_fetch_stats(spark, totals), "*") == rows(reports.fetch_domain_stats(whole), "*")


def test_checkpoints_go_to_the_named_folder(spark):
    from presslake import checkpoint_root, scratch_path

    assert checkpoint_root(spark) == spark.conf.get("spark.checkpoint.dir")
    assert scratch_path(spark, "x").startswith(checkpoint_root(spark))


@pytest.mark.parametrize("as_of", [AS_OF])
def test_reports_on_empty_tables(spark, as_of):
    tables = [empty(spark, s) for s in (SITEMAPS, NEWS_PAGES, NEWS_PAGES_CONTENT, CONTENT_EMBEDDINGS)]
    made = reports.report(*tables)
    assert made["monthly"].count() == made["domains"].count() == 0
    assert made["summary"].first().asDict() == {
        "total_pages": 0, "pages_in_news_pages_content": 0, "pages_with_non_empty_content": 0, "pages_with_embeddings": 0,
        "min_publication_date": None, "max_publication_date": None}


@pytest.mark.parametrize("files", [0, 3])
def test_given_table_streams_whole_as_file_or_folder(spark, tmp_path, files):
    from crosscheck.registry import Tables
    from crosscheck.stages import _stream

    given = "/root/testdata/sf0.001/documents.parquet"
    if files:
        spark.read.parquet(given).repartition(files).write.parquet(str(tmp_path / "documents.parquet"))
    else:
        (tmp_path / "documents.parquet").symlink_to(given)
    out = str(tmp_path / "out")
    read = _stream(Tables(spark, str(tmp_path)), "documents").select("doc_id").writeStream.format("parquet")
    read.option("path", out).option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True).start().awaitTermination(120)
    assert rows(spark.read.parquet(out), "doc_id") == rows(spark.read.parquet(given), "doc_id")
