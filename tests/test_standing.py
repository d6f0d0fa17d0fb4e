"""Standing sums against the reports they stand for."""

import datetime as dt

from conftest import plan, rows
from pyspark.sql import functions as F

from presslake.operators import text
from presslake.plans import reports, standing
from presslake.plans.standing import StandingFunnel


def tables(spark, pages, content, vectors):
    made = spark.createDataFrame([(i, s, None if d is None else dt.datetime(2024, 1, d)) for i, s, d in pages], "id_page long, id_sitemap long, publication_date timestamp")
    return (
        made, spark.createDataFrame(content, "id_page long, content string"),
        spark.createDataFrame([(i, [1.0]) for i in vectors], "id_page long, embedding array<float>"),
    )


def test_inserts_updates_and_retractions(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(standing, "MOST_CHANGES", 2)
    sitemaps = spark.createDataFrame([(1, "a"), (2, "b"), (3, "a")], "id_sitemap long, domain string")
    states = [
        ([], [], []),
        ([(1, 1, 5), (2, 2, None), (3, 3, 9)], [(1, "x"), (2, "")], [1]),
        ([(1, 1, 5), (2, 1, 7), (3, 3, 9), (4, 2, 1)], [(1, ""), (2, "y"), (3, None)], [1, 3]),
        ([(1, 2, 6), (2, 1, 7), (3, 3, 2), (4, 2, 1)], [(1, "z"), (3, "w")], [3, 4]),  # a vector and a text are gone
        ([(1, 2, 6), (4, 2, 1)], [(1, "z")], []),
    ]
    funnel, before = StandingFunnel(spark, str(tmp_path / "f")), tables(spark, *states[0])
    assert funnel.version() == -1
    funnel.start(*before)
    for number, state in enumerate(states[1:], 1):
        after = tables(spark, *state)
        touched = spark.createDataFrame([(i,) for i in range(6)], "id_page long")
        reading = funnel.sums() if number > 1 else None
        assert funnel.apply(before, after, touched) == number
        assert rows(funnel.domain_stats(sitemaps), "*") == rows(reports.domain_stats(sitemaps, *after), "*")
        assert rows(funnel.summary_stats(sitemaps), "*") == rows(reports.summary_stats(sitemaps, *after), "*")
        if reading is not None:  # readers of folders that were folded meanwhile
            assert rows(reading.agg(F.sum("total_pages")), "*") == [(before[0].count(),)]
        assert len(funnel._spans()) <= 3
        before = after


def test_a_report_reads_sums_only(spark, tmp_path):
    sitemaps = spark.createDataFrame([(1, "a")], "id_sitemap long, domain string")
    funnel = StandingFunnel(spark, str(tmp_path / "f"))
    start, then = tables(spark, [(1, 1, 1)], [], []), tables(spark, [(1, 1, 1), (2, 1, 2)], [(2, "t")], [2])
    funnel.start(*start)
    funnel.apply(start, then, spark.createDataFrame([(2,)], "id_page long"))
    found = plan(funnel.domain_stats(sitemaps))
    assert found.count("FileScan") == 2 and found.count(str(tmp_path / "f")) >= 2
    # A change that broke off before its folder was whole doesn't count.
    (tmp_path / "f/from=2/to=2").mkdir(parents=True)
    assert funnel.version() == 1 and funnel.apply(then, then, spark.createDataFrame([(2,)], "id_page long")) == 2


def test_lines_of_earlier_runs_are_gone(spark, tmp_path):
    docs = spark.createDataFrame([(1, "a\nb"), (2, "b\nc"), (3, "a\nd\nd"), (4, None), (5, "c")], "id bigint, t string")
    whole = rows(text.text_dedup_blocks(docs, "id", "t"), "*")
    seen, parts = text.lines_seen(spark, str(tmp_path / "lines"), 4, 100), []
    for run, (low, high) in enumerate([(1, 2), (3, 3), (4, 5)]):
        part = docs.where(F.col("id").between(low, high))
        parts += rows(text.text_dedup_blocks(part, "id", "t", seen, run), "*")
        assert rows(text.text_dedup_blocks(part, "id", "t", seen, run), "*") == parts[-(high - low + 1) :]  # run again
    assert sorted(parts, key=repr) == whole and seen.rows().count() == 4


def test_texts_meet_their_lines_in_tasks_of_bounded_size(shuffled_joins, tmp_path, monkeypatch):
    """However few shuffle partitions a session has; a union of runs reads one run in a task."""
    spark = shuffled_joins
    docs = spark.range(4000).select("id", F.concat(F.lit("a\n"), F.repeat(F.sha2(F.col("id").cast("string"), 256), 16)).alias("t"))
    docs = docs.unionByName(spark.range(2000).select(F.lit(None).cast("bigint").alias("id"), F.repeat(F.sha2(F.concat(F.lit("n"), "id"), 256), 16).alias("t")))
    docs.write.parquet(str(tmp_path / "d"))
    docs = spark.read.parquet(str(tmp_path / "d"))
    monkeypatch.setattr(text, "TASK_BYTES", 1 << 18, raising=False)
    seen, done = text.lines_seen(spark, str(tmp_path / "lines"), 4, 4000), None
    for run, part in enumerate([docs.where("id < 2000"), docs.where("id >= 2000 or id is null")]):
        made = text.text_dedup_blocks(part, "id", "t", seen, run)
        done = made if done is None else done.unionByName(made)
    sizes = done.rdd.mapPartitions(lambda batch: [sum(1 for _ in batch)]).collect()
    assert len(sizes) >= 24 and sum(sizes) == 6000 and max(sizes) < 600
    assert done.where("id is null and t = ''").count() == 2000 and done.where("id = 0 and t like 'a\n%'").count() == 1
    assert done.where("id > 0 and length(t) = 1024").count() == 3999


def test_standing_queries_hand_no_texts_to_their_runs(spark, monkeypatch):
    from crosscheck.registry import Tables
    from crosscheck.reports import _standing

    given = []
    monkeypatch.setattr(standing, "page_states", lambda *tables, made=standing.page_states: given.append(tables[1]) or made(*tables))
    t = Tables(spark, "/root/testdata/sf0.001")
    funnel, sitemaps = _standing(t)
    assert len(given) == 5 and all(c.columns == ["id_page", "text_chars"] and "Join" not in plan(c) for c in given)
    assert rows(funnel.domain_stats(sitemaps), "*") == rows(reports.domain_stats(*t.crawl()), "*")
