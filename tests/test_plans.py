"""The plans that large tables depend on."""

import pytest
from conftest import plan, rows
from pyspark.sql import functions as F

from presslake.functions.dates import min_date
from presslake.operators import audit, html, joins, merge, queues, redirects, text, vectors
from presslake.operators.stored import with_stored_marks
from presslake.plans import reports
from presslake.sources.sitemaps import sitemap_index_scan, urlset_scan
from presslake.sources.tables import crawl_tables_scan, read_content, write_bucketed, write_content, write_snapshot
from presslake.schemas import TABLES
from crosscheck.registry import Tables


@pytest.fixture(scope="module")
def root(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("crawl"))
    t = Tables(spark, "/root/testdata/sf0.001")
    for name, schema in TABLES.items():
        given = t(f"v_{name}")
        full = spark.createDataFrame([], schema).schema
        write_snapshot(given.select(*[
            (F.col(f.name) if f.name in given.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in full
        ]), f"{path}/{name}")
    return path


@pytest.fixture
def crawl(spark, root):
    return tuple(crawl_tables_scan(spark, root)[name] for name in TABLES)


def test_small_sitemaps_are_broadcast_without_a_hint(spark, crawl):
    sitemaps, pages, _, _ = crawl
    assert "BroadcastHashJoin" in plan(joins.pages_with_domain(pages, sitemaps))


def test_frontier_cuts_groups_before_each_shuffle(shuffled_joins, crawl):
    found = plan(queues.fetch_frontier(*crawl[:3]))
    assert found.count("WindowGroupLimit") == 4
    assert "hashpartitioning(domain" in found and "_slice" in found


def test_embed_queue_is_a_distributed_top_k_that_carries_no_text(shuffled_joins, crawl):
    found = plan(queues.embed_candidates(*crawl).orderBy(*queues.newest_first()).limit(10))
    assert "TakeOrderedAndProject" in found
    shuffled = [line for line in found.split("\n") if "Exchange" in line or "SortMergeJoin" in line]
    assert not any("content#" in line for line in shuffled)


def test_domain_report_joins_on_one_key_and_meets_sitemaps_last(shuffled_joins, crawl):
    found = plan(reports.domain_stats(*crawl))
    # Three tables by page, one exchange each; then sums per sitemap, per domain, and the final sort.
    assert found.count("Exchange hashpartitioning(id_page") == 3
    assert found.count("Exchange hashpartitioning(id_sitemap") == 2
    assert found.count("Exchange ") == 7
    assert "PythonUDF" not in found and "MapInPandas" not in found


def test_queues_and_reports_need_no_bodies_in_the_split_layout(spark, crawl, tmp_path):
    sitemaps, pages, content, embeddings = crawl
    write_content(content, str(tmp_path / "content"))
    meta, bodies = read_content(spark, str(tmp_path / "content"))
    assert "content" not in meta.columns and "page_raw_content" not in meta.columns
    assert rows(queues.fetch_frontier(sitemaps, pages, meta), "id_page") == rows(queues.fetch_frontier(sitemaps, pages, content), "id_page")
    assert rows(queues.extract_queue(sitemaps, pages, meta), "id_page") == rows(queues.extract_queue(sitemaps, pages, content), "id_page")
    assert rows(reports.domain_stats(sitemaps, pages, meta, embeddings), "*") == rows(reports.domain_stats(*crawl), "*")
    assert rows(reports.monthly_stats(sitemaps, pages, meta), "*") == rows(reports.monthly_stats(sitemaps, pages, content), "*")
    split = queues.embed_queue(sitemaps, pages, meta, embeddings, limit=9, bodies=bodies)
    assert rows(split, "*") == rows(queues.embed_queue(*crawl, limit=9), "*")
    assert with_stored_marks(content).where("has_raw <> (page_raw_content is not null)").count() == 0


def test_filters_and_columns_reach_the_scan(spark, crawl):
    found = plan(reports.monthly_stats(*crawl[:3]))
    assert "GreaterThanOrEqual(publication_date" in found and "IsNotNull(content)" in found
    assert "page_raw_content" not in found


def test_documents_are_parsed_once(spark, tmp_path):
    spark.createDataFrame([("s", "<urlset/>")], "sitemap_url string, body string").write.parquet(str(tmp_path / "d"))
    docs = spark.read.parquet(str(tmp_path / "d"))
    for scan in (urlset_scan(docs), sitemap_index_scan(docs)):
        # As is, and once more for broken ones.
        assert plan(scan).count("from_xml(") == 2


def test_text_is_shuffled_once_and_lines_as_digests(shuffled_joins, tmp_path):
    spark = shuffled_joins
    spark.read.parquet("/root/testdata/sf0.001/documents.parquet").write.parquet(str(tmp_path / "d"))
    found = plan(text.text_dedup_blocks(spark.read.parquet(str(tmp_path / "d")), "doc_id", "text"))
    assert found.count("Exchange") == 3
    assert "partial_min_by" in found and "SortAggregate" not in found


def test_built_in_operators_stay_in_the_jvm(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    for df in (html.html_extract(pages, "page_id", "html"), text.token_truncate(docs, "doc_id", "text"), text.token_count(docs, "doc_id", "text")):
        found = plan(df)
        assert "Python" not in found and "Pandas" not in found and "Exchange" not in found


def test_nearest_rows_are_one_scan(spark):
    vecs = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet")
    found = plan(vectors.semantic_topk(vecs, [0.1] * 64, 5, id_col="vec_id"))
    assert "TakeOrderedAndProject" in found and "Join" not in found and "Exchange" not in found


def test_no_cross_joins(shuffled_joins, crawl):
    sitemaps, pages, content, embeddings = crawl
    log = spark_log(shuffled_joins)
    for df in (
        reports.summary_stats(*crawl), queues.embed_queue(*crawl), queues.extract_queue(*crawl[:3]),
        redirects.redirect_chain_resolve(log), audit.constraint_audit({"sitemaps": sitemaps, "news_pages": pages}),
    ):
        found = plan(df)
        assert "CartesianProduct" not in found and "BroadcastNestedLoopJoin" not in found


def spark_log(spark):
    return spark.createDataFrame([("https://a/", 200, None)], "url string, status int, location string")


def test_redirects_are_one_plan_of_few_joins(shuffled_joins):
    spark = shuffled_joins
    found = redirects.redirect_chain_resolve(spark_log(spark), max_hops=50)
    assert found.count() == 1 and plan(found).count("SortMergeJoin") <= 2  # no redirect: nothing but the last look-up
    chain = [(f"https://a/{i}", 301, f"/{i + 1}") for i in range(70)] + [("https://a/70", 200, None)]
    log = spark.createDataFrame(chain, "url string, status int, location string")
    hops = {r.url: (r.hops, r.outcome, r.final_url) for r in redirects.redirect_chain_resolve(log, max_hops=50).collect()}
    for i in range(71):
        left = 70 - i
        assert hops[f"https://a/{i}"] == (min(left, 50), "ok" if left <= 50 else "too_many_redirects", f"https://a/{i + min(left, 50)}")
    few = redirects.redirect_chain_resolve(log, spark.createDataFrame([("https://a/3",), ("https://b/",)], "url string"))
    assert {tuple(r) for r in few.collect()} == {("https://a/3", "https://a/8", 5, "too_many_redirects"), ("https://b/", "https://b/", 0, "missing")}


def test_the_audit_sums_once(shuffled_joins, crawl):
    names = ("sitemaps", "news_pages", "news_pages_content", "content_embeddings")
    found = plan(audit.constraint_audit(dict(zip(names, crawl, strict=True))))
    assert found.count("Exchange") == 1 and "Join" not in found


def test_a_small_delta_leaves_the_stored_table_unshuffled(shuffled_joins, crawl, tmp_path):
    spark = shuffled_joins
    stored = crawl[2]
    stored.limit(20).select("id_page", "page_url", "publication_date", "page_raw_content").write.parquet(str(tmp_path / "d"))
    delta = spark.read.parquet(str(tmp_path / "d"))
    kept = plan(merge.raw_upsert(stored, delta, F.lit("2025-01-01").cast("timestamp")))
    # The rows that stay as they are pass by a broadcast of the delta's keys.
    untouched = kept[: kept.index("FileScan")]
    assert "BroadcastHashJoin" in untouched and "LeftAnti" in untouched and "Exchange" not in untouched


def test_a_large_delta_gives_the_same_rows(spark, crawl, monkeypatch):
    stored = crawl[2]
    delta = stored.where("id_page % 3 = 0").select("id_page", F.concat("page_url", F.lit("x")).alias("page_url"), "publication_date", F.lit("<p>").alias("page_raw_content"))
    delta = delta.unionByName(delta.select(F.col("id_page") + 10**6, "page_url", "publication_date", "page_raw_content").toDF(*delta.columns))
    moment = F.lit("2025-01-01").cast("timestamp")
    small = rows(merge.raw_upsert(stored, delta, moment), "*")
    monkeypatch.setattr(merge, "small_keys", lambda df, key: None)
    assert rows(merge.raw_upsert(stored, delta, moment), "*") == small
    assert joins.small_keys(delta, "id_page", max_bytes=100) is None


def test_bucketed_tables_join_without_a_shuffle(shuffled_joins):
    spark = shuffled_joins
    left = spark.range(100).select(F.col("id").alias("id_page"), F.lit("x").alias("content"))
    for name in ("bucketed_a", "bucketed_b"):
        spark.sql(f"drop table if exists {name}")
        write_bucketed(left, name, "id_page", 4)
    joined = spark.table("bucketed_a").join(spark.table("bucketed_b").select("id_page"), "id_page")
    assert "Exchange" not in plan(joined)
    for name in ("bucketed_a", "bucketed_b"):
        spark.sql(f"drop table {name}")


@pytest.fixture
def tiny_partitions(shuffled_joins):
    """Limits scaled down so that small test data counts as skewed."""
    spark = shuffled_joins
    small = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {key: spark.conf.get(key) for key in small}
    for key, value in small.items():
        spark.conf.set(key, value)
    yield spark
    for key, value in before.items():
        spark.conf.set(key, value)


def hot_pages(spark):
    """Pages of which a third lie in one sitemap of one domain."""
    return spark.range(0, 60000, 1, 12).select(
        F.col("id").alias("id_page"), F.concat(F.lit("https://p/"), "id").alias("page_url"),
        F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id") % 500).alias("id_sitemap"),
        F.when(F.col("id") % 3 == 0, "hot.com").otherwise(F.concat(F.lit("d"), F.col("id") % 500)).alias("domain"),
        F.concat(F.lit("s"), F.col("id") % 900).alias("sitemap_url"),
        F.timestamp_seconds(F.col("id") * 1000 + 1_700_000_000).alias("publication_date"),
    )


def test_the_page_join_splits_a_hot_sitemap(tiny_partitions):
    spark = tiny_partitions
    sitemaps = spark.range(-1, 500).select(F.col("id").alias("id_sitemap"), F.concat(F.lit("d"), "id").alias("domain"))
    joined = joins.pages_with_domain(hot_pages(spark).drop("domain"), sitemaps)
    assert len(joined.collect()) == 60000
    assert "skew=true" in plan(joined)


def test_a_hot_domain_is_dealt_over_many_tasks(tiny_partitions):
    spark = tiny_partitions
    known = spark.range(400).select(F.concat(F.lit("d"), "id").alias("domain")).union(spark.sql("select 'hot.com'"))
    floor = min_date(F.lit("2024-06-01").cast("timestamp"), 0)
    domains = joins.known_domains(known)
    dealt = joins.spread_lookup(hot_pages(spark), domains, "domain", F.col("page_url"), max_bytes=0)
    sizes = [r[0] for r in dealt.groupBy(F.spark_partition_id()).count().select("count").collect()]
    assert sum(sizes) == 60000 and max(sizes) < 3 * 60000 / 16
    by_broadcast = joins.spread_lookup(hot_pages(spark), domains, "domain", F.col("page_url"))
    assert "BroadcastHashJoin" in plan(by_broadcast) and "_way" not in plan(by_broadcast)
    assert rows(dealt, "id_page", "is_known") == rows(by_broadcast, "id_page", "is_known")

    hot = joins.hot_keys(hot_pages(spark), "domain")
    assert rows(hot, "domain", "_hot") == [("hot.com", True)]
    assert joins.copied_entries(domains, hot, "domain", 256).count() == 400 + 256

    labelled = reports.label_page_outcome(hot_pages(spark), known, floor)
    old = (F.col("publication_date") < floor) & ((F.col("domain") == "hot.com") | (F.substring("domain", 2, 9).try_cast("int") < 400))
    expected = hot_pages(spark).select(F.count_if(old), F.count_if(~old)).first()
    stats = reports.discovery_stats(labelled).agg(F.sum("pages_skipped"), F.sum("pages_added")).first()
    assert tuple(stats) == tuple(expected)


def test_the_sketch_names_every_hot_key_and_no_cold_one(tiny_partitions):
    spark, ids = tiny_partitions, F.col("id")
    key = F.when(ids % 3 == 0, "third").when(ids % 200 == 1, "above").when(ids % 700 == 4, "below").when(ids % 5 == 2, None).otherwise(F.concat(F.lit("k"), ids))
    many = spark.range(0, 300_000, 1, 9).select(ids, key.alias("the key"))
    assert rows(joins.hot_keys(many.where("`the key` is not null"), "the key", 200), "the key") == [("above",), ("third",)]
    assert joins.hot_keys(many.where("false"), "the key").count() == joins.hot_keys(many.where("`the key` like 'k%'"), "the key").count() == 0
    known = spark.createDataFrame([("third", 1), ("above", 2), ("k7", 3)], "`the key` string, n int")
    dealt = joins.spread_lookup(many, known, "the key", F.col("id"), ways=64, max_bytes=0)
    assert rows(dealt.groupBy("n").count(), "n", "count") == rows(many.join(known, "the key", "left").groupBy("n").count(), "n", "count")
    # Rows without a key are dealt as well.
    sizes = [r[0] for r in dealt.where("`the key` is null").groupBy(F.spark_partition_id()).count().select("count").collect()]
    assert len(sizes) > 1 and max(sizes) < sum(sizes)


def test_large_queues_end_in_no_single_task(spark, crawl, monkeypatch):
    sitemaps, pages, content, embeddings = crawl
    for limit in (1, 7, 60, 1_000_000):
        plain = rows(queues.embed_queue(sitemaps, pages, content, embeddings, limit=limit), "id_page", "publication_date")
        with monkeypatch.context() as m:
            m.setattr(queues, "ROWS_IN_ONE_TASK", 0)
            chosen = queues.embed_queue(sitemaps, pages, content, embeddings, limit=limit)
            assert rows(chosen, "id_page", "publication_date") == plain
            assert "SinglePartition" not in plan(chosen) and "TakeOrdered" not in plan(chosen)
    many = spark.range(20_000).select(
        F.col("id").alias("id_page"), F.when(F.col("id") % 10 > 0, F.timestamp_micros(F.col("id") % 700 * 1_000_003)).alias("publication_date"))
    for limit in (0, 1, 1999, 2000, 2001, 12_345, 20_000, 50_000):
        wanted = rows(many.orderBy(*queues.newest_first()).limit(limit), "id_page")
        assert rows(queues.newest(many, limit), "id_page") == wanted
