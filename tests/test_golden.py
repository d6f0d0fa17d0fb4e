"""Small hand-written inputs with the exact rows expected of them."""

import datetime as dt
import json

import pandas as pd
import pytest
from conftest import rows
from pyspark.sql import functions as F

from presslake.functions import dates, measures, tokens, urls
from presslake.operators import batches, html, joins, merge, redirects, text
from presslake.operators.audit import constraint_audit
from presslake.operators.html_walk import walk_page
from presslake.schemas import COOKIES, NEWS_PAGES, NEWS_PAGES_CONTENT, REGISTRY, SITEMAPS
from presslake.sources import jobs, seeds, sitemaps, snapshots

AS_OF = dt.datetime(2025, 3, 31, 12, 0)

NS = 'xmlns="http://www.sitemaps.org/schemas/sitemap/0.9" xmlns:news="http://www.google.com/schemas/sitemap-news/0.9"'


def documents(spark, *bodies):
    return spark.createDataFrame([(f"s{i}", b) for i, b in enumerate(bodies)], "sitemap_url string, body string")


# Sitemap XML ------------------------------------------------------------------

def test_index_in_three_namespace_forms(spark):
    found = sitemaps.sitemap_index_scan(documents(
        spark,
        f"<sitemapindex {NS}><sitemap><loc> https://a/1.xml </loc><lastmod>2024-01-02</lastmod></sitemap>"
        "<sitemap><lastmod>2024-01-03</lastmod></sitemap></sitemapindex>",
        '<sm:sitemapindex xmlns:sm="http://www.sitemaps.org/schemas/sitemap/0.9"><sm:sitemap><sm:loc>https://a/2.xml</sm:loc></sm:sitemap></sm:sitemapindex>',
        "<sitemapindex><sitemap><loc>https://a/3.xml</loc></sitemap></sitemapindex>",
    ))
    assert rows(found, "sitemap_url", "child_url", "lastmod_text") == [
        ("s0", "https://a/1.xml", "2024-01-02"), ("s1", "https://a/2.xml", None), ("s2", "https://a/3.xml", None)]


def test_children_left_out(spark):
    children = spark.createDataFrame(
        [(u,) for u in ["https://a/category-sitemap.xml", "https://a/author/x.xml", "https://a/stale.xml",
                        "https://a/unknown.xml", "https://a/null.xml", "https://a/master.xml"]], "sitemap_url string")
    stored = spark.createDataFrame(
        [("https://a/stale.xml", False, False), ("https://a/null.xml", False, None), ("https://a/master.xml", True, False)],
        "sitemap_url string, is_master boolean, is_fresh boolean")
    kept = joins.sitemap_stale_exclude(joins.sitemap_url_exclude(children), stored)
    assert rows(kept, "sitemap_url") == [("https://a/master.xml",), ("https://a/null.xml",), ("https://a/unknown.xml",)]


def test_page_dates_in_order_of_preference(spark):
    found = sitemaps.publication_date_pick(sitemaps.urlset_scan(documents(
        spark,
        f"<urlset {NS}>"
        "<url><loc>https://a/lastmod</loc><lastmod>2024-01-02T03:04:05+03:00</lastmod><news:news><news:publication_date>2020-01-01</news:publication_date></news:news></url>"
        "<url><loc>https://a/news</loc><news:news><news:publication_date>2024-02-02</news:publication_date></news:news></url>"
        "<url><loc>https://a/second</loc><lastmod>recently</lastmod><news:news><news:publication_date>2024-03-03</news:publication_date></news:news></url>"
        "<url><loc>https://a/none</loc><changefreq>daily</changefreq></url>"
        "<url><loc>https://a/cdata</loc><lastmod><![CDATA[2024-04-04]]></lastmod></url>"
        '<url><loc>https://a/image</loc><image:image xmlns:image="i"><image:loc>https://a/i.png</image:loc></image:image><pubDate>05 May 2024</pubDate></url>'
        "<url><lastmod>2024-01-01</lastmod></url></urlset>",
        "<urlset><url><loc>https://b/single</loc><time>2024-06-06</time></url></urlset>",
    )))
    day = F.date_format("publication_date", "yyyy-MM-dd HH:mm:ss").alias("at")
    assert rows(found, "page_url", day) == [
        ("https://a/cdata", "2024-04-04 00:00:00"), ("https://a/image", "2024-05-05 00:00:00"),
        ("https://a/lastmod", "2024-01-02 00:04:05"), ("https://a/news", "2024-02-02 00:00:00"),
        ("https://a/none", None), ("https://a/second", "2024-03-03 00:00:00"), ("https://b/single", "2024-06-06 00:00:00")]


def test_broken_documents(spark):
    docs = documents(
        spark,
        "<urlset><url><loc>https://a/cut</loc>",
        '\n  <?xml version="1.0"?><urlset><url><loc>https://a/blanks</loc></url></urlset>',
        '<?xml version="1.0"?><?xml-stylesheet href="s.xsl"?><urlset><url><loc>https://a/style</loc></url></urlset>',
        "<!DOCTYPE html><html><body><p>not found<br></body></html>",
        "", None, "<urlset></urlset>",
    )
    assert rows(sitemaps.urlset_scan(docs), "page_url") == [("https://a/blanks",), ("https://a/style",)]
    assert rows(sitemaps.unreadable_documents(docs), "sitemap_url") == [("s0",), ("s3",), ("s4",), ("s5",)]


@pytest.mark.parametrize("given, expected", [
    ("2024-01-05T10:00:00Z", "2024-01-05 10:00:00"), ("2024-01-05T10:00:00+03:00", "2024-01-05 07:00:00"),
    ("2024-01-05T10:00:00+0300", "2024-01-05 07:00:00"), ("2024-01-05T10:00:00.250Z", "2024-01-05 10:00:00"),
    ("2024-01-05T10:00:00", "2024-01-05 10:00:00"), ("2024-01-05 10:00:00", "2024-01-05 10:00:00"),
    ("05.01.2024 10:00:00", "2024-01-05 10:00:00"), ("05.01.2024", "2024-01-05 00:00:00"),
    ("2024/01/05", "2024-01-05 00:00:00"), ("25/01/2024", "2024-01-25 00:00:00"),
    ("Fri, 05 Jan 2024 10:00:00 +0300", "2024-01-05 07:00:00"), ("Fri, 05 Jan 2024 10:00:00 GMT", "2024-01-05 10:00:00"),
    ("Jan 5, 2024", "2024-01-05 00:00:00"), ("January 5, 2024", "2024-01-05 00:00:00"), ("  <b>2024-01-05</b>\n", "2024-01-05 00:00:00"),
    ("2024-01-05T10:00Z", "2024-01-05 10:00:00"), ("2024-01-05T10:00+03:00", "2024-01-05 07:00:00"),
    ("2024-01-05 10:00 -0130", "2024-01-05 11:30:00"), ("2024-01-05T10:00", "2024-01-05 10:00:00"),
    ("2024-01", "2024-01-01 00:00:00"), ("2024", "2024-01-01 00:00:00"), ("5 January 2024", "2024-01-05 00:00:00"),
    ("5 May 2024", "2024-05-05 00:00:00"), ("05.01.2024 10:00", "2024-01-05 10:00:00"), ("Fri, 05 Jan 24 10:00:00 GMT", "2024-01-05 10:00:00"),
    ("Fri, 05 Jan 24 10:00:00 +0300", "2024-01-05 07:00:00"), ("2024/01/05 10:00", "2024-01-05 10:00:00"), ("2024-13", None), ("20245", None),
    ("0000-00-00", None), ("1970-01-01", None), ("0001-01-01", None), ("soon", None), ("2024-02-31", None),
    ("31/02/2024", None), ("12:30", None), ("", None), (None, None),
])
def test_date_forms(spark, given, expected):
    df = spark.createDataFrame([(given,)], "t string")
    assert df.select(F.date_format(dates.parse_utc(F.col("t")), "yyyy-MM-dd HH:mm:ss")).first()[0] == expected


def test_min_date_clamps_to_month_end_and_keeps_the_time(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 2, 29, 13, 5), dt.datetime(2025, 3, 31, 1, 2))], "a timestamp, b timestamp")
    got = df.select(dates.min_date(F.col("a"), 12), dates.min_date(F.col("b"), 1)).first()
    assert tuple(got) == (dt.datetime(2023, 2, 28, 13, 5), dt.datetime(2025, 2, 28, 1, 2))


# URLs and redirects --------------------------------------------------------------

@pytest.mark.parametrize("given, netloc, domain", [
    ("https://www.a.com:8080/x?y=//z", "www.a.com:8080", "a.com:8080"), ("https://u:p@a.com", "u:p@a.com", "u:p@a.com"),
    ("//a.com/x", "a.com", "a.com"), ("a.com/x", "", ""), ("https://www.www.a.com/", "www.www.a.com", "www.a.com"),
    ("https://a.com/with blank", "a.com", "a.com"), (None, "", ""),
])
def test_hosts(spark, given, netloc, domain):
    df = spark.createDataFrame([(given,)], "u string")
    assert tuple(df.select(urls.url_netloc(F.col("u")), urls.url_domain(F.col("u"))).first()) == (netloc, domain)


def test_seed_file(spark, tmp_path):
    (tmp_path / "seeds.txt").write_text(" https://a.com/s.xml \n\n\thttps://a.com/t.xml\nhttp://b.com/u.xml\n//c.com/v.xml\n")
    found = seeds.seed_scan(spark, str(tmp_path / "seeds.txt"))
    assert found.count() == 4
    assert rows(seeds.seed_origins(found), "origin") == [("http://b.com",), ("https://a.com",), ("https://c.com",)]


def test_redirect_chains(spark):
    log = [(f"https://five.com/{i}", 301, f"/{i + 1}") for i in range(5)] + [("https://five.com/5", 200, None)]
    log += [(f"https://six.com/{i}", 302, f"{i + 1}") for i in range(6)] + [("https://six.com/6", 200, None)]
    log += [("https://loop.com/a", 301, "/b"), ("https://loop.com/b", 301, "/a")]
    log += [("https://www.w.com/", 301, "https://w.com/x"), ("https://w.com/x", 308, "https://www.w.com/y"), ("https://www.w.com/y", 200, None)]
    log += [("https://c.com/", 301, "https://d.com/"), ("https://d.com/", 200, None)]
    log += [("https://gone.com/", 301, "/nowhere"), ("https://e.com/", 404, None), ("https://odd.com/", 304, None)]
    got = redirects.redirect_chain_resolve(spark.createDataFrame(log, "url string, status int, location string"))
    by_url = {r.url: (r.final_url, r.hops, r.outcome) for r in got.collect()}
    assert len(by_url) == len(log)
    assert by_url["https://five.com/0"] == ("https://five.com/5", 5, "ok")
    assert by_url["https://six.com/0"] == ("https://six.com/5", 5, "too_many_redirects")
    assert by_url["https://six.com/1"] == ("https://six.com/6", 5, "ok")
    assert by_url["https://loop.com/a"][1:] == (5, "too_many_redirects")
    assert by_url["https://www.w.com/"] == ("https://www.w.com/y", 2, "ok")
    assert by_url["https://c.com/"] == ("https://c.com/", 0, "cross_domain")
    assert by_url["https://gone.com/"] == ("https://gone.com/nowhere", 1, "missing")
    assert by_url["https://e.com/"] == ("https://e.com/", 0, "http_error")
    assert by_url["https://odd.com/"] == ("https://odd.com/", 0, "ok")


# Sizes and durations ---------------------------------------------------------------

@pytest.mark.parametrize("size", [0, 1023, 1024, 1152, 1157, 1536, 10**6, 2**20 - 1, 2**20, 1179648, 2**30, 5 * 2**30 + 5368709, 10**15])
def test_sizes_as_python_prints_them(spark, size):
    expected = f"{size} B"
    for unit, step in (("KB", 2**10), ("MB", 2**20), ("GB", 2**30)):
        if size >= step:
            expected = f"{size / step:.2f} {unit}"
    assert spark.range(1).select(measures.format_size(F.lit(size))).first()[0] == expected


@pytest.mark.parametrize("seconds, expected", [
    (0.125, "0.12 seconds"), (59.994, "59.99 seconds"), (60.0, "1 min 0 sec"), (3599.9, "59 min 59 sec"), (3600.0, "1 hours 0 min 0 sec"),
    (90061.5, "25 hours 1 min 1 sec"),
])
def test_durations(spark, seconds, expected):
    assert spark.range(1).select(measures.format_duration(F.lit(seconds))).first()[0] == expected


# Table maintenance -------------------------------------------------------------------

def test_master_seen_again_turns_fresh(spark):
    stored = spark.createDataFrame(
        [(7, "a.com", "https://a.com/m.xml", True, None, None, False, None, None), (8, "a.com", "https://a.com/c.xml", False, 7, None, False, None, None)], SITEMAPS)
    delta = spark.createDataFrame(
        [("https://a.com/m.xml", True, None, None, False), ("https://a.com/c.xml", False, None, None, True),
         ("https://www.b.com/m.xml", True, None, None, None), ("https://www.b.com/m.xml", False, 3, None, None)],
        "sitemap_url string, is_master boolean, parent_id bigint, last_mod timestamp, is_fresh boolean")
    merged = merge.sitemap_insert_new(stored, delta, AS_OF)
    assert rows(merged, "id_sitemap", "domain", "sitemap_url", "is_master", "is_fresh") == [
        (7, "a.com", "https://a.com/m.xml", True, True), (8, "a.com", "https://a.com/c.xml", False, False),
        (9, "www.b.com", "https://www.b.com/m.xml", True, True)]


def test_page_seen_twice_in_one_delta_and_one_known(spark):
    stored = spark.createDataFrame([(3, 1, "https://a/1", None, True, None)], NEWS_PAGES)
    day = dt.datetime(2024, 5, 1)
    delta = spark.createDataFrame(
        [("https://a/1", 2, day), ("https://a/2", 5, day), ("https://a/2", 4, day), ("https://a/2", 1, dt.datetime(2024, 6, 1))],
        "page_url string, id_sitemap bigint, publication_date timestamp")
    merged = merge.page_insert_new(stored, delta, AS_OF)
    assert rows(merged, "id_page", "id_sitemap", "page_url", "publication_date", "is_error", "created_at") == [
        (3, 1, "https://a/1", None, True, None), (4, 4, "https://a/2", day, False, AS_OF)]
    assert rows(merge.page_insert_outcomes(stored, delta), "page_url", "added", "skipped") == [
        ("https://a/1", 0, 1), ("https://a/2", 1, 2)]


def test_upsert_of_html_keeps_the_text(spark):
    stored = spark.createDataFrame(
        [(1, 10, "u", None, "<old>", "text", 4, None), (2, 11, "v", None, "<kept>", None, None, None)], NEWS_PAGES_CONTENT)
    delta = spark.createDataFrame(
        [(10, "u2", None, "<new>"), (12, "w", None, None)], "id_page bigint, page_url string, publication_date timestamp, page_raw_content string")
    merged = merge.raw_upsert(stored, delta, AS_OF)
    assert rows(merged, "id", "id_page", "page_url", "page_raw_content", "content", "fetched_at") == [
        (1, 10, "u2", "<new>", "text", AS_OF), (2, 11, "v", "<kept>", None, None), (3, 12, "w", None, None, AS_OF)]
    again = merge.raw_upsert(merged, delta, AS_OF)
    assert rows(again, "*") == rows(merged, "*")


def test_text_update_sets_the_length_and_inserts_nothing(spark):
    stored = spark.createDataFrame([(1, 10, "u", None, "<x>", None, None, None), (2, 11, "u", None, "<x>", "old", 3, None)], NEWS_PAGES_CONTENT)
    delta = spark.createDataFrame([(10, "näw"), (11, None), (99, "lost")], "id_page bigint, content string")
    updated = merge.content_update(stored, delta)
    assert rows(updated, "id_page", "content", "content_length") == [(10, "näw", 3), (11, None, None)]
    assert rows(merge.content_update(updated, delta), "*") == rows(updated, "*")


# Batch jobs ---------------------------------------------------------------------------

def test_result_and_error_files(spark, tmp_path):
    ok = {"response": {"status_code": 200, "body": {"data": [{"embedding": [1.0, 2.0]}]}}}
    lines = [
        {"custom_id": "1", "error": None, **ok},
        {"custom_id": "2", "error": {"code": "bad"}, "response": None},
        {"custom_id": "3", "error": None, "response": {"status_code": 429, "body": {}}},
        {"custom_id": "1", "error": None, "response": {"status_code": 200, "body": {"data": [{"embedding": [9.0, 9.0]}]}}},
    ]
    (tmp_path / "out.jsonl").write_text("\n".join(map(json.dumps, lines)))
    (tmp_path / "err.jsonl").write_text(json.dumps({"custom_id": "3", "error": {"message": "slow down"}}))
    good, bad = batches.batch_results_load(
        jobs.batch_result_scan(spark, str(tmp_path / "out.jsonl")), jobs.batch_error_scan(spark, str(tmp_path / "err.jsonl")))
    assert rows(good, "id_page", "embedding") == [(1, [9.0, 9.0])]
    assert rows(bad, "id_page", "status_code", "message") == [(2, None, '{"code": "bad"}'), (3, 429, '{"message": "slow down"}')]


def test_registry_files(spark, tmp_path):
    job = {"batch_id": "b1", "input_file_id": "f1", "created_at": "2025-03-31T10:30:00.123456", "status": "pending", "page_ids": [1, 2], "domain_tokens": {"a.com": 7}}
    file = tmp_path / "jobs.json"
    file.write_text(json.dumps({"pending": [job], "completed": [], "failed": [dict(job, batch_id="b2", status="expired")]}, indent=2))
    registry = jobs.job_registry_scan(spark, str(file))
    assert rows(registry, "batch_id", "list_name", "page_ids", "domain_tokens") == [
        ("b1", "pending", [1, 2], {"a.com": 7}), ("b2", "failed", [1, 2], {"a.com": 7})]
    assert rows(joins.pending_pages(registry), "id_page") == [(1,), (2,)]
    assert rows(batches.job_status_counts(registry), "list_name", "jobs") == [("completed", 0), ("failed", 1), ("pending", 1)]
    assert rows(batches.job_age_report(registry, AS_OF), "row_no", "batch_id", "age_hours", "pages") == [(1, "b1", 1.5, 2)]
    assert jobs.job_registry_scan(spark, str(tmp_path / "absent.json")).count() == 0
    file.write_text("{ not json")
    assert jobs.job_registry_scan(spark, str(file)).count() == 0


def test_every_end_of_a_job(spark):
    made = [(f"b{i}", "f", AS_OF, "pending", [i], None, None, None, "pending") for i in range(6)]
    made.append(("done", "f", AS_OF, "completed", [9], None, AS_OF, 1, "completed"))
    registry = spark.createDataFrame(made, REGISTRY)
    statuses = spark.createDataFrame(
        [("b0", "completed"), ("b1", "failed"), ("b2", "expired"), ("b3", "cancelled"), ("b4", "in_progress"), ("done", "failed")], "batch_id string, status string")
    results = spark.createDataFrame([("b0", 42), ("b1", 5)], "batch_id string, processed_count bigint")
    moved = batches.job_registry_transition(registry, statuses, results, AS_OF)
    assert rows(moved, "batch_id", "status", "list_name", "processed_count") == [
        ("b0", "completed", "completed", 42), ("b1", "failed", "failed", None), ("b2", "expired", "failed", None),
        ("b3", "cancelled", "failed", None), ("b4", "pending", "pending", None), ("b5", "pending", "pending", None),
        ("done", "completed", "completed", 1)]
    # Pages of failed jobs can be queued again.
    assert rows(joins.pending_pages(moved), "id_page") == [(4,), (5,)]


def test_apportioning_rounds_halves_to_even_and_survives_no_tokens(spark):
    shares = spark.createDataFrame([(1, "a", 1), (1, "b", 1), (2, "a", 0)], "batch_no bigint, domain string, tokens bigint")
    outcomes = spark.createDataFrame([(1, 5, 3), (2, 4, 0)], "batch_no bigint, ok bigint, failed bigint")
    assert rows(batches.job_domain_apportion(shares, outcomes), "batch_no", "domain", "ok", "failed") == [
        (1, "a", 2, 2), (1, "b", 2, 2), (2, "a", 0, 0)]


# Snapshots ----------------------------------------------------------------------------

def test_snapshots(spark):
    df = spark.createDataFrame(
        [(1, "a", "05-01-2024", "x"), (2, "a", "01-02-2024", "y"), (3, "a", "01-02-2024", "z"), (4, "b", "2024", "q"), (5, "c", "31-02-2024", "r"), (6, "c", "01-01-2020", "s")],
        "id bigint, domain string, day_text string, cookies string")
    newest = snapshots.latest_snapshot_per_key(df, "domain", "day_text", "cookies", "id")
    assert rows(newest, "domain", "cookies") == [("a", "z"), ("c", "s")]
    assert rows(snapshots.superseded_snapshots(df, "domain", "day_text", "id"), "id") == [(1,), (2,)]
    assert rows(snapshots.snapshots_of_day(df, "day_text", "2024-02-01"), "id") == [(2,), (3,)]


def test_pairs_with_a_repeated_name(spark):
    df = spark.createDataFrame([('[{"name":"a","value":"1","path":"/"},{"name":"b","value":"2"},{"name":"a","value":"3"}]',)], "j string")
    assert df.select(snapshots.pairs_to_map(F.from_json("j", F.lit(COOKIES)))).first()[0] == {"a": "3", "b": "2"}


# Text ---------------------------------------------------------------------------------

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style></head><body><nav><a href="/">Home</a></nav>
<article class="x"><!-- note --><h1>Head &amp; line</h1><script>var a = "</p>";</script>
<p>One <a href="/l">two</a>  &quot;three&quot;<br>four</p><ul><li>first</li><li></li><li>second</li></ul>
<table><tr><td>a</td><td>b</td></tr></table><aside><p>Related</p></aside><H2>Sub</H2><p>a &lt; b</p></article><footer>&copy;</footer></body></html>"""
TEXT = '# Head & line\nOne two "three"\nfour\n- first\n- second\n| a | b |\n## Sub\na < b'


def test_html_by_patterns_and_by_walking(spark):
    df = spark.createDataFrame([(1, PAGE), (2, ""), (3, None), (4, "<script>x</script>"), (5, "<body><p>no article</p></body>")], "id bigint, html string")
    expected = [(1, TEXT), (2, None), (3, None), (4, None), (5, "no article")]
    assert rows(html.html_extract(df, "id", "html"), "id", "content") == expected
    walked = html.html_extract(df, "id", "html", fn=lambda pages: pages.map(walk_page, na_action=None))
    assert rows(walked, "id", "content") == expected


@pytest.mark.parametrize("given, expected", [
    # A menu that is a plain div, nested boxes of one name, a form that is never closed.
    ("<div class=menu><a href=/>Home</a> words words words words</div><form><div><div><p>The text <div>is here.</div></div></div>", "The text\nis here."),
    ("<article><header><h1>Head</h1></header><p>Body text.</p><nav><div>x</div></nav>tail</article>", "# Head\nBody text.\ntail"),
    ("<header><h1>Site</h1></header><main><p>Body text.</main>", "Body text."),
    # The heaviest of several boxes, its links' lines left out; text in sibling boxes holds together.
    ("<div><p>A teaser of four</p></div><div><p>A long paragraph that says what the page is about.</p><p><a href=/>more of this</a></p></div>", "A long paragraph that says what the page is about."),
    ("<div><div>One two three.</div><div>Four five six.</div><div>Seven eight nine.</div></div><div>Some other words.</div>", "One two three.\nFour five six.\nSeven eight nine."),
    # Tags left open, stray ends, quotes that hold a sign, table rows over lines.
    ("<ul><li>one<li>two <b>bold</ul></div></span><p title='a > b'>three", "- one\n- two bold\nthree"),
    ("<table><tr><th>a<th>b<tr><td><p>c</p><td>d &eacute; &#x27;</table>", "| a | b |\n| c | d é ' |"),
    ("<nav>only a menu</nav>", None), ("plain words", "plain words"), ("<div><a href=/>all links</a></div>", None), ("", None), (None, None),
])
def test_main_text_by_stack_and_density(given, expected):
    assert walk_page(given) == expected


def test_a_page_of_deep_and_many_tags():
    assert walk_page("<div>" * 3000 + "deep" + "</div>" * 3000) == "deep"
    assert walk_page("<p>line" * 50_000) == "\n".join(["line"] * 50_000)


@pytest.mark.parametrize("given, expected", [
    ("<p>it&#8217;s &eacute;t&eacute; &#x27;x&#X27; &rsquo;</p>", "it’s été 'x' ’"), ("<p>&#128512; &#0; &#55296; &#9999999; &#; &#xZ;</p>", "😀 &#0; &#55296; &#9999999; &#; &#xZ;"),
    ("<p>a &amp;lt; b &amp;#39; &#60;b&#62;</p>", "a &lt; b &#39; <b>"), ("<p>none</p>", "none"), (None, None),
])
def test_characters_by_number_and_name(spark, given, expected):
    df = spark.createDataFrame([(1, given)], "id bigint, h string")
    assert html.html_extract(df, "id", "h").first().content == expected


def test_repeated_lines_stay_in_the_first_document(spark):
    df = spark.createDataFrame(
        [(1, "a\n b \n\na\nc"), (2, "b\nd\na"), (3, "a\r\nc"), (4, ""), (5, None)], "id bigint, t string")
    assert rows(text.text_dedup_blocks(df, "id", "t"), "id", "t") == [(1, "a\nb\nc"), (2, "d"), (3, ""), (4, ""), (5, "")]


def test_token_limits(spark):
    made = {"below": "a b c", "at": "a b, c", "above": "a  b, c d ", "empty": ""}
    df = spark.createDataFrame(list(made.items()), "id string, t string")
    cut = text.token_truncate(df, "id", "t", limit=5)
    assert rows(cut, "id", "t", "tokens", "chars", "truncated") == [
        ("above", "a  b, c", 4, 7, True), ("at", "a b, c", 4, 6, False), ("below", "a b c", 3, 5, False), ("empty", "", 0, 0, False)]
    counted = text.token_count(df, "id", "t", fn=lambda s: s.str.split().str.len())
    assert rows(counted, "id", "tokens", "chars") == [("above", 4, 10), ("at", 3, 6), ("below", 3, 5), ("empty", 0, 0)]
    assert df.where("id = 'above'").select(tokens.count_tokens(F.col("t"))).first()[0] == 5


def test_a_codec_of_ones_own_cuts_texts(spark):
    def words_cut(texts, keep):
        words = texts.str.split()
        return pd.DataFrame({"text": words.str[:keep].str.join(" "), "tokens": words.str.len()})

    df = spark.createDataFrame([(1, "a b  c d"), (2, "a b"), (3, ""), (4, None), (5, "é " * 5000)], "id int, t string")
    cut = text.token_truncate(df, "id", "t", limit=4, fn=words_cut)
    assert rows(cut, "id", "t", "tokens", "chars", "truncated") == [
        (1, "a b c", 3, 5, True), (2, "a b", 2, 3, False), (3, "", 0, 0, False), (4, None, None, None, None), (5, "é é é", 3, 5, True)]
    assert rows(text.token_truncate(df.where("t is null"), "id", "t", limit=4), "*") == [(4, None, None, None, None)]
    assert text.token_truncate(df.where("false"), "id", "t", fn=words_cut).count() == 0
    assert text.token_truncate(df.where("t is null"), "id", "t", fn=words_cut).first().t is None


# Audit --------------------------------------------------------------------------------

def test_every_kind_of_violation(spark):
    made = {
        "sitemaps": spark.createDataFrame([(1, None, "u", True, 9, None, None, None, None), (2, "a", "u", None, 1, None, None, None, None)], SITEMAPS),
        "news_pages": spark.createDataFrame([(1, 1, "p", None, None, None), (1, None, None, None, None, None), (2, 7, None, None, None, None)], NEWS_PAGES),
        "content_embeddings": spark.createDataFrame([(1, 1, [1.0, 2.0]), (2, 5, [1.0]), (3, 1, None)], "id bigint, id_page bigint, embedding array<float>"),
    }
    assert rows(constraint_audit(made, dim=2), "table", "rule", "key") == [
        ("content_embeddings", "dimension 2", "5"), ("content_embeddings", "reference id_page", "5"), ("content_embeddings", "unique id_page", "1"),
        ("news_pages", "reference id_sitemap", "7"), ("news_pages", "required id_sitemap", "1"), ("news_pages", "required page_url", "2"),
        ("news_pages", "unique id_page", "1"), ("sitemaps", "reference parent_id", "9"), ("sitemaps", "required domain", "1"),
        ("sitemaps", "required is_master", "1"), ("sitemaps", "unique sitemap_url", "u")]


def test_an_extractor_is_given_pages_in_pieces(spark):
    page = F.when(F.col("id") % 100 == 7, None).otherwise(F.concat(F.lit("<p>"), F.repeat(F.lit("x"), 5000), F.lit("</p>"), F.col("id").cast("string")))
    pages = spark.range(0, 2000, 1, 1).select("id", page.alias("h"))

    def sized(series):
        return series.map(lambda h: None if h is None else "" if h.endswith("</p>3") else f"{len(series)} {h[5007:]}", na_action=None)

    found = {r.id: r.content for r in html.html_extract(pages, "id", "h", fn=sized).collect()}
    assert len(found) == 2000 and found[7] is None and found[3] is None
    assert all(int(c.split()[0]) < 400 and c.split()[1] == str(i) for i, c in found.items() if c)
