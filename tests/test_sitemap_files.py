"""Sitemap files read in pieces."""

import gzip
import tracemalloc

from conftest import rows

from presslake.sources.sitemap_files import entries_of, read_sitemap_files

PAGE = b"<url><loc>https://a/%d</loc><lastmod>2024-01-01</lastmod></url>"


def entries(text, size=7):
    raw = text.encode()
    return [(e[1], e[2], e[3]) for e in entries_of(iter([raw[i : i + size] for i in range(0, len(raw), size)]))]


def test_pieces_of_any_size():
    text = (
        '<?xml version="1.0"?><s:urlset xmlns:s="x"><s:url><s:loc> https://a/1 </s:loc><s:lastmod>d1</s:lastmod></s:url>'
        '<url xml:lang="en"><loc>https://a/2?a=1&amp;b=2</loc><news:news><news:publication_date>d2</news:publication_date></news:news></url>'
        "<url><lastmod>no address</lastmod></url><url><loc><![CDATA[https://a/<3>]]></loc><pubDate>d3</pubDate></url></s:urlset>"
    )
    wanted = [("https://a/1", "d1", ["d1"]), ("https://a/2?a=1&b=2", None, ["d2"]), ("https://a/<3>", None, ["d3"])]
    for size in (1, 2, 7, 64, 10_000):
        assert entries(text, size) == wanted


def test_what_is_broken_costs_its_own_entry():
    text = (
        "junk < & <urlset><url><loc>https://a/1</loc></url><url><loc>https://a/&nbsp;</loc></url><url><loc>https://a/2<url><loc>https://a/3</loc></url>"
        "<url><loc>https://a/4</lok></url><url><loc>https://a/5</loc></url><url><loc>https://a/6</lo"
    )
    for size in (1, 5, 1000):
        assert [e[0] for e in entries(text, size)] == ["https://a/1", "https://a/3", "https://a/5"]
    assert entries("") == entries("no tags at all") == entries("<" * 5000) == []


def test_a_long_file_takes_little_memory():
    def pieces():
        yield b"<urlset><url><loc>" + b"x" * 3_000_000  # an entry without an end
        for i in range(100):
            yield b"".join(PAGE % (1000 * i + j) for j in range(1000))

    tracemalloc.start()
    n = sum(1 for _ in entries_of(pieces()))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert n == 100_000 and peak < 20 << 20


def test_files_of_a_folder(spark, tmp_path):
    (tmp_path / "in/deep").mkdir(parents=True)
    (tmp_path / "in/a.xml").write_bytes(b"<urlset>" + PAGE % 1 + PAGE % 2)
    whole = gzip.compress(b"<sitemapindex>" + b"<sitemap><loc>https://m/1.xml</loc></sitemap>" * 3 + b"</sitemapindex>")
    (tmp_path / "in/deep/b.xml.gz").write_bytes(whole)
    (tmp_path / "in/c.xml").write_bytes(b"")
    (tmp_path / "in/_done").write_bytes(b"<url><loc>no</loc></url>")
    found = read_sitemap_files(spark, str(tmp_path / "in"))
    assert [r[1:] for r in rows(found, "file", "kind", "loc", "lastmod_text")] == [
        ("page", "https://a/1", "2024-01-01"), ("page", "https://a/2", "2024-01-01"), *[("sitemap", "https://m/1.xml", None)] * 3]
    (tmp_path / "none").mkdir()
    assert read_sitemap_files(spark, str(tmp_path / "none")).count() == 0
    assert read_sitemap_files(spark, f"file://{tmp_path}/in/a.xml").count() == 2


def test_small_files_share_tasks(spark, tmp_path):
    (tmp_path / "in").mkdir()
    for i in range(300):
        (tmp_path / f"in/{i} %41.xml").write_bytes(b"<urlset>" + PAGE % i + b"</urlset>")
    (tmp_path / "in/long.xml").write_bytes(b"<urlset>" + b"".join(PAGE % i for i in range(1000, 100_000)) + b"</urlset>")
    found = read_sitemap_files(spark, str(tmp_path / "in"))
    assert found.rdd.getNumPartitions() <= 6 * spark.sparkContext.defaultParallelism
    assert {r.loc for r in found.collect()} == {f"https://a/{i}" for i in [*range(300), *range(1000, 100_000)]}
    assert found.where("loc = 'https://a/7'").first().file == f"file://{tmp_path}/in/7 %41.xml"
