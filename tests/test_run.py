"""The stages from the command line, one after the other on written tables."""

import json

import pytest
import run
from conftest import rows
from presslake.schemas import CONTENT_EMBEDDINGS, NEWS_PAGES, NEWS_PAGES_CONTENT, SITEMAPS, TABLES
from test_stages import INDEX, OLD, ONE


def link(tables, out, names):
    """The next version of the tables: those under ``out``, the rest as before."""
    for name in TABLES:
        target = out / name
        if name not in names:
            target.symlink_to(tables / name)
    return out


def test_every_stage_in_turn(spark, tmp_path, capsys):
    first = tmp_path / "v0"
    for name, schema in TABLES.items():
        spark.createDataFrame([], schema).write.parquet(str(first / name))
    (tmp_path / "seeds.txt").write_text("https://a.com/index.xml\n")
    bodies = [("https://a.com/index.xml", INDEX), ("https://a.com/one.xml", ONE), ("https://a.com/old.xml", OLD)]
    spark.createDataFrame(bodies, "sitemap_url string, body string").write.parquet(str(tmp_path / "bodies"))
    at = ["--as-of", "2025-06-30T00:00:00"]

    run.main(["discover", "--tables", str(first), "--seeds", str(tmp_path / "seeds.txt"), "--bodies", str(tmp_path / "bodies"), "--out", str(tmp_path / "v1"), *at])
    second = link(first, tmp_path / "v1", ["sitemaps", "news_pages"])
    assert spark.read.schema(NEWS_PAGES).parquet(str(second / "news_pages")).count() == 3
    assert spark.read.schema(SITEMAPS).parquet(str(second / "sitemaps")).count() == 4

    page = "<article><p>" + "word " * 150 + "</p></article>"
    log = [(f"https://a.com/{i}", 200, None, page + str(i), None) for i in (1, 2, 4)]
    (tmp_path / "log.jsonl").write_text("\n".join(json.dumps({"url": u, "status": s, "body": b}) for u, s, _, b, _ in log))
    run.main(["fetch", "--tables", str(second), "--log", str(tmp_path / "log.jsonl"), "--out", str(tmp_path / "v2"), *at])
    third = link(second, tmp_path / "v2", ["news_pages", "news_pages_content"])

    run.main(["extract", "--tables", str(third), "--out", str(tmp_path / "v3")])
    fourth = link(third, tmp_path / "v3", ["news_pages_content"])
    content = spark.read.schema(NEWS_PAGES_CONTENT).parquet(str(fourth / "news_pages_content"))
    # The three pages have one line in common; it stays with one of them.
    assert content.count() == 3 and content.where("content <> ''").count() == 1

    run.main(["batch", "--tables", str(fourth), "--mode", "create", "--out", str(tmp_path / "b1"), *at])
    registry = spark.read.parquet(str(tmp_path / "b1" / "registry"))
    (job,) = registry.collect()
    (request,) = [json.loads(r.value) for r in spark.read.text(str(tmp_path / "b1" / "requests")).collect()]
    assert request["custom_id"] == str(job.page_ids[0]) and request["url"] == "/v1/embeddings"
    (tmp_path / "status.jsonl").write_text(json.dumps({"batch_id": job.batch_id, "status": "completed"}))
    body = {"status_code": 200, "body": {"data": [{"embedding": [0.5] * 4}]}}
    (tmp_path / "results.jsonl").write_text(json.dumps({"custom_id": str(job.page_ids[0]), "error": None, "response": body}))
    run.main(["batch", "--tables", str(fourth), "--mode", "check", "--registry", str(tmp_path / "b1" / "registry"), "--statuses", str(tmp_path / "status.jsonl"),
              "--results", str(tmp_path / "results.jsonl"), "--out", str(tmp_path / "b2"), "--dim", "4", *at])
    (domain,) = spark.read.parquet(str(tmp_path / "b2" / "batch_domains")).collect()
    assert (domain.domain, domain.jobs, domain.successful, domain.failed) == ("a.com", 1, 1, 0) and domain.tokens > 0
    vectors = spark.read.schema(CONTENT_EMBEDDINGS).parquet(str(tmp_path / "b2" / "content_embeddings"))
    assert rows(vectors, "id_page") == [(job.page_ids[0],)]
    run.main(["batch", "--tables", str(fourth), "--mode", "status", "--registry", str(tmp_path / "b2" / "registry"), *at])

    with pytest.raises(SystemExit):
        run.main(["embed", "--tables", str(fourth), "--out", str(tmp_path / "v4")])
    run.main(["embed", "--tables", str(fourth), "--out", str(tmp_path / "v4"), "--stand-in", "--dim", "16"])
    assert spark.read.parquet(str(tmp_path / "v4" / "embed_outcomes")).count() == 1
    last = link(fourth, tmp_path / "v4", ["content_embeddings"])
    capsys.readouterr()
    run.main(["report", "--tables", str(last)])
    printed = capsys.readouterr().out
    assert "a.com" in printed and "pages_with_embeddings" in printed
    run.main(["audit", "--tables", str(last), "--dim", "16"])
    assert capsys.readouterr().out == "Violations\ntable\trule\tcount\n(0 rows)\n"
    run.main(["audit", "--tables", str(last), "--dim", "5", "--out", str(tmp_path / "a")])
    assert "content_embeddings" in capsys.readouterr().out and spark.read.parquet(str(tmp_path / "a" / "violations")).count() == 1


def test_reports_are_printed_whole(spark, capsys):
    run._show("many", spark.range(150))
    printed = capsys.readouterr().out
    assert "149" in printed and "(150 rows)" in printed
