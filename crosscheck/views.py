"""Crawl tables derived from the given tables, in SQL that Spark and DuckDB both read.

Missing dates, missing texts and errors are set by moduli that are coprime with
each other and with the number of sources, so no case is tied to one source.
"""

from __future__ import annotations

import zlib

from pyspark.sql import DataFrame, SparkSession

SITEMAPS = """
select distinct cast(substr(source, 4) as int) as id_sitemap, source || '.example.com' as domain,
  'https://' || source || '.example.com/sitemap.xml' as sitemap_url, true as is_master, true as is_fresh
from documents"""

NEWS_PAGES = """
select doc_id as id_page, cast(substr(source, 4) as int) as id_sitemap,
  'https://' || source || '.example.com/' || cast(doc_id as varchar(20)) as page_url,
  case when doc_id % 97 = 0 then null else cast('2024-01-01' as date) + cast(doc_id % 365 as int) end as publication_date,
  doc_id % 31 = 0 as is_error
from documents"""

NEWS_PAGES_CONTENT = """
select doc_id as id_page, 'https://' || source || '.example.com/' || cast(doc_id as varchar(20)) as page_url,
  case when doc_id % 97 = 0 then null else cast('2024-01-01' as date) + cast(doc_id % 365 as int) end as publication_date,
  case when doc_id % 13 = 0 then null else html end as page_raw_content,
  case when doc_id % 11 = 0 then null else text end as content,
  cast(n_chars as int) as content_length
from documents left join pages on doc_id = page_id
where doc_id % 7 <> 0"""

CONTENT_EMBEDDINGS = """
select vec_id as id_page, embedding from embeddings where vec_id % 3 <> 0"""

URLSET = """
select 'https://' || source || '.example.com/sm-' || cast(doc_id % 50 as varchar(20)) || '.xml' as sitemap_url,
  source || '.example.com' as domain,
  'https://' || source || '.example.com/' || cast(doc_id as varchar(20)) as page_url,
  case when doc_id % 7 = 0 then null else cast('2023-01-01' as date) + cast((doc_id * 7) % 730 as int) end as publication_date
from documents"""

FETCH_LOG = """
select event_id as id_page, 'src' || cast(user_id % 20 as varchar(20)) || '.example.com' as domain,
  event_type <> 'error' as ok, cast(floor(value * 1000) as bigint) as content_size, ts
from events"""

CRAWL_LOG = """
select page_id, 'https://d' || cast(page_id % 10 as varchar(20)) || '.example.com/p' || cast(page_id as varchar(20)) as url,
  case when page_id % 40 < 30 and page_id % 7 <> 0 then 301 else 200 end as status,
  case when page_id % 40 >= 30 or page_id % 7 = 0 then null
       when page_id % 17 = 0 then 'https://other.example.org/x'
       when page_id % 3 = 0 then '/p' || cast(page_id + 10 as varchar(20))
       else 'https://d' || cast(page_id % 10 as varchar(20)) || '.example.com/p' || cast(page_id + 10 as varchar(20)) end as location
from pages"""

EMBED_OUTCOMES = """
select doc_id as id_page, source || '.example.com' as domain, cast(floor(doc_id / 100) as bigint) as batch_no,
  case when doc_id % 53 = 0 then 'failed' when n_chars < 100 then 'skipped' else 'ok' end as outcome,
  cast(floor(n_chars / 4) as bigint) as tokens, n_chars as chars
from documents"""

VIEWS = {
    "v_sitemaps": SITEMAPS,
    "v_news_pages": NEWS_PAGES,
    "v_news_pages_content": NEWS_PAGES_CONTENT,
    "v_content_embeddings": CONTENT_EMBEDDINGS,
    "v_urlset": URLSET,
    "v_fetch_log": FETCH_LOG,
    "v_crawl_log": CRAWL_LOG,
    "v_embed_outcomes": EMBED_OUTCOMES,
}

_BASE = ["documents", "pages", "embeddings", "events", "conversations", "labels", "benchmark"]


def _given(spark: SparkSession, sf_dir: str, name: str) -> str:
    """A session's name for a given table; registering it once saves reading its footer in every query."""
    view = f"given_{zlib.crc32(sf_dir.encode()):x}_{name}"
    if not spark.catalog.tableExists(view):
        spark.read.parquet(f"{sf_dir}/{name}.parquet").createOrReplaceTempView(view)
    return view


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table, or one of ``VIEWS`` over them."""
    if name not in VIEWS:
        return spark.table(_given(spark, sf_dir, name))
    return sql(spark, sf_dir, VIEWS[name])


def sql(spark: SparkSession, sf_dir: str, text: str) -> DataFrame:
    """A Spark query that names given tables and views."""
    views = [name for name in VIEWS if name in text]
    named = " ".join([text, *[VIEWS[view] for view in views]])
    heads = [f"{name} as (select * from {_given(spark, sf_dir, name)})" for name in _BASE if name in named]
    heads += [f"{view} as ({VIEWS[view]})" for view in views]
    return spark.sql(f"with {', '.join(heads)} {text}")


def oracle(text: str) -> str:
    """The same with clauses for DuckDB, where the given tables exist already.

    A query that starts with its own ``with`` is joined on.
    """
    heads = [f"{view} as ({VIEWS[view]})" for view in VIEWS if view in text]
    body = text.strip()
    if not heads:
        return body
    if body.lower().startswith("with recursive "):
        return f"with recursive {', '.join(heads)}, {body[len('with recursive '):]}"
    if body.lower().startswith("with "):
        return f"with {', '.join(heads)}, {body[len('with '):]}"
    return f"with {', '.join(heads)} {body}"
