"""Schemas of the crawl tables and of the files exchanged with outside services."""

from __future__ import annotations

SITEMAPS = (
    "id_sitemap bigint, domain string, sitemap_url string, is_master boolean, parent_id bigint, "
    "last_mod timestamp, is_fresh boolean, created_at timestamp, processed_at timestamp"
)
NEWS_PAGES = (
    "id_page bigint, id_sitemap bigint, page_url string, publication_date timestamp, "
    "is_error boolean, created_at timestamp"
)
NEWS_PAGES_CONTENT = (
    "id bigint, id_page bigint, page_url string, publication_date timestamp, "
    "page_raw_content string, content string, content_length int, fetched_at timestamp"
)
CONTENT_EMBEDDINGS = "id bigint, id_page bigint, embedding array<float>"

TABLES = {
    "sitemaps": SITEMAPS,
    "news_pages": NEWS_PAGES,
    "news_pages_content": NEWS_PAGES_CONTENT,
    "content_embeddings": CONTENT_EMBEDDINGS,
}

# Key columns of each table: surrogate key first, then the natural key.
KEYS = {
    "sitemaps": ("id_sitemap", "sitemap_url"),
    "news_pages": ("id_page", "page_url"),
    "news_pages_content": ("id", "id_page"),
    "content_embeddings": ("id", "id_page"),
}

RESULT_LINE = (
    "custom_id string, error string, "
    "response struct<status_code:int,body:struct<data:array<struct<embedding:array<float>>>>>"
)
ERROR_LINE = "custom_id string, error string"

JOB = (
    "batch_id string, input_file_id string, created_at string, status string, "
    "page_ids array<bigint>, domain_tokens map<string,bigint>, "
    "completed_at string, processed_count bigint"
)
_JOB_STRUCT = JOB.replace(" string", ":string").replace(" array<", ":array<").replace(
    " map<", ":map<").replace(" bigint", ":bigint").replace(", ", ",")
REGISTRY_FILE = ", ".join(f"{name} array<struct<{_JOB_STRUCT}>>" for name in ("pending", "completed", "failed"))
REGISTRY = (
    "batch_id string, input_file_id string, created_at timestamp, status string, "
    "page_ids array<bigint>, domain_tokens map<string,bigint>, "
    "completed_at timestamp, processed_count bigint, list_name string"
)
COOKIES = "array<struct<name:string,value:string>>"

# Inputs that something else has fetched.
BODIES = "sitemap_url string, body string"
FETCH_LOG = "url string, status int, location string, body string, ts timestamp"
STATUSES = "batch_id string, status string"
