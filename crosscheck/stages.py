"""Whole stages and streams against SQL."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crosscheck.registry import Tables, case
from crosscheck.reports import _EMBED, _EMBED_END, _FLOOR, _PENDING, AS_OF, BATCH, FETCH_DOMAINS, LIMIT, job_registry
from crosscheck.texts import PAGE_TEXT
from crosscheck.upkeep import _BATCHES, _RESULTS, parsed_results, result_lines
from presslake import scratch_path
from presslake.operators import batches
from presslake.plans import discover as discovery
from presslake.plans import embed, extract, fetch
from presslake.schemas import TABLES
from presslake.sources import jobs, tables
from presslake.streaming import incremental

# Discovery: files of at most 25 pages, listed in indexes of at most 50 files. Every
# second file of a domain holds pages two years older than the rest.

_MAPS = """select source || '.example.com' as domain, cast(floor(doc_id / 500) as int) as file_no,
  'https://' || source || '.example.com/index-' || cast(floor(doc_id / 25000) as int) || '.xml' as index_url,
  'https://' || source || '.example.com/sm-' || cast(floor(doc_id / 500) as int) || '.xml' as sitemap_url,
  'https://' || source || '.example.com/' || doc_id as page_url,
  case when doc_id % 7 = 0 then null when floor(doc_id / 500) % 2 = 1 then cast('2021-01-01' as date) + cast((doc_id * 7) % 730 as int)
    else cast('2023-01-01' as date) + cast((doc_id * 7) % 730 as int) end as publication_date
  from documents"""
_KNOWN = "select * from v_sitemaps where id_sitemap % 5 <> 0"
# Files of known domains that an earlier run found stale.
_STALE = f"""select distinct sitemap_url, domain from ({_MAPS}) where file_no % 6 = 3
  and domain in (select domain from ({_KNOWN}))"""
_OLD_PAGES = """select cast(id_page as bigint) as id_page, cast(id_sitemap as bigint) as id_sitemap, page_url, cast(publication_date as timestamp) as publication_date,
  is_error, cast(null as timestamp) as created_at from v_news_pages where publication_date < date '2024-07-01'"""
_SEEN = f"""
select u.*, k.domain is null as is_new from ({_MAPS}) u left join (select distinct domain from ({_KNOWN})) k on k.domain = u.domain
where u.sitemap_url not in (select sitemap_url from ({_STALE}))"""
_FRESH = f"select sitemap_url from ({_SEEN}) group by 1 having bool_or(is_new) or coalesce(bool_or(publication_date >= {_FLOOR}), false)"
_FOUND = f"""
select s.domain, s.page_url, s.publication_date, case when s.publication_date is null then 'no_date'
  when not is_new and s.publication_date < {_FLOOR} then 'too_old'
  when s.page_url in (select page_url from ({_OLD_PAGES})) then 'existing' else 'keep' end as outcome
from ({_SEEN}) s where s.sitemap_url in ({_FRESH})"""


def _discovered(t: Tables) -> discovery.Discovery:
    maps = t.sql(_MAPS)
    entry = F.concat(
        F.lit("<url><loc>"), "page_url", F.lit("</loc>"),
        F.coalesce(F.concat(F.lit("<lastmod>"), F.col("publication_date").cast("string"), F.lit("</lastmod>")), F.lit("")),
        F.lit("</url>"),
    )
    files = maps.groupBy("sitemap_url").agg(
        F.concat(F.lit("<urlset>"), F.array_join(F.collect_list(entry), ""), F.lit("</urlset>")).alias("body")
    )
    child = F.concat(F.lit("<sitemap><loc>"), "sitemap_url", F.lit("</loc></sitemap>"))
    indexes = maps.select("index_url", "sitemap_url").distinct().groupBy(F.col("index_url").alias("sitemap_url")).agg(
        F.concat(F.lit("<sitemapindex>"), F.array_join(F.collect_list(child), ""),
                 F.lit("<sitemap><loc>https://x.example.com/author/a.xml</loc></sitemap></sitemapindex>")).alias("body")
    )
    known = t.sql(f"""select cast(id_sitemap as bigint) as id_sitemap, domain, sitemap_url, is_master, cast(null as bigint) as parent_id,
      cast(null as timestamp) as last_mod, is_fresh, cast(null as timestamp) as created_at, cast(null as timestamp) as processed_at from ({_KNOWN})
      union all select xxhash64(sitemap_url), domain, sitemap_url, false, null, null, false, null, null from ({_STALE})""")
    seeds = indexes.select(F.col("sitemap_url").alias("url"))
    return discovery.discover(seeds, files.unionByName(indexes), known, t.sql(_OLD_PAGES), AS_OF)


@case("discover", f"select domain, outcome, count(*) as pages, min(publication_date) as first_date from ({_FOUND}) group by 1, 2")
def discover(t: Tables) -> DataFrame:
    return _discovered(t).outcomes.groupBy("domain", "outcome").agg(
        F.count("*").alias("pages"), F.min("publication_date").cast("date").alias("first_date")
    )


@case("discover_pages", f"""
select page_url, publication_date, true as is_new from ({_FOUND}) where outcome = 'keep'
union all select page_url, cast(publication_date as date), false from ({_OLD_PAGES})""")
def discover_pages(t: Tables) -> DataFrame:
    pages = _discovered(t).pages
    return pages.select(
        "page_url", F.col("publication_date").cast("date").alias("publication_date"), F.col("created_at").isNotNull().alias("is_new")
    )


# Fetching: the log answers every page of the frontier by number, some after redirects.

_RESPONSES = """select 'https://' || source || '.example.com/' || doc_id as url,
  case doc_id % 8 when 0 then 301 when 1 then 404 when 2 then 302 else 200 end as status,
  case doc_id % 8 when 0 then '/moved/' || doc_id when 2 then 'https://elsewhere.example.org/' || doc_id end as location,
  case when doc_id % 8 > 2 then text end as body, cast('2025-06-29' as timestamp) as ts from documents where doc_id % 9 <> 5
  union all select 'https://' || source || '.example.com/moved/' || doc_id, 200, null, 'moved ' || text, cast('2025-06-29' as timestamp) from documents where doc_id % 3 > 0"""
_FRONTIER = """select p.id_page, p.page_url, domain, p.publication_date from v_news_pages p join v_sitemaps using (id_sitemap)
  where not p.is_error and p.id_page not in (select id_page from v_news_pages_content where page_raw_content is not null)
  qualify row_number() over (partition by domain order by p.publication_date desc nulls first, p.id_page) <= 40"""
_TRIED = f"""
select f.id_page, f.domain, case when r.status = 404 then 'http_error' when r.status = 302 then 'cross_domain'
  when r.status = 301 and m.url is null then 'missing' else 'ok' end as outcome,
  case when r.status = 301 then m.body else r.body end as body
from ({_FRONTIER}) f join ({_RESPONSES}) r on r.url = f.page_url
left join ({_RESPONSES}) m on m.url = regexp_extract(f.page_url, '^https://[^/]+') || r.location"""


# Every fifth URL was tried the day before, in vain; every tenth answer is in the log twice.
_LOG = f"""{_RESPONSES}
  union all select 'https://' || source || '.example.com/' || doc_id, 503, null, 'busy', cast('2025-06-28' as timestamp) from documents where doc_id % 5 = 0 and doc_id % 9 <> 5
  union all select 'https://' || source || '.example.com/' || doc_id, 200, null, text, cast('2025-06-29' as timestamp) from documents where doc_id % 10 = 3 and doc_id % 8 > 2 and doc_id % 9 <> 5"""


def _fetched(t: Tables) -> fetch.Fetched:
    sitemaps, pages, content, _ = t.crawl()
    stored = content.select("*", F.col("id_page").alias("id"), F.lit(None).cast("timestamp").alias("fetched_at"))
    return fetch.fetch_apply(sitemaps, pages, stored, t.sql(_LOG), AS_OF, cap=40)


@case("fetch_apply", f"""
select id_page, domain, outcome, outcome = 'ok' and coalesce(body, '') <> '' as ok,
  case when outcome = 'ok' then length(coalesce(body, '')) else 0 end::bigint as content_size from ({_TRIED})""")
def fetch_apply(t: Tables) -> DataFrame:
    return _fetched(t).outcomes.select("id_page", "domain", "outcome", "ok", "content_size")


@case("fetch_apply_content", f"""
select id_page, case when outcome = 'ok' then body end as page_raw_content, true as fetched from ({_TRIED})
union all select id_page, page_raw_content, false from v_news_pages_content where id_page not in (select id_page from ({_TRIED}))""")
def fetch_apply_content(t: Tables) -> DataFrame:
    return _fetched(t).content.select("id_page", "page_raw_content", F.col("fetched_at").isNotNull().alias("fetched"))


@case("fetch_apply_pages", f"""
select id_page, is_error or id_page in (select id_page from ({_TRIED}) where outcome <> 'ok') as is_error from v_news_pages""")
def fetch_apply_pages(t: Tables) -> DataFrame:
    return _fetched(t).pages.select("id_page", "is_error")


# Every page has stored HTML here and no text yet.
_WAITING = """select page_id as id, page_id as id_page, url as page_url, cast(null as timestamp) as publication_date, html as page_raw_content,
  cast(null as string) as content, cast(null as int) as content_length from pages"""
_HTML_LINES = f"""select page_id, trim(line, E' \\t\\r') as line, place from (
  select page_id, unnest(string_split(content, E'\\n')) as line, generate_subscripts(string_split(content, E'\\n'), 1) as place
  from (select page_id, {PAGE_TEXT} as content from pages))"""


@case("extract", f"""
select p.page_id as id_page, coalesce(k.text, case when h.content is not null then '' end) as content,
  length(coalesce(k.text, case when h.content is not null then '' end))::int as content_length from pages p
join (select page_id, {PAGE_TEXT} as content from pages) h using (page_id) left join (select page_id, string_agg(line, E'\\n' order by place) as text from (
  select *, row_number() over (partition by line order by page_id, place) as rn from ({_HTML_LINES}) where line <> '') where rn = 1 group by 1) k using (page_id)
""")
def extract_(t: Tables) -> DataFrame:
    pages = t.sql("select page_id as id_page, 1 + page_id % 9 as id_sitemap, url as page_url, cast(null as timestamp) as publication_date, false as is_error from pages")
    sitemaps = t("v_sitemaps")
    return extract.extract(sitemaps, pages, t.sql(_WAITING), dedup=True).content.select("id_page", "content", "content_length")


@case("embed_sync", f"""
select domain, count(*) as texts, sum(length(content))::bigint as chars, 1536 as dim from ({_EMBED} {_EMBED_END}) group by domain""")
def embed_sync(t: Tables) -> DataFrame:
    sitemaps, pages, content, embeddings = t.crawl()
    stored = embeddings.select(F.col("id_page").alias("id"), "id_page", "embedding")
    made = embed.embed_sync(sitemaps, pages, content, stored, limit=LIMIT)
    new = made.outcomes.join(made.embeddings.select("id_page", F.size("embedding").alias("dim")), "id_page")
    return new.groupBy("domain").agg(F.count("*").alias("texts"), F.sum("chars").alias("chars"), F.max("dim").alias("dim"))


@case("embed_batch_create", f"""
select 'run-' || batch_no as batch_id, string_agg(id_page, ',' order by id_page) as page_ids, count(*) as requests from (
  select id_page, cast(floor((row_number() over (order by publication_date desc nulls first, id_page) - 1) / {BATCH}) as bigint) as batch_no
  from ({_EMBED} and npc.id_page not in ({_PENDING}) {_EMBED_END})) group by batch_no""")
def embed_batch_create(t: Tables) -> DataFrame:
    made = embed.embed_batch_create(*t.crawl(), job_registry(t), AS_OF, "run", limit=LIMIT, size=BATCH)
    sent = made.requests.groupBy("batch_no").agg(F.count("*").alias("requests"))
    sent = sent.select(F.concat(F.lit("run-"), "batch_no").alias("batch_id"), "requests")
    return made.registry.join(sent, "batch_id").select("batch_id", F.array_join("page_ids", ",").alias("page_ids"), "requests")


def _vector_jobs(t: Tables) -> DataFrame:
    """Jobs over the vectors' pages, all pending."""
    return t.sql(_BATCHES).groupBy("batch_no").agg(F.sort_array(F.collect_list("id_page")).alias("page_ids")).select(
        F.concat(F.lit("job-"), "batch_no").alias("batch_id"), F.lit("f").alias("input_file_id"),
        F.lit(AS_OF).cast("timestamp").alias("created_at"), F.lit("pending").alias("status"), "page_ids",
        F.lit(None).cast("map<string,bigint>").alias("domain_tokens"), F.lit(None).cast("timestamp").alias("completed_at"),
        F.lit(None).cast("bigint").alias("processed_count"), F.lit("pending").alias("list_name"),
    )


_REPORTED = "case batch_no % 4 when 0 then 'completed' when 1 then 'failed' when 2 then 'in_progress' else 'completed' end"


# A result file that lacks the lines of some pages, and an error file that names every page of label 4.
_LINES = "select * from embeddings where vec_id % 11 <> 0"
_ERRORS = "select vec_id as id_page, 'from file ' || vec_id as message from embeddings where label = 4"
_FINAL = f"""select b.batch_no, b.id_page, r.error is null and r.status_code = 200 as ok, r.status_code, r.embedding,
  coalesce(case when label = 4 then 'from file ' || b.id_page end, r.error) as message
from ({_BATCHES}) b join ({_RESULTS}) r using (id_page) where r.id_page % 11 <> 0 and {_REPORTED} = 'completed'
union all select batch_no, id_page, false, null, null, 'from file ' || id_page from ({_BATCHES}) join embeddings on id_page = vec_id
where label = 4 and id_page % 11 = 0 and {_REPORTED} = 'completed'"""


def _checked(t: Tables) -> embed.Checked:
    registry = _vector_jobs(t)
    batch_no = F.regexp_extract("batch_id", r"(\d+)$", 1).cast("int").alias("batch_no")
    statuses = registry.select("batch_id", batch_no).select("batch_id", F.expr(_REPORTED).alias("status"))
    # Stored vectors are turned round, so that a replaced one shows.
    stored = t("v_content_embeddings").select(F.col("id_page").alias("id"), "id_page", F.reverse("embedding").alias("embedding"))
    return embed.embed_batch_check(registry, statuses, parsed_results(t, _LINES), t.sql(_ERRORS), stored, AS_OF, dim=_width(t))


def _width(t: Tables) -> int:
    return t("embeddings").agg(F.max(F.size("embedding"))).first()[0]


@case("embed_batch_check", f"""
select 'job-' || batch_no as batch_id, s as status, case when s = 'completed' then 'completed' when s = 'failed' then 'failed' else 'pending' end as list_name,
  case when s = 'completed' then coalesce(n, 0) end as processed_count from (
  select distinct batch_no, case when {_REPORTED} = 'in_progress' then 'pending' else {_REPORTED} end as s from ({_BATCHES}))
left join (select batch_no, count(*) filter (where ok) as n from ({_FINAL}) group by 1) using (batch_no)""")
def embed_batch_check(t: Tables) -> DataFrame:
    return _checked(t).registry.select("batch_id", "status", "list_name", "processed_count")


@case("embed_batch_failures", f"select id_page, status_code, message from ({_FINAL}) where not ok")
def embed_batch_failures(t: Tables) -> DataFrame:
    return _checked(t).failures.select("id_page", "status_code", "message")


@case("embed_batch_embeddings", f"""
select coalesce(n.id_page, s.id_page) as id_page, round(list_sum(coalesce(n.embedding, s.embedding)::double[]), 4) as total,
  round(coalesce(n.embedding, s.embedding)[1]::double, 5) as first
from (select id_page, embedding from ({_FINAL}) where ok) n
full join (select id_page, list_reverse(embedding) as embedding from v_content_embeddings) s on s.id_page = n.id_page""")
def embed_batch_embeddings(t: Tables) -> DataFrame:
    total = F.aggregate("embedding", F.lit(0.0), lambda a, v: a + v.cast("double"))
    first = F.get("embedding", F.lit(0)).cast("double")
    return _checked(t).embeddings.select("id_page", F.round(total, 4).alias("total"), F.round(first, 5).alias("first"))


@case("embed_batch_counts", f"select 'job-' || batch_no as batch_id, count(*) filter (where ok) as ok, count(*) filter (where not ok) as failed from ({_FINAL}) group by 1")
def embed_batch_counts(t: Tables) -> DataFrame:
    return _checked(t).counts


@case("embed_batch_domains", f"""
with done as (select batch_no, count(*) filter (where ok)::double as ok, count(*) filter (where not ok)::double as failed from ({_FINAL}) group by 1),
  shares as (select batch_no, domain, sum(id_page % 90 + 10)::bigint as tokens from ({_BATCHES}) group by 1, 2),
  parts as (select *, tokens::double / sum(tokens) over (partition by batch_no) as share from shares)
select domain, count(*) as jobs, sum(round_even(ok * share, 0))::bigint as successful, sum(round_even(failed * share, 0))::bigint as failed,
  sum(tokens)::bigint as tokens, round(sum(tokens) * 0.02 / 1000000 * 0.5, 6) as cost from parts join done using (batch_no) group by domain""")
def embed_batch_domains(t: Tables) -> DataFrame:
    """Results of finished jobs by domain."""
    pages = t.sql(f"select batch_no, domain, id_page % 90 + 10 as tokens from ({_BATCHES})")
    shares = batches.job_domain_tokens(pages).groupBy("batch_no").agg(F.map_from_entries(F.collect_list(F.struct("domain", "tokens"))).alias("domain_tokens"))
    registry = shares.select(F.concat(F.lit("job-"), "batch_no").alias("batch_id"), "domain_tokens")
    return embed.embed_batch_domains(registry, _checked(t).counts)


@case("embed_batch_full", f"""
select 'run-' || batch_no as batch_id, 'pending' as list_name, count(*) as pages, cast(null as bigint) as processed_count from (
  select cast(floor((row_number() over (order by publication_date desc nulls first, id_page) - 1) / {BATCH}) as bigint) as batch_no
  from ({_EMBED} and npc.id_page not in (select vec_id from embeddings) {_EMBED_END})) group by batch_no
union all select 'job-' || batch_no, case when s = 'completed' then 'completed' when s = 'failed' then 'failed' else 'pending' end, n,
  case when s = 'completed' then ok end from (select batch_no, {_REPORTED} as s, count(*) as n, count(*) filter (where error is null and status_code = 200) as ok
  from ({_BATCHES}) join ({_RESULTS}) using (id_page) group by 1)""")
def embed_batch_full(t: Tables) -> DataFrame:
    """New jobs for pages in no pending job, then the finished ones taken in."""
    sitemaps, pages, content, embeddings = t.crawl()
    registry = _vector_jobs(t)
    batch_no = F.regexp_extract("batch_id", r"(\d+)$", 1).cast("int").alias("batch_no")
    statuses = registry.select("batch_id", batch_no).select("batch_id", F.expr(_REPORTED).alias("status"))
    stored = embeddings.select(F.col("id_page").alias("id"), "id_page", "embedding")
    _, checked = embed.embed_batch_full(
        sitemaps, pages, content, stored, registry, statuses, parsed_results(t), None, AS_OF, "run", dim=_width(t), limit=LIMIT, size=BATCH
    )
    return checked.registry.select("batch_id", "list_name", F.size("page_ids").cast("bigint").alias("pages"), "processed_count")


@case("embed_batch_status", """
select 'counts' as part, list_name as name, count(*) as n from (
  select distinct floor(doc_id / 75)::int as job_no, case when floor(doc_id / 75)::int % 3 <> 0 then 'pending'
    when floor(doc_id / 75)::int % 2 = 0 then 'completed' else 'failed' end as list_name from documents) group by 2
union all select 'pending', 'job-' || floor(doc_id / 75)::int, count(*) from documents where floor(doc_id / 75)::int % 3 <> 0 group by 2""")
def embed_batch_status(t: Tables) -> DataFrame:
    made = embed.embed_batch_status(job_registry(t), AS_OF)
    counts = made["counts"].where("jobs > 0").select(F.lit("counts").alias("part"), F.col("list_name").alias("name"), F.col("jobs").alias("n"))
    return counts.unionByName(made["pending"].select(F.lit("pending").alias("part"), F.col("batch_id").alias("name"), F.col("pages").alias("n")))


# Files and streams ---------------------------------------------------------------

def _results_dir(t: Tables) -> str:
    path = scratch_path(t.spark, "results")
    result_lines(t).repartition(4).write.text(path)
    return path


@case("batch_result_files", f"select id_page, error is null and status_code = 200 as ok from ({_RESULTS})")
def batch_result_files(t: Tables) -> DataFrame:
    """Result lines written as files and read back."""
    rows = jobs.batch_result_scan(t.spark, _results_dir(t))
    return rows.select("id_page", (F.col("error").isNull() & (F.col("status_code") == 200)).alias("ok"))


@case("batch_error_scan", "select vec_id as id_page, 'rate limit' as message from embeddings")
def batch_error_scan(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "errors")
    t.sql("select cast(vec_id as string) as custom_id, 'rate limit' as error from embeddings").write.json(path)
    return jobs.batch_error_scan(t.spark, path)


@case("job_registry_scan", f"""
select 'job-' || floor(doc_id / 75)::int as batch_id, count(*) as pages from documents group by 1""")
def job_registry_scan(t: Tables) -> DataFrame:
    """The registry written as one line per job list and read back."""
    path = scratch_path(t.spark, "registry")
    job = F.struct("batch_id", "input_file_id", F.col("created_at").cast("string").alias("created_at"), "status", "page_ids")
    lists = [F.when(F.col("list_name") == name, F.array(job)).alias(name) for name in ("pending", "completed", "failed")]
    job_registry(t).select(*lists).write.json(path)
    return jobs.job_registry_scan(t.spark, path, multi_line=False).select("batch_id", F.size("page_ids").cast("bigint").alias("pages"))


@case("crawl_tables_scan", "select 'news_pages' as name, count(*) as n from v_news_pages union all select 'sitemaps', count(*) from v_sitemaps union all select 'news_pages_content', count(*) from v_news_pages_content union all select 'content_embeddings', count(*) from v_content_embeddings")
def crawl_tables_scan(t: Tables) -> DataFrame:
    """The four tables written with their declared schemas and read back."""
    root = scratch_path(t.spark, "tables")
    for name, schema in TABLES.items():
        given = t(f"v_{name}")
        full = t.spark.createDataFrame([], schema).schema
        tables.write_snapshot(given.select(*[
            (F.col(f.name) if f.name in given.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in full
        ]), f"{root}/{name}")
    counts = [df.agg(F.count("*").alias("n")).select(F.lit(name).alias("name"), "n") for name, df in tables.crawl_tables_scan(t.spark, root).items()]
    return reduce(DataFrame.unionByName, counts)


def _stream(t: Tables, name: str) -> DataFrame:
    """A given table, a file or a folder of files, as a stream; the pattern serves both."""
    schema = t(name).schema
    return t.spark.readStream.schema(schema).parquet(f"{t.sf_dir}/{name}.parquet*")


@case("stream_page_discovery", """
select page_url, coalesce(publication_date < date '2024-07-01', false) as is_old from v_news_pages""")
def stream_page_discovery(t: Tables) -> DataFrame:
    root, state = scratch_path(t.spark, "pages"), scratch_path(t.spark, "state")
    incremental.write_base(t.sql(_OLD_PAGES), root)
    found = _stream(t, "documents").select(
        F.format_string("https://%s.example.com/%d", "source", "doc_id").alias("page_url"), F.lit(1).cast("bigint").alias("id_sitemap"),
        F.lit(None).cast("timestamp").alias("publication_date"),
    )
    incremental.stream_page_discovery(found, root, state, AS_OF).awaitTermination()
    return incremental.current_pages(t.spark, root).select("page_url", F.col("created_at").isNull().alias("is_old"))


@case("stream_batch_results", f"select id_page, len(embedding)::int as dim from ({_RESULTS}) where error is null and status_code = 200")
def stream_batch_results(t: Tables) -> DataFrame:
    root = scratch_path(t.spark, "vectors")
    incremental.stream_batch_results(t.spark, _results_dir(t), root, scratch_path(t.spark, "state")).awaitTermination()
    return incremental.current_embeddings(t.spark, root).select("id_page", F.size("embedding").alias("dim"))


@case("stream_fetch_stats", FETCH_DOMAINS)
def stream_fetch_stats(t: Tables) -> DataFrame:
    root = scratch_path(t.spark, "fetches")
    log = _stream(t, "events").select(
        F.format_string("src%d.example.com", F.col("user_id") % 20).alias("domain"), (F.col("event_type") != "error").alias("ok"),
        F.floor(F.col("value") * 1000).cast("bigint").alias("content_size"),
    )
    incremental.stream_fetch_stats(log, root, scratch_path(t.spark, "state")).awaitTermination()
    return incremental.current_fetch_stats(t.spark, root)


@case("stream_generations", f"select id_page, round(list_sum(embedding::double[]), 4) as total from ({_RESULTS}) where error is null and status_code = 200")
def stream_generations(t: Tables) -> DataFrame:
    """Result files taken in by several micro-batches whose folders are folded as they come."""
    lines, root = scratch_path(t.spark, "results"), scratch_path(t.spark, "vectors")
    result_lines(t).repartition(8).write.text(lines)
    incremental.stream_batch_results(t.spark, lines, root, scratch_path(t.spark, "state"), files=2, fold_every=1).awaitTermination()
    total = F.aggregate("embedding", F.lit(0.0), lambda a, v: a + v.cast("double"))
    return incremental.current_embeddings(t.spark, root).select("id_page", F.round(total, 4).alias("total"))
