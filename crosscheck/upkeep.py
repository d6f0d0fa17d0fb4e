"""Table maintenance, audits and batch jobs against SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crosscheck.registry import Tables, case
from crosscheck.reports import AS_OF, job_registry
from presslake import materialize, scratch_path
from presslake.operators import batches, merge
from presslake.operators.audit import constraint_audit, vector_dim_check
from presslake.operators.key_filters import existing_key_lookup_filtered
from presslake.operators.numbering import surrogate_keys
from presslake.schemas import RESULT_LINE
from presslake.sources import jobs

_STORED_SITEMAPS = """select id_sitemap, domain, sitemap_url, is_master, cast(null as bigint) as parent_id, cast(null as timestamp) as last_mod,
  case when id_sitemap % 2 = 0 then false else is_fresh end as is_fresh, cast(null as timestamp) as created_at, cast(null as timestamp) as processed_at
  from v_sitemaps where id_sitemap % 3 <> 0"""
# Every sitemap of the page list, some seen several times, and all masters again.
_SEEN_SITEMAPS = """select sitemap_url, false as is_master, cast(null as bigint) as parent_id, cast(publication_date as timestamp) as last_mod, false as is_fresh from v_urlset
  union all select sitemap_url, is_master, null, null, is_fresh from v_sitemaps where id_sitemap % 4 <> 2"""


@case("sitemap_insert_new", f"""
with seen as (select sitemap_url, bool_or(is_master) as is_master from ({_SEEN_SITEMAPS}) group by 1), old as ({_STORED_SITEMAPS})
select coalesce(o.sitemap_url, s.sitemap_url) as sitemap_url,
  coalesce(o.domain, regexp_extract(s.sitemap_url, '^https?://([^/]+)', 1)) as domain, coalesce(o.is_master, s.is_master) as is_master,
  case when s.is_master then true else coalesce(o.is_fresh, false) end as is_fresh, o.sitemap_url is null as is_new
from old o full join seen s on o.sitemap_url = s.sitemap_url""")
def sitemap_insert_new(t: Tables) -> DataFrame:
    merged = merge.sitemap_insert_new(t.sql(_STORED_SITEMAPS), t.sql(_SEEN_SITEMAPS), AS_OF)
    return merged.select("sitemap_url", "domain", "is_master", "is_fresh", F.col("created_at").isNotNull().alias("is_new"))


_ALL_PAGES = """select cast(id_page as bigint) as id_page, cast(id_sitemap as bigint) as id_sitemap, page_url,
  cast(publication_date as timestamp) as publication_date, is_error, cast(null as timestamp) as created_at from v_news_pages"""
_STORED_PAGES = f"{_ALL_PAGES} where publication_date < date '2024-07-01'"
_FOUND_PAGES = """select page_url, 1 as id_sitemap, cast(publication_date as timestamp) as publication_date from v_urlset
  union all select page_url, 2, cast(publication_date as timestamp) from v_news_pages"""


@case("page_insert_new", f"""
with seen as (select page_url, min(publication_date) as publication_date from ({_FOUND_PAGES}) group by 1), old as ({_STORED_PAGES})
select coalesce(o.page_url, s.page_url) as page_url, cast(case when o.page_url is null then s.publication_date else o.publication_date end as date) as publication_date,
  o.page_url is null as is_new, coalesce(o.is_error, false) as is_error
from old o full join seen s on o.page_url = s.page_url""")
def page_insert_new(t: Tables) -> DataFrame:
    merged = merge.page_insert_new(t.sql(_STORED_PAGES), t.sql(_FOUND_PAGES), AS_OF)
    return merged.select(
        "page_url", F.col("publication_date").cast("date").alias("publication_date"),
        F.col("created_at").isNotNull().alias("is_new"), "is_error",
    )


@case("page_insert_filtered", f"""
with seen as (select page_url, min(publication_date) as publication_date from ({_FOUND_PAGES}) group by 1), old as ({_STORED_PAGES})
select s.page_url, cast(s.publication_date as date) as publication_date, (select max(id_page) from old)::bigint as above,
  (select count(*) from seen where page_url not in (select page_url from old)) as n_new
from seen s where s.page_url not in (select page_url from old)""")
def page_insert_filtered(t: Tables) -> DataFrame:
    """The new pages by stored key filters, in two versions of the stored table."""
    stored = merge.FilteredTable(t.spark, scratch_path(t.spark, "pages-by-key"), "page_url", "id_page", 64, 4096)
    stored.append(t.sql(f"{_STORED_PAGES} and id_page % 2 = 0"))
    stored.append(t.sql(f"{_STORED_PAGES} and id_page % 2 = 1"))
    top = t.sql(_STORED_PAGES).agg(F.max("id_page")).scalar()
    new = materialize(merge.new_pages_filtered(stored, t.sql(_FOUND_PAGES), AS_OF))
    ids = new.agg(F.struct(F.min("id_page").alias("low"), F.max("id_page").alias("high"))).scalar()
    found = new.withColumn("ids", ids)
    return found.select(
        "page_url", F.col("publication_date").cast("date").alias("publication_date"), (F.col("ids.low") - 1).alias("above"),
        (F.col("ids.high") - F.lit(top)).alias("n_new"),
    )


@case("existing_key_filtered", f"""
with old as ({_STORED_PAGES})
select u.page_url, o.id_page from (select distinct page_url from v_urlset) u left join old o on o.page_url = u.page_url""")
def existing_key_filtered(t: Tables) -> DataFrame:
    stored = merge.FilteredTable(t.spark, scratch_path(t.spark, "pages-by-key"), "page_url", "id_page", 64, 4096)
    stored.append(t.sql(_STORED_PAGES))
    return existing_key_lookup_filtered(t("v_urlset").select("page_url").distinct(), stored).select("page_url", "id_page")


@case("page_insert_outcomes", f"""
with old as ({_STORED_PAGES})
select sum(case when known = 0 then 1 else 0 end)::bigint as added, sum(case when known = 0 then seen - 1 else seen end)::bigint as skipped
from (select f.page_url, count(*) as seen, max(case when o.page_url is null then 0 else 1 end) as known
  from ({_FOUND_PAGES}) f left join old o on o.page_url = f.page_url group by 1)""")
def page_insert_outcomes(t: Tables) -> DataFrame:
    per_url = merge.page_insert_outcomes(t.sql(_STORED_PAGES), t.sql(_FOUND_PAGES))
    return per_url.agg(F.sum("added").alias("added"), F.sum("skipped").alias("skipped"))


_STORED_CONTENT = """select cast(id_page as bigint) as id, cast(id_page as bigint) as id_page, page_url, cast(publication_date as timestamp) as publication_date,
  page_raw_content, content, content_length, cast(null as timestamp) as fetched_at from v_news_pages_content"""
_FETCHED = "select page_id as id_page, url as page_url, cast('2024-06-01' as timestamp) as publication_date, html as page_raw_content from pages"


@case("raw_upsert", f"""
with old as ({_STORED_CONTENT}), d as ({_FETCHED})
select coalesce(d.id_page, o.id_page) as id_page, case when d.id_page is null then o.page_url else d.page_url end as page_url,
  cast(case when d.id_page is null then o.publication_date else d.publication_date end as date) as publication_date,
  md5(case when d.id_page is null then o.page_raw_content else d.page_raw_content end) as raw, md5(o.content) as text, d.id_page is not null as is_fetched
from old o full join d on o.id_page = d.id_page""")
def raw_upsert(t: Tables) -> DataFrame:
    merged = merge.raw_upsert(t.sql(_STORED_CONTENT), t.sql(_FETCHED), AS_OF)
    return merged.select(
        "id_page", "page_url", F.col("publication_date").cast("date").alias("publication_date"),
        F.md5("page_raw_content").alias("raw"), F.md5("content").alias("text"), F.col("fetched_at").isNotNull().alias("is_fetched"),
    )


# Texts for every page, but a cleared one for every 17th.
_EXTRACTED = "select doc_id as id_page, case when doc_id % 17 = 0 then null else text end as content from documents where lang <> 'de'"


@case("content_update", f"""
with d as ({_EXTRACTED})
select c.id_page, md5(case when d.id_page is null then c.content else d.content end) as text,
  case when d.id_page is null then c.content_length else length(d.content)::int end as content_length
from v_news_pages_content c left join d on c.id_page = d.id_page""")
def content_update(t: Tables) -> DataFrame:
    updated = merge.content_update(t.sql(_STORED_CONTENT), t.sql(_EXTRACTED))
    return updated.select("id_page", F.md5("content").alias("text"), "content_length")


_FLAGGED = "select doc_id as id_page, n_chars > 1000 as is_error from documents where lang <> 'en'"


@case("error_flag_update", f"""
select np.id_page, case when d.id_page is null then np.is_error else d.is_error end as is_error
from v_news_pages np left join ({_FLAGGED}) d on np.id_page = d.id_page""")
def error_flag_update(t: Tables) -> DataFrame:
    return merge.error_flag_update(t.sql(_ALL_PAGES), t.sql(_FLAGGED)).select("id_page", "is_error")


_JUDGED = "select sitemap_url, id_sitemap % 2 = 0 as is_fresh from v_sitemaps where id_sitemap % 3 <> 1"


@case("freshness_update", f"""
with old as ({_STORED_SITEMAPS})
select o.sitemap_url, case when d.sitemap_url is null then o.is_fresh else d.is_fresh end as is_fresh, d.sitemap_url is not null as is_processed
from old o left join ({_JUDGED}) d on o.sitemap_url = d.sitemap_url""")
def freshness_update(t: Tables) -> DataFrame:
    updated = merge.freshness_update(t.sql(_STORED_SITEMAPS), t.sql(_JUDGED), AS_OF)
    return updated.select("sitemap_url", "is_fresh", F.col("processed_at").isNotNull().alias("is_processed"))


_STORED_VECTORS = "select cast(id_page as bigint) as id, id_page, embedding from v_content_embeddings"


@case("embedding_upsert", """
with d as (select vec_id as id_page, list_reverse(embedding) as embedding from embeddings where label < 5), old as (select * from v_content_embeddings)
select coalesce(d.id_page, old.id_page) as id_page, round(coalesce(d.embedding, old.embedding)[1]::double, 6) as first_value,
  coalesce(old.id_page, 0)::bigint as old_id
from old full join d on old.id_page = d.id_page""")
def embedding_upsert(t: Tables) -> DataFrame:
    delta = t.sql("select vec_id as id_page, reverse(embedding) as embedding from embeddings where label < 5")
    merged = merge.embedding_upsert(t.sql(_STORED_VECTORS), delta)
    kept_id = F.when(F.col("id") == F.col("id_page"), F.col("id")).otherwise(F.lit(0).cast("bigint"))
    return merged.select("id_page", F.round(F.get("embedding", F.lit(0)).cast("double"), 6).alias("first_value"), kept_id.alias("old_id"))


@case("surrogate_keys", "select count(*) as n, 101::bigint as lowest, 100 + count(*) as highest, count(*) as different from documents")
def surrogate_keys_(t: Tables) -> DataFrame:
    urls = t("v_news_pages").select("page_url")
    return surrogate_keys(urls, "page_url", "id_page", after=100).agg(
        F.count("*").alias("n"), F.min("id_page").alias("lowest"), F.max("id_page").alias("highest"),
        F.count_distinct("id_page").alias("different"),
    )


_PAGES_AGAIN = "select * from v_news_pages union all select id_page, id_sitemap + 1000, page_url, publication_date, null from v_news_pages where id_page % 50 = 0"


@case("constraint_audit", f"""
with np as ({_PAGES_AGAIN}), ce as (select id_page, len(embedding) as dim from v_content_embeddings)
select 'news_pages' as "table", 'unique id_page' as rule, cast(id_page as varchar) as key from np group by id_page having count(*) > 1
union all select 'news_pages', 'unique page_url', page_url from np group by page_url having count(*) > 1
union all select distinct 'news_pages', 'reference id_sitemap', cast(id_sitemap as varchar) from np where id_sitemap not in (select id_sitemap from v_sitemaps)
union all select distinct 'news_pages_content', 'reference id_page', cast(id_page as varchar) from v_news_pages_content where id_page not in (select id_page from np)
union all select distinct 'content_embeddings', 'reference id_page', cast(id_page as varchar) from ce where id_page not in (select id_page from np)
union all select 'content_embeddings', 'dimension 64', cast(id_page as varchar) from ce where id_page % 10 = 0""")
def constraint_audit_(t: Tables) -> DataFrame:
    short = F.when(F.col("id_page") % 10 == 0, F.slice("embedding", 1, 32)).otherwise(F.col("embedding"))
    return constraint_audit({
        "sitemaps": t("v_sitemaps"), "news_pages": t.sql(_PAGES_AGAIN),
        "news_pages_content": t("v_news_pages_content"),
        "content_embeddings": t("v_content_embeddings").withColumn("embedding", short),
    }, dim=64)


@case("vector_dim_check", "select vec_id from (select vec_id, case when vec_id % 9 = 0 then embedding[1:10] else embedding end as e from embeddings) where len(e) <> 64")
def vector_dim_check_(t: Tables) -> DataFrame:
    short = F.when(F.col("vec_id") % 9 == 0, F.slice("embedding", 1, 10)).otherwise(F.col("embedding"))
    return vector_dim_check(t("embeddings").withColumn("embedding", short), 64).select("vec_id")


# Batch jobs ---------------------------------------------------------------------

_TEXTS = "select doc_id as id_page, case when doc_id % 23 = 0 then '' else text end as content, cast(floor(doc_id / 100) as bigint) as batch_no from documents"


@case("batch_requests", f"""
select batch_no, cast(id_page as varchar) as custom_id, 'POST' as method, '/v1/embeddings' as url, 'text-embedding-3-small' as model,
  md5(content) as input, 'float' as encoding_format from ({_TEXTS}) where content <> ''""")
def batch_requests(t: Tables) -> DataFrame:
    line = F.from_json("request", F.lit("custom_id string, method string, url string, body struct<model:string,input:string,encoding_format:string>"))
    made = batches.batch_requests(t.sql(_TEXTS)).withColumn("l", line)
    return made.select(
        "batch_no", "l.custom_id", "l.method", "l.url", "l.body.model", F.md5("l.body.input").alias("input"), "l.body.encoding_format"
    )


def _outcome_texts(t: Tables) -> DataFrame:
    return t("v_embed_outcomes").select("batch_no", "id_page", "domain", "tokens")


@case("job_manifest", """
select batch_no, page_ids, texts, p.tokens, domain_tokens from (
  select batch_no, string_agg(id_page, ',' order by id_page) as page_ids, count(*) as texts, sum(tokens)::bigint as tokens from v_embed_outcomes group by 1) p
join (select batch_no, string_agg(domain || '=' || tokens, ';' order by domain) as domain_tokens
  from (select batch_no, domain, sum(tokens)::bigint as tokens from v_embed_outcomes group by 1, 2) group by 1) using (batch_no)""")
def job_manifest(t: Tables) -> DataFrame:
    shares = F.transform(F.array_sort(F.map_entries("domain_tokens")), lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string")))
    return batches.job_manifest(_outcome_texts(t)).select(
        "batch_no", F.array_join("page_ids", ",").alias("page_ids"), "texts", "tokens", F.array_join(shares, ";").alias("domain_tokens")
    )


_SHARES = "select batch_no, domain, sum(tokens)::bigint as tokens from v_embed_outcomes group by 1, 2"


@case("job_domain_tokens", _SHARES)
def job_domain_tokens(t: Tables) -> DataFrame:
    return batches.job_domain_tokens(_outcome_texts(t))


@case("token_share", f"select *, round(tokens::double / sum(tokens) over (partition by batch_no), 9) as share from ({_SHARES})")
def token_share(t: Tables) -> DataFrame:
    return batches.token_share(batches.job_domain_tokens(_outcome_texts(t))).withColumn("share", F.round("share", 9))


@case("job_domain_apportion", f"""
with s as ({_SHARES}), o as (select batch_no, count(*) filter (where outcome = 'ok') as ok, count(*) filter (where outcome = 'failed') as failed from v_embed_outcomes group by 1)
select batch_no, domain, tokens, round_even(ok * share, 0)::bigint as ok, round_even(failed * share, 0)::bigint as failed
from (select *, tokens::double / sum(tokens) over (partition by batch_no) as share from s) join o using (batch_no)""")
def job_domain_apportion(t: Tables) -> DataFrame:
    outcomes = t("v_embed_outcomes").groupBy("batch_no").agg(
        F.count_if(F.col("outcome") == "ok").alias("ok"), F.count_if(F.col("outcome") == "failed").alias("failed")
    )
    return batches.job_domain_apportion(batches.job_domain_tokens(_outcome_texts(t)), outcomes)


def result_lines(t: Tables, lines: str = "select * from embeddings") -> DataFrame:
    """Result lines as JSON: a few with an error, a few with another status."""
    vector = F.array(F.struct("embedding"))
    failed = F.col("vec_id") % 10 == 3
    limited = F.col("vec_id") % 10 == 7
    line = F.struct(
        F.col("vec_id").cast("string").alias("custom_id"),
        F.when(failed, "bad input").alias("error"),
        F.struct(
            F.when(limited, 429).otherwise(200).alias("status_code"),
            F.struct(F.when(~limited & ~failed, vector).alias("data")).alias("body"),
        ).alias("response"),
    )
    return t.sql(lines).select(F.to_json(line).alias("value"))


def parsed_results(t: Tables, lines: str = "select * from embeddings") -> DataFrame:
    lines = result_lines(t, lines).select(F.from_json("value", F.lit(RESULT_LINE)).alias("l")).select("l.*")
    return jobs.result_rows(lines)


_RESULTS = "select vec_id as id_page, case when vec_id % 10 = 3 then 'bad input' end as error, case when vec_id % 10 = 7 then 429 else 200 end as status_code, embedding, label from embeddings"


@case("batch_result_scan", f"select id_page, error, status_code, case when status_code = 200 and error is null then len(embedding)::int end as dim from ({_RESULTS})")
def batch_result_scan(t: Tables) -> DataFrame:
    dim = F.when(F.col("embedding").isNotNull(), F.size("embedding"))
    return parsed_results(t).select("id_page", "error", "status_code", dim.alias("dim"))


@case("result_ok", f"select count(*) filter (where error is null and status_code = 200) as ok, count(*) filter (where error is not null or status_code <> 200) as failed from ({_RESULTS})")
def result_ok(t: Tables) -> DataFrame:
    ok = batches.result_ok(F.col("error"), F.col("status_code"))
    return parsed_results(t).agg(F.count_if(ok).alias("ok"), F.count_if(~ok).alias("failed"))


@case("batch_results_load", f"""
select id_page, error is null and status_code = 200 as ok,
  case when error is null and status_code = 200 then null when label < 5 then 'from file ' || id_page else error end as message from ({_RESULTS})""")
def batch_results_load(t: Tables) -> DataFrame:
    errors = t.sql("select vec_id as id_page, 'from file ' || vec_id as message from embeddings where label < 5")
    ok, failed = batches.batch_results_load(parsed_results(t), errors)
    return ok.select("id_page", F.lit(True).alias("ok"), F.lit(None).cast("string").alias("message")).unionByName(
        failed.select("id_page", F.lit(False).alias("ok"), "message")
    )


_BATCHES = "select vec_id as id_page, cast(floor(vec_id / 50) as bigint) as batch_no, 'd' || (vec_id % 3) || '.example.com' as domain from embeddings"


@case("job_domain_outcomes", f"""
select batch_no, domain, count(*) filter (where error is null and status_code = 200) as ok, count(*) filter (where error is not null or status_code <> 200) as failed
from ({_RESULTS}) join ({_BATCHES}) using (id_page) group by 1, 2""")
def job_domain_outcomes(t: Tables) -> DataFrame:
    return batches.job_domain_outcomes(parsed_results(t), t.sql(_BATCHES))


_JOB_LIST = """select distinct 'job-' || cast(floor(doc_id / 75) as int) as batch_id, cast(floor(doc_id / 75) as int) as job_no,
  case when floor(doc_id / 75)::int % 3 <> 0 then 'pending' when floor(doc_id / 75)::int % 2 = 0 then 'completed' else 'failed' end as list_name,
  count(*) over (partition by floor(doc_id / 75)) as pages from documents"""
_STATUS = "case job_no % 5 when 0 then 'completed' when 1 then 'expired' when 2 then 'in_progress' when 3 then 'cancelled' else 'completed' end"


@case("job_registry_transition", f"""
select batch_id, case when list_name = 'pending' and s <> 'in_progress' then case when s = 'completed' then 'completed' else 'failed' end else list_name end as list_name,
  case when list_name = 'pending' and s <> 'in_progress' then s else list_name end as status,
  list_name = 'pending' and s <> 'in_progress' as ended,
  case when list_name = 'pending' and s = 'completed' then job_no::bigint end as processed_count
from (select *, {_STATUS} as s from ({_JOB_LIST}))""")
def job_registry_transition(t: Tables) -> DataFrame:
    job_no = F.regexp_extract("batch_id", r"(\d+)$", 1).cast("int").alias("job_no")
    seen = job_registry(t).select("batch_id", job_no)
    statuses = seen.select("batch_id", F.expr(_STATUS).alias("status"))
    results = seen.select("batch_id", F.col("job_no").cast("bigint").alias("processed_count"))
    moved = batches.job_registry_transition(job_registry(t), statuses, results, AS_OF)
    return moved.select("batch_id", "list_name", "status", F.col("completed_at").isNotNull().alias("ended"), "processed_count")


@case("job_status_counts", f"""
select list_name, count(j.batch_id) as jobs from (values ('pending'), ('completed'), ('failed')) l(list_name)
left join ({_JOB_LIST}) j using (list_name) group by 1""")
def job_status_counts(t: Tables) -> DataFrame:
    return batches.job_status_counts(job_registry(t))


@case("job_age_report", f"""
select row_number() over (order by job_no desc, batch_id) as row_no, batch_id, round((job_no + 1)::double, 1) as age_hours, pages
from ({_JOB_LIST}) where list_name = 'pending'""")
def job_age_report(t: Tables) -> DataFrame:
    return batches.job_age_report(job_registry(t), AS_OF)
