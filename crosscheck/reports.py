"""Reports, run statistics, joins, queues and filters against SQL.

Every query reads its tables whole. Where a case needs something to be absent,
say a domain without a stored sitemap, a modulus decides which rows of the
derived table count as stored.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from crosscheck.registry import Tables, case
from presslake.functions.dates import min_date
from presslake.functions.predicates import awaits_extraction, has_text, long_enough, not_an_error, on_or_after
from presslake.operators import joins, queues
from presslake.operators.numbering import batch_assign, report_row_number
from presslake import materialize, scratch_path
from presslake.plans import reports
from presslake.plans.standing import StandingFunnel

AS_OF = dt.datetime(2025, 6, 30)
CAP, LIMIT, BATCH = 5, 50, 7

# One row per page with what is known of it.
_PAGE_STATES = """
select domain, p.publication_date,
  exists (select 1 from v_news_pages_content c where c.id_page = p.id_page) as stored,
  exists (select 1 from v_news_pages_content c where c.id_page = p.id_page and length(c.content) > 0) as has_text,
  p.id_page in (select id_page from v_content_embeddings) as embedded
from v_news_pages p join v_sitemaps using (id_sitemap)"""
_FUNNEL = f"""count(*) as total_pages, count(*) filter (where stored) as pages_in_news_pages_content,
  count(*) filter (where has_text) as pages_with_non_empty_content, count(*) filter (where embedded) as pages_with_embeddings,
  min(publication_date) filter (where embedded) as min_publication_date, max(publication_date) filter (where embedded) as max_publication_date
from ({_PAGE_STATES})"""

_MONTHLY = """
select domain, month, count(*) as content_count, round(sum(chars) / 1048576, 4) as total_content_mb, round(avg(chars), 2) as avg_content_bytes
from (select domain, c.publication_date - cast(day(c.publication_date) - 1 as int) as month, c.content_length::double as chars
  from v_news_pages_content c join (select id_page, id_sitemap from v_news_pages) using (id_page) join v_sitemaps using (id_sitemap)
  where c.publication_date >= date '2024-04-01' and c.content is not null)
group by domain, month"""


@case("domain_stats", f"select domain, {_FUNNEL} group by domain")
def domain_stats(t: Tables) -> DataFrame:
    return reports.domain_stats(*t.crawl())


@case("summary_stats", f"select {_FUNNEL}")
def summary_stats(t: Tables) -> DataFrame:
    return reports.summary_stats(*t.crawl())


def _standing(t: Tables) -> tuple[StandingFunnel, DataFrame]:
    """The funnel of an earlier state of the tables, brought up to date in two runs: pages that came or moved, then
    texts and vectors that came, went or were replaced. Texts are looked at once; the runs read their lengths."""
    sitemaps, pages, content, embeddings = t.crawl()
    content = materialize(content.select("id_page", F.length("content").alias("text_chars")), "content-meta")
    moved = F.when(F.col("id_page") % 5 == 0, 1 + F.col("id_sitemap") % 3).otherwise(F.col("id_sitemap")).alias("id_sitemap")
    dated = F.when(F.col("id_page") % 4 == 0, F.date_add("publication_date", -400)).otherwise(F.col("publication_date")).alias("publication_date")
    old_pages = pages.where("id_page % 3 <> 0").select("id_page", moved, dated)
    text = F.when(F.col("id_page") % 4 == 1, 0).when(F.col("id_page") % 4 == 2, F.col("text_chars")).alias("text_chars")
    old_content = content.where("id_page % 6 <> 1").select("id_page", text)
    old_embeddings = pages.where("id_page % 2 = 0").select("id_page").unionByName(embeddings.where("id_page % 5 = 0").select("id_page")).distinct()
    funnel = StandingFunnel(t.spark, scratch_path(t.spark, "funnel"))
    funnel.start(old_pages, old_content, old_embeddings)
    came = pages.where("id_page % 3 = 0 or id_page % 4 = 0 or id_page % 5 = 0").select("id_page")
    funnel.apply((old_pages, old_content, old_embeddings), (pages, old_content, old_embeddings), came)
    filled = pages.select("id_page").unionByName(content.select("id_page")).unionByName(embeddings.select("id_page"))
    funnel.apply((pages, old_content, old_embeddings), (pages, content, embeddings), filled)
    return funnel, sitemaps


@case("domain_stats_standing", f"select domain, {_FUNNEL} group by domain")
def domain_stats_standing(t: Tables) -> DataFrame:
    funnel, sitemaps = _standing(t)
    return funnel.domain_stats(sitemaps)


@case("summary_stats_standing", f"select {_FUNNEL}")
def summary_stats_standing(t: Tables) -> DataFrame:
    funnel, sitemaps = _standing(t)
    return funnel.summary_stats(sitemaps)


@case("monthly_stats", _MONTHLY)
def monthly_stats(t: Tables) -> DataFrame:
    return reports.monthly_stats(*t.crawl()[:3])


@case("report_sort", f"select row_number() over (order by domain, month desc)::int as place, * from ({_MONTHLY})")
def report_sort(t: Tables) -> DataFrame:
    """The report with the places its rows come in; a row for each domain and month."""
    listed = reports.monthly_stats(*t.crawl()[:3]).withColumn("_at", F.monotonically_increasing_id())
    return listed.withColumn("place", F.row_number().over(Window.orderBy("_at"))).drop("_at")


@case("report_row_number", f"select row_number() over (order by domain, month desc) as row_no, * from ({_MONTHLY})")
def report_numbers(t: Tables) -> DataFrame:
    return report_row_number(reports.monthly_stats(*t.crawl()[:3]), [F.asc("domain"), F.desc("month")])


@case("report", f"""
select 'monthly' as report, domain, cast(month as varchar) as detail, content_count as n from ({_MONTHLY})
union all select 'domains', domain, cast(max_publication_date as varchar), total_pages from (select domain, {_FUNNEL} group by domain)
union all select 'summary', null, cast(max_publication_date as varchar), total_pages from (select {_FUNNEL})""")
def report(t: Tables) -> DataFrame:
    made = reports.report(*t.crawl())
    cut = {
        "monthly": ("domain", "month", "content_count"),
        "domains": ("domain", "max_publication_date", "total_pages"),
        "summary": (None, "max_publication_date", "total_pages"),
    }
    parts = [
        made[name].select(
            F.lit(name).alias("report"), (F.col(domain) if domain else F.lit(None).cast("string")).alias("domain"),
            F.col(detail).cast("string").alias("detail"), F.col(n).alias("n"),
        )
        for name, (domain, detail, n) in cut.items()
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


# Filters and joins -------------------------------------------------------------

@case("error_exclude", "select id_page from v_news_pages where is_error = false")
def error_exclude(t: Tables) -> DataFrame:
    return t("v_news_pages").where(not_an_error(F.col("is_error"))).select("id_page")


@case("content_ready", "select id_page from v_news_pages_content where page_raw_content is not null and content is null")
def content_ready(t: Tables) -> DataFrame:
    return t("v_news_pages_content").where(awaits_extraction(F.col("page_raw_content"), F.col("content"))).select("id_page")


@case("content_min_length", "select id_page from v_news_pages_content where content is not null and length(content) >= 500")
def content_min_length(t: Tables) -> DataFrame:
    return t("v_news_pages_content").where(long_enough(F.col("content"))).select("id_page")


@case("non_empty_content", "select count(case when content is not null and content <> '' then 1 end) as filled, count(*) as total from v_news_pages_content")
def non_empty_content(t: Tables) -> DataFrame:
    return t("v_news_pages_content").agg(F.count_if(has_text(F.col("content"))).alias("filled"), F.count("*").alias("total"))


@case("date_floor", "select id_page, publication_date from v_news_pages where publication_date >= date '2024-04-01'")
def date_floor(t: Tables) -> DataFrame:
    return t("v_news_pages").where(on_or_after(F.col("publication_date"))).select("id_page", "publication_date")


@case("skip_empty_text", """
select domain, count(*) filter (where coalesce(content, '') = '') as skipped, count(*) filter (where content <> '') as queued
from v_news_pages_content join v_news_pages using (id_page) join v_sitemaps using (id_sitemap) group by domain""")
def skip_empty_text(t: Tables) -> DataFrame:
    sitemaps, pages, content, _ = t.crawl()
    texts = reports.label_empty_text(content.select("id_page", "content")).select("id_page", "outcome")
    per_sitemap = texts.join(pages.select("id_page", "id_sitemap"), "id_page").groupBy("id_sitemap").agg(
        F.count_if(F.col("outcome") == "skipped").alias("skipped"), F.count_if(F.col("outcome") == "queued").alias("queued")
    )
    return joins.pages_with_domain(per_sitemap, sitemaps).groupBy("domain").agg(
        F.sum("skipped").alias("skipped"), F.sum("queued").alias("queued")
    )


@case("sitemap_url_exclude", """
select url from (select 'https://' || source || '.example.com/' ||
  case doc_id % 7 when 0 then 'category-sitemap.xml' when 1 then 'author-sitemap.xml' when 2 then 'category/' || doc_id || '.xml'
    when 3 then 'author/' || doc_id || '.xml' else 'post-sitemap' || doc_id || '.xml' end as url from documents)
where url not like '%category-sitemap.xml' and url not like '%author-sitemap.xml' and url not like '%/category/%' and url not like '%/author/%'""")
def sitemap_url_exclude(t: Tables) -> DataFrame:
    urls = t.sql("""select 'https://' || source || '.example.com/' ||
      case doc_id % 7 when 0 then 'category-sitemap.xml' when 1 then 'author-sitemap.xml' when 2 then 'category/' || doc_id || '.xml'
        when 3 then 'author/' || doc_id || '.xml' else 'post-sitemap' || doc_id || '.xml' end as url from documents""")
    return joins.sitemap_url_exclude(urls, "url")


_PREVIOUS = """select sitemap_url, bool_and(pos % 5 = 0) as is_master,
  case when min(pos) % 3 = 0 then null else min(pos) % 2 = 0 end as is_fresh
  from (select sitemap_url, cast(regexp_extract(sitemap_url, 'sm-([0-9]+)', 1) as int) as pos from v_urlset where publication_date > date '2023-02-01')
  group by sitemap_url"""


@case("sitemap_stale_exclude", f"""
select distinct u.sitemap_url from v_urlset u where not exists (
  select 1 from ({_PREVIOUS}) p where p.sitemap_url = u.sitemap_url and not p.is_master and p.is_fresh is false)""")
def sitemap_stale_exclude(t: Tables) -> DataFrame:
    return joins.sitemap_stale_exclude(t("v_urlset").select("sitemap_url").distinct(), t.sql(_PREVIOUS))


@case("pages_with_domain", "select id_page, page_url, domain, publication_date from v_news_pages join v_sitemaps using (id_sitemap)")
def pages_with_domain(t: Tables) -> DataFrame:
    return joins.pages_with_domain(t("v_news_pages"), t("v_sitemaps")).select("id_page", "page_url", "domain", "publication_date")


@case("pages_left_content", """
select id_page, page_url from v_news_pages p
where not exists (select 1 from v_news_pages_content c where c.id_page = p.id_page and c.page_raw_content is not null)""")
def pages_left_content(t: Tables) -> DataFrame:
    return joins.pages_left_content(t("v_news_pages"), t("v_news_pages_content")).select("id_page", "page_url")


@case("content_inner_chain", """
select id_page, domain, content_length, is_error from v_sitemaps
join (select id_page, id_sitemap, is_error from v_news_pages) using (id_sitemap) join v_news_pages_content using (id_page)""")
def content_inner_chain(t: Tables) -> DataFrame:
    sitemaps, pages, content, _ = t.crawl()
    return joins.content_inner_chain(content, pages, sitemaps).select("id_page", "domain", "content_length", "is_error")


_HALF_KNOWN = """select id_page, case when id_page % 4 = 0 then null else page_url end as page_url,
  case when id_page % 5 = 0 then null else publication_date end as publication_date from v_news_pages_content"""


@case("coalesce_page_fields", f"""
select c.id_page, coalesce(c.page_url, np.page_url) as page_url, coalesce(c.publication_date, np.publication_date) as publication_date
from ({_HALF_KNOWN}) c join v_news_pages np on c.id_page = np.id_page join v_sitemaps s on s.id_sitemap = np.id_sitemap""")
def coalesce_page_fields(t: Tables) -> DataFrame:
    sitemaps, pages, _, _ = t.crawl()
    chain = joins.content_inner_chain(t.sql(_HALF_KNOWN), pages, sitemaps)
    return joins.with_preferred_page_fields(chain).select("id_page", "page_url", "publication_date")


@case("unembedded_anti", "select id_page from v_news_pages_content where id_page not in (select id_page from v_content_embeddings)")
def unembedded_anti(t: Tables) -> DataFrame:
    return joins.unembedded_anti(t("v_news_pages_content").select("id_page"), t("v_content_embeddings"))


# All pages in jobs of 75, two of three jobs pending.
_JOBS = """select 'job-' || cast(floor(doc_id / 75) as int) as batch_id, cast(floor(doc_id / 75) as int) as job_no, doc_id from documents"""
_PENDING = f"select doc_id from ({_JOBS}) where job_no % 3 <> 0"


def job_registry(t: Tables) -> DataFrame:
    jobs = t.sql(_JOBS).groupBy("batch_id", "job_no").agg(F.sort_array(F.collect_list("doc_id")).alias("page_ids"))
    kind = F.when(F.col("job_no") % 3 != 0, "pending").when(F.col("job_no") % 2 == 0, "completed").otherwise("failed")
    # Creation times differ between jobs and lie before the reference time.
    created = F.lit(AS_OF) - F.make_dt_interval(F.lit(0), F.lit(1) + F.col("job_no"))
    return jobs.select(
        "batch_id", F.concat(F.lit("file-"), "job_no").alias("input_file_id"), created.alias("created_at"),
        kind.alias("status"), "page_ids", F.lit(None).cast("map<string,bigint>").alias("domain_tokens"),
        F.lit(None).cast("timestamp").alias("completed_at"), F.lit(None).cast("bigint").alias("processed_count"),
        kind.alias("list_name"),
    )


@case("pending_anti", f"select id_page from v_news_pages_content where id_page not in ({_PENDING})")
def pending_anti(t: Tables) -> DataFrame:
    return joins.pending_anti(t("v_news_pages_content").select("id_page"), job_registry(t))


@case("funnel_left_chain", """
select p.id_page, domain, p.id_page in (select id_page from v_news_pages_content) as is_fetched,
  p.id_page in (select id_page from v_news_pages_content where length(content) > 0) as has_text,
  p.id_page in (select id_page from v_content_embeddings) as is_embedded
from v_news_pages p join v_sitemaps using (id_sitemap)""")
def funnel_left_chain(t: Tables) -> DataFrame:
    no = F.lit(False)
    return joins.funnel_left_chain(*t.crawl()).select(
        "id_page", "domain", F.coalesce("is_fetched", no).alias("is_fetched"),
        F.coalesce("has_text", no).alias("has_text"), F.coalesce("is_embedded", no).alias("is_embedded"),
    )


@case("existing_key_lookup", """
select u.page_url, np.id_page from v_urlset u left join (select * from v_news_pages where id_page % 4 <> 0) np on u.page_url = np.page_url""")
def existing_key_lookup(t: Tables) -> DataFrame:
    stored = t("v_news_pages").where("id_page % 4 <> 0")
    return joins.existing_key_lookup(t("v_urlset").select("page_url"), stored, "page_url", "id_page")


@case("known_domain_semi", """
select d.domain, d.domain not in (select domain from v_sitemaps where id_sitemap % 3 <> 0) as is_new_domain
from (select distinct domain from v_urlset) d""")
def known_domain_semi(t: Tables) -> DataFrame:
    return joins.known_domain_semi(t("v_urlset").select("domain").distinct(), t("v_sitemaps").where("id_sitemap % 3 <> 0"))


@case("sitemap_parent_child", """
select u.sitemap_url, s.sitemap_url as parent_url from (select distinct sitemap_url, domain from v_urlset) u
join v_sitemaps s on s.domain = u.domain""")
def sitemap_parent_child(t: Tables) -> DataFrame:
    children = t("v_urlset").select("sitemap_url", "domain").distinct().join(
        t("v_sitemaps").select("domain", F.col("id_sitemap").alias("parent_id")), "domain"
    ).select((F.lit(1 << 40) + F.xxhash64("sitemap_url")).alias("id_sitemap"), "sitemap_url", F.col("parent_id").cast("bigint"))
    masters = t("v_sitemaps").select(
        F.col("id_sitemap").cast("bigint"), "sitemap_url", F.lit(None).cast("bigint").alias("parent_id")
    )
    return joins.sitemap_parent_child(masters.unionByName(children)).select("sitemap_url", "parent_url")


# Queues -----------------------------------------------------------------------

@case("fetch_frontier", f"""
select p.id_page, p.page_url, domain, p.publication_date from v_news_pages p join v_sitemaps using (id_sitemap)
where not p.is_error and p.id_page not in (select id_page from v_news_pages_content where page_raw_content is not null)
qualify row_number() over (partition by domain order by p.publication_date desc nulls first, p.id_page) <= {CAP}""")
def fetch_frontier(t: Tables) -> DataFrame:
    return queues.fetch_frontier(*t.crawl()[:3], cap=CAP)


_EMBED = """select npc.id_page, npc.content, domain, npc.publication_date from v_news_pages_content npc
join (select id_page, id_sitemap from v_news_pages) using (id_page) join v_sitemaps using (id_sitemap)
where length(npc.content) >= 500 and npc.id_page not in (select id_page from v_content_embeddings)"""
_EMBED_END = f"order by npc.publication_date desc nulls first, npc.id_page limit {LIMIT}"


@case("embed_queue", f"{_EMBED} {_EMBED_END}")
def embed_queue(t: Tables) -> DataFrame:
    return queues.embed_queue(*t.crawl(), limit=LIMIT)


@case("embed_queue_pending", f"{_EMBED} and npc.id_page not in ({_PENDING}) {_EMBED_END}")
def embed_queue_pending(t: Tables) -> DataFrame:
    return queues.embed_queue(*t.crawl(), registry=job_registry(t), limit=LIMIT)


@case("extract_queue", """
select id_page, ifnull(c.page_url, p.page_url) as page_url, domain, ifnull(c.publication_date, p.publication_date) as publication_date
from v_news_pages_content c join v_news_pages p using (id_page) join v_sitemaps using (id_sitemap)
where not p.is_error and c.content is null and c.page_raw_content is not null""")
def extract_queue(t: Tables) -> DataFrame:
    return queues.extract_queue(*t.crawl()[:3])


@case("batch_assign", f"""
select id_page, cast(floor((row_number() over (order by publication_date desc nulls first, id_page) - 1) / {BATCH}) as bigint) as batch_no
from v_news_pages_content""")
def batch_assign_(t: Tables) -> DataFrame:
    rows = t("v_news_pages_content").select("id_page", "publication_date")
    return batch_assign(rows, queues.newest_first(), BATCH).select("id_page", "batch_no")


# Discovery, fetch and embedding statistics --------------------------------------

_FLOOR = "date '2024-06-30'"
_LABELLED = f"""select u.*, case when u.publication_date is null then 'no_date'
  when s.domain is not null and u.publication_date < {_FLOOR} then 'too_old' else 'keep' end as outcome
from v_urlset u left join (select distinct domain from v_sitemaps where id_sitemap % 4 <> 0) s on s.domain = u.domain"""


def labelled(t: Tables) -> DataFrame:
    known = t("v_sitemaps").where("id_sitemap % 4 <> 0")
    return reports.label_page_outcome(t("v_urlset"), known, min_date(AS_OF))


@case("page_no_date", """
select count(publication_date) as dated, count(*) - count(publication_date) as undated from v_urlset""")
def page_no_date(t: Tables) -> DataFrame:
    return t("v_urlset").agg(
        F.count_if(F.col("publication_date").isNotNull()).alias("dated"),
        F.count_if(F.col("publication_date").isNull()).alias("undated"),
    )


@case("page_recent", f"select page_url, outcome from ({_LABELLED})")
def page_recent(t: Tables) -> DataFrame:
    return labelled(t).select("page_url", "outcome")


@case("sitemap_freshness", f"select sitemap_url, coalesce(bool_or(publication_date >= {_FLOOR}), false) as is_fresh from v_urlset group by 1")
def sitemap_freshness(t: Tables) -> DataFrame:
    return reports.sitemap_freshness(t("v_urlset"), min_date(AS_OF))


@case("sitemap_no_date_alert", """
select sitemap_url, count(*) as pages, count(*) - count(publication_date) as no_date from v_urlset group by 1
having count(*) - count(publication_date) > count(*) * 0.1 and count(*) > 5""")
def sitemap_no_date_alert(t: Tables) -> DataFrame:
    return reports.sitemap_no_date_alert(t("v_urlset"), ratio=0.1, min_n=5)


_DISCOVERY = f"""select domain, count(distinct sitemap_url) as sitemaps_processed,
  count(*) filter (where outcome = 'keep') as pages_added, count(*) filter (where outcome = 'too_old') as pages_skipped,
  count(*) filter (where outcome = 'no_date') as pages_no_date,
  min(publication_date) filter (where outcome = 'keep') as min_date, max(publication_date) filter (where outcome = 'keep') as max_date
from ({_LABELLED}) group by domain"""


@case("discovery_stats", _DISCOVERY)
def discovery_stats(t: Tables) -> DataFrame:
    return reports.discovery_stats(labelled(t))


@case("discovery_totals", f"select count(*) as domains, sum(sitemaps_processed)::bigint as sitemaps, sum(pages_added)::bigint as pages from ({_DISCOVERY})")
def discovery_totals(t: Tables) -> DataFrame:
    return reports.discovery_totals(labelled(t))


@case("fetch_run_stats", """
select count(*) as processed, count(*) filter (where ok) as successful, count(*) filter (where not ok) as failed,
  round(100.0::double * count(*) filter (where ok) / count(*), 2) as success_rate,
  coalesce(sum(content_size) filter (where ok), 0)::bigint as total_bytes,
  round(sum(content_size) filter (where ok)::double / count(*) filter (where ok), 2) as avg_bytes,
  round(count(*) / ((epoch_us(max(ts)) - epoch_us(min(ts))) / 1e6), 6) as pages_per_second
from v_fetch_log""")
def fetch_run_stats(t: Tables) -> DataFrame:
    return reports.fetch_run_stats(t("v_fetch_log"))


FETCH_DOMAINS = """
select domain, count(*) filter (where ok) as successful, count(*) filter (where not ok) as failed,
  round(100.0::double * count(*) filter (where ok) / count(*), 2) as success_rate,
  coalesce(sum(content_size) filter (where ok), 0)::bigint as total_bytes
from v_fetch_log group by domain"""


@case("fetch_domain_stats", FETCH_DOMAINS)
def fetch_domain_stats(t: Tables) -> DataFrame:
    return reports.fetch_domain_stats(t("v_fetch_log"))


@case("extract_parser_stats", """
select parser, count(*) filter (where ok) as successful, count(*) filter (where not ok) as failed, count(*) filter (where ok) as parsed,
  round(100.0::double * count(*) filter (where ok) / count(*), 2) as success_rate
from (select case when id_page % 3 = 0 then 'walk' else 'patterns' end as parser, content is not null as ok from v_news_pages_content) group by parser""")
def extract_parser_stats(t: Tables) -> DataFrame:
    outcomes = t("v_news_pages_content").select(
        F.when(F.col("id_page") % 3 == 0, "walk").otherwise("patterns").alias("parser"), F.col("content").isNotNull().alias("ok")
    )
    return reports.extract_parser_stats(outcomes)


@case("embed_run_stats", """
select *, round(tokens_sent::double / successful, 4) as avg_tokens_per_text, round(chars_sent::double / tokens_sent, 4) as avg_chars_per_token,
  round(tokens_sent / 1000000.0::double * 0.02, 6) as cost, round(successful / 60.0::double, 4) as texts_per_second
from (select count(*) as total_texts, count(*) filter (where outcome = 'ok') as successful,
  count(*) filter (where outcome = 'failed') as failed, count(*) filter (where outcome = 'skipped') as skipped, count(*) filter (where tokens > 500) as truncated,
  sum(tokens) filter (where outcome <> 'skipped')::bigint as tokens_sent, sum(chars) filter (where outcome <> 'skipped')::bigint as chars_sent
  from v_embed_outcomes)""")
def embed_run_stats(t: Tables) -> DataFrame:
    return reports.embed_run_stats(t("v_embed_outcomes").withColumn("truncated", F.col("tokens") > 500), seconds=60)


def _embed_domains(discount: str) -> str:
    return f"""
select *, round(tokens / 1000000.0::double * 0.02 * {discount}, 6) as cost from (
select domain, count(*) filter (where outcome = 'ok') as successful, count(*) filter (where outcome = 'failed') as failed,
  count(*) filter (where outcome = 'skipped') as skipped, count(*) as total,
  coalesce(sum(tokens) filter (where outcome = 'ok'), 0)::bigint as tokens, coalesce(sum(chars) filter (where outcome = 'ok'), 0)::bigint as chars
from v_embed_outcomes group by domain)"""


@case("embed_domain_stats", _embed_domains("1.0"))
def embed_domain_stats(t: Tables) -> DataFrame:
    return reports.embed_domain_stats(t("v_embed_outcomes"))


@case("embed_batch_domain_stats", _embed_domains("0.5"))
def embed_batch_domain_stats(t: Tables) -> DataFrame:
    return reports.embed_batch_domain_stats(t("v_embed_outcomes"))
