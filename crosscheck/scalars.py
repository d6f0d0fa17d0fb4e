"""URL, date, size and sitemap functions against SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crosscheck.registry import Tables, case
from presslake import scratch_path
from presslake.functions import dates, measures, urls
from presslake.operators.redirects import redirect_chain_resolve
from presslake.sources import seeds, sitemaps, snapshots
from presslake.sources.sitemap_files import read_sitemap_files

# Page URLs with www., ports, user parts, or no scheme mixed in.
_URLS = """select page_id, case page_id % 5
  when 0 then replace(url, '://', '://www.') when 1 then replace(url, '.example.', '.example.test:8080/a.example.')
  when 2 then replace(url, '://', '://user@') when 3 then regexp_replace(url, '^[a-z]+:', '') else url end as url from pages"""
_NETLOC = "regexp_extract(url, '^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//([^/?#]*)', 1)"


@case("url_netloc", f"select page_id, {_NETLOC} as netloc from ({_URLS})")
def url_netloc(t: Tables) -> DataFrame:
    return t.sql(_URLS).select("page_id", urls.url_netloc(F.col("url")).alias("netloc"))


@case("url_domain", f"select page_id, regexp_replace({_NETLOC}, '^www\\.', '') as domain from ({_URLS})")
def url_domain(t: Tables) -> DataFrame:
    return t.sql(_URLS).select("page_id", urls.url_domain(F.col("url")).alias("domain"))


@case("seed_origins", f"""
select distinct case when url like '//%' then 'https:' || '//' || {_NETLOC} else regexp_extract(url, '^([a-z]+)://', 1) || '://' || {_NETLOC} end as origin
from ({_URLS})""")
def seed_origins(t: Tables) -> DataFrame:
    return seeds.seed_origins(t.sql(_URLS).select("url"))


@case("seed_scan", "select trim(text, E' \\t\\r\\n\\v\\f') as url from (select unnest(string_split(text, E'\\n')) as text from documents) where trim(text, E' \\t\\r\\n\\v\\f') <> ''")
def seed_scan(t: Tables) -> DataFrame:
    """Reads the documents back from text files, one line per row."""
    path = scratch_path(t.spark, "seeds")
    t("documents").select("text").write.text(path)
    return seeds.seed_scan(t.spark, path)


_DAY = "cast('2024-01-01' as date) + cast(doc_id % 365 as int)"
_PARTS = f"""select doc_id, d, lpad(cast(doc_id % 24 as varchar(2)), 2, '0') || ':' || lpad(cast(doc_id % 60 as varchar(2)), 2, '0') || ':00' as hms,
  cast(year(d) as varchar(4)) as y, lpad(cast(month(d) as varchar(2)), 2, '0') as m, lpad(cast(day(d) as varchar(2)), 2, '0') as dd,
  substr('JanFebMarAprMayJunJulAugSepOctNovDec', cast(month(d) * 3 - 2 as int), 3) as mon,
  trim(substr('January  February March    April    May      June     July     August   SeptemberOctober  November December ', cast(month(d) * 9 - 8 as int), 9)) as month_name
from (select doc_id, {_DAY} as d from documents)"""
_TEXTS = f"""select doc_id, d, case doc_id % 25
  when 0 then y || '-' || m || '-' || dd
  when 1 then y || '-' || m || '-' || dd || 'T' || hms || 'Z'
  when 2 then y || '-' || m || '-' || dd || 'T' || hms || '+03:00'
  when 3 then y || '-' || m || '-' || dd || 'T' || hms || '+0300'
  when 4 then y || '-' || m || '-' || dd || ' ' || hms
  when 5 then dd || '.' || m || '.' || y || ' ' || hms
  when 6 then dd || '.' || m || '.' || y
  when 7 then y || '/' || m || '/' || dd
  when 8 then dd || '/' || m || '/' || y
  when 9 then '<![CDATA[' || y || '-' || m || '-' || dd || ']]>'
  when 10 then '0000-00-00'
  when 11 then 'yesterday or so'
  when 12 then y || '-02-31'
  when 13 then '  <b>' || y || '-' || m || '-' || dd || '</b> '
  when 14 then 'Mon, ' || dd || ' ' || mon || ' ' || y || ' ' || hms || ' +0300'
  when 15 then dd || ' ' || mon || ' ' || y || ' ' || hms || ' GMT'
  when 17 then y || '-' || m || '-' || dd || 'T' || substr(hms, 1, 5) || 'Z'
  when 18 then y || '-' || m || '-' || dd || 'T' || substr(hms, 1, 5) || '+03:00'
  when 19 then y || '-' || m
  when 20 then y
  when 21 then dd || ' ' || month_name || ' ' || y
  when 22 then dd || '.' || m || '.' || y || ' ' || substr(hms, 1, 5)
  when 23 then 'Mon, ' || dd || ' ' || mon || ' ' || substr(y, 3) || ' ' || hms || ' +0300'
  when 24 then 'Mon, ' || dd || ' ' || mon || ' ' || substr(y, 3) || ' ' || hms || ' GMT'
  else y || '-' || m || '-' || dd || 'T' || hms || '.250Z' end as text from ({_PARTS})"""
_READ = """case when doc_id % 25 in (10, 11, 12) then null
  when doc_id % 25 in (0, 6, 7, 8, 9, 13, 21) then cast(d as timestamp)
  when doc_id % 25 = 19 then cast(date_trunc('month', d) as timestamp)
  when doc_id % 25 = 20 then cast(date_trunc('year', d) as timestamp)
  else cast(d as timestamp) + to_hours(doc_id % 24) + to_minutes(doc_id % 60)
    - to_hours(case when doc_id % 25 in (2, 3, 14, 18, 23) then 3 else 0 end)
    + to_milliseconds(case when doc_id % 25 = 16 then 250 else 0 end) end"""


@case("date_clean", f"""
select doc_id, case when clean in ('', '0000-00-00', '1970-01-01', '0001-01-01') then null else clean end as clean from (
select doc_id, trim(regexp_replace(replace(replace(text, '<![CDATA[', ''), ']]>', ''), '<[^>]+>', '', 'g')) as clean from ({_TEXTS}))""")
def date_clean(t: Tables) -> DataFrame:
    return t.sql(_TEXTS).select("doc_id", dates.clean_date_text(F.col("text")).alias("clean"))


@case("date_parse_utc", f"select doc_id, strftime({_READ}, '%Y-%m-%d %H:%M:%S.%g') as parsed from ({_TEXTS})")
def date_parse_utc(t: Tables) -> DataFrame:
    parsed = F.date_format(dates.parse_utc(F.col("text")), "yyyy-MM-dd HH:mm:ss.SSS")
    return t.sql(_TEXTS).select("doc_id", parsed.alias("parsed"))


@case("min_date", f"select doc_id, strftime(cast({_DAY} as timestamp) + to_hours(doc_id % 24) - interval 12 month, '%Y-%m-%d %H:%M:%S') as floor from documents")
def min_date(t: Tables) -> DataFrame:
    moments = t.sql(f"select doc_id, cast({_DAY} as timestamp) + make_dt_interval(0, cast(doc_id % 24 as int)) as at from documents")
    return moments.select("doc_id", F.date_format(dates.min_date(F.col("at")), "yyyy-MM-dd HH:mm:ss").alias("floor"))


@case("month_bucket", "select id_page, cast(date_trunc('month', publication_date) as date) as month from v_news_pages")
def month_bucket(t: Tables) -> DataFrame:
    return t("v_news_pages").select("id_page", dates.month_bucket(F.col("publication_date")).alias("month"))


@case("content_len", "select doc_id, length(text)::int as chars, strlen(text)::int as bytes from documents")
def content_len(t: Tables) -> DataFrame:
    text = F.col("text")
    return t("documents").select("doc_id", measures.content_chars(text).alias("chars"), measures.content_bytes(text).alias("bytes"))


# Sizes from bytes to hundreds of gigabytes, exact ties at two decimals among them.
_SIZES = "select event_id, case event_id % 4 when 0 then event_id % 1024 when 1 then event_id * 128 + 1152 when 2 then event_id * 131072 + 1179648 else event_id * 10737418 + 1073741824 end as size from events"


@case("format_size", f"""
select event_id, case when size < 1024 then size || ' B' when size < 1048576 then printf('%.2f KB', size / 1024.0::double)
  when size < 1073741824 then printf('%.2f MB', size / 1048576.0::double) else printf('%.2f GB', size / 1073741824.0::double) end as label from ({_SIZES})""")
def format_size(t: Tables) -> DataFrame:
    return t.sql(_SIZES).select("event_id", measures.format_size(F.col("size")).alias("label"))


_SECONDS = "select event_id, case when event_id % 3 = 0 then (event_id % 240) / 4e0 when event_id % 3 = 1 then (event_id % 3600) + 0.5e0 else event_id * 7.25e0 end as s from events"


@case("format_duration", f"""
select event_id, case when s < 60 then printf('%.2f seconds', s) when s < 3600 then printf('%d min %d sec', floor(s / 60)::int, floor(s % 60)::int)
  else printf('%d hours %d min %d sec', floor(s / 3600)::int, floor((s % 3600) / 60)::int, floor(s % 60)::int) end as label from ({_SECONDS})""")
def format_duration(t: Tables) -> DataFrame:
    return t.sql(_SECONDS).select("event_id", measures.format_duration(F.col("s")).alias("label"))


@case("format_hms", f"""
select event_id, printf('%dч %dм %dс', floor(s / 3600)::int, floor((s % 3600) / 60)::int, floor(s % 60)::int) as label from ({_SECONDS})""")
def format_hms(t: Tables) -> DataFrame:
    return t.sql(_SECONDS).select("event_id", measures.format_hms(F.col("s")).alias("label"))


@case("token_cost", "select id_page, round(tokens / 1e6 * 0.02, 9) as cost, round(tokens / 1e6 * 0.02 * 0.5, 9) as batch_cost from v_embed_outcomes")
def token_cost(t: Tables) -> DataFrame:
    tokens = F.col("tokens")
    return t("v_embed_outcomes").select(
        "id_page", F.round(measures.token_cost(tokens), 9).alias("cost"),
        F.round(measures.token_cost(tokens, discount=measures.BATCH_DISCOUNT), 9).alias("batch_cost"),
    )


_FLAGS = "select id_page, id_page % 3 = 0 as is_master, case id_page % 4 when 0 then null when 1 then true else false end as is_fresh from v_news_pages"


@case("bool_flag_normalise", f"select id_page, case when is_master then true else is_fresh end as is_fresh from ({_FLAGS})")
def bool_flag_normalise(t: Tables) -> DataFrame:
    return t.sql(_FLAGS).select("id_page", measures.normalise_fresh(F.col("is_master"), F.col("is_fresh")).alias("is_fresh"))


# Redirects ----------------------------------------------------------------------

_LOC = "case when location like 'http%' then location when location like '/%' then regexp_extract(url, '^https?://[^/]+') || location else regexp_extract(url, '^https?://[^/]+') || '/' || location end"
_MIXED = """select page_id, case when page_id % 9 = 4 then replace(url, '://', '://www.') else url end as url,
  case when page_id % 6 = 0 then substr(location, 2) else location end as location from v_crawl_log where location like '/%' or location like 'http%'"""
_MIXED = _MIXED.replace("substr(location, 2)", "regexp_replace(location, '^/', '')")


@case("relative_redirect_resolve", f"select page_id, {_LOC} as target from ({_MIXED})")
def relative_redirect_resolve(t: Tables) -> DataFrame:
    return t.sql(_MIXED).select("page_id", urls.resolve_location(F.col("url"), F.col("location")).alias("target"))


_HOST = "regexp_replace(regexp_extract({0}, '^https?://([^/]+)', 1), '^www\\.', '')"


@case("redirect_same_domain", f"""
select page_id, {_HOST.format("url")} = {_HOST.format("target")} as allowed from (select page_id, url, {_LOC} as target from ({_MIXED}))""")
def redirect_same_domain(t: Tables) -> DataFrame:
    target = urls.resolve_location(F.col("url"), F.col("location"))
    return t.sql(_MIXED).select("page_id", urls.same_site(F.col("url"), target).alias("allowed"))


@case("redirect_chain_resolve", f"""
with recursive hop(url, final_url, hops) as (
  select url, url, 0 from v_crawl_log
  union all
  select h.url, l.target, h.hops + 1 from hop h join (select *, {_LOC} as target from v_crawl_log) l on l.url = h.final_url
  where l.status = 301 and l.location is not null and h.hops < 5 and {_HOST.format("h.url")} = {_HOST.format("l.target")})
select h.url, h.final_url, h.hops,
  case when l.url is null then 'missing' when l.status = 301 and l.location is not null and h.hops >= 5 then 'too_many_redirects'
    when l.status = 301 and l.location is not null then 'cross_domain' when l.status >= 400 then 'http_error' else 'ok' end as outcome
from (select *, row_number() over (partition by url order by hops desc) as rn from hop) h
left join v_crawl_log l on l.url = h.final_url where rn = 1""")
def redirect_chain(t: Tables) -> DataFrame:
    return redirect_chain_resolve(t("v_crawl_log"))


# Sitemap XML, written from the documents, 25 entries to a file --------------------

_ENTRIES = f"""select doc_id, cast(floor(doc_id / 25) as bigint) as file_no, 'https://' || source || '.example.com/' || doc_id as page_url, {_DAY} as d from documents"""


def _files(t: Tables, root: str, entry: str) -> DataFrame:
    """Files in five shapes: declared default namespace, ``sm:`` prefix, blanks before the declaration, bare, cut short."""
    tag = F.when(F.col("file_no") % 5 == 1, "sm:").otherwise("")
    lines = t.sql(_ENTRIES).withColumn("_e", F.expr(entry))
    body = F.array_join(F.collect_list("_e"), "")
    made = lines.groupBy("file_no").agg(body.alias("_b")).select(
        F.format_string("https://maps.example.com/%d.xml", "file_no").alias("sitemap_url"), "file_no",
        F.regexp_replace("_b", "<(/?)(?=[a-z])(?!news)", F.concat(F.lit("<$1"), tag)).alias("_b"),
    )
    ns = 'xmlns{0}="http://www.sitemaps.org/schemas/sitemap/0.9" xmlns:news="http://www.google.com/schemas/sitemap-news/0.9"'
    heads = {
        0: f'<?xml version="1.0" encoding="UTF-8"?><{root} {ns.format("")}>',
        1: f'<sm:{root} {ns.format(":sm")}>',
        2: f'\n  <?xml version="1.0"?><?xml-stylesheet type="text/xsl" href="s.xsl"?><{root} {ns.format("")}>',
        3: f"<{root}>",
        4: f"<{root}>",
    }
    ends = {0: f"</{root}>", 1: f"</sm:{root}>", 2: f"</{root}>", 3: f"</{root}>", 4: ""}
    kind = F.col("file_no") % 5
    head = F.coalesce(*[F.when(kind == k, F.lit(v)) for k, v in heads.items()])
    end = F.coalesce(*[F.when(kind == k, F.lit(v)) for k, v in ends.items()])
    return made.select("sitemap_url", "file_no", F.concat(head, "_b", end).alias("body"))


_URL_ENTRY = """case doc_id % 6
  when 0 then '<url><loc>' || page_url || '</loc><lastmod>' || d || '</lastmod></url>'
  when 1 then '<url><loc> ' || page_url || ' </loc><news:news><news:publication_date>' || d || 'T05:00:00+05:00</news:publication_date></news:news></url>'
  when 2 then '<url><loc>' || page_url || '</loc><lastmod>soon</lastmod><news:news><news:publication_date>' || d || '</news:publication_date></news:news></url>'
  when 3 then '<url><loc>' || page_url || '</loc></url>'
  when 4 then '<url><loc>' || page_url || '</loc><lastmod><![CDATA[' || d || ']]></lastmod><pubDate>2001-01-01</pubDate></url>'
  else '<url><lastmod>' || d || '</lastmod></url>' end"""
_READABLE = "file_no % 5 <> 4"
_MAP = "'https://maps.example.com/' || file_no || '.xml'"


def urlset_files(t: Tables) -> DataFrame:
    return _files(t, "urlset", _URL_ENTRY)


@case("urlset_scan", f"""
select {_MAP} as sitemap_url, page_url, case doc_id % 6 when 0 then cast(d as varchar) when 1 then d || 'T05:00:00+05:00'
  when 2 then 'soon|' || d when 3 then '' else d || '|2001-01-01' end as texts
from ({_ENTRIES}) where {_READABLE} and doc_id % 6 <> 5""")
def urlset_scan(t: Tables) -> DataFrame:
    return sitemaps.urlset_scan(urlset_files(t)).select("sitemap_url", "page_url", F.array_join("date_texts", "|").alias("texts"))


def _write_files(files: DataFrame, folder: str) -> None:
    """A file for each body, written by tasks."""
    def write(batches):
        from pyarrow import fs as stores

        store, root = stores.FileSystem.from_uri(folder)
        store.create_dir(root, recursive=True)
        for batch in batches:
            for number, body in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                with store.open_output_stream(f"{root}/{number}.xml") as out:
                    out.write(body.encode())
            yield batch.select(["file_no"])

    files.select("file_no", "body").mapInArrow(write, "file_no long").count()


@case("sitemap_files_scan", f"""
select {_MAP} as sitemap_url, page_url, case doc_id % 6 when 0 then cast(d as varchar) when 1 then d || 'T05:00:00+05:00'
  when 2 then 'soon|' || d when 3 then '' else d || '|2001-01-01' end as texts
from ({_ENTRIES}) where doc_id % 6 <> 5""")
def sitemap_files_scan(t: Tables) -> DataFrame:
    """The same files read in pieces; those that are cut short give their entries as well."""
    folder = scratch_path(t.spark, "sitemap-files")
    folder = folder if ":/" in folder else f"file://{folder}"
    _write_files(urlset_files(t), folder)
    number = F.regexp_extract("file", r"(\d+)\.xml$", 1)
    return read_sitemap_files(t.spark, folder).where("kind = 'page'").select(
        F.concat(F.lit("https://maps.example.com/"), number, F.lit(".xml")).alias("sitemap_url"), F.col("loc").alias("page_url"),
        F.array_join("date_texts", "|").alias("texts"),
    )


@case("publication_date_pick", f"""
select page_url, case doc_id % 6 when 3 then null else d end as publication_date from ({_ENTRIES}) where {_READABLE} and doc_id % 6 <> 5""")
def publication_date_pick(t: Tables) -> DataFrame:
    picked = sitemaps.publication_date_pick(sitemaps.urlset_scan(urlset_files(t)))
    return picked.select("page_url", F.col("publication_date").cast("date").alias("publication_date"))


@case("xml_clean", f"select distinct {_MAP} as sitemap_url from ({_ENTRIES}) where not ({_READABLE})")
def xml_clean(t: Tables) -> DataFrame:
    return sitemaps.unreadable_documents(urlset_files(t)).select("sitemap_url")


_CHILD_ENTRY = """case doc_id % 4
  when 0 then '<sitemap><loc>' || page_url || '/post-sitemap.xml</loc><lastmod>' || d || '</lastmod></sitemap>'
  when 1 then '<sitemap><loc>' || page_url || '/sitemap.xml</loc></sitemap>'
  when 2 then '<sitemap><loc>' || page_url || '/category-sitemap.xml</loc></sitemap>'
  else '<sitemap><lastmod>' || d || '</lastmod></sitemap>' end"""


@case("sitemap_index_scan", f"""
select {_MAP} as sitemap_url, page_url || case doc_id % 4 when 0 then '/post-sitemap.xml' when 1 then '/sitemap.xml' else '/category-sitemap.xml' end as child_url,
  case when doc_id % 4 = 0 then cast(d as varchar) end as lastmod_text
from ({_ENTRIES}) where {_READABLE} and doc_id % 4 <> 3""")
def sitemap_index_scan(t: Tables) -> DataFrame:
    return sitemaps.sitemap_index_scan(_files(t, "sitemapindex", _CHILD_ENTRY))


# Snapshots ---------------------------------------------------------------------

_SNAPSHOTS = """select event_id, user_id, props, case when event_id % 11 = 0 then 'no date'
  else lpad(cast(day(ts) as varchar(2)), 2, '0') || '-' || lpad(cast(month(ts) as varchar(2)), 2, '0') || '-' || cast(year(ts) as varchar(4)) end as date_text from events"""
_RANKED = f"""select *, row_number() over (partition by user_id order by day desc, event_id desc) as rn from (
  select event_id, user_id, props, cast(try_strptime(date_text, '%d-%m-%Y') as date) as day from ({_SNAPSHOTS})) where day is not null"""


@case("latest_snapshot_per_key", f"select user_id, day, event_id, props from ({_RANKED}) where rn = 1")
def latest_snapshot_per_key(t: Tables) -> DataFrame:
    return snapshots.latest_snapshot_per_key(t.sql(_SNAPSHOTS), "user_id", "date_text", "props", "event_id")


@case("superseded_snapshots", f"select user_id, event_id from ({_RANKED}) where rn > 1")
def superseded_snapshots(t: Tables) -> DataFrame:
    older = snapshots.superseded_snapshots(t.sql(_SNAPSHOTS), "user_id", "date_text", "event_id")
    return older.select("user_id", "event_id")


@case("snapshots_of_day", f"select event_id, user_id from ({_SNAPSHOTS}) where date_text = '09-01-2024'")
def snapshots_of_day(t: Tables) -> DataFrame:
    return snapshots.snapshots_of_day(t.sql(_SNAPSHOTS), "date_text", "2024-01-09").select("event_id", "user_id")


@case("pairs_to_map", """
select event_id, 'kind=' || event_type || ';user=' || case when event_id % 2 = 0 then 'again' else cast(user_id as varchar) end as pairs from events""")
def pairs_to_map(t: Tables) -> DataFrame:
    """Pairs with the name ``user`` given twice for even events."""
    pair = lambda name, value: F.struct(F.lit(name).alias("name"), value.alias("value"))
    pairs = F.array(
        pair("kind", F.col("event_type")), pair("user", F.col("user_id").cast("string")),
        pair("user", F.when(F.col("event_id") % 2 == 0, F.lit("again")).otherwise(F.col("user_id").cast("string"))),
    )
    entries = F.array_sort(F.map_entries(snapshots.pairs_to_map(pairs)))
    shown = F.array_join(F.transform(entries, lambda e: F.concat(e["key"], F.lit("="), e["value"])), ";")
    return t("events").select("event_id", shown.alias("pairs"))
