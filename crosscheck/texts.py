"""HTML, repeated blocks, tokens and vectors against SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crosscheck.registry import Tables, case
from presslake import materialize, scratch_path
from presslake.functions import vectors as vf
from presslake.functions.tokens import TOKEN_PATTERN
from presslake.operators import html, text, vectors
from presslake.operators.html_walk import walk_pages
from presslake.operators.vector_index import semantic_topk_index as search_index
from presslake.operators.vector_index import write_vector_index

_TOKEN_LIMIT, _DIM, _K = 200, 1536, 10


# What the article of a given page says, stated by what stands in it: a heading, paragraphs, breaks and bold words.
_ARTICLE = """replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_extract(html, '<article>(.*)</article>', 1, 's'),
  '[ \\t\\r\\n]+', ' ', 'g'), '<h1>', E'\\n# ', 'g'), '<(br|p|/p|/h1)>', E'\\n', 'g'), '</?b>', '', 'g'), '&quot;', '"')"""
_TIDY = """nullif(array_to_string(list_filter(list_transform(string_split({0}, E'\n'), lambda x: trim(regexp_replace(x, '\\s+', ' ', 'g'))),
  lambda x: not regexp_full_match(x, '[| ]*|#')), E'\n'), '')"""
PAGE_TEXT = _TIDY.format(f"replace({_ARTICLE}, '&amp;', '&')")
# A parser of HTML reads a cut-off "&amp" as well.
_PARSED_TEXT = _TIDY.format(f"regexp_replace({_ARTICLE}, '&amp;?', '&', 'g')")


@case("html_extract", f"select page_id, {PAGE_TEXT} as content from pages")
def html_extract(t: Tables) -> DataFrame:
    return html.html_extract(t("pages"), "page_id", "html")


@case("html_main_text", f"select page_id, {_PARSED_TEXT} as content from pages")
def html_main_text(t: Tables) -> DataFrame:
    return html.html_extract(t("pages"), "page_id", "html", fn=walk_pages)


@case("html_main_text_nested", f"select doc_id, {_TIDY.format('text')} as content from documents")
def html_main_text_nested(t: Tables) -> DataFrame:
    """Every document as a page without an article: its lines among menus, nested furniture and tags left open."""
    def escaped(line):
        for sign, name in (("&", "&amp;"), ("<", "&lt;"), (">", "&#62;"), ('"', "&quot;")):
            line = F.replace(line, F.lit(sign), F.lit(name))
        return line

    closes = F.when(F.col("doc_id") % 2 == 0, "</p>").otherwise("")
    body = F.array_join(F.transform(F.split("text", "\n"), lambda line: F.concat(F.lit("<p>"), escaped(line), closes)), "")
    page = F.concat(
        F.lit("<html><head><title>Title</title><body><form action=/find><div class='top menu'><ul><li><a href=/>Home</a><li><a href=/a>All <b>about us</b></a></ul></div>"
              "<div id=sidebar><div><div><p>Words that belong to no text <div>and more of them</div></div></div> still beside it</div>"
              "<div><ul><li><a href=/1>First of many links</a></li><li><a href=/2>Second of many links</a></ul></div></i></td><div><div class=page>"),
        body, F.lit("</div></div><header><p>Not a headline</header><div role=navigation><nav><div>On</div></nav>Back</div><footer><p>All rights</footer>"),
    )
    return html.html_extract(t("documents").select("doc_id", page.alias("html")), "doc_id", "html", fn=walk_pages)


_SINGLE_LINES = """
with lines as (
  select doc_id, place, trim(line, E' \\t\\r') as line from (
    select doc_id, unnest(string_split(text, E'\\n')) as line, generate_subscripts(string_split(text, E'\\n'), 1) as place from documents)),
kept as (select *, row_number() over (partition by line order by doc_id, place) as rn from lines where line <> '')
select d.doc_id, coalesce(k.text, '') as text from documents d
left join (select doc_id, string_agg(line, E'\\n' order by place) as text from kept where rn = 1 group by 1) k using (doc_id)"""


@case("text_dedup_blocks", _SINGLE_LINES)
def text_dedup_blocks(t: Tables) -> DataFrame:
    return text.text_dedup_blocks(t("documents"), "doc_id", "text")


@case("text_dedup_runs", _SINGLE_LINES)
def text_dedup_runs(t: Tables) -> DataFrame:
    """Three runs over a part of the documents each, with the lines that earlier runs have seen."""
    docs, seen = t("documents"), text.lines_seen(t.spark, scratch_path(t.spark, "lines"), 64, 65_536)
    part = F.floor(F.col("doc_id") * 3 / (docs.agg(F.max("doc_id")).scalar() + 1))
    done = None
    for run in range(3):
        made = text.text_dedup_blocks(docs.where(part == run), "doc_id", "text", seen, run)
        done = made if done is None else done.unionByName(made)
    return done


@case("token_count", f"select doc_id, len(regexp_extract_all(text, '{TOKEN_PATTERN}', 0)) as tokens, length(text) as chars from documents")
def token_count(t: Tables) -> DataFrame:
    return text.token_count(t("documents"), "doc_id", "text")


@case("token_truncate", f"""
select doc_id, md5(text) as text, tokens, length(text) as chars, truncated from (
select doc_id, least(len(tk), {_TOKEN_LIMIT - 1}) as tokens, len(tk) > {_TOKEN_LIMIT - 1} as truncated,
  case when len(tk) > {_TOKEN_LIMIT - 1} then array_to_string(tk[1:{_TOKEN_LIMIT - 1}], '') else text end as text
from (select doc_id, text, regexp_extract_all(text, '{TOKEN_PATTERN}', 0) as tk from documents))""")
def token_truncate(t: Tables) -> DataFrame:
    return text.token_truncate(t("documents"), "doc_id", "text", _TOKEN_LIMIT).withColumn("text", F.md5("text"))


@case("embed_texts", f"""
select doc_id, case when text = '' then 'skipped' else 'ok' end as outcome, {_DIM} as dim, regexp_matches(text, '[\\p{{L}}\\p{{N}}]') as has_unit_length from documents""")
def embed_texts(t: Tables) -> DataFrame:
    made = vectors.embed_texts(t("documents"), "doc_id", "text", dim=_DIM)
    unit = F.abs(vf.norm(F.col("embedding")) - 1) < 1e-4
    return made.select("doc_id", "outcome", F.size("embedding").alias("dim"), unit.alias("has_unit_length"))


def _first_vector(t: Tables):
    return t("embeddings").agg(F.min_by("embedding", "vec_id")).scalar()


_QUERY = "(select embedding::double[] from embeddings order by vec_id limit 1)"


def _nearest(metric: str, order: str) -> str:
    return f"""select vec_id, round(score, 5) as score from (
      select vec_id, {metric}(embedding::double[], {_QUERY}) as score from embeddings) order by score {order}, vec_id limit {_K}"""


def _topk(t: Tables, metric: str) -> DataFrame:
    found = vectors.semantic_topk(t("embeddings"), _first_vector(t), _K, metric, id_col="vec_id")
    return found.select("vec_id", F.round("score", 5).alias("score"))


@case("semantic_topk", _nearest("list_cosine_similarity", "desc"))
def semantic_topk(t: Tables) -> DataFrame:
    return _topk(t, "cosine")


@case("semantic_topk_l2", _nearest("list_distance", "asc"))
def semantic_topk_l2(t: Tables) -> DataFrame:
    return _topk(t, "l2")


@case("semantic_topk_ip", _nearest("list_inner_product", "desc"))
def semantic_topk_ip(t: Tables) -> DataFrame:
    return _topk(t, "ip")


_CENTRES = """select label as query_id, list(v order by i) as embedding from (
  select label, i, avg(v) as v from (select label, unnest(embedding::double[]) as v, generate_subscripts(embedding, 1) as i from embeddings) group by 1, 2) group by 1"""


@case("semantic_topk_many", f"""
select query_id, vec_id, round(score, 5) as score from (
  select *, row_number() over (partition by query_id order by score desc, vec_id) as rn from (
    select c.query_id, e.vec_id, list_cosine_similarity(e.embedding::double[], c.embedding) as score from ({_CENTRES}) c, embeddings e)) where rn <= {_K}""")
def semantic_topk_many(t: Tables) -> DataFrame:
    """The rows nearest to the centre of each label."""
    values = t("embeddings").select("label", F.posexplode("embedding").alias("i", "v"))
    means = values.groupBy("label", "i").agg(F.avg("v").alias("v"))
    centres = means.groupBy("label").agg(F.array_sort(F.collect_list(F.struct("i", "v"))).alias("_e")).select(
        F.col("label").alias("query_id"), F.transform("_e", lambda e: e["v"]).alias("embedding")
    )
    found = vectors.semantic_topk_many(t("embeddings"), centres, _K, id_col="vec_id")
    return found.withColumn("score", F.round("score", 5))


@case("semantic_topk_all", f"""
select query_id, vec_id, round(score, 5) as score from (
  select *, row_number() over (partition by query_id order by score desc, vec_id) as rn from (
    select q.vec_id as query_id, e.vec_id, list_cosine_similarity(e.embedding::double[], q.embedding::double[]) as score from embeddings q, embeddings e)) where rn <= 3""")
def semantic_topk_all(t: Tables) -> DataFrame:
    """Every vector as a query."""
    asked = t("embeddings").select(F.col("vec_id").alias("query_id"), "embedding")
    found = vectors.semantic_topk_many(t("embeddings"), asked, 3, id_col="vec_id")
    return found.withColumn("score", F.round("score", 5))


@case("semantic_topk_index", f"select count(*) as asked, count(*) * {_K} as found, true as recall_is_met, true as few_are_scored  from embeddings where vec_id % 20 = 0")
def semantic_topk_index(t: Tables) -> DataFrame:
    """The index against the exact search: every 20th vector as a query, all rows indexed."""
    rows = t("embeddings")
    index = write_vector_index(rows, scratch_path(t.spark, "index"), id_col="vec_id", k=_K)
    asked = rows.where("vec_id % 20 = 0").select(F.col("vec_id").alias("query_id"), "embedding")
    near = materialize(search_index(index, asked, _K), "near")
    exact = vectors.semantic_topk_many(rows, asked, _K, id_col="vec_id").select("query_id", F.col("vec_id").alias("id"), F.lit(1).alias("hit"))
    met = near.join(exact, ["query_id", "id"], "left").groupBy("query_id").agg(
        F.count("*").alias("found"), F.sum("hit").alias("hits"), F.max("rows_scored").alias("scored")
    )
    n = rows.agg(F.count("*")).scalar()
    return met.agg(
        F.count("*").alias("asked"), F.sum("found").alias("found"), (F.sum("hits") >= 0.95 * F.sum("found")).alias("recall_is_met"),
        (5 * F.sum("scored") <= F.count("*") * F.first(n)).alias("few_are_scored"),
    )
