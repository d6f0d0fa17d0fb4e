"""Sitemap XML in a column ``body`` of a table ``(sitemap_url, body)``.

Prefixes are ignored, so documents with a default namespace, a prefixed one or
none read alike.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from presslake.functions.dates import first_date

_OPTIONS = {"mode": "PERMISSIVE", "ignoreNamespace": "true", "columnNameOfCorruptRecord": "_bad"}

# Elements that may carry a page's date, in order of preference;
# news.publication_date comes between the first and the rest.
DATE_TAGS = ["lastmod", "publication_date", "pubDate", "date", "updated", "modified",
             "published", "created", "issued", "time"]

_INDEX = "sitemap array<struct<loc:string,lastmod:string>>, _bad string"
_URLSET = (
    "url array<struct<loc:string,news:struct<publication_date:string>,"
    + ",".join(f"{tag}:string" for tag in DATE_TAGS)
    + ">>, _bad string"
)


def xml_clean(body: Column) -> Column:
    """The document without XML declarations and stylesheet instructions."""
    return F.regexp_replace(body, r"<\?xml[^>]+\?>", "")


def _parsed(documents: DataFrame, schema: str) -> DataFrame:
    """Adds ``_doc``: parsed as is, else after ``xml_clean``; ``_doc._bad`` is set if both fail.

    Lists in it are unfolded with ``explode_outer``: for plain ``explode`` Spark
    tests for empty lists first and would parse every document again for that.
    """
    as_is = F.from_xml("body", F.lit(schema), _OPTIONS)
    retry = F.when(
        F.col("_doc._bad").isNotNull(), F.from_xml(F.btrim(xml_clean(F.col("body"))), F.lit(schema), _OPTIONS)
    ).otherwise(F.col("_doc"))
    return documents.withColumn("_doc", as_is).withColumn("_doc", retry)


def sitemap_index_scan(documents: DataFrame) -> DataFrame:
    """Children of each sitemap index: ``(sitemap_url, child_url, lastmod_text)``."""
    return (
        _parsed(documents, _INDEX)
        .select("sitemap_url", F.explode_outer("_doc.sitemap").alias("s"))
        .select("sitemap_url", F.trim("s.loc").alias("child_url"), F.col("s.lastmod").alias("lastmod_text"))
        .where("child_url <> ''")
    )


def urlset_scan(documents: DataFrame) -> DataFrame:
    """Pages of each sitemap: ``(sitemap_url, page_url, date_texts)``."""
    lead, *others = DATE_TAGS
    texts = F.array(f"u.{lead}", "u.news.publication_date", *[f"u.{tag}" for tag in others])
    return (
        _parsed(documents, _URLSET)
        .select("sitemap_url", F.explode_outer("_doc.url").alias("u"))
        .select("sitemap_url", F.trim("u.loc").alias("page_url"), F.array_compact(texts).alias("date_texts"))
        .where("page_url <> ''")
    )


def unreadable_documents(documents: DataFrame) -> DataFrame:
    """Documents that cannot be parsed even after cleaning, for quarantine."""
    readable = _parsed(documents, _URLSET)
    return readable.where("_doc is null or _doc._bad is not null").select("sitemap_url", "body")


def publication_date_pick(pages: DataFrame) -> DataFrame:
    """Replaces ``date_texts`` by ``publication_date``: the first text that reads as a date."""
    return pages.withColumn("publication_date", first_date(F.col("date_texts"))).drop("date_texts")
