"""The list of checked queries."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from crosscheck import views
from presslake import configure


@dataclass
class Tables:
    """The tables of one folder, by name."""

    spark: SparkSession
    sf_dir: str

    def __call__(self, name: str) -> DataFrame:
        return views.table(self.spark, self.sf_dir, name)

    def sql(self, text: str) -> DataFrame:
        return views.sql(self.spark, self.sf_dir, text)

    def crawl(self) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
        """Sitemaps, pages, content and embeddings."""
        return tuple(self(f"v_{n}") for n in ("sitemaps", "news_pages", "news_pages_content", "content_embeddings"))


Query = Callable[[Tables], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def case(name: str, oracle: str | None = None) -> Callable[[Query], Query]:
    """Register a query; ``oracle`` is the SQL that must give the same rows, if SQL can."""
    def add(query: Query) -> Query:
        QUERIES[name] = query
        if oracle is not None:
            ORACLES[name] = views.oracle(oracle)
        return query
    return add


def runnable(query: Query) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return query(Tables(configure(spark), sf_dir))
    return run
