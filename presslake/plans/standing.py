"""Standing reports: the page funnel as sums that are kept up by signed changes.

``domain_stats`` and ``summary_stats`` join all pages with all content and embeddings. Here the same measures stand as
sums per sitemap and day of publication. A change of a page, its text or its vector takes the page's earlier state out
of the sums (counted -1) and puts the new one in (+1), so sums go both ways; the date range is that of the days which
still have embedded pages. A run reads the states of the pages it touched, before and after; a report reads the sums.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from presslake.operators.joins import sitemap_domains, small_keys
from presslake.operators.stored import text_not_empty
from presslake.plans.reports import FUNNEL_COUNTS
from presslake.session import materialize

#: Change folders that are summed up into one once there are more.
MOST_CHANGES = 16
_KEYS = ["id_sitemap", "day"]


def page_states(pages: DataFrame, content: DataFrame, embeddings: DataFrame, touched: DataFrame | None = None) -> DataFrame:
    """Each page's sitemap and day, and 1 for each stage it has reached; of ``touched`` pages (``id_page``) only, if given.

    Few touched pages are broadcast, by measure, so the tables pass by unshuffled.
    """
    def of(table: DataFrame) -> DataFrame:
        if touched is None:
            return table
        return table.join(keys if keys is not None else touched, "id_page", "left_semi")

    keys = None if touched is None else small_keys(touched, "id_page")
    stored = of(content.select("id_page", F.lit(1).alias("_stored"), text_not_empty(content).cast("int").alias("_text")))
    embedded = of(embeddings.select("id_page", F.lit(1).alias("_embedded"))).distinct()
    met = of(pages.select("id_page", "id_sitemap", F.col("publication_date").cast("date").alias("day")))
    met = met.join(stored, "id_page", "left").join(embedded, "id_page", "left")
    reached = [F.lit(1), F.col("_stored"), F.col("_text"), F.col("_embedded")]
    return met.select(*_KEYS, *[F.coalesce(r, F.lit(0)).cast("bigint").alias(n) for r, n in zip(reached, FUNNEL_COUNTS, strict=True)])


def _summed(states: DataFrame) -> DataFrame:
    """Sums that are all zero say nothing and go."""
    sums = states.groupBy(*_KEYS).agg(*[F.sum(n).alias(n) for n in FUNNEL_COUNTS])
    return sums.where(" or ".join(f"{n} <> 0" for n in FUNNEL_COUNTS))


def signed_changes(before: DataFrame, after: DataFrame) -> DataFrame:
    """Sums of ``after`` less those of ``before``."""
    gone = before.select(*_KEYS, *[(-F.col(n)).alias(n) for n in FUNNEL_COUNTS])
    return _summed(gone.unionByName(after))


class StandingFunnel:
    """Sums under ``path``: folders ``from=A/to=B`` hold what versions A to B changed; they are written whole or not
    at all, and of folders that overlap the widest counts, so changes may be folded while others read."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path.rstrip("/")

    def _spans(self) -> list[tuple[int, int]]:
        """The folders that count: from the first version on, each time the one that reaches furthest."""
        place = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/from=*/to=*/_SUCCESS")
        found = place.getFileSystem(self.spark._jsc.hadoopConfiguration()).globStatus(place) or []
        names = [str(f.getPath()).split("/")[-3:-1] for f in found]
        spans = sorted((int(a.split("=")[1]), -int(b.split("=")[1])) for a, b in names)
        kept, reached = [], -1
        for first, last in spans:
            if first == reached + 1:
                kept.append((first, -last))
                reached = -last
        return kept

    def version(self) -> int:
        """The latest version; -1 before the start."""
        spans = self._spans()
        return spans[-1][1] if spans else -1

    def sums(self) -> DataFrame:
        """``id_sitemap, day`` and the counts, as of the latest version."""
        parts = [self.spark.read.parquet(f"{self.path}/from={a}/to={b}") for a, b in self._spans()]
        every = parts[0]
        for part in parts[1:]:
            every = every.unionByName(part)
        return _summed(every)

    def start(self, pages: DataFrame, content: DataFrame, embeddings: DataFrame) -> None:
        """Version 0: the sums of the tables as they are."""
        self._write(_summed(page_states(pages, content, embeddings)), 0)

    def apply(self, before: tuple[DataFrame, ...], after: tuple[DataFrame, ...], touched: DataFrame) -> int:
        """The next version, after a run that changed the ``touched`` pages (``id_page``) in any of the tables.

        ``before`` and ``after`` are the tables (pages, content, embeddings) on either side of the run.
        """
        ids = materialize(touched.select("id_page").where("id_page is not null").distinct(), "touched")
        version = self.version() + 1
        self._write(signed_changes(page_states(*before, ids), page_states(*after, ids)), version)
        if len(self._spans()) > MOST_CHANGES:
            self.fold()
        return version

    def fold(self) -> None:
        """Sum up all folders into one; the old ones stay for those who read them."""
        self.sums().write.mode("overwrite").parquet(f"{self.path}/from=0/to={self.version()}")

    def _write(self, sums: DataFrame, version: int) -> None:
        sums.write.mode("overwrite").parquet(f"{self.path}/from={version}/to={version}")

    def domain_stats(self, sitemaps: DataFrame) -> DataFrame:
        """The rows of ``reports.domain_stats``."""
        return self._funnel(sitemaps).groupBy("domain").agg(*_measures()).orderBy("domain")

    def summary_stats(self, sitemaps: DataFrame) -> DataFrame:
        """The row of ``reports.summary_stats``."""
        return self._funnel(sitemaps).agg(*_measures())

    def _funnel(self, sitemaps: DataFrame) -> DataFrame:
        return self.sums().join(sitemap_domains(sitemaps), "id_sitemap")


def _measures() -> list:
    day = F.when(F.col("pages_with_embeddings") > 0, F.col("day"))
    counts = [F.coalesce(F.sum(n), F.lit(0)).cast("bigint").alias(n) for n in FUNNEL_COUNTS]
    return [*counts, F.min(day).alias("min_publication_date"), F.max(day).alias("max_publication_date")]
