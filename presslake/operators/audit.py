"""Checks of what a database would enforce: unique keys, references, required values."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

EMBEDDING_DIM = 1536

# The constraints of the crawl tables.
UNIQUE = [
    ("sitemaps", "id_sitemap"), ("sitemaps", "sitemap_url"), ("news_pages", "id_page"),
    ("news_pages", "page_url"), ("news_pages_content", "id"), ("news_pages_content", "id_page"),
    ("content_embeddings", "id"), ("content_embeddings", "id_page"),
]
REFERENCES = [
    ("sitemaps", "parent_id", "sitemaps", "id_sitemap"),
    ("news_pages", "id_sitemap", "sitemaps", "id_sitemap"),
    ("news_pages_content", "id_page", "news_pages", "id_page"),
    ("content_embeddings", "id_page", "news_pages", "id_page"),
]
REQUIRED = [
    ("sitemaps", "domain"), ("sitemaps", "sitemap_url"), ("sitemaps", "is_master"),
    ("news_pages", "id_sitemap"), ("news_pages", "page_url"),
    ("news_pages_content", "id_page"), ("content_embeddings", "id_page"),
]


def _found(rows: DataFrame, table: str, rule: str, key: Column) -> DataFrame:
    return rows.select(F.lit(table).alias("table"), F.lit(rule).alias("rule"), key.cast("string").alias("key"))


def vector_dim_check(df: DataFrame, dim: int = EMBEDDING_DIM, column: str = "embedding") -> DataFrame:
    """Rows whose vector has another length than ``dim``."""
    return df.where(F.size(column) != dim)


def constraint_audit(tables: dict[str, DataFrame], dim: int = EMBEDDING_DIM) -> DataFrame:
    """Violations as ``(table, rule, key)``; constraints on absent columns are passed over.

    Each table is read once and gives its keys, labelled by what they are keys
    of; one sum by key then tells both repeats and references to nothing.
    """
    def has(table: str, column: str) -> bool:
        return table in tables and column in tables[table].columns

    unique = [(t, c) for t, c in UNIQUE if has(t, c)]
    references = [(t, c, (target, key)) for t, c, target, key in REFERENCES if has(t, c) and has(target, key)]
    required = [(t, c) for t, c in REQUIRED if has(t, c)]
    # Every column with a constraint, and the key space it belongs to.
    space = {source: source for source in unique} | {target: target for _, _, target in references}
    space |= {(t, c): target for t, c, target in references}
    number = {source: i for i, source in enumerate(space)}

    found = []
    for table, df in tables.items():
        entries = [
            F.when(F.col(c).isNotNull(), F.struct(
                F.lit(".".join(space[t, c])).alias("space"), F.col(c).cast("string").alias("key"), F.lit(number[t, c]).alias("source")
            )) for t, c in space if t == table
        ]
        # NULLs have no key of their own; one row per column tells how many there are.
        entries += [
            F.when(F.col(c).isNull(), F.struct(
                F.lit(f"required {t}.{c}").alias("space"), F.lit(None).cast("string").alias("key"), F.lit(-1).alias("source")
            )) for t, c in required if t == table
        ]
        if entries:
            found.append(df.select(F.inline(F.array_compact(F.array(*entries)))))
    dimension = []
    if has("content_embeddings", "embedding"):
        rows = vector_dim_check(tables["content_embeddings"], dim)
        dimension = [_found(rows, "content_embeddings", f"dimension {dim}", F.col("id_page"))]
    if not found:
        return reduce(DataFrame.unionByName, dimension)

    times = {source: F.col(f"n{i}") for source, i in number.items()}
    sums = reduce(DataFrame.unionByName, found).groupBy("space", "key").agg(
        F.count("*").alias("n"), *[F.count_if(F.col("source") == i).alias(f"n{i}") for i in number.values()]
    )

    def violation(broken: Column, table: str, rule: str, key: Column) -> Column:
        return F.when(broken, F.struct(F.lit(table).alias("table"), F.lit(rule).alias("rule"), key.alias("key")))

    rules = [violation(times[t, c] > 1, t, f"unique {c}", F.col("key")) for t, c in unique]
    rules += [violation((times[t, c] > 0) & (times[target] == 0), t, f"reference {c}", F.col("key")) for t, c, target in references]
    rules += [violation(F.col("space") == f"required {t}.{c}", t, f"required {c}", F.col("n").cast("string")) for t, c in required]
    return reduce(DataFrame.unionByName, [sums.select(F.inline(F.array_compact(F.array(*rules)))), *dimension])
