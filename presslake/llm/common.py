"""Small helpers shared by the operators of this package."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from presslake.session import scratch_path

#: White space that ends a word, as a character class and as plain characters.
SPACE = r"\x20\x09-\x0D"
WORD = rf"[^{SPACE}]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def whole_text(column: str = "text") -> Column:
    """The text, where null counts as empty."""
    return F.coalesce(F.col(column), F.lit(""))


def written(df: DataFrame, label: str) -> DataFrame:
    """Write the rows under the shared checkpoint folder and go on from the files.

    Cuts the lineage: what follows survives a lost executor and always sees the very same rows.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once a row, also where ``body`` uses it inside a lambda."""
    return F.transform(F.array(value), body)[0]


def running_start(df: DataFrame, group: list[str], chunk: str, order: list[Column], amount: str, name: str) -> DataFrame:
    """Adds ``name``: the sum of ``amount`` over the rows of the group before each row.

    ``chunk`` numbers bounded pieces of a group; rows are summed within their chunk and shifted by the chunks
    before, so a group that holds a third of all rows is never in one task.
    """
    inside = Window.partitionBy(*group, chunk).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    across = Window.partitionBy(*group).orderBy(chunk).rowsBetween(Window.unboundedPreceding, -1)
    sums = df.groupBy(*group, chunk).agg(F.sum(amount).alias("__sum"))
    before = sums.select(
        *[F.col(g).alias(f"__{g}") for g in group], F.col(chunk).alias("__chunk"),
        F.coalesce(F.sum("__sum").over(across), F.lit(0)).alias("__before"),
    )
    same = F.col(chunk) == F.col("__chunk")
    for g in group:
        same &= F.col(g).eqNullSafe(F.col(f"__{g}"))
    placed = df.withColumn("__in", F.coalesce(F.sum(amount).over(inside), F.lit(0)))
    return placed.join(before, same).withColumn(name, F.col("__before") + F.col("__in")).select(*df.columns, name)


def settled(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """Adds columns that are computed once a row, whatever later steps filter or derive from them.

    Spark moves a filter below a projection by repeating its expressions; it doesn't move one below a generator.
    Columns of the same name are replaced.
    """
    rest = df.select(*[F.col(f"`{c}`") for c in df.columns])
    taken = {c.lower() for c in columns}
    made = F.inline(F.array(F.struct(*[c.alias(f"__new_{name}") for name, c in columns.items()])))
    kept = [F.col(f"`{c}`") for c in df.columns if c.lower() not in taken]
    return rest.select("*", made).select(*kept, *[F.col(f"__new_{name}").alias(name) for name in columns])
