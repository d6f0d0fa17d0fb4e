"""Session settings and durable scratch space."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_SETTINGS = {
    # Dates without a zone mean UTC throughout.
    "spark.sql.session.timeZone": "UTC",
    # A repeated name in a list of pairs: the last one wins.
    "spark.sql.mapKeyDedupPolicy": "LAST_WIN",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Splits an oversized join partition, e.g. many pages that lead to one URL.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Also where that costs a shuffle, e.g. a join on domain followed by sums per domain.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Set what the operators rely on; all of it can change at run time."""
    for key, value in _SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Only a local session without the setting gets one of its own, and the setting
    with it: on a cluster the executors would not see such a folder.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
    made = tempfile.mkdtemp(prefix="presslake-")
    spark.conf.set("spark.checkpoint.dir", made)
    return made


class ScratchNotes:
    """Notes the scratch paths taken inside a ``with`` block; ``clear`` removes them when nothing reads them any more."""

    _open: list[ScratchNotes] = []

    def __init__(self) -> None:
        self.paths: list[str] = []

    def __enter__(self) -> ScratchNotes:
        self._open.append(self)
        return self

    def __exit__(self, *_) -> None:
        self._open.remove(self)

    def clear(self, spark: SparkSession) -> None:
        for path in self.paths:
            remove_path(spark, path)
        self.paths = []


def remove_path(spark: SparkSession, path: str) -> None:
    """Remove a folder of any store that Spark reaches."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path under the checkpoint folder."""
    path = f"{checkpoint_root(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"
    for notes in ScratchNotes._open:
        notes.paths.append(path)
    return path


def materialize(df: DataFrame, label: str = "rows") -> DataFrame:
    """Write the rows as Parquet under the checkpoint folder and go on from the files.

    Used where a later step needs the very same rows twice, which a recomputed
    lineage does not promise. Later steps read only the columns they need.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
