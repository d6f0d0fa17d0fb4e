"""Streams that maintain a table as folders, one per micro-batch.

A folder is named by the stream's checkpoint and the number of the micro-batch.
A micro-batch that runs again overwrites its own folder, so a restart neither
loses nor repeats rows; a stream with a new checkpoint writes beside the old
folders, never over them. Rows of a later stream count as newer. Every stream
takes what is there and stops (``availableNow``), like a scheduled run. Finished
folders are folded into generations (``generations``), ``fold_every`` at a time.
"""

from __future__ import annotations

import datetime as dt
import time
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from presslake.operators.batches import results_ok
from presslake.operators.merge import numbered_pages
from presslake.schemas import NEWS_PAGES, RESULT_LINE
from presslake.session import remove_path
from presslake.sources.jobs import result_rows
from presslake.streaming.generations import BASE, FOLD_EVERY, create_once, fold, names_in, parts

_TOPS = "top bigint"
_VECTORS = "id_page bigint, embedding array<float>"
_TOTALS = "domain string, successful bigint, failed bigint, total_bytes bigint"
_FIRST = "page_url string, id_sitemap bigint, publication_date timestamp"
#: Groups that the URLs of a stream without a span are dealt to; a checkpoint keeps the number it began with.
URL_BUCKETS = 4096


def _age() -> Column:
    """Order of the folders: streams by their start, then micro-batches."""
    return F.struct(F.split_part("stream", F.lit("-"), F.lit(1)).cast("bigint"), "stream", "batch_id")


def _newest(df: DataFrame, key: str) -> DataFrame:
    """Of each key the row of the newest folder."""
    rest = [c for c in df.columns if c != key]
    return df.groupBy(key).agg(F.max_by(F.struct(*rest), _age()).alias("_row")).select(key, "_row.*")


def _highest(tops: DataFrame) -> DataFrame:
    return tops.groupBy("stream").agg(F.max("top").alias("top"), F.max("batch_id").alias("batch_id"))


def _write_part(df: DataFrame, root: str, stream: str, batch_id: int) -> None:
    df.write.mode("overwrite").parquet(f"{root}/stream={stream}/batch_id={batch_id}")


def write_base(df: DataFrame, root: str) -> None:
    """Put an existing table under ``root``, before any micro-batch."""
    _write_part(df, root, BASE, -1)
    if "id_page" in df.columns:
        _write_top(df.sparkSession, root, BASE, -1)


def _write_top(spark: SparkSession, root: str, stream: str, batch_id: int) -> None:
    """Note the highest id of a folder beside it."""
    part = spark.read.schema("id_page bigint").parquet(f"{root}/stream={stream}/batch_id={batch_id}")
    _write_part(part.agg(F.max("id_page").alias("top")), f"{root.rstrip('/')}-tops", stream, batch_id)


def _kept_line(spark: SparkSession, path: str, text: str) -> str:
    """The line of a small file, created with ``text`` if it isn't there."""
    create_once(spark, path, text)
    line = spark.read.text(path).first()
    if line is None:
        raise RuntimeError(f"{path} is empty, its writer was cut off: remove it and start the stream again")
    return line[0]


def _stream_name(spark: SparkSession, checkpoint: str) -> str:
    """A stream's name, kept beside its checkpoint: the time of its first start and a random part.

    The file is created once, so of two first starts both take the name of the one that came first.
    """
    return _kept_line(spark, f"{checkpoint.rstrip('/')}-name", f"{time.time_ns()}-{uuid.uuid4().hex[:8]}")


def _url_buckets(spark: SparkSession, checkpoint: str) -> int | None:
    """Buckets of a stream's URLs, kept beside its checkpoint; None for one begun when state was dealt by URL."""
    path = f"{checkpoint.rstrip('/')}-buckets"
    if names_in(spark, f"{checkpoint.rstrip('/')}/offsets") and not names_in(spark, path):
        return None
    return int(_kept_line(spark, path, f"{URL_BUCKETS}"))


def _start(stream: DataFrame, checkpoint: str, each: Callable[[DataFrame, int], None], mode: str = "append") -> StreamingQuery:
    return (
        stream.writeStream.outputMode(mode).foreachBatch(each)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )


class _BucketSightings(StatefulProcessor):
    """Gives the URLs of a bucket that are seen for the first time; none is forgotten.

    A call, its Arrow batches and its key cost far more than a look into the state, so a bucket shares them.
    """

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.known = handle.getMapState("known", "page_url string", "known boolean")

    def handleInitialState(self, key, initialState: Row, timerValues) -> None:
        self.known.updateValue((initialState.page_url,), (True,))

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        best: dict[str, tuple] = {}
        for row in rows:
            order = (row.date_us is None, row.date_us or 0, row.id_sitemap is None, row.id_sitemap or 0)
            if row.page_url not in best or order < best[row.page_url]:
                best[row.page_url] = order
        for url, (no_date, date_us, no_sitemap, sitemap) in best.items():
            if not self.known.containsKey((url,)):
                self.known.updateValue((url,), (True,))
                yield Row(page_url=url, id_sitemap=None if no_sitemap else sitemap, date_us=None if no_date else date_us)


def _best_of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each URL the best row of a batch: a URL that very many rows hold reaches the state a few times only."""
    for batch in batches:
        order = pc.sort_indices(batch, [(c, "ascending") for c in ("page_url", "date_us", "id_sitemap")], null_placement="at_end")
        ordered = batch.take(order)
        urls = ordered.column("page_url")
        first = np.ones(len(urls), dtype=bool)
        first[1:] = pc.not_equal(urls[1:], urls[:-1]).to_numpy(zero_copy_only=False)
        yield ordered.filter(pa.array(first))


def _by_bucket(rows: DataFrame, before: DataFrame, buckets: int) -> DataFrame:
    """Rows of URLs that are neither among those ``before`` nor in the state, one for each URL."""
    bucket = F.pmod(F.xxhash64("page_url"), F.lit(buckets)).cast("int").alias("bucket")
    dealt = rows.select(bucket, "page_url", "id_sitemap", F.unix_micros("publication_date").alias("date_us"))
    dealt = dealt.mapInArrow(_best_of_batches, "bucket int, page_url string, id_sitemap bigint, date_us bigint")
    new = dealt.groupBy("bucket").transformWithState(
        statefulProcessor=_BucketSightings(), outputStructType="page_url string, id_sitemap bigint, date_us bigint", outputMode="append",
        timeMode="None", initialState=before.select(bucket, "page_url").groupBy("bucket"),
    )
    return new.select("page_url", "id_sitemap", F.timestamp_micros("date_us").alias("publication_date"))


class _FirstSightings(StatefulProcessor):
    """Gives a URL the first time it is seen; a URL not seen for ``keep_ms`` is forgotten."""

    def __init__(self, keep_ms: int | None) -> None:
        self.keep_ms = keep_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.known = handle.getValueState("known", "until bigint")

    def _know(self, last_ms: int) -> None:
        until = 0 if self.keep_ms is None else last_ms + self.keep_ms
        if self.known.exists():
            until = max(until, self.known.get()[0])
        self.known.update((until,))
        if self.keep_ms is not None:
            self.handle.registerTimer(until)

    def handleInitialState(self, key, initialState, timerValues) -> None:
        # Stored pages count as seen just before the stream's first rows.
        self._know(0 if self.keep_ms is None else max(0, timerValues.getCurrentWatermarkInMs()))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        is_new, best, last_ms = not self.known.exists(), None, 0
        for batch in rows:
            if self.keep_ms is not None:
                last_ms = max(last_ms, int(batch["seen_at"].max().timestamp() * 1000))
            for date, sitemap in zip(batch["publication_date"], batch["id_sitemap"]):
                order = (pd.isna(date), date if not pd.isna(date) else pd.Timestamp.min, pd.isna(sitemap), 0 if pd.isna(sitemap) else sitemap)
                if best is None or order < best[0]:
                    best = order, date, sitemap
        self._know(last_ms)
        if is_new:
            date, sitemap = (None if pd.isna(x) else x for x in best[1:])
            made = pd.DataFrame({"page_url": [key[0]], "id_sitemap": pd.array([sitemap], dtype="Int64"), "publication_date": [date]})
            yield made.astype({"publication_date": "datetime64[us]"})

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        if self.known.exists() and self.known.get()[0] <= expiredTimerInfo.getExpiryTimeInMs():
            self.known.clear()
        yield from ()


_ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def stream_page_discovery(
    found: DataFrame, root: str, checkpoint: str, as_of: dt.datetime, late: str = "0 seconds", keep: dt.timedelta | None = None,
    fold_every: int = FOLD_EVERY,
) -> StreamingQuery:
    """Add the pages of a stream (``page_url, id_sitemap, publication_date``) whose URL is not stored yet.

    The URLs seen are the stream's own state, kept in its checkpoint by RocksDB and dealt by buckets of URLs; a stream
    with a new checkpoint takes what is stored into its state once. After that no micro-batch reads any stored page: of
    older folders only the highest id is looked up, one row each. A checkpoint whose state was dealt by URL goes on so.

    With ``keep`` the stream has a column ``seen_at`` and its state is dealt by URL. A row that is ``late`` behind the newest one of the micro-batches
    before is dropped and counts as neither added nor seen. A URL that isn't seen again for ``keep`` leaves the state
    (never before the watermark has passed that time), so the state holds the URLs of that span; one that comes back
    later is taken for new.
    """
    spark = found.sparkSession
    name = _stream_name(spark, checkpoint)
    columns = ["page_url", "id_sitemap", "publication_date"] + ["seen_at"] * (keep is not None)
    rows = found.select(*columns) if keep is None else found.select(*columns).withWatermark("seen_at", late)
    rows = rows.where("page_url is not null")
    before = parts(spark, root, NEWS_PAGES).where(F.col("stream") != name).select("page_url").distinct()
    buckets = _url_buckets(spark, checkpoint) if keep is None else None
    if buckets:
        new = _by_bucket(rows, before, buckets)
    else:
        new = rows.groupBy("page_url").transformWithStateInPandas(
            statefulProcessor=_FirstSightings(None if keep is None else int(keep.total_seconds() * 1000)), outputStructType=_FIRST,
            outputMode="append", timeMode="None" if keep is None else "EventTime", initialState=before.groupBy("page_url"),
        )

    def each(batch: DataFrame, batch_id: int) -> None:
        # Numbering reads the rows twice; read from the stream, each time would pass all URLs through the state again.
        first = f"{checkpoint.rstrip('/')}-first/{batch_id}"
        batch.write.mode("overwrite").parquet(first)
        own = (F.col("stream") == name) & (F.col("batch_id") >= batch_id)
        tops = parts(batch.sparkSession, f"{root.rstrip('/')}-tops", _TOPS).where(~own)
        new = batch.sparkSession.read.schema(_FIRST).parquet(first)
        made = numbered_pages(new, tops.agg(F.coalesce(F.max("top"), F.lit(0))).scalar(), as_of)
        _write_part(made, root, name, batch_id)
        _write_top(batch.sparkSession, root, name, batch_id)
        remove_path(batch.sparkSession, first)
        fold(batch.sparkSession, root, NEWS_PAGES, every=fold_every)
        fold(batch.sparkSession, f"{root.rstrip('/')}-tops", _TOPS, _highest, fold_every)

    provider = spark.conf.get("spark.sql.streaming.stateStore.providerClass", None)
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", _ROCKS)
    try:  # a stream takes its settings along when it starts
        return _start(new, checkpoint, each)
    finally:
        if provider is None:
            spark.conf.unset("spark.sql.streaming.stateStore.providerClass")
        else:
            spark.conf.set("spark.sql.streaming.stateStore.providerClass", provider)


def current_pages(spark: SparkSession, root: str) -> DataFrame:
    return parts(spark, root, NEWS_PAGES).drop("stream", "batch_id")


def stream_batch_results(
    spark: SparkSession, results_dir: str, root: str, checkpoint: str, files: int = 1000, fold_every: int = FOLD_EVERY,
) -> StreamingQuery:
    """Take in result files as they appear, at most ``files`` in a micro-batch; only good lines are stored."""
    lines = spark.readStream.schema(RESULT_LINE).option("maxFilesPerTrigger", files).json(results_dir).select(
        "custom_id", "error", "response", "_metadata.file_name", "_metadata.file_block_start"
    )

    name = _stream_name(spark, checkpoint)

    def each(batch: DataFrame, batch_id: int) -> None:
        place = F.struct("file_name", "file_block_start", F.monotonically_increasing_id().alias("n"))
        placed = result_rows(batch.withColumn("seq", place), keep=["seq"])
        _write_part(results_ok(placed), root, name, batch_id)
        fold(batch.sparkSession, root, _VECTORS, lambda df: _newest(df, "id_page"), fold_every)

    return _start(lines, checkpoint, each)


def current_embeddings(spark: SparkSession, root: str) -> DataFrame:
    """The newest stored vector of each page."""
    return _newest(parts(spark, root, _VECTORS), "id_page").select("id_page", "embedding")


def stream_fetch_stats(log: DataFrame, root: str, checkpoint: str, fold_every: int = FOLD_EVERY) -> StreamingQuery:
    """Running totals per domain of a stream of fetches (``domain, ok, content_size``)."""
    ok = F.col("ok")
    totals = log.groupBy("domain").agg(
        F.count_if(ok).alias("successful"), F.count_if(~ok).alias("failed"),
        F.coalesce(F.sum(F.when(ok, F.col("content_size"))), F.lit(0)).alias("total_bytes"),
    )
    name = _stream_name(log.sparkSession, checkpoint)

    def each(batch: DataFrame, batch_id: int) -> None:
        _write_part(batch, root, name, batch_id)
        fold(batch.sparkSession, root, _TOTALS, lambda df: _newest(df, "domain"), fold_every)

    return _start(totals, checkpoint, each, mode="update")


def current_fetch_stats(spark: SparkSession, root: str) -> DataFrame:
    """The newest totals of each domain; a stream that starts anew reads its source from the start."""
    totals = _newest(parts(spark, root, _TOTALS), "domain")
    rate = F.round(100.0 * F.col("successful") / (F.col("successful") + F.col("failed")), 2)
    return totals.select("domain", "successful", "failed", rate.alias("success_rate"), "total_bytes")
