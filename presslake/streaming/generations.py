"""Folders of micro-batches, folded into numbered generations.

A stream leaves a folder for each micro-batch. ``fold`` gathers the finished ones
into segments and notes the result as the next generation: the segments to read,
and for each stream the last micro-batch they hold. Readers take the highest
generation whose note is complete and add the folders it doesn't cover, so they
see the same rows before, while and after folders are folded.

- A micro-batch is finished once its stream has written a later one; the newest
  folder of a stream may be written again and is left alone.
- A note is created once: of two folds to the same number one gives way. A note cut
  off by a lost driver isn't complete; readers go on with the one before, and the
  next fold takes a higher number.
- What a generation has replaced is removed when the one after it is noted, so a
  reader that began during the last fold still finds its files.
- A new segment takes in earlier ones while they hold no more micro-batches than it,
  so a row is written again a logarithmic number of times and segments stay few.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from presslake.session import remove_path

#: Finished micro-batches that are folded at once.
FOLD_EVERY = 16
BASE = "0-base"


@dataclass
class Generation:
    number: int = 0
    covers: dict[str, int] = field(default_factory=dict)
    segments: list[tuple[str, int]] = field(default_factory=list)


def _place(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def names_in(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder, of any store that Spark reaches; none where there is no such folder."""
    store, place = _place(spark, path)
    return sorted(s.getPath().getName() for s in store.listStatus(place)) if store.exists(place) else []


def create_once(spark: SparkSession, path: str, text: str) -> bool:
    """Write a small file that isn't there yet; False if another writer was first."""
    store, place = _place(spark, path)
    try:
        out = store.create(place, False)
    except Py4JJavaError as error:
        if store.exists(place):
            return False
        raise error
    out.write(bytearray(text.encode()))
    out.close()
    return True


def _beside(root: str, what: str) -> str:
    return f"{root.rstrip('/')}-generations/{what}"


def latest(spark: SparkSession, root: str) -> Generation:
    """The highest generation whose note is complete."""
    notes = _beside(root, "notes")
    for name in reversed(names_in(spark, notes)):
        text = "".join(r.value for r in spark.read.text(f"{notes}/{name}").collect())
        try:
            note = json.loads(text)
        except json.JSONDecodeError:
            continue
        return Generation(note["number"], note["covers"], [(s, n) for s, n in note["segments"]])
    return Generation()


def _folders(spark: SparkSession, root: str, schema: str) -> DataFrame:
    return spark.read.schema(f"{schema}, stream string, batch_id bigint").parquet(root)


def _segments(spark: SparkSession, root: str, schema: str, names: list[str]) -> list[DataFrame]:
    full = f"{schema}, stream string, batch_id bigint"
    return [spark.read.schema(full).parquet(*[_beside(root, f"rows/{n}") for n in names])] if names else []


def parts(spark: SparkSession, root: str, schema: str) -> DataFrame:
    """All rows under ``root`` with ``stream`` and ``batch_id``; none when nothing is written yet."""
    generation = latest(spark, root)
    if not names_in(spark, root):
        return spark.createDataFrame([], f"{schema}, stream string, batch_id bigint")
    rows = _folders(spark, root, schema)
    if generation.covers:
        upto = F.create_map(*[F.lit(x) for pair in generation.covers.items() for x in pair])
        rows = rows.where(F.coalesce(F.col("batch_id") > F.try_element_at(upto, F.col("stream")), F.lit(True)))
    for segment in _segments(spark, root, schema, [s for s, _ in generation.segments]):
        rows = rows.unionByName(segment)
    return rows


def fold(
    spark: SparkSession, root: str, schema: str, newest: Callable[[DataFrame], DataFrame] = lambda df: df, every: int = FOLD_EVERY,
) -> int | None:
    """Fold the finished folders under ``root`` if there are ``every`` or more; gives the generation's number.

    ``newest`` reduces rows of several folders to those that still count; it must keep ``stream`` and ``batch_id`` and
    give the same when parts were reduced before. A table put there by ``write_base`` is left where it is.
    """
    last = latest(spark, root)
    fresh: dict[str, list[int]] = {}
    covered: list[str] = []
    for name in names_in(spark, root):
        stream = name.removeprefix("stream=")
        if stream == name or stream == BASE:
            continue
        ids = sorted(int(b.removeprefix("batch_id=")) for b in names_in(spark, f"{root}/{name}") if b.startswith("batch_id="))
        upto = last.covers.get(stream, -1)
        covered += [f"{root}/{name}/batch_id={b}" for b in ids if b <= upto]
        if done := [b for b in ids[:-1] if b > upto]:
            fresh[stream] = done
    held = sum(map(len, fresh.values()))
    if held < max(1, every):
        return None

    segments, taken = list(last.segments), []
    while segments and segments[-1][1] <= held:
        name, n = segments.pop()
        taken.append(name)
        held += n
    inside = F.lit(False)
    for stream, ids in fresh.items():
        inside |= (F.col("stream") == stream) & F.col("batch_id").between(ids[0], ids[-1])
    rows = _folders(spark, root, schema).where(inside)
    for segment in _segments(spark, root, schema, taken):
        rows = rows.unionByName(segment)
    noted = names_in(spark, _beside(root, "notes"))
    number = 1 + max([last.number, *(int(n.split(".")[0]) for n in noted)])
    made = f"{number:010d}-{uuid.uuid4().hex[:8]}"
    newest(rows).write.parquet(_beside(root, f"rows/{made}"))
    segments.append((made, held))
    covers = last.covers | {stream: ids[-1] for stream, ids in fresh.items()}
    note = json.dumps({"number": number, "covers": covers, "segments": segments})
    if not create_once(spark, _beside(root, f"notes/{number:010d}.json"), note):
        remove_path(spark, _beside(root, f"rows/{made}"))
        return None

    for path in covered:
        remove_path(spark, path)
    used = {s for s, _ in segments} | {s for s, _ in last.segments}
    for name in names_in(spark, _beside(root, "rows")):
        if name not in used and int(name.split("-")[0]) < number:
            remove_path(spark, _beside(root, f"rows/{name}"))
    for name in noted:
        if int(name.split(".")[0]) < last.number:
            remove_path(spark, _beside(root, f"notes/{name}"))
    return number
