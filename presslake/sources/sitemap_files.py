"""Sitemap files of any size as a data source: ``read_sitemap_files(spark, folder)``.

``urlset_scan`` and ``sitemap_index_scan`` parse a body as one string. This source reads files (plain or ``.gz``) in
pieces, cuts entries out of them and parses each by itself, so a task holds one piece and a batch of entries however
long a file is. What is broken, be it a cut end or a stray sign, costs the entry it stands in and no other. Small files
share a partition; a long one has its own.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from xml.etree import ElementTree

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from presslake.sources.sitemaps import DATE_TAGS

SCHEMA = "file string, kind string, loc string, lastmod_text string, date_texts array<string>"
PIECE_BYTES, BATCH_ENTRIES = 1 << 20, 4096
#: Bytes of several files that one task reads at most, and what opening a file counts as.
PART_BYTES, FILE_COST = 64 << 20, 1 << 16
#: Bytes of an entry at most; a start tag without an end within them is passed over.
MOST_ENTRY_BYTES = 1 << 20

_START = re.compile(rb"<(?:[A-Za-z_][\w.\-]*:)?(url|sitemap)(?:\s[^>]*)?>")
_PREFIX = re.compile(rb"(</?)[A-Za-z_][\w.\-]*:")
_PREFIXED = re.compile(rb"\s[A-Za-z_][\w.\-]*:([A-Za-z_][\w.\-]*\s*=)")
_SPACE = " \t\r\n"

Entry = tuple[str, str, str | None, list[str]]


def parsed_entry(kind: str, raw: bytes) -> Entry | None:
    """``(kind, loc, lastmod, dates)`` of one element, or None if it can't be parsed or has no address."""
    try:
        # Prefixes say nothing here, and an entry by itself doesn't declare them.
        entry = ElementTree.fromstring(_PREFIXED.sub(rb" \1", _PREFIX.sub(rb"\1", raw)))
    except (ElementTree.ParseError, ValueError):
        return None
    loc = (entry.findtext("loc") or "").strip(_SPACE)
    if not loc:
        return None
    lead, *others = DATE_TAGS
    dates = [found.text or "" for tag in (lead, "news/publication_date", *others) if (found := entry.find(tag)) is not None]
    return {"url": "page", "sitemap": "sitemap"}[kind], loc, entry.findtext("lastmod"), dates


def entries_of(pieces: Iterator[bytes]) -> Iterator[Entry]:
    """Entries of a document that comes in pieces. Of a start tag within an entry the inner one counts."""
    held = b""
    for piece in pieces:
        held += piece
        at = 0
        while (start := _START.search(held, at)) is not None:
            name = start.group(1)
            end = re.compile(rb"</(?:[A-Za-z_][\w.\-]*:)?" + name + rb"\s*>").search(held, start.end())
            again = _START.search(held, start.end(), end.start() if end else len(held))
            if again is not None:  # the first one never ended
                at = again.start()
            elif end is not None:
                found = parsed_entry(name.decode(), held[start.start() : end.end()])
                if found is not None:
                    yield found
                at = end.end()
            elif len(held) - start.start() > MOST_ENTRY_BYTES:
                at = start.end()
            else:
                at = start.start()
                break
        else:
            at = max(at, held.rfind(b"<"))  # a tag may go on in the next piece
        held = held[at:] if at >= 0 else held[-64:]
        if len(held) > 2 * MOST_ENTRY_BYTES:
            held = held[-MOST_ENTRY_BYTES:]


def _plain(pieces: Iterator[bytes], gzipped: bool) -> Iterator[bytes]:
    if not gzipped:
        yield from pieces
        return
    unpack = zlib.decompressobj(47)
    for piece in pieces:
        try:
            while piece:
                yield unpack.decompress(piece, PIECE_BYTES)
                piece = unpack.unconsumed_tail
        except zlib.error:
            return  # what came before it is good


class _Files(InputPartition):
    def __init__(self, paths: list[str]) -> None:
        super().__init__(paths)
        self.paths = paths


def together(files: list[tuple[str, int]], parts: int) -> list[list[str]]:
    """Files (path and bytes) in groups of about equal cost: ``parts`` of them, or more where one would pass ``PART_BYTES``."""
    most = min(PART_BYTES, -(-sum(FILE_COST + size for _, size in files) // max(1, parts)))
    groups, held = [], most
    for path, size in files:
        if held + FILE_COST + size > most:
            groups.append([])
            held = 0
        groups[-1].append(path)
        held += FILE_COST + size
    return groups


class _Reader(DataSourceReader):
    def __init__(self, folder: str, scheme: str, groups: list[list[str]]) -> None:
        self.folder, self.scheme, self.groups = folder, scheme, groups

    def partitions(self) -> list[InputPartition]:
        return [_Files(paths) for paths in self.groups]

    def read(self, partition: _Files | None) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs as stores

        if partition is None:  # a folder without files
            return
        store, _ = stores.FileSystem.from_uri(self.folder)
        names: list[str] = []
        rows: list[Entry] = []
        for path in partition.paths:
            with store.open_input_stream(path, compression=None) as stream:
                for entry in entries_of(_plain(iter(lambda: stream.read(PIECE_BYTES), b""), path.endswith(".gz"))):
                    names.append(f"{self.scheme}://{path}")
                    rows.append(entry)
                    if len(rows) >= BATCH_ENTRIES:
                        yield _batch(names, rows)
                        names, rows = [], []
        yield _batch(names, rows)


def _batch(names: list[str], rows: list[Entry]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [()] * 4
    kinds = (pa.string(), pa.string(), pa.string(), pa.list_(pa.string()))
    arrays = [pa.array(names, pa.string()), *(pa.array(c, t) for c, t in zip(columns, kinds, strict=True))]
    return pa.RecordBatch.from_arrays(arrays, names=["file", "kind", "loc", "lastmod_text", "date_texts"])


class SitemapEntries(DataSource):
    """Option ``path``: a folder of sitemap files, or one file; ``parts``: tasks that share small files."""

    @classmethod
    def name(cls) -> str:
        return "sitemap_entries"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        from pyarrow import fs as stores

        path = self.options["path"]
        folder = path if ":/" in path else f"file://{path}"
        store, root = stores.FileSystem.from_uri(folder)
        info = store.get_file_info(root)
        found = [info] if info.is_file else store.get_file_info(stores.FileSelector(root, recursive=True))
        files = sorted((f.path, f.size or 0) for f in found if f.is_file and not f.base_name.startswith((".", "_")))
        return _Reader(folder, folder.split(":", 1)[0], together(files, int(self.options.get("parts", "64"))))


def read_sitemap_files(spark: SparkSession, folder: str) -> DataFrame:
    """``file, kind, loc, lastmod_text, date_texts`` of every entry with an address; ``kind`` is page or sitemap."""
    spark.dataSource.register(SitemapEntries)
    parts = 4 * spark.sparkContext.defaultParallelism
    return spark.read.format("sitemap_entries").option("parts", str(parts)).load(folder)
