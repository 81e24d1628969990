"""Raw folders of any number of files, listed and read by the tasks.

Spark's readers keep the status of every file on the driver, once for each table that is read, and list and open the files one at a time. Here
a folder's listing is a table as any other: the folders are listed by one task, their files by many, and the tasks that read a file get its
path from that table. The driver holds neither. Files are opened through Arrow's file systems, so this needs a store that Arrow can open.
"""

from __future__ import annotations

import gzip
import os
from collections.abc import Iterable, Iterator
from contextlib import contextmanager
from functools import cache
from itertools import islice
from typing import BinaryIO
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from betaloom.tables import materialize

# Of a task at most, and enough for one more task as long as the session has cores for it.
MOST_FILES, MOST_BYTES = 1000, 64 << 20
SOME_FILES, SOME_BYTES = 20, 1 << 20
BATCH_ROWS = 10_000
BLOCK = 1 << 22

FOLDERS = "root string, folder string"
FILES = "root string, folder string, file_name string, size long"
LINES = "file_id string, file_name string, line string"
# Endings that Hadoop has codecs for, without ``.gz``: such files are left to Spark's reader.
CODECS = r"\.(bz2|deflate|lz4|snappy|zst|zstd|passthrough)$"


def roots(spark: SparkSession, path: str) -> list[str] | None:
    """URIs of the folders that a path or a pattern names, or ``None`` if there are none or Arrow can't open their store."""
    pattern = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = pattern.getFileSystem(spark._jsc.hadoopConfiguration())
    found = files.globStatus(files.makeQualified(pattern))
    uris = [status.getPath().toUri() for status in found or () if status.isDirectory()]
    named = [f"{u.getScheme()}://{u.getAuthority() or ''}{quote(u.getPath())}" for u in uris]
    try:
        there = bool(named) and _opened(named[0])[0].get_file_info(_opened(named[0])[1]).type == fs.FileType.Directory
    except (pa.ArrowException, OSError, ValueError):
        return None
    return named if there else None


@cache
def _opened(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(uri)


def _entries(files: fs.FileSystem, folder: str) -> Iterator[tuple[str, bool, int]]:
    """(name, whether it is a folder, size) of what lies in a folder, without the names that Spark's readers pass over. A local folder is read as
    a stream."""
    if isinstance(files, fs.LocalFileSystem):
        with os.scandir(folder) as found:
            for entry in found:
                if not _hidden(entry.name):
                    inside = entry.is_dir()
                    try:
                        yield entry.name, inside, 0 if inside else entry.stat().st_size
                    except FileNotFoundError:  # a link to nothing
                        continue
    else:
        for info in files.get_file_info(fs.FileSelector(folder)):
            if not _hidden(info.base_name):
                yield info.base_name, info.type == fs.FileType.Directory, info.size or 0


def _hidden(name: str) -> bool:
    return name.startswith(".") or name.startswith("_") and "=" not in name or name.endswith("._COPYING_")


def _chunks(rows: Iterable[tuple], *names: str) -> Iterator[pa.RecordBatch]:
    rows = iter(rows)
    while chunk := list(islice(rows, BATCH_ROWS)):
        yield pa.RecordBatch.from_arrays([pa.array(column) for column in zip(*chunk, strict=True)], list(names))


def _folders(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for uri in batch.column(0).to_pylist():
            yield from _chunks(((uri, name) for name, inside, _ in _entries(*_opened(uri)) if inside), "root", "folder")


def _files(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def found() -> Iterator[tuple]:
        for batch in batches:
            for uri, folder in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                files, top = _opened(uri)
                for name, inside, size in _entries(files, f"{top}/{folder}"):
                    if size and not inside:
                        yield uri, folder, name, size

    return _chunks(found(), "root", "folder", "file_name", "size")


def _tasks(spark: SparkSession, n: int, size: int = 0) -> int:
    """Tasks for ``n`` files or folders of ``size`` bytes in all."""
    at_once = min(spark.sparkContext.defaultParallelism, max(n // SOME_FILES, size // SOME_BYTES))
    return max(1, at_once, -(-n // MOST_FILES), -(-size // MOST_BYTES))


def listed(spark: SparkSession, uris: list[str]) -> DataFrame:
    """A row for every file with content in a folder of the roots: ``root``, ``folder``, ``file_name`` and ``size``, stored."""
    tops = spark.createDataFrame([(uri,) for uri in uris], "root string").coalesce(len(uris))
    folders = materialize(tops.mapInArrow(_folders, FOLDERS), "folders")
    return materialize(folders.repartition(_tasks(spark, folders.count())).mapInArrow(_files, FILES), "files")


@contextmanager
def _content(uri: str, folder: str, name: str) -> Iterator[BinaryIO]:
    files, top = _opened(uri)
    with files.open_input_file(f"{top}/{folder}/{name}") as source:
        yield gzip.GzipFile(fileobj=source) if name.endswith(".gz") else source


def _file_lines(source: BinaryIO) -> Iterator[list[bytes]]:
    """Lines of a file after its header, the first line that isn't blank, in lists; as Hadoop cuts them, at ``\\n``, ``\\r`` or both."""
    rest, header, first = b"", True, True
    while True:
        block = source.read(BLOCK)
        ended = not block
        if first:
            block, first = block.removeprefix(b"\xef\xbb\xbf"), False
        pieces = (rest + block).splitlines(keepends=True)
        # a line isn't over before what follows it is known: its ``\r`` may be half a mark
        rest = b"" if ended or not pieces or pieces[-1].endswith(b"\n") else pieces.pop()
        lines = [line for line in (piece.rstrip(b"\r\n") for piece in pieces) if line.strip(_BLANK)]
        if header and lines:
            lines, header = lines[1:], False
        if lines:
            yield lines
        if ended:
            return


# What Java trims.
_BLANK = bytes(range(33))


def _text(lines: list[bytes]) -> pa.Array:
    try:
        return pa.array(lines, pa.binary()).cast(pa.string())
    except pa.ArrowInvalid:
        return pa.array([line.decode("utf-8", "replace") for line in lines], pa.string())


def _lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    lines: list[bytes] = []
    runs: list[tuple[str, str, int]] = []

    def batch_of() -> pa.RecordBatch:
        at = pa.array([k for k, run in enumerate(runs) for _ in range(run[2])], pa.int32())
        ids, names = (pa.array([run[c] for run in runs], pa.string()).take(at) for c in (0, 1))
        return pa.RecordBatch.from_arrays([ids, names, _text(lines)], ["file_id", "file_name", "line"])

    for batch in batches:
        for uri, folder, name, file_id in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            with _content(uri, folder, name) as source:
                for found in _file_lines(source):
                    for low in range(0, len(found), BATCH_ROWS):
                        part = found[low : low + BATCH_ROWS]
                        lines += part
                        runs.append((file_id, name, len(part)))
                        if len(lines) >= BATCH_ROWS:
                            yield batch_of()
                            lines, runs = [], []
    if lines:
        yield batch_of()


def lines_of(files: DataFrame) -> DataFrame:
    """(file_id, file_name, line) for every line that isn't blank, headers left out, of the listed files with their ``file_id``."""
    n, size = files.agg(F.count("*"), F.coalesce(F.sum("size"), F.lit(0))).first()
    return files.select("root", "folder", "file_name", "file_id").repartition(_tasks(files.sparkSession, n, size)).mapInArrow(_lines, LINES)
