"""Token counts of documents from flat token files that have no index.

A token file is nothing but little-endian unsigned 16-bit ids, each document followed by the end id; the
files of a folder in name order are one stream, and documents may run on from one block or file into the next. Files are cut into blocks.
In a block, the end ids are found with one array comparison, which gives the documents that lie inside it, the ids
before its first end and after its last. A prefix scan over the blocks, first within files, then over one row per
file, tells each block how many ids its first document has already had.

An empty folder gives no rows; files without an end id are part of a longer document; ids after the last end of the stream
are no document. Documents of no ids count 0. Null and empty texts are written as the end id alone.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import BinaryIO

import numpy as np
import pandas as pd
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from betaloom.llm.tokens import default_vocabulary, encoded
from betaloom.tables import materialize

END_ID = 50256
BLOCK_IDS = 1 << 20
BLOCKS_A_TASK = 16

BLOCKS = "file string, block long, n_ids long, n_ends long, head long, tail long, inside array<int>"


def write_token_files(docs: DataFrame, path: str, vocabulary: str | None = None) -> None:
    """Write whole texts as flat token files, one per task, in the order of the input.

    The end id's string inside a text is written as ordinary text (the library's ``encode_special_tokens``): as the one id
    it would end the document there.

    The text sink writes each row's bytes as they are and the end id's two bytes after each, as its line separator.
    """
    place = vocabulary or default_vocabulary()

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = []
            for _, ids in encoded(frame["text"], place, added=False):
                if len(ids) and ids.max() >= 1 << 16:
                    raise ValueError("the vocabulary has ids beyond 16 bits")
                rows.append(ids.astype("<u2").tobytes())
            yield pd.DataFrame({"value": rows})

    raw = docs.select("text").mapInPandas(run, "value binary").select(F.col("value").cast("string").alias("value"))
    raw.write.option("lineSep", chr(END_ID)).option("encoding", "UTF-16LE").text(path)


def opened(path: str) -> BinaryIO:
    """A file to be read at any place: a local one directly, others through Arrow's file systems."""
    if path.startswith("file:"):
        return open("/" + path.removeprefix("file:").lstrip("/"), "rb")
    system, place = fs.FileSystem.from_uri(path)
    return system.open_input_file(place)


def ranged(path: str) -> bool:
    """Whether byte ranges of files in this store can be read."""
    try:
        opened(path).close()
    except (pa.ArrowException, OSError, ValueError):
        return False
    return True


def blocks(spark: SparkSession, path: str, end_id: int = END_ID, size: int = BLOCK_IDS) -> DataFrame:
    """One row per block: its ids, ends, ids before the first end (``head``) and after the last (``tail``), and the lengths between.

    Blocks come from the listed lengths, are dealt over tasks, and each reads its own bytes only. Where Arrow can't open the
    store, ``binaryFile`` reads whole files instead.
    """
    step = 2 * size

    def block(name: str, number: int, content: bytes) -> pd.DataFrame:
        part = np.frombuffer(content, "<u2")
        ends = np.flatnonzero(part == end_id)
        head = int(ends[0]) if len(ends) else len(part)
        tail = len(part) - int(ends[-1]) - 1 if len(ends) else len(part)
        inside = (np.diff(ends) - 1).astype(np.int32)
        return pd.DataFrame({"file": [name], "block": [number], "n_ids": [len(part)], "n_ends": [len(ends)], "head": [head], "tail": [tail], "inside": [inside]})

    def read_ranges(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for name, length, number in zip(frame["path"], frame["length"].tolist(), frame["block"].tolist(), strict=True):
                wanted = min(step, length - number * step)
                with opened(name) as source:
                    source.seek(number * step)
                    content = source.read(wanted)
                if len(content) != wanted or wanted % 2:
                    raise OSError(f"{name}: block {number} has {len(content)} of {wanted} bytes, or half an id")
                yield block(name, number, content)

    def read_whole(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for name, content in zip(frame["path"], frame["content"], strict=True):
                for number, low in enumerate(range(0, len(content), step)):
                    yield block(name, number, content[low : low + step])

    files = spark.read.format("binaryFile").load(path).where("length > 0")
    any_file = files.select("path").first()
    if any_file and not ranged(any_file["path"]):
        return files.select("path", "content").mapInPandas(read_whole, BLOCKS)
    # without ``content``, only the listing is read
    last = F.expr(f"(length - 1) div {step}")
    total = files.agg(F.sum(last + 1)).first()[0] or 1
    tasks = min(total, max(spark.sparkContext.defaultParallelism, -(-total // BLOCKS_A_TASK)))
    dealt = files.select("path", "length", F.explode(F.sequence(F.lit(0).cast("long"), last)).alias("block")).repartition(tasks)
    return dealt.mapInPandas(read_ranges, BLOCKS)


def _carried(order: W) -> Column:
    """Ids of the open document when a part begins: the tails since the last part that has an end, with that part's own."""
    before = order.rowsBetween(W.unboundedPreceding, -1)
    upto = order.rowsBetween(W.unboundedPreceding, W.currentRow)
    total = F.sum("tail").over(upto) - F.col("tail")
    closed = F.max(F.when(F.col("n_ends") > 0, F.col("upto"))).over(before)
    return F.coalesce(total - closed, total)


def counted(spark: SparkSession, path: str, end_id: int = END_ID, size: int = BLOCK_IDS) -> DataFrame:
    """One row per document of the stream: ``file`` and ``ordinal`` (from 0) of its end id, and ``n_tokens``."""
    found = materialize(blocks(spark, path, end_id, size), "token-blocks")
    # ``upto`` is the sum of tails before a part; the open document began with the last part that has an end
    within = W.partitionBy("file").orderBy("block")
    upto = F.coalesce(F.sum("tail").over(within.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    parts = found.drop("inside").withColumn("upto", upto).withColumn("carry", _carried(within))
    parts = parts.withColumn("first", F.coalesce(F.sum("n_ends").over(within.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)))
    files = parts.groupBy("file").agg(F.max_by(F.struct("n_ends", "carry", "tail"), "block").alias("last"), F.sum("n_ends").alias("n_ends"))
    tail = F.col("last.tail") + F.when(F.col("last.n_ends") == 0, F.col("last.carry")).otherwise(0)
    over = W.orderBy("file")  # one row per file
    files = files.select("file", "n_ends", tail.alias("tail"))
    files = files.withColumn("upto", F.coalesce(F.sum("tail").over(over.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)))
    files = files.select("file", _carried(over).alias("file_carry"))
    parts = parts.select("file", "block", "head", "n_ends", "carry", "first").where("n_ends > 0").join(files, "file")
    opening = F.col("head") + F.col("carry") + F.when(F.col("first") == 0, F.col("file_carry")).otherwise(0)
    heads = parts.select("file", F.col("first").alias("ordinal"), opening.alias("n_tokens"))
    rest = found.select("file", "block", "inside").join(parts.select("file", "block", "first"), ["file", "block"])
    rest = rest.select("file", "first", F.posexplode("inside").alias("k", "n"))
    rest = rest.select("file", (F.col("first") + 1 + F.col("k")).alias("ordinal"), F.col("n").cast("long").alias("n_tokens"))
    return heads.unionByName(rest)
