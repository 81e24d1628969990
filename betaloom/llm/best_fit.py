"""Best-fit packing planned over the histogram of lengths.

The driver sees how many pieces there are of each length, at most ``capacity`` numbers, and plans
best-fit-decreasing over those counts: a run of equal pieces goes to a range of equally full
sequences at once, so the plan has a few runs for each length however many documents there are.
Spark then deals the slots out: slots and pieces are numbered within their length and joined on
(length, rank).

Null and empty texts are one piece, the end id alone. Repeated rows are packed each on its own.
An empty table gives no rows. Only ``doc_id`` and ``text`` are read, other columns don't matter.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from betaloom.llm.tokens import default_vocabulary, encoded, release_encoders
from betaloom.tables import materialize

CAPACITY = 2048
END_ID = 0
RANKED_TOGETHER = 100_000

PIECES = "doc_id string, piece int, start long, length long, ids_crc32 long"
RUNS = "length long, first_rank long, items long, first_sequence long, each long, first_offset long"


def pieces(docs: DataFrame, vocabulary: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """One row per piece. All pieces of a document but the first have ``capacity`` ids."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            keys, rows = frame["doc_id"].tolist(), []
            for k, ids in encoded(frame["text"], vocabulary):
                ids = np.append(ids, end_id).astype("<u4")
                cuts = [0, *range(len(ids) % capacity or capacity, len(ids), capacity), len(ids)]
                for p, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)):
                    rows.append((keys[k], p, a, b - a, zlib.crc32(ids[a:b].tobytes())))
            yield pd.DataFrame(rows, columns=["doc_id", "piece", "start", "length", "ids_crc32"])
        release_encoders()

    # ids go as strings: pandas would make a column with nulls a float
    found = docs.select(F.col("doc_id").cast("string").alias("doc_id"), "text").mapInPandas(run, PIECES)
    return found.withColumn("doc_id", F.col("doc_id").cast("long"))


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int, int]]:
    """Runs (length, first rank, items, first sequence, items in each sequence, offset of the first).

    Item ``q`` of a run lies in sequence ``first + q // each`` at ``offset + q % each * length``.
    """
    runs, sequences = [], 0
    open_ranges: dict[int, list[tuple[int, int]]] = defaultdict(list)  # room left: (first sequence, how many)
    rooms: list[int] = []

    def put(room: int, first: int, many: int) -> None:
        if many and room:
            if not open_ranges[room]:
                insort(rooms, room)
            open_ranges[room].append((first, many))

    for length in sorted(counts, reverse=True):
        rank, left = 0, counts[length]
        while left:
            at = bisect_left(rooms, length)
            if at < len(rooms):
                room = rooms[at]
                first, many = open_ranges[room].pop()
                if not open_ranges[room]:
                    rooms.pop(at)
            else:
                room, first = capacity, sequences
                many = -(-left // (capacity // length))
                sequences += many
            each = room // length
            items = min(left, many * each)
            runs.append((length, rank, items, first, each, capacity - room))
            full, rest = divmod(items, each)
            put(room - each * length, first, full)
            if rest:
                put(room - rest * length, first + full, 1)
            used = full + bool(rest)
            put(room, first + used, many - used)
            rank, left = rank + items, left - items
    return runs


def ranked(found: DataFrame, counts: dict[int, int], capacity: int) -> DataFrame:
    """Pieces numbered from 0 within their length; a frequent length is numbered in many parts."""
    parts = [1 + counts.get(i, 0) // RANKED_TOGETHER for i in range(capacity + 1)]
    many: Column = F.get(F.lit(parts), F.col("length").cast("int"))
    part = F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), many)
    dealt = found.withColumn("part", part)
    before = W.partitionBy("length").orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    sizes = dealt.groupBy("length", "part").agg(F.count("*").alias("size"))
    bases = sizes.select("length", "part", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("base"))
    inside = W.partitionBy("length", "part").orderBy("doc_id", "piece", "start", "ids_crc32")
    numbered = dealt.withColumn("place", F.row_number().over(inside) - 1)
    return numbered.join(bases, ["length", "part"]).withColumn("rank", F.col("base") + F.col("place")).drop("part", "base", "place")


def slots(spark, runs: list[tuple]) -> DataFrame:
    """One row for each planned item: (length, rank, sequence_id, offset)."""
    step = F.lit(RANKED_TOGETHER)
    parts = spark.createDataFrame(runs, RUNS).select(
        "*", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("items") - 1) / step))).alias("part")
    )
    low = F.col("part") * step
    high = F.least(low + step, F.col("items")) - 1
    items = parts.repartition("length", "part").select("*", F.explode(F.sequence(low, high)).alias("q"))
    q, each = F.col("q"), F.col("each")
    return items.select(
        "length",
        (F.col("first_rank") + q).alias("rank"),
        (F.col("first_sequence") + F.floor(q / each)).alias("sequence_id"),
        (F.col("first_offset") + q % each * F.col("length")).alias("offset"),
    )


def pack(docs: DataFrame, vocabulary: str | None = None, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """Place every piece of every document in a sequence of at most ``capacity`` ids.

    Returns doc_id, piece, start, length, ids_crc32, sequence_id, offset.
    """
    spark = docs.sparkSession
    found = materialize(pieces(docs, vocabulary or default_vocabulary(), capacity, end_id), "pieces")
    histogram = found.groupBy("length").agg(F.count("*").alias("n")).collect()  # at most ``capacity`` rows
    counts = {r["length"]: r["n"] for r in histogram}
    placed = ranked(found, counts, capacity).join(slots(spark, plan(counts, capacity)).hint("merge"), ["length", "rank"])
    return placed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
