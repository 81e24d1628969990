"""Token ids written as packed matrices: best-fit decreasing with a segment tree over the room left.

Each task takes its documents in blocks of about ``BLOCK_IDS`` ids, so memory is bounded, and packs a
block by itself, so no text or id is shuffled. Documents longer than a row are cut into whole rows and a
rest, and lose nothing: the pieces of a document in order are its ids with the end id. Lengths go from long to
short; for each piece the tree finds the least room that still takes it. Every row of the output is one sequence: its ids
(little-endian unsigned 16-bit integers, filled up with the end id), cumulative segment lengths and the position of
each id in its segment, which starts again at every segment.

A null or empty text is the end id alone. Repeated rows are packed each on its own. An empty table gives no rows. Only
``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from betaloom.llm.tokens import default_vocabulary, encoded

CAPACITY = 2048
END_ID = 50256
BLOCK_IDS = 4_000_000

ROWS = (
    "ids binary, n_ids int, cu_seqlens array<int>, positions binary, "
    "segments array<struct<doc_id:bigint,piece:int,start:bigint,length:int,offset:int>>"
)


class RoomTree:
    """For each room from 0 to ``capacity`` the sequences that have it, under a tree that counts them."""

    def __init__(self, capacity: int):
        self.leaves = 1 << capacity.bit_length()
        self.count = [0] * (2 * self.leaves)
        self.held: list[list[int]] = [[] for _ in range(capacity + 1)]

    def _add(self, room: int, by: int) -> None:
        node = self.leaves + room
        while node:
            self.count[node] += by
            node >>= 1

    def put(self, room: int, sequence: int) -> None:
        self.held[room].append(sequence)
        self._add(room, 1)

    def take(self, length: int) -> tuple[int, int] | None:
        """(room, sequence) with the least room of at least ``length``."""
        node = self.leaves + length
        if not self.count[node]:
            while node > 1 and (node & 1 or not self.count[node + 1]):
                node >>= 1
            if node <= 1:
                return None
            node += 1
            while node < self.leaves:
                node = 2 * node if self.count[2 * node] else 2 * node + 1
        room = node - self.leaves
        self._add(room, -1)
        return room, self.held[room].pop()


def best_fit_decreasing(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Sequence and offset of every piece."""
    tree, sequences = RoomTree(capacity), 0
    sequence, offset = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    for i in np.argsort(-lengths, kind="stable").tolist():
        length = int(lengths[i])
        found = tree.take(length)
        if found is None:
            found = capacity, sequences
            sequences += 1
        room, sequence[i] = found
        offset[i] = capacity - room
        if room > length:
            tree.put(room - length, int(sequence[i]))
    return sequence, offset


def packed_block(keys: list, texts: list[np.ndarray], capacity: int, end_id: int) -> pd.DataFrame:
    """The rows of one block; ``texts`` are id arrays that end with the end id."""
    cuts = [(k, p, a, min(a + capacity, len(ids))) for k, ids in enumerate(texts) for p, a in enumerate(range(0, len(ids), capacity))]
    lengths = np.array([b - a for *_, a, b in cuts], np.int64)
    sequence, offset = best_fit_decreasing(lengths, capacity)
    order = np.lexsort((offset, sequence))
    rows = []
    for group in np.split(order, np.flatnonzero(np.diff(sequence[order])) + 1):
        ids, positions = np.full(capacity, end_id, "<u2"), np.zeros(capacity, "<u2")
        segments = []
        for i in group.tolist():
            k, p, a, b = cuts[i]
            at = int(offset[i])
            ids[at : at + b - a] = texts[k][a:b]
            positions[at : at + b - a] = np.arange(b - a)
            key = keys[k]
            segments.append({"doc_id": None if key is None else int(key), "piece": p, "start": a, "length": b - a, "offset": at})
        ends = np.cumsum([s["length"] for s in segments])
        rows.append((ids.tobytes(), int(ends[-1]), [0, *ends.tolist()], positions.tobytes(), segments))
    return pd.DataFrame(rows, columns=["ids", "n_ids", "cu_seqlens", "positions", "segments"])


def packed_rows(docs: DataFrame, vocabulary: str | None = None, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """One row per packed sequence: ids, n_ids (those not filled up), cu_seqlens, positions, segments."""
    path = vocabulary or default_vocabulary()
    if not 0 < capacity < 1 << 16:
        raise ValueError("positions are 16-bit integers")

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        keys, texts, size = [], [], 0
        for frame in frames:
            names = frame["doc_id"].tolist()
            for k, ids in encoded(frame["text"], path):
                if len(ids) and ids.max() >= 1 << 16:
                    raise ValueError("the vocabulary has ids beyond 16 bits")
                keys.append(names[k])
                texts.append(np.append(ids, end_id).astype("<u2"))
                size += len(texts[-1])
                if size >= BLOCK_IDS:
                    yield packed_block(keys, texts, capacity, end_id)
                    keys, texts, size = [], [], 0
        if texts:
            yield packed_block(keys, texts, capacity, end_id)

    # ids go as strings: pandas would make a column with nulls a float
    return docs.select(F.col("doc_id").cast("long").cast("string").alias("doc_id"), "text").mapInPandas(run, ROWS)


def write_packed(docs: DataFrame, path: str, **options) -> None:
    """Write the packed rows as Parquet, one matrix row to a record."""
    packed_rows(docs, **options).write.option("compression", "zstd").parquet(path)
