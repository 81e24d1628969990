"""Near-duplicate documents by bottom-k sketches of their word shingles.

Every shingle is hashed by one hash function, and the k least values of a document are its sketch.
Documents with equal sets are one class from the start. A document puts itself on the inverted
lists of its rarest retained values: two documents as alike as asked share c of their k retained values but
with a chance of 1e-8, so they meet on a list among the first k - c + 1 values by frequency, and
passages that many documents share are not listed. Members of a list are compared by the size of
their sketches' overlap against the sketch of the union; what passes joins a cluster. Clusters are
tight, each member's full set is sent to its cluster, and exact Jaccard similarity decides. Long lists and large clusters
are linked through pivots first (``blocks.edges_within``), so that near copies cost a few rows each.

Words are runs of anything but ASCII white space, after A-Z are lower-cased. A text with fewer words
than a shingle is one shingle. Null texts, empty ones and those without words have no shingle and are linked with
nothing. Rows with equal texts belong together, also if they share an id; null ids are never the
name of a component unless all its ids are null. An empty table gives no rows. Only ``doc_id`` and
``text`` are read.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from betaloom.llm.blocks import BLOCK, components, edges_within, overlaps, stars
from betaloom.llm.tokens import SpanHash, code_points, mix64, text_batches, tidy
from betaloom.tables import materialize

SKETCH = 48
CHANCE = 1e-8

SKETCHES = "doc_id string, class binary, n_shingles long, sketch array<long>"
SETS = "class binary, cluster binary, many long, shingles array<long>"

_spans: list[SpanHash] = []


def shingle_sets(texts: list[str], width: int) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    if not _spans:
        _spans.append(SpanHash())
    for batch in text_batches(texts):
        codes = code_points(" ".join(batch)).copy()
        codes[(codes >= 65) & (codes <= 90)] += 32
        inside = np.zeros(len(codes) + 2, np.int8)
        inside[1:-1] = ~((codes == 32) | ((codes >= 9) & (codes <= 13)))
        turn = np.diff(inside)
        starts, ends = np.flatnonzero(turn == 1), np.flatnonzero(turn == -1)
        words = _spans[0](codes, starts, ends)
        lengths = np.fromiter((len(t) + 1 for t in batch), np.int64, len(batch))
        bounds = np.searchsorted(starts, np.concatenate([[0], np.cumsum(lengths)]))
        with np.errstate(over="ignore"):
            rolled = [words]
            for k in range(1, width):
                rolled.append(mix64(rolled[-1][:-1] * np.uint64(0x9E3779B97F4A7C15) + words[k:]) if len(words) > k else words[:0])
        for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
            size = min(width, b - a)
            yield np.unique(rolled[size - 1][a : b - size + 1]) if size else words[:0]


def release_spans() -> None:
    """Drop the hash's tables after a task: some 50 MB that an idle worker would keep."""
    _spans.clear()


def class_of(shingles: np.ndarray) -> bytes | None:
    return hashlib.md5(shingles.tobytes(), usedforsecurity=False).digest() if len(shingles) else None


def sketches(docs: DataFrame, width: int, k: int) -> DataFrame:
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            sets = shingle_sets([t if isinstance(t, str) else "" for t in frame["text"]], width)
            rows = [(class_of(s), len(s), s[:k].view(np.int64)) for s in sets]
            out = pd.DataFrame(rows, columns=["class", "n_shingles", "sketch"])
            out.insert(0, "doc_id", frame["doc_id"].to_numpy())
            yield out
        release_spans()

    # ids go as strings: pandas would make a column with nulls a float
    found = docs.select(F.col("doc_id").cast("string").alias("doc_id"), "text").mapInPandas(tidy(run), SKETCHES)
    return found.withColumn("doc_id", F.col("doc_id").cast("long"))


def least_overlap(k: int, similarity: float, chance: float = CHANCE) -> int:
    """Retained values that two documents of this similarity share at least, but for this chance."""
    below, c = 0.0, 0
    while (below := below + math.comb(k, c) * similarity**c * (1 - similarity) ** (k - c)) <= chance:
        c += 1
    return max(1, c)


def listed(classes: DataFrame, k: int, c: int) -> DataFrame:
    """(value, class): the rarest retained values of each class that others retain too."""
    size = F.size("sketch")
    values = classes.select("class", size.alias("m"), F.explode("sketch").alias("value"))
    frequent = values.groupBy("value").agg(F.count("*").alias("f")).where("f > 1")
    common = values.join(frequent, "value").groupBy("class", "m").agg(F.collect_list(F.struct("f", "value")).alias("held"))
    needed = [m - max(1, m * c // k) + 1 for m in range(k + 1)]
    # values that no other class retains come first and need no list
    take = F.greatest(F.lit(0), F.get(F.lit(needed), F.col("m")) - (F.col("m") - F.size("held")))
    return common.select("class", F.explode(F.slice(F.array_sort("held"), F.lit(1), take)).alias("s")).select("s.value", "class")


def distinct_lists(lists: DataFrame) -> DataFrame:
    """(value, n): lists of two or more members, one of those with the same members."""
    marks = [F.expr(f"bit_xor(xxhash64(class, {seed}))").alias(f"mark{seed}") for seed in (1, 2)]
    sizes = lists.groupBy("value").agg(F.count("*").alias("n"), *marks).where("n > 1")
    return sizes.groupBy("n", "mark1", "mark2").agg(F.min("value").alias("value")).select("value", "n")


def _edges(frame: pd.DataFrame, linked: np.ndarray) -> pd.DataFrame | None:
    pairs = stars(linked, frame["class"].to_numpy())
    return pd.DataFrame(pairs, columns=["a", "b"]) if pairs else None


def _read_twice(rows: DataFrame, largest: int, label: str) -> DataFrame:
    """Rows of groups, written if there are large groups: those are read apart, which would make every row twice."""
    return materialize(rows, label) if largest > BLOCK else rows


def groups(docs: DataFrame, width: int = 5, share: tuple[int, int] = (80, 100), k: int = SKETCH) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept.

    Two documents are linked if intersection / union of their shingle sets is at least ``share``
    (numerator, denominator); ``component_id`` is the least id reachable by links.
    """
    part, whole = share
    c = least_overlap(k, part / whole)
    held = materialize(sketches(docs, width, k), "sketches")
    classes = held.where("class IS NOT NULL").groupBy("class").agg(
        F.min("doc_id").alias("first_id"), F.first("n_shingles").alias("n_shingles"), F.first("sketch").alias("sketch")
    )
    classes = materialize(classes, "classes")
    lists = materialize(listed(classes, k, c), "lists")

    def alike(frame: pd.DataFrame) -> pd.DataFrame | None:
        own, m = overlaps(list(frame["sketch"])), np.array([len(s) for s in frame["sketch"]])
        n = frame["n_shingles"].to_numpy()
        union = np.minimum(k, m[:, None] + m - own)
        near = np.minimum(n[:, None], n) * whole >= part * np.maximum(n[:, None], n)
        return _edges(frame, near & (own > 0) & (own * k >= c * union))

    chosen = materialize(distinct_lists(lists), "list-sizes")

    longest = chosen.agg(F.max("n")).first()[0] or 0
    on_lists = lists.join(chosen, "value").join(classes.select("class", "n_shingles", "sketch"), "class")
    on_lists = _read_twice(on_lists, longest, "on-lists")
    clusters = components(edges_within(on_lists.where, "value", "n", ["n_shingles", "sketch"], alike, longest))
    clusters = materialize(clusters, "clusters")

    sizes = materialize(clusters.groupBy("root").agg(F.count("*").alias("many")), "cluster-sizes")
    members = clusters.join(sizes, "root").select(F.col("node").alias("class"), F.col("root").alias("cluster"), "many")
    members = members.join(classes.select("class", "first_id"), "class")

    def full(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            sets = list(shingle_sets([t if isinstance(t, str) else "" for t in frame["text"]], width))
            own = np.array([class_of(s) == name for s, name in zip(sets, frame["class"], strict=True)], bool)
            out = frame.loc[own, ["class", "cluster", "many"]].copy()
            out["shingles"] = [s.view(np.int64) for s, keep in zip(sets, own, strict=True) if keep]
            yield out
        release_spans()

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    texts = texts.join(members, texts["doc_id"].eqNullSafe(members["first_id"])).select("class", "cluster", "many", "text")

    def same(frame: pd.DataFrame) -> pd.DataFrame | None:
        sets = list(frame["shingles"])
        own, n = overlaps(sets), np.array([len(s) for s in sets])
        return _edges(frame, (own > 0) & (own * whole >= part * (n[:, None] + n - own)))

    widest = sizes.agg(F.max("many")).first()[0] or 0
    in_clusters = _read_twice(texts.mapInPandas(tidy(full), SETS), widest, "full-sets")
    found = components(edges_within(in_clusters.where, "cluster", "many", ["shingles"], same, widest))

    named = classes.join(found, classes["class"] == found["node"], "left")
    named = named.select("class", F.coalesce("root", "class").alias("root"), "first_id")
    least = named.groupBy("root").agg(F.min("first_id").alias("component_id"))
    named = materialize(named.join(least, "root").select("class", "component_id"), "named")
    alone = F.when(F.col("class").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    out = held.select("doc_id", "class", "n_shingles").join(named, "class", "left")
    out = out.select("doc_id", "n_shingles", alone.alias("component_id"))
    return out.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
