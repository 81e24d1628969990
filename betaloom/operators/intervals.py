"""Genomic intervals (1-based, closed): liftover, flanks, set difference, overlap classes."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from betaloom.functions.running import running_totals
from betaloom.tables import materialize

BIN = 10_000
SALTS = 8
SWEEP_BIN = 1_000_000
CONTEXTS = ("OpenSea", "Island", "Shore", "Shelf")


def containing(points: DataFrame, intervals: DataFrame, bin_width: int = BIN, salts: int = SALTS) -> DataFrame:
    """Pairs of a point and an interval of the same chromosome that contains it.

    Intervals are listed in every ``bin_width`` bin they touch, so the join is an equi-join with
    a range test. The (small) interval side is repeated per salt, which spreads the points of a
    crowded bin over ``salts`` keys.
    """
    bins = F.sequence(F.floor(F.col("start") / bin_width), F.floor(F.col("end") / bin_width))
    listed = intervals.withColumn("_bin", F.explode(bins)).withColumn(
        "_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))
    )
    placed = points.withColumn("_bin", F.floor(F.col("pos") / bin_width)).withColumn(
        "_salt", F.pmod(F.xxhash64("probe_id"), F.lit(salts)).cast("int")
    )
    matched = placed.join(listed, ["chr", "_bin", "_salt"])
    return matched.where(F.col("pos").between(F.col("start"), F.col("end"))).drop("_bin", "_salt")


def segment_starts(points: DataFrame, intervals: DataFrame, bin_width: int = BIN) -> DataFrame:
    """(chr, pos, segment) of each distinct position: the lower end of the longest run of its bin around it that no interval begins or ends in.

    The positions of a segment lie in the same intervals. A bin has at most ``bin_width`` positions and as many ends, so sorting one is bounded.
    """
    ends = F.array(F.col("start").cast("long"), (F.col("end") + 1).cast("long"))
    marks = intervals.select("chr", F.explode(ends).alias("pos")).distinct().withColumn("place", F.lit(False))
    places = points.where("chr IS NOT NULL AND pos IS NOT NULL").select("chr", F.col("pos").cast("long").alias("pos")).distinct()
    both = marks.unionByName(places.withColumn("place", F.lit(True))).withColumn("_bin", F.floor(F.col("pos") / bin_width))
    up_to = W.partitionBy("chr", "_bin").orderBy("pos", "place").rowsBetween(W.unboundedPreceding, 0)
    latest = F.max(F.when(~F.col("place"), F.col("pos"))).over(up_to)
    return both.withColumn("segment", F.coalesce(latest, F.col("_bin") * bin_width)).where("place").select("chr", "pos", "segment")


def liftover(points: DataFrame, chain: DataFrame) -> DataFrame:
    """Positions mapped through chain blocks; a point outside every block is dropped, a point in
    several blocks is mapped several times."""
    forward = F.col("to_start") + (F.col("pos") - F.col("start"))
    backward = F.col("to_start") + (F.col("end") - F.col("pos"))
    reverse = F.col("to_strand") == "-"
    mapped = containing(points, chain)
    columns = ["probe_id", F.col("to_chr").alias("chr"), F.when(reverse, backward).otherwise(forward).alias("pos")]
    if "strand" in points.columns:
        flipped = F.when(F.col("strand") == "+", "-").when(F.col("strand") == "-", "+").otherwise(F.col("strand"))
        columns.append(F.when(reverse, flipped).otherwise(F.col("strand")).alias("strand"))
    return mapped.select(*columns)


def uniquely_mapped(lifted: DataFrame) -> DataFrame:
    """Probes with exactly one mapping. Counting combines before the shuffle, so a probe with
    very many mappings costs one row per task."""
    columns = [c for c in lifted.columns if c != "probe_id"]
    one = lifted.groupBy("probe_id").agg(F.count("*").alias("_n"), *[F.any_value(c).alias(c) for c in columns])
    return one.where(F.col("_n") == 1).select(*lifted.columns)


def join_lifted(annotation: DataFrame, lifted: DataFrame, source: str = "hg19", target: str = "hg38") -> DataFrame:
    """Annotation rows that were lifted, with both coordinates under the builds' prefixes."""
    places = [c for c in ("chr", "pos", "strand") if c in annotation.columns and c in lifted.columns]
    left = annotation.withColumnsRenamed({c: f"{source}_{c}" for c in places})
    right = lifted.select("probe_id", *[F.col(c).alias(f"{target}_{c}") for c in places])
    return left.join(right, "probe_id")


def liftover_annotation(annotation: DataFrame, chain: DataFrame) -> DataFrame:
    columns = [c for c in ("probe_id", "chr", "pos", "strand") if c in annotation.columns]
    return join_lifted(annotation, uniquely_mapped(liftover(annotation.select(*columns), chain)))


def flank(intervals: DataFrame, width: int, both_ends: bool = False) -> DataFrame:
    """``width`` positions on either side of each start; with ``both_ends`` around the end as well."""
    starts = intervals.select("chr", (F.col("start") - width).alias("start"), (F.col("start") + (width - 1)).alias("end"))
    if not both_ends:
        return starts
    ends = intervals.select("chr", (F.col("end") - (width - 1)).alias("start"), (F.col("end") + width).alias("end"))
    return starts.unionByName(ends)


def _edges(intervals: DataFrame, side: str, keys: Sequence[str]) -> DataFrame:
    """+1 where an interval starts, -1 just after it ends, counted for one side of the difference."""
    marks = F.array(
        F.struct(F.col("start").cast("long").alias("pos"), F.lit(1).alias("step")),
        F.struct((F.col("end") + 1).cast("long").alias("pos"), F.lit(-1).alias("step")),
    )
    edges = intervals.select(*keys, F.inline(marks))
    sides = {s: (F.col("step") if s == side else F.lit(0)).cast("long").alias(s) for s in ("keep", "drop")}
    return edges.select(*keys, "pos", *sides.values())


def difference(a: DataFrame, b: DataFrame | None = None, keys: Sequence[str] = ("chr",)) -> DataFrame:
    """Maximal intervals covered by ``a`` and not by ``b``, for each value of ``keys``; without ``b`` the merged ``a``.

    A sweep over interval ends: equal positions are summed first, coverage is a running total
    whose sort never spans more than ``SWEEP_BIN`` positions, and positions where membership
    changes pair up into intervals.
    """
    edges = _edges(a, "keep", keys)
    if b is not None:
        edges = edges.unionByName(_edges(b, "drop", keys))
    steps = edges.groupBy(*keys, "pos").agg(F.sum("keep").alias("keep"), F.sum("drop").alias("drop"))
    region = F.floor(F.col("pos") / SWEEP_BIN)
    swept = running_totals(steps, keys, region, ["pos"], {"kept": F.col("keep"), "dropped": F.col("drop")})
    now = (F.col("kept") > 0) & (F.col("dropped") == 0)
    before = (F.col("kept") - F.col("keep") > 0) & (F.col("dropped") - F.col("drop") == 0)
    changes = materialize(swept.where(now != before).select(*keys, "pos", now.cast("long").alias("opens")), "sweep")
    numbered = running_totals(changes, keys, region, ["pos"], {"piece": F.col("opens")})
    pieces = numbered.groupBy(*keys, "piece").agg(F.min("pos").alias("start"), (F.max("pos") - 1).alias("end"))
    return pieces.select(*keys, "start", "end")


def shores_and_shelves(islands: DataFrame, both_ends: bool = False) -> tuple[DataFrame, DataFrame]:
    """Shores: 2000 around islands without them. Shelves: 4000 around, without islands and shores."""
    bare = islands.select("chr", F.col("start").cast("long").alias("start"), F.col("end").cast("long").alias("end"))
    shores = materialize(difference(flank(bare, 2_000, both_ends), bare), "shores")
    shelves = difference(flank(bare, 4_000, both_ends), bare.unionByName(shores))
    return shores, shelves


def overlap_class(points: DataFrame, classes: list[tuple[str, DataFrame]], default: str = "OpenSea") -> DataFrame:
    """Class per point; of several classes the last listed wins, no overlap gives ``default``."""
    labels = [default, *[label for label, _ in classes]]
    ranked = [
        intervals.select("chr", "start", "end", F.lit(rank).alias("rank"))
        for rank, (_, intervals) in enumerate(classes, start=1)
    ]
    hits = containing(points, reduce(DataFrame.unionByName, ranked)).select("probe_id", "rank")
    every = points.select("probe_id", F.lit(0).alias("rank")).unionByName(hits)
    best = every.groupBy("probe_id").agg(F.max("rank").alias("rank"))
    names = F.array(*[F.lit(label) for label in labels])
    return best.select("probe_id", F.get(names, F.col("rank")).alias("context"))


def island_context(points: DataFrame, islands: DataFrame, both_ends: bool = False) -> DataFrame:
    shores, shelves = shores_and_shelves(islands, both_ends)
    merged = difference(islands)
    return overlap_class(points, list(zip(CONTEXTS[1:], (merged, shores, shelves))), CONTEXTS[0])
