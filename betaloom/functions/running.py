"""Running totals over a long ordered group without sorting the group on one task."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from betaloom.tables import materialize

# low bits of a monotonically increasing id, which count inside a partition
RANGE_BITS = 33


def running_totals(
    df: DataFrame,
    keys: Sequence[str],
    bucket: Column,
    order: Sequence[str],
    totals: Mapping[str, Column],
) -> DataFrame:
    """Add inclusive running sums per ``keys`` in the order ``(bucket, *order)``.

    ``bucket`` must be non-decreasing in the wanted order. Buckets are summed first (with
    partial aggregation), their offsets accumulate over one row per bucket, and rows are
    sorted only inside their own bucket. Null keys are one group, a null bucket comes first.
    """
    keys = list(keys)
    staged = df.withColumn("_bucket", bucket)
    for i, amount in enumerate(totals.values()):
        staged = staged.withColumn(f"_amount{i}", amount)
    earlier = W.partitionBy(*keys).orderBy("_bucket").rowsBetween(W.unboundedPreceding, -1)
    sums = [F.sum(f"_amount{i}").alias(f"_sum{i}") for i in range(len(totals))]
    offsets = staged.groupBy(*keys, "_bucket").agg(*sums)
    own = [*keys, "_bucket"]
    offsets = offsets.select(
        *[F.col(c).alias(f"_own{i}") for i, c in enumerate(own)],
        *[F.coalesce(F.sum(f"_sum{i}").over(earlier), F.lit(0)).alias(f"_base{i}") for i in range(len(totals))],
    )
    inside = W.partitionBy(*keys, "_bucket").orderBy(*order).rowsBetween(W.unboundedPreceding, 0)
    running = [
        (F.col(f"_base{i}") + F.sum(f"_amount{i}").over(inside)).alias(name) for i, name in enumerate(totals)
    ]
    same = reduce(and_, [F.col(c).eqNullSafe(F.col(f"_own{i}")) for i, c in enumerate(own)])
    return staged.join(offsets, same).select(*df.columns, *running)


def numbered(rows: DataFrame, order: Sequence[str], name: str) -> DataFrame:
    """Add ``name``: 0, 1, 2, ... in the order of columns whose values differ in every row.

    Rows are sorted by range; the ranges' sizes, one row each, give the offsets.
    """
    place = F.monotonically_increasing_id()
    sorted_rows = rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_place", place)
    placed = materialize(sorted_rows, "numbered").withColumn("_range", F.shiftright("_place", RANGE_BITS))
    sizes = placed.groupBy("_range").agg(F.count("*").alias("_size"))
    earlier = W.orderBy("_range").rowsBetween(W.unboundedPreceding, -1)
    offsets = sizes.select("_range", F.coalesce(F.sum("_size").over(earlier), F.lit(0)).alias("_base"))
    inside = F.col("_place").bitwiseAND(F.lit((1 << RANGE_BITS) - 1))
    return placed.join(offsets, "_range").select(*rows.columns, (F.col("_base") + inside).alias(name))


def hash_prefix(digest: Column, digits: int = 3) -> Column:
    """Leading hex digits: even buckets in digest order."""
    return F.substring(digest, 1, digits)
