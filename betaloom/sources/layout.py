"""A matrix stored by probe, so that what works per probe needs no exchange of it.

The table is bucketed and sorted on ``probe_id``: Spark knows that all cells of a probe lie in one bucket. Probe statistics aggregate where the
cells are, and joins with tables of one row per probe (verdicts, imputation values, correction factors, medians) move only those tables. Writing it
shuffles the matrix once; every bucket is one file.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from betaloom.tables import checkpoint_root

#: Cells that one bucket should hold: some hundred megabytes.
CELLS_A_BUCKET = 20_000_000


def buckets_for(cells: int, least: int = 1) -> int:
    return max(least, -(-cells // CELLS_A_BUCKET))


def by_probe(values: DataFrame, path: str | None = None, buckets: int | None = None) -> DataFrame:
    """Write the matrix by probe and return a scan of it.

    The number of buckets follows from the cells unless given. The table is known to this session's catalog under a name of its own; ``path``
    defaults to a new folder beside the checkpoints.
    """
    spark: SparkSession = values.sparkSession
    buckets = buckets_for(values.count(), spark.sparkContext.defaultParallelism) if buckets is None else buckets
    name = f"by_probe_{uuid.uuid4().hex}"
    path = path or f"{checkpoint_root(spark)}/betaloom/{name}"
    dealt = values.repartition(buckets, F.col("probe_id")).sortWithinPartitions("probe_id")
    dealt.write.bucketBy(buckets, "probe_id").sortBy("probe_id").option("path", path).option("compression", "zstd").saveAsTable(name)
    return spark.table(name)
