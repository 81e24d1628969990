"""Stage boundaries: small derived tables written once and read back.

A table that several later stages need (sample statistics, probe verdicts, correction
factors) is written as Parquet under the shared checkpoint folder. Reading it back cuts the
lineage, survives the loss of an executor, and gives the planner a real size, so the choice
between broadcasting and shuffling it rests on what was written and not on a guess.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_local_roots: dict[str, str] = {}


def checkpoint_root(spark: SparkSession) -> str:
    """The folder the session names in ``spark.checkpoint.dir``."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    if context.applicationId not in _local_roots:
        _local_roots[context.applicationId] = tempfile.mkdtemp(prefix="betaloom-")
    return _local_roots[context.applicationId]


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the checkpoint folder and return a scan of what was written."""
    spark = df.sparkSession
    folder = f"{checkpoint_root(spark)}/betaloom/{spark.sparkContext.applicationId}"
    path = f"{folder}/{label}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def spread(df: DataFrame, bound: DataFrame | None = None) -> DataFrame:
    """``df`` as a join partner that is shuffled, not broadcast, if its rows may take more memory than the session broadcasts.

    The planner takes a stored table's bytes on disk for its size. Columns of few values are stored in a hundredth of what they take in memory, so
    a table of a row per file, sample or probe would be gathered on the driver long after it outgrew that. Rows are counted, in the footers of
    a stored table; ``bound`` may be a stored table of about as many.
    """
    most = df.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    width = df._jdf.schema().defaultSize() + 8 * (len(df.columns) + 1)
    return df.hint("merge") if 0 <= most < (df if bound is None else bound).count() * width else df
