"""Download attempts as an append-only log, and the state of each file folded from it.

A row ``(file_id, attempt, status, timestamp)`` says what one attempt gave for one file. Several rows may speak of the same attempt: a failed
request and the success that was noted for the whole request. A failure wins over a success of the same attempt, a later
attempt over an earlier one. The fold is one keyed aggregation whose result depends neither on the order of the rows nor on their
being logged twice, so the log may be replayed or written again after a failure.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from betaloom.operators.control import initialize_audit_table

FAILED, SUCCESS = "failed", "success"


def fold_attempts(log: DataFrame) -> DataFrame:
    """(file_id, status, attempts, timestamp): the last state of each file in the log and how often it was tried."""
    failed = F.col("status") != SUCCESS
    last = F.max(F.struct(F.col("attempt").cast("int").alias("attempt"), F.coalesce(failed, F.lit(True)).alias("failed"), "timestamp")).alias("last")
    folded = log.where("file_id IS NOT NULL AND attempt IS NOT NULL").groupBy("file_id").agg(last)
    status = F.when(F.col("last.failed"), FAILED).otherwise(SUCCESS)
    return folded.select("file_id", status.alias("status"), F.col("last.attempt").alias("attempts"), F.col("last.timestamp").alias("timestamp"))


def next_attempts(manifest: DataFrame, log: DataFrame, landed: DataFrame, timestamp: Column, failed: DataFrame | None = None) -> DataFrame:
    """Log rows of one more attempt at every manifest file whose last state isn't a success.

    ``landed`` lists the files that exist now, raw or stored; ``failed`` those whose request failed, which wins.
    """
    state = fold_attempts(log).select("file_id", F.col("status").alias("_status"), "attempts")
    marks = landed.select("file_id").distinct().withColumn("_landed", F.lit(True))
    tried = manifest.join(state, "file_id", "left").where(F.coalesce(F.col("_status") != SUCCESS, F.lit(True))).join(marks, "file_id", "left")
    good = F.coalesce("_landed", F.lit(False))
    if failed is not None:
        tried = tried.join(failed.select("file_id").distinct().withColumn("_failed", F.lit(True)), "file_id", "left")
        good = good & F.col("_failed").isNull()
    return tried.select(
        "file_id", (F.coalesce("attempts", F.lit(0)) + 1).alias("attempt"), F.when(good, SUCCESS).otherwise(FAILED).alias("status"), timestamp.alias("timestamp")
    )


def status_log(manifest: DataFrame, log: DataFrame) -> DataFrame:
    """The status log of a manifest; files that were never tried have failed with no attempt."""
    state = manifest.join(fold_attempts(log), "file_id", "left")
    return state.select("file_id", "file_name", F.coalesce("status", F.lit(FAILED)).alias("status"), F.coalesce("attempts", F.lit(0)).alias("attempts"), "timestamp")


def still_pending(manifest: DataFrame, log: DataFrame) -> DataFrame:
    """Manifest rows whose last state isn't a success."""
    done = fold_attempts(log).where(F.col("status") == SUCCESS)
    return manifest.join(done, "file_id", "left_anti")


def audit_of_attempts(manifest: DataFrame, log: DataFrame) -> DataFrame:
    """A fresh audit table with each file's own attempts."""
    return initialize_audit_table(manifest, status_log(manifest, log))
