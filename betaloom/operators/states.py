"""Statistics as stored states (count, mean, sum of squared deviations) that merge when samples arrive.

A batch of files gives one state per sample and per probe. States of one key merge exactly as one count over all
cells would give them (up to rounding): counts add, means are weighted, squared deviations add up with those of the means. So a new batch is scanned once and
no stored cell again.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from betaloom.operators.quality import PROBE, SAMPLE
from betaloom.sources import ledger

STATE = ("n_cells", "n_present", "mean", "squares")


def state(values: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows, values present, their mean and their squared deviations from it, per key."""
    squares = F.var_pop("value") * F.count("value")
    return values.groupBy(*keys).agg(F.count("*").alias("n_cells"), F.count("value").alias("n_present"), F.avg("value").alias("mean"), squares.alias("squares"))


def merged(states: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One state per key from any number of them. A key has one state per batch, which one task adds up."""
    own = W.partitionBy(*keys)
    mean = F.sum(F.col("n_present") * F.col("mean")).over(own) / F.sum(F.when(F.col("n_present") > 0, F.col("n_present"))).over(own)
    apart = states.withColumn("_mean", mean)
    shift = F.col("n_present") * (F.col("mean") - F.col("_mean")) ** 2
    return apart.groupBy(*keys).agg(
        F.sum("n_cells").alias("n_cells"), F.sum("n_present").alias("n_present"), F.first("_mean").alias("mean"), F.sum(F.col("squares") + shift).alias("squares")
    )


def sample_stats(states: DataFrame, counts: DataFrame) -> DataFrame:
    """``quality.sample_stats`` from merged sample states and the probes per project."""
    rate = (F.col("n_probes") - F.col("n_present")) / F.col("n_probes")
    return states.join(counts, "project_id").select(*SAMPLE, "n_present", "n_probes", rate.alias("missing_rate"), "mean")


def probe_stats(states: DataFrame, counts: DataFrame) -> DataFrame:
    """``quality.probe_stats`` from merged probe states and the samples per project."""
    rate = (F.col("n_samples") - F.col("n_present")) / F.col("n_samples")
    variance = F.try_divide(F.col("squares"), F.col("n_present"))
    return states.join(counts, "project_id").select(*PROBE, "n_present", "n_samples", rate.alias("missing_rate"), "mean", variance.alias("variance"))


_FIELDS = {
    "samples": T.StructType([T.StructField("sample_id", T.StringType())]),
    "probes": T.StructType([T.StructField("probe_id", T.StringType())]),
}
_STATE = [T.StructField(c, T.LongType()) for c in STATE[:2]] + [T.StructField(c, T.DoubleType()) for c in STATE[2:]]
_KEYS = {"samples": SAMPLE, "probes": PROBE}


def add_states(values: DataFrame, path: str, batch: str) -> None:
    """Write the states of one batch of cells below ``path``; a batch that is there already adds nothing."""
    spark = values.sparkSession
    for kind, keys in _KEYS.items():
        folder = f"{path}/{kind}"
        if batch not in ledger.published(spark, folder):
            ledger.write_batch(state(values.withColumns({k: F.col(k).cast("string") for k in keys}), keys), folder, batch)
            ledger.commit(spark, folder, batch)


def read_states(spark: SparkSession, path: str, kind: str, projects: list[str] | None = None) -> DataFrame:
    """Merged states of all published batches: ``kind`` is ``samples`` or ``probes``."""
    fields = T.StructType([*_FIELDS[kind].fields, *_STATE])
    return merged(ledger.stored_rows(spark, f"{path}/{kind}", fields, projects), _KEYS[kind])
