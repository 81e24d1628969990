"""Numbers behind the batch-effect and data-quality charts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from betaloom.functions.columns import clipped
from betaloom.functions.quantiles import grouped_quantiles
from betaloom.operators.components import principal_components  # noqa: F401
from betaloom.operators.quality import SAMPLE
from betaloom.tables import materialize


def dispersions(values: DataFrame, bins: int = 20) -> DataFrame:
    """Normalised dispersion per probe within bins of equal mean width.

    Values are taken as log1p data: moments are computed on expm1, the log dispersion is
    standardised inside ``bins`` right-closed bins of log1p mean. A bin with one probe gives it
    a score of 1. A probe whose dispersion has no logarithm gets no score.
    """
    raw = F.expm1("value")
    moments = values.groupBy("probe_id").agg(F.avg(raw).alias("mean"), F.var_samp(raw).alias("variance"))
    mean = F.when(F.col("mean") == 0, 1e-12).otherwise(F.col("mean"))
    ratio = F.try_divide("variance", mean)
    scored = moments.select(
        "probe_id", F.log1p(mean).alias("mean"), F.when(ratio > 0, F.log(ratio)).alias("dispersion")
    )
    scored = materialize(scored, "dispersions")
    ends = scored.agg(F.struct(F.min("mean").alias("lo"), F.max("mean").alias("hi")).alias("ends")).scalar()
    place = F.ceil(F.try_divide(F.col("mean") - ends["lo"], ends["hi"] - ends["lo"]) * bins)
    binned = scored.withColumn("bin", F.coalesce(F.greatest(place, F.lit(1)), F.lit(1)).cast("int"))
    per_bin = binned.groupBy("bin").agg(F.avg("dispersion").alias("center"), F.stddev_samp("dispersion").alias("spread"))
    center = F.when(F.col("spread").isNull(), 0.0).otherwise(F.col("center"))
    spread = F.coalesce("spread", "center")
    score = F.try_divide(F.col("dispersion") - center, spread)
    return binned.join(per_bin, "bin").select("probe_id", "mean", "dispersion", "bin", score.alias("score"))


def highly_variable(values: DataFrame, top_n: int = 5_000, bins: int = 20) -> DataFrame:
    """The ``top_n`` probes by normalised dispersion, ties by id."""
    scored = dispersions(values, bins).where(F.col("score").isNotNull())
    return scored.orderBy(F.desc("score"), "probe_id").limit(top_n)


def standardize(values: DataFrame, max_value: float = 10.0) -> DataFrame:
    """Zero mean and unit variance per probe, limited to ``max_value`` either side."""
    moments = values.groupBy("probe_id").agg(F.avg("value").alias("center"), F.stddev_samp("value").alias("spread"))
    spread = F.when(F.col("spread") > 0, F.col("spread")).otherwise(1.0)
    scaled = (F.col("value") - F.col("center")) / spread
    limited = clipped(scaled, F.lit(-max_value), F.lit(max_value))
    return values.join(moments, "probe_id").select(*SAMPLE, "probe_id", limited.alias("value"))


def fraction_variance(scores: DataFrame, columns: Sequence[str], factor: str) -> DataFrame:
    """Share of the columns' variance that lies between the (unweighted) means of the factor levels."""
    levels = scores.where(F.col(factor).isNotNull()).groupBy(factor).agg(*[F.avg(c).alias(c) for c in columns])
    between = levels.agg(sum((F.var_samp(c) for c in columns), F.lit(0.0))).scalar()
    overall = sum((F.var_samp(c) for c in columns), F.lit(0.0))
    return scores.agg(overall.alias("overall")).select(
        F.lit(factor).alias("factor"), (between / F.col("overall")).alias("fraction")
    )


def distribution(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Box-plot numbers per group: quartiles, ends and size."""
    keys = list(keys)
    quartiles = grouped_quantiles(df, keys, value, {"q1": 0.25, "median": 0.5, "q3": 0.75})
    ends = df.groupBy(*keys).agg(F.count(value).alias("n"), F.min(value).alias("min"), F.max(value).alias("max"))
    return ends.join(quartiles, keys)


def histogram(values: DataFrame, bins: int = 100, sample: int | None = None, seed: int = 42) -> DataFrame:
    """Counts in ``bins`` equal-width bins of the non-missing values, the last bin closed.

    All values are counted; ``sample`` restricts it to that many values drawn by seeded hash.
    """
    drawn = values.where(F.col("value").isNotNull())
    if sample is not None:
        drawn = drawn.orderBy(F.xxhash64(*SAMPLE, "probe_id", F.lit(seed)), *SAMPLE, "probe_id").limit(sample)
    drawn = drawn.select("value")
    ends = drawn.agg(F.min("value").alias("lo"), F.max("value").alias("hi"))
    flat = F.col("lo") == F.col("hi")
    ends = ends.select(F.when(flat, F.col("lo") - 0.5).otherwise(F.col("lo")).alias("lo"), F.when(flat, F.col("hi") + 0.5).otherwise(F.col("hi")).alias("hi"))
    span = ends.select(F.struct("lo", "hi")).scalar()
    place = F.floor((F.col("value") - span["lo"]) / (span["hi"] - span["lo"]) * bins)
    counts = drawn.groupBy(F.least(place, F.lit(bins - 1)).cast("int").alias("bin")).agg(F.count("*").alias("n"))
    step = (F.col("hi") - F.col("lo")) / bins
    frame = ends.select("lo", step.alias("step"), F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    return frame.join(counts, "bin", "left").select(
        "bin",
        (F.col("lo") + F.col("bin") * F.col("step")).alias("low"),
        (F.col("lo") + (F.col("bin") + 1) * F.col("step")).alias("high"),
        F.coalesce("n", F.lit(0)).alias("n"),
    )


def integrity(values: DataFrame) -> DataFrame:
    """Matrix size, value range and missing cells, absent rows included."""
    found = values.agg(
        F.countDistinct(*SAMPLE).alias("n_samples"),
        F.countDistinct("probe_id").alias("n_probes"),
        F.min("value").alias("min"),
        F.max("value").alias("max"),
        F.count("value").alias("present"),
    )
    missing = F.col("n_samples") * F.col("n_probes") - F.col("present")
    return found.select("n_samples", "n_probes", "min", "max", missing.alias("n_missing"))
