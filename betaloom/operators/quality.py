"""Sample and probe quality control on the long matrix.

Every statistic is a partial aggregation over the matrix; every removal is a semi-join with a
table of one row per sample or per probe. The matrix itself is never pivoted or sorted.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from betaloom.functions.quantiles import grouped_quantiles
from betaloom.settings import ProjectOptions
from betaloom.tables import materialize

SAMPLE = ["project_id", "sample_id"]
PROBE = ["project_id", "probe_id"]


def probe_counts(values: DataFrame) -> DataFrame:
    """Probes in each project's matrix, the denominator of a sample's missing rate."""
    return values.select(*PROBE).distinct().groupBy("project_id").agg(F.count("*").alias("n_probes"))


def sample_counts(samples: DataFrame) -> DataFrame:
    """Samples per project, the denominator of a probe's missing rate."""
    return samples.select(*SAMPLE).distinct().groupBy("project_id").agg(F.count("*").alias("n_samples"))


def sample_stats(values: DataFrame, counts: DataFrame | None = None) -> DataFrame:
    """Missing rate and mean per sample. Absent cells count as missing.

    ``counts`` may name the probes per project when they are known (an array manifest), which
    saves the distinct pass. The counts are stored before they meet the samples, so that their
    real size decides the join and a large project need not be one join key.
    """
    counts = materialize(probe_counts(values) if counts is None else counts, "probe-counts")
    per_sample = values.groupBy(*SAMPLE).agg(F.count("value").alias("n_present"), F.avg("value").alias("mean"))
    rate = (F.col("n_probes") - F.col("n_present")) / F.col("n_probes")
    return per_sample.join(counts, "project_id").select(*SAMPLE, "n_present", "n_probes", rate.alias("missing_rate"), "mean")


def iqr_bounds(df: DataFrame, keys: list[str], value: str, k: float = 1.5) -> DataFrame:
    """Quartiles and the fences ``k`` interquartile ranges outside them, per key."""
    quartiles = grouped_quantiles(df, keys, value, {"q1": 0.25, "q3": 0.75})
    reach = F.lit(k) * (F.col("q3") - F.col("q1"))
    return quartiles.select(*keys, "q1", "q3", (F.col("q1") - reach).alias("low"), (F.col("q3") + reach).alias("high"))


def sample_verdicts(stats: DataFrame, missing_threshold: float = 0.20, outlier_threshold: float = 1.5) -> DataFrame:
    """Sample QC: too many missing cells, or a mean outside the project's fences.

    The fences come from all samples, failing ones included. A sample without any value has
    no mean and is not an outlier.
    """
    fences = iqr_bounds(stats, ["project_id"], "mean", outlier_threshold)
    outside = (F.col("mean") < F.col("low")) | (F.col("mean") > F.col("high"))
    return (
        stats.join(fences, "project_id", "left")
        .withColumn("fail_missing", F.col("missing_rate") > missing_threshold)
        .withColumn("fail_mean", F.coalesce(outside, F.lit(False)))
        .withColumn("passed", ~(F.col("fail_missing") | F.col("fail_mean")))
        .select(*SAMPLE, "missing_rate", "mean", "fail_missing", "fail_mean", "passed")
    )


def keep_samples(df: DataFrame, kept: DataFrame) -> DataFrame:
    return df.join(kept.select(*SAMPLE), SAMPLE, "left_semi")


def align_to_annotation(df: DataFrame, annotation: DataFrame) -> DataFrame:
    """Drop probes the annotation does not know."""
    return df.join(annotation.select("probe_id"), "probe_id", "left_semi")


def is_standard_probe(probe: Column) -> Column:
    return probe.startswith("cg")


def flag_filter(options: ProjectOptions) -> Column:
    """Conjunction of the annotation filters that are switched on."""
    tests = []
    if options.remove_sex_chromosome:
        tests.append(~F.col("is_sex_chr"))
    if options.remove_snp_associated:
        tests += [~F.col(f) for f in ("has_cpg_snp", "has_sbe_snp", "has_probe_snp")]
    if options.remove_cross_reactive:
        tests.append(~F.col("is_cross_reactive"))
    if options.remove_multi_mapped:
        tests.append(~F.col("is_multi_mapped"))
    return reduce(lambda a, b: a & b, tests, F.lit(True))


def usable_probes(annotation: DataFrame, options: ProjectOptions = ProjectOptions()) -> DataFrame:
    """Annotated standard probes that no active filter removes: the part of probe QC that
    needs no matrix, applied to the scan before anything is shuffled."""
    return annotation.where(is_standard_probe(F.col("probe_id")) & flag_filter(options)).select("probe_id")


def probe_stats(values: DataFrame, counts: DataFrame) -> DataFrame:
    """One pass over the matrix gives all per-probe numbers QC and preprocessing need."""
    per_probe = values.groupBy(*PROBE).agg(
        F.count("value").alias("n_present"), F.avg("value").alias("mean"), F.var_pop("value").alias("variance")
    )
    rate = (F.col("n_samples") - F.col("n_present")) / F.col("n_samples")
    return per_probe.join(counts, "project_id").select(
        *PROBE, "n_present", "n_samples", rate.alias("missing_rate"), "mean", "variance"
    )


def probe_verdicts(stats: DataFrame, annotation: DataFrame, options: ProjectOptions = ProjectOptions()) -> DataFrame:
    """Probe QC for the annotated standard probes, with each test's outcome."""
    flags = annotation.where(is_standard_probe(F.col("probe_id"))).select(
        "probe_id", flag_filter(options).alias("keep_annotation")
    )
    return (
        stats.join(flags, "probe_id")
        .withColumn("keep_missing", F.col("missing_rate") <= options.probe_missing_threshold)
        .withColumn("passed", F.col("keep_missing") & F.col("keep_annotation"))
        .select(*stats.columns, "keep_missing", "keep_annotation", "passed")
    )


def keep_probes(df: DataFrame, kept: DataFrame) -> DataFrame:
    return df.join(kept.select(*PROBE), PROBE, "left_semi")
