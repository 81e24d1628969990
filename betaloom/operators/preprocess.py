"""Variance filter, mean imputation and M-values."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from betaloom.functions.columns import m_value
from betaloom.operators.quality import PROBE
from betaloom.settings import EPSILON, ProjectOptions


def variance_filter(options: ProjectOptions = ProjectOptions()) -> Column:
    """Condition on probe statistics: enough variance, mean inside the range, all inclusive.

    Under the default ``propagate`` policy a probe with any missing value fails, because its
    variance is undefined; ``skip`` judges the values that are present.
    """
    if options.na_policy not in ("propagate", "skip"):
        raise ValueError(f"na_policy must be 'propagate' or 'skip', not {options.na_policy!r}")
    informative = (F.col("variance") >= options.min_variance) & F.col("mean").between(options.min_mean, options.max_mean)
    if options.na_policy == "propagate":
        informative = informative & (F.col("n_present") == F.col("n_samples"))
    return informative


def filter_variance(stats: DataFrame, options: ProjectOptions = ProjectOptions()) -> DataFrame:
    return stats.where(variance_filter(options))


def imputation_table(stats: DataFrame) -> DataFrame:
    """Per probe the share of cells to fill and the mean that fills them."""
    return stats.select(*PROBE, F.col("missing_rate").alias("frac_imputed"), F.col("mean").alias("impute_value"))


def impute(dense: DataFrame, table: DataFrame) -> DataFrame:
    """Fill missing cells with the probe mean; a probe without any value stays missing.

    ``dense`` needs a row for every cell that is to be filled (see ``matrix.densify``).
    """
    filled = F.coalesce("value", "impute_value")
    return dense.join(table.select(*PROBE, "impute_value"), PROBE, "left").select(
        "project_id", "sample_id", "probe_id", filled.alias("value")
    )


def convert_to_mval(values: DataFrame, epsilon: float = EPSILON) -> DataFrame:
    return values.withColumn("value", m_value(F.col("value"), epsilon))
