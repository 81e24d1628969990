"""Diagnostics of the matrix and of batch effects."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from betaloom.catalog.fixtures import Fixtures
from betaloom.catalog.matrix_queries import CELL, rounded
from betaloom.catalog.prelude import dispersion_sql
from betaloom.catalog.registry import query
from betaloom.functions.columns import portion
from betaloom.operators import diagnostics as dg
from betaloom.operators import quality as qc
from betaloom.tables import materialize

@query("G1", f"""
SELECT probe_id, round(mean, 6) AS mean, round(dispersion, 6) AS dispersion, bin, round(score, 6) AS score
FROM ({dispersion_sql("fx_m")}) WHERE score IS NOT NULL ORDER BY score DESC, probe_id LIMIT 25""")
def highly_variable_probes(fx: Fixtures) -> DataFrame:
    return rounded(dg.highly_variable(fx.mvals, 25), "mean", "dispersion", "score")


@query("G2", """
SELECT project_id, sample_id, probe_id, round(CASE WHEN value IS NULL THEN NULL ELSE least(greatest((value - center) / spread, -10), 10) END, 6) AS value
FROM fx_m JOIN (SELECT probe_id, avg(value) AS center, stddev_samp(value) AS spread FROM fx_m GROUP BY probe_id) USING (probe_id)""")
def standardized(fx: Fixtures) -> DataFrame:
    return rounded(dg.standardize(fx.mvals).select(*CELL, "value"), "value")


COMPONENTS = ", ".join(f"round(max(score) FILTER (k = {i}), 6) AS PC{i}" for i in range(1, 11))


@query("G3", f"SELECT project_id, sample_id, {COMPONENTS} FROM pc_plain_scores GROUP BY project_id, sample_id")
def principal_components(fx: Fixtures) -> DataFrame:
    from betaloom.plans.cohort import aggregate_cohort

    scores = dg.principal_components(dg.standardize(aggregate_cohort(fx.prepared, "pancancer").values))
    return rounded(scores, *[f"PC{i}" for i in range(1, 11)])


@query("G4", """
SELECT sample_id, batch_id, split_part(batch_id, '-', 1) AS portion FROM fx_batched""")
def portions(fx: Fixtures) -> DataFrame:
    return fx.batched.select("sample_id", "batch_id", portion(F.col("batch_id")).alias("portion"))


def _fraction(factor: str) -> str:
    return f"""
SELECT '{factor}' AS factor, round((SELECT var_samp(a) + var_samp(b) FROM (SELECT avg(mean) AS a, avg(missing_rate) AS b FROM gs_scores WHERE {factor} IS NOT NULL GROUP BY {factor}))
  / (var_samp(mean) + var_samp(missing_rate)), 6) AS fraction FROM gs_scores"""


@query("G5", f"{_fraction('project_id')} UNION ALL {_fraction('portion')}")
def variance_by_factor(fx: Fixtures) -> DataFrame:
    scores = qc.sample_stats(fx.beta).join(fx.batched.select(*qc.SAMPLE, "batch_id"), qc.SAMPLE)
    scores = materialize(scores.withColumn("portion", portion(F.col("batch_id"))), "scores")
    parts = [dg.fraction_variance(scores, ["mean", "missing_rate"], f) for f in ("project_id", "portion")]
    return rounded(parts[0].unionByName(parts[1]), "fraction")


BOX = "round({k}({v}, 0.25), 6) AS q1, round({k}({v}, 0.5), 6) AS median, round({k}({v}, 0.75), 6) AS q3, round(min({v}), 6) AS min, round(max({v}), 6) AS max, count({v}) AS n"


@query("G6", f"SELECT portion, {BOX.format(k='quantile_cont', v='mean')} FROM gs_scores WHERE portion IS NOT NULL GROUP BY portion")
def distribution_by_portion(fx: Fixtures) -> DataFrame:
    means = fx.beta.groupBy(*qc.SAMPLE).agg(F.avg("value").alias("mean"))
    batches = fx.batched.where(F.col("batch_id").isNotNull()).select(*qc.SAMPLE, portion(F.col("batch_id")).alias("portion"))
    return rounded(dg.distribution(means.join(batches, qc.SAMPLE), ["portion"], "mean"), "q1", "median", "q3", "min", "max")


@query("G7", """
SELECT b AS bin, round(lo + b * (hi - lo) / 100, 6) AS low, round(lo + (b + 1) * (hi - lo) / 100, 6) AS high, count(value) AS n
FROM (SELECT CAST(unnest(range(100)) AS INTEGER) AS b, lo, hi FROM (SELECT min(value) AS lo, max(value) AS hi FROM fx_beta))
LEFT JOIN (SELECT value, CAST(least(floor((value - (SELECT min(value) FROM fx_beta)) / ((SELECT max(value) FROM fx_beta) - (SELECT min(value) FROM fx_beta)) * 100), 99) AS INTEGER) AS b
           FROM fx_beta WHERE value IS NOT NULL) USING (b) GROUP BY b, lo, hi""")
def value_histogram(fx: Fixtures) -> DataFrame:
    return rounded(dg.histogram(fx.beta), "low", "high")


@query("G8", f"SELECT project_id, {BOX.format(k='quantile_cont', v='mean')} FROM qc_stats GROUP BY project_id")
def sample_mean_distribution(fx: Fixtures) -> DataFrame:
    means = fx.beta.groupBy(*qc.SAMPLE).agg(F.avg("value").alias("mean"))
    return rounded(dg.distribution(means, ["project_id"], "mean"), "q1", "median", "q3", "min", "max")


@query("G9", """
SELECT count(DISTINCT sample_id) AS n_samples, count(DISTINCT probe_id) AS n_probes, round(min(value), 6) AS min, round(max(value), 6) AS max,
       count(DISTINCT sample_id) * count(DISTINCT probe_id) - count(value) AS n_missing FROM fx_beta""")
def integrity_summary(fx: Fixtures) -> DataFrame:
    return rounded(dg.integrity(fx.beta), "min", "max")
