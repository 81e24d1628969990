"""Cohort assembly, probe selection, batch correction, gene roll-up, scaling and splitting."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from betaloom.catalog.fixtures import Fixtures
from betaloom.catalog.matrix_queries import CELL, rounded
from betaloom.catalog.registry import query
from betaloom.operators import cohort as co
from betaloom.operators import combat
from betaloom.operators import split as sp
from betaloom.operators.quality import SAMPLE
from betaloom.plans import batch_report
from betaloom.plans import cohort as plan
from betaloom.settings import CohortOptions, PLATFORM_PRIORITY
from betaloom.tables import materialize

FRACTIONS = (0.60, 0.20, 0.20)
REGIONS = ("TSS200", "TSS1500")


@query("F1", "SELECT project_id, sample_id, probe_id, round(value, 6) AS value FROM co_matrix")
def cohort_matrix(fx: Fixtures) -> DataFrame:
    cohort = co.cohort_aggregation(fx.prepared.values, fx.prepared.probes, fx.prepared.meta)
    return rounded(cohort.select(*CELL, "value"), "value")


@query("F1", """
SELECT probe_id FROM fx_beta GROUP BY probe_id HAVING count(DISTINCT project_id) = (SELECT count(*) FROM fx_projects)""")
def common_probes(fx: Fixtures) -> DataFrame:
    return co.common_probes(fx.beta, fx.projects)


@query("F2", f"""
SELECT coalesce(arg_min(platform, CASE platform WHEN '{PLATFORM_PRIORITY[0]}' THEN 1 WHEN '{PLATFORM_PRIORITY[1]}' THEN 2 ELSE 3 END), '{PLATFORM_PRIORITY[2]}') AS platform
FROM fx_projects""")
def cohort_platform(fx: Fixtures) -> DataFrame:
    return co.resolve_platform(fx.projects)


@query("F3", """
SELECT 'pancancer' AS cohort_id, 'Illumina Methylation Epic' AS platform, 'GRCh38' AS reference_genome, 'beta_value' AS conversion,
       'cpg_matrix' AS data_type, 'raw' AS state, p.project_id AS entry, p.platform AS entry_platform
FROM fx_projects p""")
def cohort_metadata(fx: Fixtures) -> DataFrame:
    row = co.cohort_row(fx.meta, "pancancer")
    entries = row.select("cohort_id", "platform", "reference_genome", "conversion", "data_type", "state", F.explode("projects").alias("entry", "own"))
    return entries.withColumn("entry_platform", F.col("own.platform")).drop("own")


@query("F3", """
SELECT unnest(['reference_genome', 'data_type', 'conversion']) AS field, unnest([genomes, CAST(1 AS BIGINT), conversions]) AS distinct_values
FROM (SELECT count(DISTINCT CASE WHEN ordinal % 4 = 1 THEN 'GRCh37' ELSE 'GRCh38' END) AS genomes,
             count(DISTINCT CASE ordinal % 3 WHEN 0 THEN 'm_value' WHEN 1 THEN 'beta_value' ELSE 'other' END) AS conversions FROM fx_projects)""")
def mixed_fields(fx: Fixtures) -> DataFrame:
    """Projects of two genome builds and three conversions."""
    kind = F.when(F.col("ordinal") % 3 == 0, "m_value").when(F.col("ordinal") % 3 == 1, "beta_value").otherwise("other")
    build = F.when(F.col("ordinal") % 4 == 1, "GRCh37").otherwise("GRCh38")
    return co.mixed_fields(fx.meta.withColumns({"conversion": kind, "reference_genome": build}))


@query("F4", "SELECT probe_id, round(mad(value), 6) AS mad_score FROM fx_m GROUP BY probe_id")
def mad_scores(fx: Fixtures) -> DataFrame:
    return rounded(co.mad_scores(fx.mvals), "mad_score")


@query("F4", "SELECT probe_id, round(mad(value), 6) AS mad_score FROM fx_m GROUP BY probe_id")
def mad_scores_narrowing(fx: Fixtures) -> DataFrame:
    """The path large groups take: no group is gathered."""
    return rounded(co.mad_scores(materialize(fx.mvals, "matrix"), small_group=50), "mad_score")


@query("F5", """
SELECT probe_id, round(mad(value), 6) AS mad_score FROM fx_m GROUP BY probe_id HAVING mad(value) > 0
ORDER BY mad(value) DESC, probe_id LIMIT 20""")
def top_variable_probes(fx: Fixtures) -> DataFrame:
    return rounded(co.top_probes(co.mad_scores(fx.mvals), 20), "mad_score")


FULL = "coalesce(batch_id, 'None')"
BATCH = f"""CASE WHEN (SELECT min(n) FROM (SELECT count(*) AS n FROM fx_batched GROUP BY {FULL})) > 1 THEN {FULL}
     WHEN (SELECT min(n) FROM (SELECT count(*) AS n FROM fx_batched GROUP BY split_part({FULL}, '-', 1))) > 1 THEN split_part({FULL}, '-', 1)
     ELSE array_to_string(string_split({FULL}, '-')[1:2], '-') END"""


@query("F6", f"SELECT project_id, sample_id, {BATCH} AS batch FROM fx_batched")
def batch_labels(fx: Fixtures) -> DataFrame:
    return combat.batch_labels(fx.batched).select(*SAMPLE, "batch")


@query("F6", """
SELECT coalesce(batch_id, 'None') AS batch, count(*) AS n, count(*) = 1 AS singleton FROM fx_batched GROUP BY 1""")
def batch_sizes(fx: Fixtures) -> DataFrame:
    sizes = fx.batched.groupBy(F.coalesce("batch_id", F.lit("None")).alias("batch")).agg(F.count("*").alias("n"))
    return sizes.withColumn("singleton", F.col("n") == 1)


@query("F7", "SELECT project_id, count(*) - count(value) AS missing, count(*) AS cells FROM co_matrix GROUP BY project_id")
def correction_preconditions(fx: Fixtures) -> DataFrame:
    cohort = plan.aggregate_cohort(fx.prepared, "pancancer")
    combat.check_preconditions(cohort.values, cohort.samples, "m_value", "batch_id", ("project_id",))
    missing = F.count("*") - F.count("value")
    return cohort.values.groupBy("project_id").agg(missing.alias("missing"), F.count("*").alias("cells"))


@query("F8", "SELECT project_id, sample_id, probe_id, round(value, 6) AS value FROM cb_corrected")
def batch_corrected(fx: Fixtures) -> DataFrame:
    cohort = plan.aggregate_cohort(fx.prepared, "pancancer")
    return rounded(combat.batch_correction(cohort.values, cohort.samples), "value")


GENES = """
SELECT probe_id, unnest(string_split(gene_symbol, ';')) AS gene_symbol FROM fx_annotation
WHERE (TSS200 OR TSS1500) AND gene_symbol IS NOT NULL"""


@query("F9", f"SELECT probe_id, gene_symbol, count(*) AS weight FROM ({GENES}) GROUP BY probe_id, gene_symbol")
def gene_map(fx: Fixtures) -> DataFrame:
    return co.gene_map(fx.annotation, REGIONS)


@query("F9", f"SELECT probe_id, gene_symbol, CAST(1 AS BIGINT) AS weight FROM ({GENES}) GROUP BY probe_id, gene_symbol")
def gene_map_distinct(fx: Fixtures) -> DataFrame:
    return co.gene_map(fx.annotation, REGIONS, distinct_genes=True)


@query("F10", f"""
SELECT project_id, sample_id, gene_symbol, round(avg(value), 6) AS value FROM fx_m JOIN ({GENES}) USING (probe_id)
GROUP BY project_id, sample_id, gene_symbol""")
def gene_means(fx: Fixtures) -> DataFrame:
    return rounded(co.gene_aggregation(fx.mvals, co.gene_map(fx.annotation, REGIONS)), "value")


BOUNDS = "SELECT quantile_cont(value, 0.01) AS lo, quantile_cont(value, 0.99) AS hi FROM fx_m"


@query("F11", f"""
SELECT project_id, sample_id, probe_id, round(CASE WHEN value IS NULL THEN NULL ELSE least(greatest(value, lo), hi) END, 6) AS value
FROM fx_m CROSS JOIN ({BOUNDS})""")
def winsorized(fx: Fixtures) -> DataFrame:
    values = materialize(fx.mvals, "matrix")
    return rounded(co.winsorize(values, *co.winsor_bounds(values)).select(*CELL, "value"), "value")


@query("F11", f"SELECT project_id, count(*) FILTER (value < lo) AS below, count(*) FILTER (value > hi) AS above, round(any_value(lo), 6) AS lo, round(any_value(hi), 6) AS hi FROM fx_m CROSS JOIN ({BOUNDS}) GROUP BY project_id")
def winsor_bounds_narrowing(fx: Fixtures) -> DataFrame:
    """Whole-matrix quantiles on the path a large matrix takes."""
    from betaloom.functions.quantiles import global_quantiles

    values = materialize(fx.mvals, "matrix")
    lo, hi = global_quantiles(values, "value", (0.01, 0.99), small_group=200)
    return values.groupBy("project_id").agg(
        F.count_if(F.col("value") < lo).alias("below"), F.count_if(F.col("value") > hi).alias("above"),
        F.round(F.lit(lo), 6).alias("lo"), F.round(F.lit(hi), 6).alias("hi"),
    )


@query("F12", f"""
SELECT project_id, sample_id, probe_id,
       round(CASE WHEN value IS NULL THEN NULL ELSE 2 * ((least(greatest(value, lo), hi) - lo) / (hi - lo)) - 1 END, 6) AS value
FROM fx_m CROSS JOIN ({BOUNDS})""")
def scaled_matrix(fx: Fixtures) -> DataFrame:
    values, _ = co.clip_and_scale(materialize(fx.mvals, "matrix"))
    return rounded(values.select(*CELL, "value"), "value")


@query("F13", """
SELECT project_id, file_name, name AS sample_id,
       CAST(name AS VARCHAR) || CASE WHEN rn > 1 THEN '-' || (rn - 1) ELSE '' END AS sample_name
FROM (SELECT *, row_number() OVER (PARTITION BY name ORDER BY project_id, file_name) AS rn
      FROM (SELECT project_id, file_name, sample_id // 3 AS name FROM fx_samples))""")
def unique_sample_names(fx: Fixtures) -> DataFrame:
    shared = fx.samples.select("project_id", "file_name", F.floor(F.col("sample_id") / 3).alias("sample_id"))
    return co.unique_names(shared)


def split_sql(samples: str) -> str:
    """Two draws with largest-remainder quotas over ``samples(project_id, sample_id)``."""
    return f"""
SELECT s.project_id, s.sample_id, CASE WHEN rn <= n_test THEN 'test' WHEN rn <= n_test + n_validation THEN 'validation' ELSE 'training' END AS split
FROM (SELECT project_id, sample_id, row_number() OVER (PARTITION BY project_id ORDER BY md5('42:' || sample_id), CAST(sample_id AS VARCHAR)) AS rn FROM {samples}) s
JOIN (
  SELECT project_id, n_test, n_rest - (n_rest * stay // total
           + CASE WHEN row_number() OVER (ORDER BY n_rest * stay % total DESC, project_id) <= stay - sum(n_rest * stay // total) OVER () THEN 1 ELSE 0 END) AS n_validation
  FROM (SELECT *, CAST(sum(n_rest) OVER () AS BIGINT) AS total, CAST(sum(n_rest) OVER () AS BIGINT) - CAST(ceil(CAST(0.2 AS DOUBLE) * sum(n_rest) OVER ()) AS BIGINT) AS stay
        FROM (SELECT project_id, n_test, n - n_test AS n_rest
              FROM (SELECT project_id, n, n - (n * stay // total
                             + CASE WHEN row_number() OVER (ORDER BY n * stay % total DESC, project_id) <= stay - sum(n * stay // total) OVER () THEN 1 ELSE 0 END) AS n_test
                    FROM (SELECT *, CAST(sum(n) OVER () AS BIGINT) AS total, CAST(sum(n) OVER () AS BIGINT) - CAST(ceil(CAST(0.2 AS DOUBLE) * sum(n) OVER ()) AS BIGINT) AS stay
                          FROM (SELECT project_id, count(*) AS n FROM {samples} GROUP BY project_id)))))) q USING (project_id)"""


@query("F14", split_sql("fx_samples"))
def stratified_split(fx: Fixtures) -> DataFrame:
    return sp.split(fx.samples.select(*SAMPLE), FRACTIONS).select(*SAMPLE, "split")


@query("F15", f"""
SELECT split, CAST(CASE split WHEN 'training' THEN 0.6 ELSE 0.2 END AS DOUBLE) AS split_percentage, count(*) AS n_samples,
       round(count(*) / (SELECT count(*) FROM fx_samples), 6) AS actual_percentage
FROM ({split_sql("fx_samples")}) GROUP BY split""")
def split_sizes(fx: Fixtures) -> DataFrame:
    return rounded(sp.split_summary(sp.split(fx.samples.select(*SAMPLE), FRACTIONS)), "actual_percentage")


@query("F16", f"""
SELECT m.project_id, m.sample_id, m.probe_id, round(2 * ((least(greatest(value, lo), hi) - lo) / (hi - lo)) - 1, 6) AS value, split
FROM co_selected m CROSS JOIN (SELECT quantile_cont(value, 0.01) AS lo, quantile_cont(value, 0.99) AS hi FROM co_selected)
JOIN ({split_sql("co_survivors")}) USING (project_id, sample_id)""")
def prepare_cohort(fx: Fixtures) -> DataFrame:
    done = plan.prepare_cohort(fx.prepared, options=CohortOptions(top_n=12))
    placed = done.values.join(done.samples.select(*SAMPLE, "split"), SAMPLE)
    return rounded(placed.select(*CELL, "value", "split"), "value")


@query("F10 F12 F14 F16", f"""
SELECT g.project_id, g.sample_id, gene_symbol, round(2 * ((least(greatest(value, lo), hi) - lo) / (hi - lo)) - 1, 6) AS value, split
FROM co_genes g CROSS JOIN (SELECT quantile_cont(value, 0.01) AS lo, quantile_cont(value, 0.99) AS hi FROM co_genes)
JOIN ({split_sql("co_survivors")}) USING (project_id, sample_id)""")
def prepare_gene_cohort(fx: Fixtures) -> DataFrame:
    options = CohortOptions(mad_probe_filtering=False, gene_aggregation=True)
    done = plan.prepare_cohort(fx.prepared, annotation=fx.annotation, options=options)
    placed = done.values.join(done.samples.select(*SAMPLE, "split"), SAMPLE)
    return rounded(placed.select(*SAMPLE, F.col("probe_id").alias("gene_symbol"), "value", "split"), "value")


@query("F8 G1 G2 G3 G4 G5", """
SELECT 'before' AS stage, factor, round(between / total, 6) AS fraction FROM pc_before_shares CROSS JOIN pc_before_total
UNION ALL
SELECT 'after', factor, round(between / total, 6) FROM pc_after_shares CROSS JOIN pc_after_total""")
def batch_report_before_after(fx: Fixtures) -> DataFrame:
    cohort = plan.aggregate_cohort(fx.prepared, "pancancer")
    values = materialize(cohort.values, "matrix")
    return rounded(batch_report.explain_batch(values, cohort.samples), "fraction")
