"""Sources, matrix assembly, quality control and preprocessing."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from betaloom import schemas
from betaloom.catalog.fixtures import Fixtures
from betaloom.catalog.registry import query
from betaloom.dataset import Dataset
from betaloom.functions.columns import parsed_number
from betaloom.operators import control, matrix, states
from betaloom.operators import preprocess as prep
from betaloom.operators import quality as qc
from betaloom.plans import project
from betaloom.plans.workflow import ProjectInputs, prepare_project
from betaloom.settings import PLATFORMS, ManifestRequest, ProjectOptions
from betaloom.sources import annotation as an
from betaloom.sources import beta as store
from betaloom.sources import layout
from betaloom.sources.control import read_table, write_table
from betaloom.sources.matrix import load_datasets, save_dataset
from betaloom.tables import materialize, spread

CELL = ("project_id", "sample_id", "probe_id")


def rounded(df: DataFrame, *columns: str, digits: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in columns})


# --- A ---


def _write_raw_projects(fx: Fixtures) -> str:
    """Tab-separated files in one folder per project, missing values spelled NA."""
    path = fx.scratch("raw")
    fx.beta.select(
        F.col("project_id").alias("file_id"),
        F.col("probe_id").alias("Composite Element REF"),
        F.coalesce(F.col("value").cast("string"), F.lit("NA")).alias("Beta_value"),
    ).write.partitionBy("file_id").csv(path, sep="\t", header=True)
    return path


@query("A1 A2", """
SELECT project_id AS file_id, probe_id, round(value, 6) AS beta_value FROM fx_beta""")
def read_raw_beta(fx: Fixtures) -> DataFrame:
    rows = store.read_raw(fx.spark, _write_raw_projects(fx))
    return rounded(rows.select("file_id", "probe_id", "beta_value"), "beta_value")


@query("A2", """
SELECT vec_id, dim, round(CASE dim % 8 WHEN 0 THEN NULL WHEN 1 THEN NULL WHEN 2 THEN NULL WHEN 3 THEN NULL ELSE v END, 6) AS beta_value
FROM fx_cells""")
def numeric_coercion(fx: Fixtures) -> DataFrame:
    kind, number = F.col("dim") % 8, F.col("v").cast("string")
    text = (
        F.when(kind == 0, "NA").when(kind == 1, "NaN").when(kind == 2, F.concat(number, F.lit("f")))
        .when(kind == 3, "").when(kind == 4, F.concat(F.lit(" "), number, F.lit(" "))).otherwise(number)
    )
    return rounded(fx.cells.select("vec_id", "dim", parsed_number(text).alias("beta_value")), "beta_value")


@query("A3", """
SELECT project_id, 'F-' || sample_id AS file_id, probe_id, round(value, 6) AS beta_value FROM fx_beta""")
def beta_store(fx: Fixtures) -> DataFrame:
    path = fx.scratch("store")
    file_id = F.concat(F.lit("F-"), F.col("sample_id").cast("string")).alias("file_id")
    store.write_store(fx.beta.select("project_id", file_id, "probe_id", F.col("value").alias("beta_value")), path)
    rows = store.read_store(fx.spark, path).select("project_id", "file_id", "probe_id", "beta_value")
    return rounded(rows, "beta_value")


@query("A4", "SELECT * FROM fx_annotation")
def annotation_by_key(fx: Fixtures) -> DataFrame:
    path = fx.scratch("annotation")
    keyed = [
        fx.annotation.withColumns({"platform": F.lit(p), "reference_genome": F.lit("GRCh38")}) for p in PLATFORMS
    ]
    an.write_annotation(reduce(DataFrame.unionByName, keyed), path)
    return an.load_annotation(fx.spark, path, PLATFORMS[1], "GRCh38")


@query("A5", "SELECT * FROM fx_annotation")
def annotation_csv(fx: Fixtures) -> DataFrame:
    folder, target = fx.scratch("csv"), fx.scratch("parquet")
    fx.annotation.write.csv(folder, header=True, nullValue="NA")
    return an.csvs_to_parquet(fx.spark, folder, target, fx.annotation.schema).select(*fx.annotation.columns)


@query("A6", """
SELECT m.file_id, m.file_name, CAST(coalesce(s.status = 'success', false) AS INTEGER) AS downloaded, s.status AS download_status,
       CAST(s.attempts AS VARCHAR) AS download_attempts
FROM fx_manifest m LEFT JOIN fx_status s USING (file_id)""")
def control_table_files(fx: Fixtures) -> DataFrame:
    path = fx.scratch("audit")
    audit = control.initialize_audit_table(fx.manifest, fx.status_log)
    write_table(audit, path)
    rows = read_table(fx.spark, path, audit.schema)
    attempts = F.col("download_attempts").cast("string").alias("download_attempts")
    return rows.select("file_id", "file_name", "downloaded", "download_status", attempts)


@query("A7 A8", """
SELECT project_id, sample_id, probe_id, round(value, 6) AS value FROM fx_beta""")
def saved_projects(fx: Fixtures) -> DataFrame:
    paths = []
    for parity in (0, 1):
        own = fx.projects.where(F.col("ordinal") % 2 == parity).select("project_id")
        tables = [t.join(own, "project_id", "left_semi") for t in (fx.beta, fx.samples, fx.raw.probes, fx.meta)]
        paths.append(fx.scratch("project"))
        save_dataset(Dataset(*tables), paths[-1])
    return rounded(load_datasets(fx.spark, paths).values.select(*CELL, "value"), "value")


# --- C ---


@query("C1", """
SELECT b.project_id, b.sample_id, b.probe_id, round(b.value, 6) AS value
FROM fx_beta b JOIN fx_status s ON s.file_id = 'F-' || b.sample_id WHERE s.status = 'success'""")
def assemble_matrix(fx: Fixtures) -> DataFrame:
    number = F.substring_index("file_id", "-", -1).cast("long")
    files = fx.status_log.select(number.alias("file_id"), "status")
    ready = fx.samples.select(F.col("sample_id").alias("file_id"), "project_id").join(files, "file_id")
    beta = fx.beta.select(F.col("sample_id").alias("file_id"), "probe_id", F.col("value").alias("beta_value"))
    return rounded(matrix.assemble(beta, ready), "value")


@query("C2", """
SELECT s.project_id, s.sample_id, p.probe_id, round(b.value, 6) AS value
FROM fx_samples s JOIN fx_designs p USING (project_id)
LEFT JOIN fx_beta b ON b.project_id = s.project_id AND b.sample_id = s.sample_id AND b.probe_id = p.probe_id""")
def dense_matrix(fx: Fixtures) -> DataFrame:
    return rounded(matrix.densify(fx.beta, fx.samples, fx.designs), "value")


@query("C3", """
SELECT b.project_id, b.sample_id, b.probe_id, round(b.value, 6) AS value, s.submitter_id, s.aliquot_id
FROM fx_beta b JOIN fx_samples s USING (project_id, sample_id)""")
def matrix_with_metadata(fx: Fixtures) -> DataFrame:
    return rounded(matrix.attach_samples(fx.beta, fx.samples.select(*qc.SAMPLE, "submitter_id", "aliquot_id")), "value")


@query("C4", """
SELECT project_id, platform, 'GRCh38' AS reference_genome, 'project' AS level, 'cpg_matrix' AS data_type,
       'm_value' AS conversion, 'processed' AS state,
       'sample_qc,probe_qc,filter_variance,impute,convert_to_mval' AS steps
FROM fx_projects""")
def dataset_log(fx: Fixtures) -> DataFrame:
    meta = fx.prepared.meta
    columns = ("project_id", "platform", "reference_genome", "level", "data_type", "conversion", "state")
    return meta.select(*columns, F.concat_ws(",", "preprocessing_steps").alias("steps"))


@query("C5", """
SELECT sample_id, submitter_id, file_name FROM fx_samples
QUALIFY row_number() OVER (PARTITION BY submitter_id ORDER BY file_name, sample_id) = 1""")
def first_replicates(fx: Fixtures) -> DataFrame:
    return matrix.first_replicates(fx.samples.select("sample_id", "submitter_id", "file_name"))


@query("C6", """
SELECT project_id, sample_id, array_to_string(list(probe_id ORDER BY probe_id), ',') AS probes,
       count(*) AS width, round(sum(CAST(CAST(value AS FLOAT) AS DOUBLE)), 4) AS total,
       round(CAST(CAST(arg_min(value, probe_id) AS FLOAT) AS DOUBLE), 6) AS first_value
FROM pp_matrix GROUP BY project_id, sample_id""")
def packed_vectors(fx: Fixtures) -> DataFrame:
    rows = matrix.pack(fx.prepared.values)
    total = F.aggregate("vector", F.lit(0.0), lambda a, x: a + x.cast("double"))
    return rows.select(
        *qc.SAMPLE,
        F.concat_ws(",", "probe_ids").alias("probes"),
        F.size("vector").cast("long").alias("width"),
        F.round(total, 4).alias("total"),
        F.round(F.get("vector", 0).cast("double"), 6).alias("first_value"),
    )


@query("C6", """
SELECT project_id, sample_id, CAST(block AS INTEGER) AS block, string_agg(CASE WHEN value IS NULL THEN '0' ELSE '1' END, '' ORDER BY place) AS present,
       round(sum(coalesce(CAST(CAST(value AS FLOAT) AS DOUBLE), 0) * (place + 1)), 3) AS total
FROM (SELECT s.project_id, s.sample_id, i // 10 AS block, i % 10 AS place, b.value
      FROM fx_samples s CROSS JOIN (SELECT probe_id, row_number() OVER (ORDER BY probe_id) - 1 AS i FROM (SELECT DISTINCT probe_id FROM fx_beta)) d
      LEFT JOIN fx_beta b ON b.project_id = s.project_id AND b.sample_id = s.sample_id AND b.probe_id = d.probe_id)
GROUP BY project_id, sample_id, block""")
def aligned_blocks(fx: Fixtures) -> DataFrame:
    """Vectors in blocks of ten places: which are there, and their values by place."""
    rows = matrix.pack_blocks(fx.beta, fx.samples, matrix.probe_dictionary(fx.beta), 10)
    bits = F.array_join(F.transform(F.split(F.hex("present"), ""), lambda d: F.lpad(F.conv(d, 16, 2), 4, "0")), "")
    total = F.aggregate(F.transform("vector", lambda v, i: v.cast("double") * (i + 1)), F.lit(0.0), lambda a, v: a + v)
    return rows.select(*qc.SAMPLE, "block", F.substring(bits, 1, F.size("vector")).alias("present"), F.round(total, 3).alias("total"))


@query("C6", """
SELECT project_id, sample_id, probe_id, round(CAST(CAST(value AS FLOAT) AS DOUBLE), 5) AS value FROM fx_beta WHERE value IS NOT NULL""")
def unpacked_blocks(fx: Fixtures) -> DataFrame:
    dictionary = matrix.probe_dictionary(fx.beta)
    blocks = materialize(matrix.pack_blocks(fx.beta, fx.samples, dictionary, 16), "blocks")
    return rounded(matrix.unpack_blocks(blocks, dictionary, 16), "value", digits=5)


@query("A7 D7 E1", """
SELECT project_id, probe_id, count(value) AS n_present, round(avg(value), 6) AS mean, round(var_pop(value), 6) AS variance FROM fx_beta
WHERE probe_id IN (SELECT probe_id FROM fx_annotation WHERE starts_with(probe_id, 'cg') AND NOT (is_sex_chr OR has_cpg_snp OR has_sbe_snp OR has_probe_snp OR is_cross_reactive OR is_multi_mapped))
GROUP BY project_id, probe_id""")
def probe_statistics_in_place(fx: Fixtures) -> DataFrame:
    """Usable probes and their statistics from the matrix stored by probe: the matrix isn't exchanged."""
    values = qc.align_to_annotation(layout.by_probe(fx.beta), qc.usable_probes(fx.annotation))
    found = qc.probe_stats(values, qc.sample_counts(fx.samples))
    return rounded(found.select("project_id", "probe_id", "n_present", "mean", "variance"), "mean", "variance")


def _three_batches(fx: Fixtures) -> str:
    """States of uneven batches, as three deliveries of samples would leave them."""
    path = fx.scratch("states")
    kind = F.when(F.col("sample_id") % 10 == 0, 0).when(F.col("sample_id") % 10 < 4, 1).otherwise(2)
    for number in range(3):
        states.add_states(fx.beta.where(kind == number), path, f"delivery-{number}")
    return path


@query("D1 D2", """
SELECT project_id, CAST(sample_id AS VARCHAR) AS sample_id, n_present, n_probes, round(missing_rate, 6) AS missing_rate, round(mean, 6) AS mean FROM qc_stats""")
def merged_sample_states(fx: Fixtures) -> DataFrame:
    found = states.sample_stats(states.read_states(fx.spark, _three_batches(fx), "samples"), qc.probe_counts(fx.beta))
    return rounded(found, "missing_rate", "mean")


@query("D7 E1", """
SELECT b.project_id, probe_id, count(value) AS n_present, any_value(n) AS n_samples, round((any_value(n) - count(value)) / any_value(n), 6) AS missing_rate,
       round(avg(value), 6) AS mean, round(var_pop(value), 6) AS variance
FROM fx_beta b JOIN (SELECT project_id, count(*) AS n FROM fx_samples GROUP BY project_id) USING (project_id) GROUP BY b.project_id, probe_id""")
def merged_probe_states(fx: Fixtures) -> DataFrame:
    found = states.probe_stats(states.read_states(fx.spark, _three_batches(fx), "probes"), qc.sample_counts(fx.samples))
    return rounded(found, "missing_rate", "mean", "variance")


@query("C7", """
SELECT 'raw' AS stage, project_id, count(DISTINCT sample_id) AS n_samples, count(DISTINCT probe_id) AS n_probes FROM fx_beta GROUP BY project_id
UNION ALL
SELECT 'prepared', project_id, count(DISTINCT sample_id), count(DISTINCT probe_id) FROM pp_matrix GROUP BY project_id""")
def stage_shapes(fx: Fixtures) -> DataFrame:
    return matrix.shape(fx.beta, "raw").unionByName(matrix.shape(fx.prepared.values, "prepared"))


# --- D ---


@query("D1", "SELECT project_id, sample_id, n_present, n_probes, round(missing_rate, 6) AS missing_rate FROM qc_stats")
def sample_missing_rate(fx: Fixtures) -> DataFrame:
    return rounded(qc.sample_stats(fx.beta).drop("mean"), "missing_rate")


@query("D2", "SELECT project_id, sample_id, round(avg(value), 6) AS mean FROM fx_beta GROUP BY project_id, sample_id")
def sample_mean(fx: Fixtures) -> DataFrame:
    return rounded(qc.sample_stats(fx.beta).select(*qc.SAMPLE, "mean"), "mean")


@query("D3", """
SELECT project_id, round(q1, 6) AS q1, round(q3, 6) AS q3, round(low, 6) AS low, round(high, 6) AS high FROM qc_fences""")
def sample_mean_fences(fx: Fixtures) -> DataFrame:
    return rounded(qc.iqr_bounds(qc.sample_stats(fx.beta), ["project_id"], "mean"), "q1", "q3", "low", "high")


@query("D4", """
SELECT project_id, sample_id, round(missing_rate, 6) AS missing_rate, round(mean, 6) AS mean, fail_missing, fail_mean, passed FROM qc_samples""")
def sample_qc(fx: Fixtures) -> DataFrame:
    return rounded(qc.sample_verdicts(qc.sample_stats(fx.beta)), "missing_rate", "mean")


@query("D5", """
SELECT project_id, probe_id, count(*) AS cells FROM fx_beta
WHERE probe_id IN (SELECT probe_id FROM fx_annotation) GROUP BY project_id, probe_id""")
def annotated_probes(fx: Fixtures) -> DataFrame:
    return qc.align_to_annotation(fx.beta, fx.annotation).groupBy(*qc.PROBE).agg(F.count("*").alias("cells"))


@query("D6", """
SELECT project_id, probe_id, count(*) AS cells FROM fx_beta WHERE probe_id LIKE 'cg%' GROUP BY project_id, probe_id""")
def standard_probes(fx: Fixtures) -> DataFrame:
    return fx.beta.where(qc.is_standard_probe(F.col("probe_id"))).groupBy(*qc.PROBE).agg(F.count("*").alias("cells"))


@query("D7", """
SELECT b.project_id, probe_id, count(value) AS n_present, any_value(n) AS n_samples, round((any_value(n) - count(value)) / any_value(n), 6) AS missing_rate,
       (any_value(n) - count(value)) / any_value(n) <= 0.05 AS keep
FROM fx_beta b JOIN (SELECT project_id, count(*) AS n FROM fx_samples GROUP BY project_id) c USING (project_id)
GROUP BY b.project_id, probe_id""")
def probe_missing_rate(fx: Fixtures) -> DataFrame:
    stats = qc.probe_stats(fx.beta, qc.sample_counts(fx.samples))
    keep = F.col("missing_rate") <= ProjectOptions().probe_missing_threshold
    return stats.select(*qc.PROBE, "n_present", "n_samples", F.round("missing_rate", 6).alias("missing_rate"), keep.alias("keep"))


@query("D8", """
SELECT probe_id, NOT is_sex_chr AND NOT (has_cpg_snp OR has_sbe_snp OR has_probe_snp) AND NOT is_cross_reactive AND NOT is_multi_mapped AS keep_all,
       NOT is_sex_chr AND NOT is_multi_mapped AS keep_some
FROM fx_annotation""")
def annotation_filter(fx: Fixtures) -> DataFrame:
    some = ProjectOptions(remove_snp_associated=False, remove_cross_reactive=False)
    return fx.annotation.select("probe_id", qc.flag_filter(ProjectOptions()).alias("keep_all"), qc.flag_filter(some).alias("keep_some"))


@query("D9", """
SELECT project_id, probe_id, round(missing_rate, 6) AS missing_rate, missing_rate <= 0.05 AS keep_missing, keep_annotation,
       missing_rate <= 0.05 AND keep_annotation AS passed
FROM (SELECT b.project_id, probe_id, (any_value(n) - count(value)) / any_value(n) AS missing_rate
      FROM fx_beta b JOIN (SELECT project_id, count(*) AS n FROM fx_samples GROUP BY project_id) c USING (project_id)
      GROUP BY b.project_id, probe_id) JOIN qc_flags USING (probe_id)""")
def probe_qc(fx: Fixtures) -> DataFrame:
    stats = qc.probe_stats(fx.beta, qc.sample_counts(fx.samples))
    verdicts = qc.probe_verdicts(stats, fx.annotation)
    return rounded(verdicts.select(*qc.PROBE, "missing_rate", "keep_missing", "keep_annotation", "passed"), "missing_rate")


@query("D10", """
SELECT project_id, sample_id, probe_id, round(value, 6) AS value FROM qc_matrix""")
def quality_control(fx: Fixtures) -> DataFrame:
    ds, _ = project.quality_control(fx.raw, fx.annotation)
    return rounded(ds.values.select(*CELL, "value"), "value")


# --- E ---


@query("E1", """
SELECT project_id, probe_id, n_present, round(mean, 6) AS mean, round(variance, 6) AS variance
FROM qc_probes WHERE n_present = n_samples AND variance >= 0.0001 AND mean BETWEEN 0.01 AND 0.99""")
def filter_variance(fx: Fixtures) -> DataFrame:
    checked = project.sample_qc(fx.raw)
    stats = qc.probe_stats(checked.values, qc.sample_counts(checked.samples))
    kept = prep.filter_variance(stats).select(*qc.PROBE, "n_present", "mean", "variance")
    return rounded(kept, "mean", "variance")


@query("E1", """
SELECT b.project_id, probe_id, count(value) AS n_present, round(avg(value), 6) AS mean, round(var_pop(value), 6) AS variance
FROM fx_beta b GROUP BY b.project_id, probe_id
HAVING var_pop(value) >= 0.0001 AND avg(value) BETWEEN 0.01 AND 0.99""")
def filter_variance_skipping(fx: Fixtures) -> DataFrame:
    stats = qc.probe_stats(fx.beta, qc.sample_counts(fx.samples))
    kept = prep.filter_variance(stats, ProjectOptions(na_policy="skip")).select(*qc.PROBE, "n_present", "mean", "variance")
    return rounded(kept, "mean", "variance")


@query("E2", """
SELECT b.project_id, sample_id, probe_id, round(coalesce(value, impute_value), 6) AS value, round(frac_imputed, 6) AS frac_imputed
FROM fx_beta b JOIN (SELECT project_id, probe_id, avg(value) AS impute_value, 1 - count(value) / count(*) AS frac_imputed
                     FROM fx_beta GROUP BY project_id, probe_id) USING (project_id, probe_id)""")
def impute(fx: Fixtures) -> DataFrame:
    table = prep.imputation_table(qc.probe_stats(fx.beta, qc.sample_counts(fx.samples)))
    filled = prep.impute(fx.beta, table).join(table.select(*qc.PROBE, "frac_imputed"), qc.PROBE)
    return rounded(filled.select(*CELL, "value", "frac_imputed"), "value", "frac_imputed")


@query("E3", "SELECT project_id, sample_id, probe_id, round(value, 6) AS value FROM fx_m")
def m_values(fx: Fixtures) -> DataFrame:
    return rounded(prep.convert_to_mval(fx.beta), "value")


@query("E4", """
SELECT m.project_id, sample_id, m.probe_id, round(m.value, 6) AS value FROM fx_m m
JOIN (SELECT project_id, probe_id FROM fx_beta GROUP BY project_id, probe_id
      HAVING count(value) = count(*) AND var_pop(value) >= 0.0001 AND avg(value) BETWEEN 0.01 AND 0.99) USING (project_id, probe_id)""")
def preprocess(fx: Fixtures) -> DataFrame:
    return rounded(project.preprocess(fx.raw).values.select(*CELL, "value"), "value")


@query("E2 E4", """
SELECT b.project_id, b.sample_id, probe_id, round(log2(x / (1 - x)), 6) AS value
FROM (SELECT project_id, sample_id, probe_id, least(greatest(coalesce(value, mean), 0.001), 0.999) AS x
      FROM fx_beta JOIN (SELECT project_id, probe_id, avg(value) AS mean FROM fx_beta GROUP BY project_id, probe_id
                         HAVING var_pop(value) >= 0.0001 AND avg(value) BETWEEN 0.01 AND 0.99) USING (project_id, probe_id)) b""")
def preprocess_imputing(fx: Fixtures) -> DataFrame:
    done = project.preprocess(fx.raw, ProjectOptions(na_policy="skip"))
    return rounded(done.values.select(*CELL, "value"), "value")


@query("F17", """
SELECT project_id, sample_id, probe_id, round(value, 6) AS value FROM pp_matrix""")
def prepare_dataset(fx: Fixtures) -> DataFrame:
    ds, _ = project.prepare_dataset(fx.raw, fx.annotation)
    return rounded(ds.values.select(*CELL, "value"), "value")


@query("F17", """
SELECT project_id, probe_id, round(missing_rate, 6) AS missing_rate, round(mean, 6) AS mean, round(variance, 6) AS variance FROM pp_probes""")
def prepared_probes(fx: Fixtures) -> DataFrame:
    ds, _ = project.prepare_dataset(fx.raw, fx.annotation)
    return rounded(ds.probes.select(*qc.PROBE, "missing_rate", "mean", "variance"), "missing_rate", "mean", "variance")


# Small files cost by their number, not their bytes, so the tasks that write them aren't left to coalescing.
FILE_TASKS = 200
RAW_HEADER = "Composite Element REF\tBeta_value"


def _write_raw(cells: DataFrame, path: str) -> None:
    """A file ``<path>/file_id=<id>/beta.csv`` per sample, written by the tasks. Spark's writer takes some 25 ms a file and renames all from the driver;
    it remains for file systems that Arrow doesn't open."""
    from pyarrow import ArrowInvalid, ArrowNotImplementedError
    from pyarrow.fs import FileSystem

    dealt = cells.repartition(FILE_TASKS, "file_id")
    try:
        files, folder = FileSystem.from_uri(path)
        files.create_dir(folder)
    except (ArrowInvalid, ArrowNotImplementedError, OSError):
        renamed = dealt.select("file_id", F.col("probe_id").alias("Composite Element REF"), F.col("value").alias("Beta_value"))
        renamed.write.partitionBy("file_id").csv(path, sep="\t", header=True)
        return

    def write(rows) -> None:
        files, folder = FileSystem.from_uri(path)
        for row in rows:
            files.create_dir(f"{folder}/file_id={row.file_id}")
            with files.open_output_stream(f"{folder}/file_id={row.file_id}/beta.csv") as out:
                out.write(f"{RAW_HEADER}\n{row.text}\n".encode())

    line = F.concat_ws("\t", "probe_id", "value")
    dealt.groupBy("file_id").agg(F.concat_ws("\n", F.collect_list(line)).alias("text")).foreachPartition(write)


def _project_inputs(fx: Fixtures) -> ProjectInputs:
    """A raw folder with a file per sample, and the saved responses that name them."""
    path = fx.scratch("raw-project")
    _write_raw(fx.beta.select(F.col("sample_id").alias("file_id"), "probe_id", F.coalesce(F.col("value").cast("string"), F.lit("NA")).alias("value")), path)
    want = ManifestRequest(project_id="ALL")
    specimen = F.struct(F.lit(want.sample_type).alias("sample_type"), F.lit(None).cast(schemas._SAMPLE["portions"].dataType).alias("portions"))
    case = F.struct(
        F.concat(F.lit("CASE-"), F.col("file_id")).alias("submitter_id"), F.struct(F.lit("ALL").alias("project_id")).alias("project"), F.array(specimen).alias("samples")
    )
    fields = {c: F.lit(getattr(want, c)) for c in ("data_category", "experimental_strategy", "data_type", "platform", "access")}
    hits = store.raw_files(fx.spark, path).withColumns(
        {**fields, "reference_genome": F.lit("GRCh38"), "status": F.lit(None).cast("string"), "cases": F.array(case)}
    )
    hits = materialize(hits.select(*schemas.FILE_HIT.names), "hits")
    cases = fx.spark.createDataFrame([], schemas.CASE)
    return ProjectInputs(path, hits, cases, fx.annotation, want, "ALL", want.platform, "GRCh38", expected=hits.count())


@query("A1 B1 B3 B5 B6 B7 B8 B9 C1 D10 E4 F17", """
SELECT CAST(m.sample_id AS VARCHAR) AS sample_id, probe_id, round(value, 6) AS value, q.qc AS qc_pass
FROM one_pp_matrix m JOIN (SELECT sample_id, CAST(passed AS INTEGER) AS qc FROM one_qc_samples) q USING (sample_id)""")
def project_from_raw_files(fx: Fixtures) -> DataFrame:
    """One call from raw files and saved responses to the prepared matrix and its audit, run twice: the second run finds every step done."""
    run, inputs = fx.scratch("run"), _project_inputs(fx)
    prepare_project(fx.spark, run, inputs, timestamp=F.lit("2024-01-01 00:00:00").cast("timestamp"))
    ds, audit = prepare_project(fx.spark, run, inputs)
    values = ds.values.join(spread(audit.select(F.col("file_id").alias("sample_id"), "qc_pass")), "sample_id")
    return rounded(values.select("sample_id", "probe_id", "value", "qc_pass"), "value")
