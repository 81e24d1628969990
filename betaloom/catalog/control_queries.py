"""Manifest, metadata, biospecimen and audit tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from betaloom import schemas
from betaloom.catalog.fixtures import Fixtures
from betaloom.catalog.registry import query
from betaloom.functions import columns as C
from betaloom.operators import attempts, control
from betaloom.settings import ManifestRequest
from betaloom.sources.control import read_responses

WANT = ManifestRequest(project_id="src7", platform="en")


def _shown(flag: str) -> Column:
    """A nullable number as text, so both engines render it alike."""
    return F.col(flag).cast("string").alias(flag)


@query("A9", """
SELECT file_id, file_name, platform, project_id, submitter_id, sample_type, aliquot_id FROM fx_metadata""")
def saved_responses(fx: Fixtures) -> DataFrame:
    path = fx.scratch("responses")
    hit = F.struct(*[F.col(c) for c in fx.hits.columns])
    fx.hits.select(F.struct(F.array(hit).alias("hits")).alias("data")).write.json(path)
    hits = read_responses(fx.spark, path, schemas.FILE_HIT, one_per_line=True)
    columns = ("file_id", "file_name", "platform", "project_id", "submitter_id", "sample_type", "aliquot_id")
    return control.flatten_metadata(hits).select(*columns)


@query("B1 B2", """
SELECT file_id, file_name FROM fx_hits
WHERE access = 'open' AND platform = 'en' AND has_cases AND has_samples AND first_type = 'Primary Tumor'""")
def manifest_rows(fx: Fixtures) -> DataFrame:
    return control.build_manifest(fx.hits, WANT)


@query("B2", "SELECT file_id, file_name FROM fx_hits")
def manifest_projection(fx: Fixtures) -> DataFrame:
    return control.project_manifest(fx.hits)


@query("B3", """
SELECT unnest(['not_empty', 'not_truncated', 'data_category', 'experimental_strategy', 'data_type', 'platform', 'sample_type', 'project_id']) AS "check",
       unnest([CAST(n = 0 AS BIGINT), 0, 0, 0, 0, platform, kind, project]) AS violations,
       unnest([n > 0, true, true, true, true, platform = 0, kind = 0, project = 0]) AS ok
FROM (SELECT count(*) AS n, CAST(count(*) FILTER (platform <> 'en') AS BIGINT) AS platform,
             count(*) FILTER (NOT (has_cases AND has_samples AND first_type = 'Primary Tumor')) AS kind,
             count(*) FILTER (NOT has_cases) AS project FROM fx_hits)""")
def manifest_checks(fx: Fixtures) -> DataFrame:
    return control.manifest_checks(fx.hits, WANT)


@query("B4", """
SELECT file_id, file_name FROM fx_manifest WHERE file_id NOT IN (SELECT file_id FROM fx_status WHERE status = 'success')""")
def pending_files(fx: Fixtures) -> DataFrame:
    return control.pending_files(fx.manifest, control.landed_files(fx.landed, fx.landed))


@query("B5", """
SELECT m.file_id, m.file_name, CASE WHEN s.status = 'success' THEN 'success' ELSE 'failed' END AS status, 3 AS attempts
FROM fx_manifest m LEFT JOIN fx_status s USING (file_id)""")
def download_status(fx: Fixtures) -> DataFrame:
    return control.download_status(fx.manifest, fx.landed, F.lit(3), F.current_timestamp()).drop("timestamp")


FOLDED = """
SELECT doc_id, max(attempt) AS attempts, CASE WHEN bool_or(status = 'failed' AND attempt = last) THEN 'failed' ELSE 'success' END AS status
FROM (SELECT *, max(attempt) OVER (PARTITION BY doc_id) AS last FROM fx_attempts) GROUP BY doc_id"""


@query("B5 B6", f"""
SELECT m.file_id, m.file_name, CAST(coalesce(f.status, 'failed') = 'success' AS INTEGER) AS downloaded, coalesce(f.status, 'failed') AS download_status,
       CAST(coalesce(f.attempts, 0) AS INTEGER) AS download_attempts, CAST(1700000000 + 60 * f.attempts AS VARCHAR) AS seconds
FROM fx_manifest m LEFT JOIN ({FOLDED}) f ON m.file_id = 'F-' || f.doc_id""")
def audit_of_attempts(fx: Fixtures) -> DataFrame:
    """The audit after three attempts, replayed with some rows twice."""
    log = fx.attempt_log.unionByName(fx.attempt_log.where("attempt = 2"))
    audit = attempts.audit_of_attempts(fx.manifest, log)
    seconds = F.unix_timestamp("download_timestamp").cast("string").alias("seconds")
    return audit.select("file_id", "file_name", "downloaded", "download_status", "download_attempts", seconds)


@query("B4", f"SELECT file_id, file_name FROM fx_manifest WHERE file_id NOT IN (SELECT 'F-' || doc_id FROM ({FOLDED}) WHERE status = 'success')")
def pending_after_attempts(fx: Fixtures) -> DataFrame:
    return attempts.still_pending(fx.manifest, fx.attempt_log)


@query("B6", """
SELECT m.file_id, m.file_name, CAST(coalesce(s.status = 'success', false) AS INTEGER) AS downloaded, s.status AS download_status,
       CAST(s.attempts AS VARCHAR) AS download_attempts, CAST(NULL AS VARCHAR) AS qc_pass, CAST(NULL AS VARCHAR) AS parquet_path, '' AS notes
FROM fx_manifest m LEFT JOIN fx_status s USING (file_id)""")
def audit_table(fx: Fixtures) -> DataFrame:
    audit = control.initialize_audit_table(fx.manifest, fx.status_log)
    return audit.select(
        "file_id", "file_name", "downloaded", "download_status", _shown("download_attempts"), _shown("qc_pass"), "parquet_path", "notes"
    )


@query("B7 B12", """
SELECT m.file_id, CAST(coalesce(s.status = 'success', false) AND h.has_cases AS INTEGER) AS metadata_fetched,
       CASE WHEN s.status = 'success' THEN CASE WHEN h.has_cases THEN 'success' ELSE 'failed' END END AS metadata_status
FROM fx_manifest m JOIN fx_hits h USING (file_id) LEFT JOIN fx_status s USING (file_id)""")
def audit_with_metadata(fx: Fixtures) -> DataFrame:
    audit = control.initialize_audit_table(fx.manifest, fx.status_log)
    returned = fx.hits.where(F.size("cases") > 0)
    metadata = control.build_metadata(audit, returned)
    return control.update_metadata(audit, metadata).select("file_id", "metadata_fetched", "metadata_status")


@query("B8", """
SELECT m.file_id, CASE WHEN l.file_id IS NULL THEN NULL WHEN l.status = 'success' AND l.attempts = 1 THEN '1' ELSE '0' END AS qc_pass
FROM fx_manifest m LEFT JOIN fx_status l USING (file_id)""")
def audit_with_qc(fx: Fixtures) -> DataFrame:
    audit = control.initialize_audit_table(fx.manifest, fx.status_log)
    survived = fx.status_log.where((F.col("status") == "success") & (F.col("attempts") == 1))
    return control.update_qc(audit, fx.status_log, survived).select("file_id", _shown("qc_pass"))


@query("B9", """
SELECT m.file_id, CASE WHEN s.status = 'success' THEN 'store/' || m.file_id END AS parquet_path
FROM fx_manifest m LEFT JOIN fx_status s USING (file_id)""")
def audit_with_paths(fx: Fixtures) -> DataFrame:
    audit = control.initialize_audit_table(fx.manifest, fx.status_log)
    stored = fx.landed.distinct().withColumn("path", F.concat(F.lit("store/"), F.col("file_id")))
    return control.update_paths(audit, stored).select("file_id", "parquet_path")


@query("B10", """
SELECT file_id, project_id, submitter_id, sample_type, aliquot_id FROM fx_metadata""")
def flat_metadata(fx: Fixtures) -> DataFrame:
    return control.flatten_metadata(fx.hits).select("file_id", "project_id", "submitter_id", "sample_type", "aliquot_id")


@query("B11", """
SELECT file_id, CASE WHEN has_samples THEN file_name END AS first_name FROM fx_hits""")
def first_file_names(fx: Fixtures) -> DataFrame:
    name = F.struct("file_name")
    empty = F.exists("cases", lambda c: c["samples"].isNull()) | (F.expr("substring(file_id, 3) % 7 = 0"))
    files = F.when(empty, F.slice(F.array(name), 1, 0)).otherwise(F.array(name, name))
    return fx.hits.select("file_id", C.first_file_name(files).alias("first_name"))


@query("B12", """
SELECT m.file_id, CASE WHEN s.status IS NULL THEN 'failed' ELSE s.status END AS status, CAST(s.attempts AS VARCHAR) AS attempts
FROM fx_manifest m LEFT JOIN fx_status s USING (file_id)""")
def completed_metadata(fx: Fixtures) -> DataFrame:
    done = control.complete_metadata(fx.manifest, fx.status_log)
    return done.select("file_id", "status", _shown("attempts"))


@query("B13", "SELECT DISTINCT submitter_id FROM fx_samples")
def case_ids(fx: Fixtures) -> DataFrame:
    return control.case_ids(fx.samples)


@query("B14", "SELECT case_id, aliquot_id, barcode FROM fx_aliquots")
def aliquot_rows(fx: Fixtures) -> DataFrame:
    return control.flatten_biospecimen(fx.cases)


@query("B15", """
SELECT case_id, aliquot_id, barcode FROM fx_aliquots
WHERE aliquot_id IN (SELECT 'X-' || o_orderkey || '-' || (o_custkey % 200) FROM orders)
   OR aliquot_id IN (SELECT 'A-' || o_orderkey || '-' || (1 + o_custkey % 7) FROM orders)""")
def known_aliquots(fx: Fixtures) -> DataFrame:
    order = F.col("o_orderkey").cast("string")
    ids = F.array(
        F.concat(F.lit("X-"), order, F.lit("-"), (F.col("o_custkey") % 200).cast("string")),
        F.concat(F.lit("A-"), order, F.lit("-"), (F.col("o_custkey") % 7 + 1).cast("string")),
    )
    metadata = fx.table("orders").select(F.explode(ids).alias("aliquot_id"))
    return control.known_aliquots(control.flatten_biospecimen(fx.cases), metadata).select("case_id", "aliquot_id", "barcode")


@query("B16", """
SELECT case_id, aliquot_id, barcode FROM fx_aliquots
QUALIFY row_number() OVER (PARTITION BY aliquot_id ORDER BY barcode, case_id) = 1""")
def first_aliquots(fx: Fixtures) -> DataFrame:
    return control.first_per_aliquot(control.flatten_biospecimen(fx.cases))


@query("B13 B14 B15 B16", """
SELECT case_id, aliquot_id, barcode FROM fx_aliquots
WHERE case_id IN (SELECT 'C-' || o_custkey FROM orders WHERE o_orderstatus = 'F')
  AND aliquot_id IN (SELECT 'A-' || l_orderkey || '-' || l_linenumber FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE o_orderstatus = 'F')
QUALIFY row_number() OVER (PARTITION BY aliquot_id ORDER BY barcode, case_id) = 1""")
def biospecimen(fx: Fixtures) -> DataFrame:
    lines = fx.table("lineitem").join(fx.table("orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    aliquot = F.concat_ws("-", F.lit("A"), F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string"))
    case = F.concat(F.lit("C-"), F.col("o_custkey").cast("string"))
    metadata = lines.where(F.col("o_orderstatus") == "F").select(case.alias("submitter_id"), aliquot.alias("aliquot_id"))
    return control.build_biospecimen(fx.cases, metadata)


@query("B17 B18", """
SELECT sample_id, aliquot_id, CASE WHEN sample_id % 4 > 0 THEN barcode END AS barcode, CASE WHEN sample_id % 4 > 0 THEN batch_id END AS batch_id
FROM fx_batched""")
def metadata_with_barcodes(fx: Fixtures) -> DataFrame:
    known = fx.samples.where(F.col("sample_id") % 4 > 0)
    joined = control.attach_barcodes(fx.samples.drop("barcode"), known)
    return joined.select("sample_id", "aliquot_id", "barcode", "batch_id")


@query("B18", """
SELECT aliquot_id, barcode,
       CASE WHEN len(string_split(barcode || '-x-y', '-')) >= 6
            THEN string_split(barcode || '-x-y', '-')[4] || '-' || string_split(barcode || '-x-y', '-')[6] END AS batch_id
FROM (SELECT DISTINCT aliquot_id, barcode FROM fx_aliquots UNION SELECT aliquot_id, barcode FROM fx_samples)""")
def batch_ids(fx: Fixtures) -> DataFrame:
    rows = control.flatten_biospecimen(fx.cases).select("aliquot_id", "barcode")
    rows = rows.unionByName(fx.samples.select("aliquot_id", "barcode")).distinct()
    return rows.withColumn("batch_id", C.batch_id(F.concat(F.col("barcode"), F.lit("-x-y"))))


@query("B19", """
SELECT 'F-' || sample_id AS file_id, submitter_id FROM fx_samples
WHERE (project_id, sample_id) IN (SELECT (project_id, sample_id) FROM qc_samples WHERE passed)""")
def clean_metadata(fx: Fixtures) -> DataFrame:
    from betaloom.plans.project import sample_qc

    file_id = F.concat(F.lit("F-"), F.col("sample_id").cast("string")).alias("file_id")
    metadata = fx.samples.select(file_id, "submitter_id")
    return control.clean_metadata(metadata, sample_qc(fx.raw).samples.select(file_id))


@query("B20", """
SELECT file_id, CAST(attempts AS INTEGER) AS download_attempts FROM fx_manifest JOIN fx_status USING (file_id) WHERE status = 'success'""")
def downloaded_files(fx: Fixtures) -> DataFrame:
    audit = control.initialize_audit_table(fx.manifest, fx.status_log)
    return control.downloaded(audit).select("file_id", "download_attempts")


@query("B21", """
SELECT file_id, file_name FROM fx_manifest JOIN fx_status USING (file_id) WHERE status = 'success' ORDER BY file_name""")
def successful_metadata(fx: Fixtures) -> DataFrame:
    metadata = fx.manifest.join(fx.status_log.select("file_id", "status"), "file_id")
    return control.successful_metadata(metadata).select("file_id", "file_name")


@query("B1 B2 B3 B5 B6 B7 B10 B12 B17 B18", """
SELECT m.file_id, CAST(coalesce(s.status = 'success', false) AS INTEGER) AS downloaded,
       CAST(coalesce(s.status = 'success', false) AND h.doc_id % 2 = 0 AS INTEGER) AS metadata_fetched,
       CASE WHEN s.status = 'success' AND h.doc_id % 2 = 0 THEN t.submitter_id END AS submitter_id,
       CASE WHEN s.status = 'success' AND h.doc_id % 2 = 0 AND t.aliquot_id IS NOT NULL
            THEN CASE WHEN h.doc_id % 3 = 0 THEN 'PO-' || h.doc_id ELSE 'BC-' || h.doc_id END END AS barcode
FROM fx_manifest m JOIN fx_hits h USING (file_id) JOIN fx_metadata t USING (file_id) LEFT JOIN fx_status s USING (file_id)
WHERE h.access = 'open' AND h.platform = 'en' AND h.has_cases AND h.has_samples AND h.first_type = 'Primary Tumor'""")
def registered_files(fx: Fixtures) -> DataFrame:
    from betaloom.plans.intake import register_files, verified_manifest

    manifest = verified_manifest(fx.hits, WANT)
    answered = fx.hits.where(F.expr("cast(substring(file_id, 3) AS BIGINT) % 2 = 0"))
    cases = fx.hits.select(F.explode("cases").alias("c")).select("c.*")
    done = register_files(manifest, answered, cases, fx.landed, F.lit(1), F.current_timestamp())
    audit = done.audit.select("file_id", "downloaded", F.coalesce("metadata_fetched", F.lit(0)).alias("metadata_fetched"))
    return audit.join(done.metadata.select("file_id", "submitter_id", "barcode"), "file_id", "left")
