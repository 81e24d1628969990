"""Manifest, metadata, biospecimen and audit tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from betaloom.functions import columns as C
from betaloom.settings import ManifestRequest

FILE_FIELDS = ("data_category", "experimental_strategy", "data_type", "platform")


# --- manifest ---


def request_filter(want: ManifestRequest) -> Column:
    """All membership tests of a manifest request; the nested ones hold if any element matches."""
    tests = F.col("access") == want.access
    for field in FILE_FIELDS:
        tests = tests & (F.col(field) == getattr(want, field))
    tests = tests & F.exists("cases", lambda c: c["project"]["project_id"] == want.project_id)
    has_type = lambda s: s["sample_type"] == want.sample_type
    tests = tests & F.exists("cases", lambda c: F.exists(c["samples"], has_type))
    if want.reference_genome is not None:
        tests = tests & (F.col("reference_genome") == want.reference_genome)
    return tests


def build_manifest(hits: DataFrame, want: ManifestRequest) -> DataFrame:
    return project_manifest(hits.where(request_filter(want)))


def project_manifest(hits: DataFrame) -> DataFrame:
    return hits.select("file_id", "file_name")


def manifest_checks(hits: DataFrame, want: ManifestRequest, expected: int | None = None) -> DataFrame:
    """Integrity report ``(check, violations, ok)`` from one aggregation over the hits.

    ``expected`` is the total that the service reported for the request, if known: fewer hits are
    a truncated response. Without it the number of hits is not judged.
    """
    has_type = lambda s: s["sample_type"] == want.sample_type
    rules = {field: F.col(field) == getattr(want, field) for field in FILE_FIELDS}
    rules["sample_type"] = F.exists(F.get("cases", 0)["samples"], has_type)
    rules["project_id"] = F.exists("cases", lambda c: c["project"]["project_id"] == want.project_id)
    counts = [F.sum((~F.coalesce(rule, F.lit(False))).cast("long")).alias(name) for name, rule in rules.items()]
    totals = hits.agg(F.count("*").alias("n"), *counts)
    report = [
        ("not_empty", (F.col("n") == 0).cast("long")),
        ("not_truncated", F.greatest(F.lit(expected) - F.col("n"), F.lit(0).cast("long")) if expected is not None else F.lit(0).cast("long")),
        *[(name, F.coalesce(F.col(name), F.lit(0))) for name in rules],
    ]
    rows = F.array(*[F.struct(F.lit(name).alias("check"), bad.alias("violations")) for name, bad in report])
    return totals.select(F.inline(rows)).withColumn("ok", F.col("violations") == 0)


# --- download bookkeeping ---


def landed_files(raw: DataFrame, stored: DataFrame) -> DataFrame:
    """Ids of files that exist, either as delivered or in the beta store."""
    return raw.select("file_id").unionByName(stored.select("file_id")).distinct()


def pending_files(manifest: DataFrame, landed: DataFrame) -> DataFrame:
    """Manifest rows with neither a raw nor a stored file yet."""
    return manifest.join(landed.select("file_id"), "file_id", "left_anti")


def download_status(manifest: DataFrame, landed: DataFrame, attempts: Column, timestamp: Column) -> DataFrame:
    """Status log: a landed file succeeded, every other manifest row failed."""
    marks = landed.select("file_id").distinct().withColumn("landed", F.lit(True))
    status = F.when(F.col("landed"), "success").otherwise("failed")
    return manifest.join(marks, "file_id", "left").select(
        "file_id", "file_name", status.alias("status"), attempts.cast("int").alias("attempts"), timestamp.alias("timestamp")
    )


# --- audit ---


def initialize_audit_table(manifest: DataFrame, status_log: DataFrame) -> DataFrame:
    log = status_log.select("file_id", "status", "attempts", "timestamp")
    return manifest.join(log, "file_id", "left").select(
        "file_id",
        "file_name",
        F.col("status").eqNullSafe("success").cast("int").alias("downloaded"),
        F.col("status").alias("download_status"),
        F.col("attempts").cast("int").alias("download_attempts"),
        F.col("timestamp").alias("download_timestamp"),
        F.lit(None).cast("int").alias("metadata_fetched"),
        F.lit(None).cast("string").alias("metadata_status"),
        F.lit(None).cast("int").alias("qc_pass"),
        F.lit(None).cast("string").alias("parquet_path"),
        F.lit("").alias("notes"),
    )


def update_metadata(audit: DataFrame, metadata: DataFrame) -> DataFrame:
    found = metadata.select("file_id", F.col("status").alias("_status"))
    joined = audit.join(found, "file_id", "left")
    fetched = F.col("_status").eqNullSafe("success").cast("int")
    return joined.withColumns({"metadata_fetched": fetched, "metadata_status": F.col("_status")}).select(*audit.columns)


def update_qc(audit: DataFrame, entered: DataFrame, survived: DataFrame) -> DataFrame:
    """1 for survivors of sample QC, 0 for files it removed, unchanged for files it never saw."""
    into = entered.select("file_id").distinct().withColumn("_in", F.lit(True))
    out = survived.select("file_id").distinct().withColumn("_out", F.lit(True))
    verdict = F.when(F.col("_out"), 1).when(F.col("_in"), 0).otherwise(F.col("qc_pass"))
    joined = audit.join(into, "file_id", "left").join(out, "file_id", "left")
    return joined.withColumn("qc_pass", verdict).select(*audit.columns)


def update_paths(audit: DataFrame, stored: DataFrame) -> DataFrame:
    """Fill ``parquet_path`` of files that were stored and had none."""
    found = stored.select("file_id", F.col("path").alias("_path"))
    joined = audit.join(found, "file_id", "left")
    return joined.withColumn("parquet_path", F.coalesce("parquet_path", "_path")).select(*audit.columns)


def downloaded(audit: DataFrame) -> DataFrame:
    return audit.where(F.col("downloaded") == 1)


# --- metadata ---


def flatten_metadata(hits: DataFrame) -> DataFrame:
    """Lift the first case's fields out of the nested records."""
    cases = F.col("cases")
    return hits.withColumns(
        {
            "project_id": C.case_project_id(cases),
            "submitter_id": C.case_submitter_id(cases),
            "sample_type": C.case_sample_type(cases),
            "aliquot_id": C.case_aliquot_id(cases),
        }
    ).drop("cases")


def complete_metadata(requested: DataFrame, metadata: DataFrame) -> DataFrame:
    """A row for every requested file: what was not returned, or was returned as failed, is failed."""
    found = metadata.withColumn("_found", ~F.col("status").eqNullSafe("failed")) if "status" in metadata.columns else (
        metadata.withColumn("_found", F.lit(True))
    )
    status = F.when(F.col("_found"), "success").otherwise("failed")
    return requested.select("file_id").join(found, "file_id", "left").withColumn("status", status).drop("_found")


def build_metadata(audit: DataFrame, hits: DataFrame) -> DataFrame:
    return complete_metadata(downloaded(audit), flatten_metadata(hits))


def case_ids(metadata: DataFrame) -> DataFrame:
    return metadata.select("submitter_id").distinct()


def successful_metadata(metadata: DataFrame) -> DataFrame:
    return metadata.where(F.col("status") == "success").orderBy("file_name")


def clean_metadata(metadata: DataFrame, survived: DataFrame) -> DataFrame:
    return metadata.join(survived.select("file_id"), "file_id", "left_semi")


# --- biospecimen ---


def flatten_biospecimen(cases: DataFrame) -> DataFrame:
    """One row per aliquot. The barcode is the aliquot's, or its portion's when it has none."""
    return (
        cases.select(F.col("submitter_id").alias("case_id"), F.explode("samples").alias("sample"))
        .select("case_id", F.explode("sample.portions").alias("portion"))
        .select("case_id", F.col("portion.submitter_id").alias("fallback"), F.explode("portion.analytes").alias("analyte"))
        .select("case_id", "fallback", F.explode("analyte.aliquots").alias("aliquot"))
        .select("case_id", "aliquot.aliquot_id", F.coalesce("aliquot.submitter_id", "fallback").alias("barcode"))
    )


def known_aliquots(biospecimen: DataFrame, metadata: DataFrame) -> DataFrame:
    return biospecimen.join(metadata.select("aliquot_id"), "aliquot_id", "left_semi")


def first_per_aliquot(biospecimen: DataFrame) -> DataFrame:
    """One row per aliquot, the smallest barcode first. A minimum combines before the shuffle,
    so a heavily repeated aliquot costs one row per task."""
    first = F.min(F.struct(F.col("barcode").isNull().alias("last"), "barcode", "case_id")).alias("first")
    return biospecimen.groupBy("aliquot_id").agg(first).select("first.case_id", "aliquot_id", "first.barcode")


def build_biospecimen(cases: DataFrame, metadata: DataFrame) -> DataFrame:
    wanted = cases.join(case_ids(metadata), "submitter_id", "left_semi")
    return known_aliquots(first_per_aliquot(flatten_biospecimen(wanted)), metadata)


def attach_barcodes(metadata: DataFrame, biospecimen: DataFrame) -> DataFrame:
    barcodes = biospecimen.select("aliquot_id", "barcode")
    return metadata.join(barcodes, "aliquot_id", "left").withColumn("batch_id", C.batch_id(F.col("barcode")))
