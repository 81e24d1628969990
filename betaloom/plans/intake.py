"""From saved service responses and landed files to control tables and a raw project."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from betaloom.dataset import Dataset
from betaloom.operators import control, matrix
from betaloom.settings import ManifestRequest
from betaloom.sources.annotation import check_key
from betaloom.sources.beta import read_store, stored_files
from betaloom.tables import materialize, spread


@dataclass(frozen=True)
class ControlTables:
    manifest: DataFrame
    status_log: DataFrame
    metadata: DataFrame
    audit: DataFrame


def verified_manifest(hits: DataFrame, want: ManifestRequest, expected: int | None = None) -> DataFrame:
    """Manifest of the matching hits, however many; raises when an integrity check fails.

    ``expected`` is the total that the service reported, where it is known.
    """
    chosen = hits.where(control.request_filter(want))
    failed = [r.check for r in control.manifest_checks(chosen, want, expected).where(~F.col("ok")).collect()]
    if failed:
        raise ValueError(f"manifest checks failed: {', '.join(failed)}")
    return control.project_manifest(chosen)


def register_files(
    manifest: DataFrame, hits: DataFrame, cases: DataFrame, landed: DataFrame, attempts: Column, timestamp: Column
) -> ControlTables:
    """Status, metadata with barcodes and batch ids, and audit of the files of a manifest.

    ``hits`` are the metadata responses, ``cases`` the specimen responses, ``landed`` the files
    that exist raw or stored.
    """
    status = materialize(control.download_status(manifest, spread(landed), attempts, timestamp), "status-log")
    audit = control.initialize_audit_table(manifest, spread(status))
    metadata = materialize(control.build_metadata(audit, spread(hits)), "metadata")
    barcodes = materialize(control.build_biospecimen(cases, spread(metadata)), "barcodes")
    metadata = materialize(control.attach_barcodes(metadata, spread(barcodes)), "metadata-barcodes")
    return ControlTables(manifest, status, metadata, control.update_metadata(audit, spread(metadata)))


def load_raw_project(
    spark: SparkSession, store_path: str, metadata: DataFrame, project_id: str, platform: str, reference_genome: str
) -> Dataset:
    """The stored beta values of one project as a dataset, aligned with its metadata by file id."""
    check_key(platform, reference_genome)
    beta = read_store(spark, store_path, [project_id]).drop("project_id")
    values = matrix.assemble(beta, spread(metadata.select("file_id", "status")), project_id)
    ready = metadata.where(F.col("status") == "success").withColumn("project_id", F.lit(project_id))
    stored = spread(stored_files(spark, store_path, [project_id]).select("file_id"))
    samples = ready.join(stored, "file_id", "left_semi").withColumnRenamed("file_id", "sample_id")
    probes = values.select("project_id", "probe_id").distinct()
    own = spark.createDataFrame([(project_id,)], "project_id string")
    return Dataset(values, samples, probes, matrix.dataset_row(own, F.lit(platform), F.lit(reference_genome)))
