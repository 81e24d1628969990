"""From a folder of raw files and saved responses to a prepared project, in steps that a later run doesn't repeat.

Every step publishes its tables under its name by one rename. A run that finds a step's tables reads them and goes on with the next, so a
job that was killed is started again with the same call. Raw files go through the store's ledger, which takes each file once.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from betaloom.dataset import Dataset
from betaloom.plans.intake import load_raw_project, register_files, verified_manifest
from betaloom.plans.project import prepare_dataset
from betaloom.settings import ManifestRequest, ProjectOptions
from betaloom.sources import versions
from betaloom.sources.beta import clean_data, raw_files
from betaloom.sources.matrix import load_dataset, save_dataset


@dataclass(frozen=True)
class Steps:
    """Named outputs of a run below one folder."""

    spark: SparkSession
    path: str

    def done(self, step: str) -> bool:
        return versions.latest(self.spark, f"{self.path}/{step}") is not None

    def tables(self, step: str, build: Callable[[], Mapping[str, DataFrame]]) -> dict[str, DataFrame]:
        """The step's tables, built and published first unless an earlier run did."""
        folder = versions.latest(self.spark, f"{self.path}/{step}")
        if folder is None:
            folder = versions.write_version(build(), f"{self.path}/{step}")
        files = versions._files(self.spark, folder)
        names = sorted(s.getPath().getName() for s in files[0].listStatus(files[1]))
        return {name: self.spark.read.parquet(f"{folder}/{name}") for name in names}


@dataclass(frozen=True)
class ProjectInputs:
    """What a project starts from: saved responses, raw files, and what the service said of them."""

    raw_dir: str
    hits: DataFrame
    cases: DataFrame
    annotation: DataFrame
    request: ManifestRequest
    project_id: str
    platform: str
    reference_genome: str
    expected: int | None = None


def prepare_project(
    spark: SparkSession,
    run_path: str,
    inputs: ProjectInputs,
    options: ProjectOptions = ProjectOptions(),
    attempts: Column | None = None,
    timestamp: Column | None = None,
) -> tuple[Dataset, DataFrame]:
    """Prepared dataset and final audit table of one project.

    Steps: ``control`` (manifest, status, metadata, audit), ``stored`` (beta store and audit with paths), ``prepared`` (quality control and preprocessing
    of the assembled matrix, with the audit of what passed). ``timestamp`` should be a fixed value, as steps are not rebuilt.
    """
    steps = Steps(spark, run_path)
    attempts = F.lit(1) if attempts is None else attempts
    timestamp = F.current_timestamp() if timestamp is None else timestamp

    def control() -> Mapping[str, DataFrame]:
        manifest = verified_manifest(inputs.hits, inputs.request, inputs.expected)
        landed = raw_files(spark, inputs.raw_dir)
        found = register_files(manifest, inputs.hits, inputs.cases, landed, attempts, timestamp)
        return {"manifest": found.manifest, "status_log": found.status_log, "metadata": found.metadata, "audit": found.audit}

    tables = steps.tables("control", control)
    store = f"{run_path}/store"
    audit = steps.tables("stored", lambda: {"audit": clean_data(spark, inputs.raw_dir, tables["audit"], store, inputs.project_id)})["audit"]
    target = f"{run_path}/prepared"
    if not steps.done("prepared"):
        raw = load_raw_project(spark, store, tables["metadata"], inputs.project_id, inputs.platform, inputs.reference_genome)
        ds, passed = prepare_dataset(raw, inputs.annotation, options, audit)
        save_dataset(ds, target, audit=audit if passed is None else passed)
    return load_dataset(spark, target), spark.read.parquet(f"{versions.latest(spark, target)}/audit")
