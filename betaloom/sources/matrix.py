"""Finished datasets on disk."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession

from betaloom.dataset import Dataset
from betaloom.operators.quality import SAMPLE
from betaloom.sources.versions import latest, write_version

PARTS = ("values", "samples", "probes", "meta")


def save_dataset(ds: Dataset, path: str, partition_by: tuple[str, ...] = ("project_id",), **others: DataFrame) -> None:
    """Write the matrix and its companions (and ``others``) as Parquet tables that appear together, as a new version below ``path``."""
    tables = {part: getattr(ds, part) for part in PARTS} | others
    write_version(tables, path, {"values": partition_by})


def save_split(ds: Dataset, path: str) -> None:
    """Write a split cohort, partitioned by part, so a reader of one part prunes the others."""
    values = ds.values.join(ds.samples.select(*SAMPLE, "split"), SAMPLE)
    save_dataset(ds.replaced(values=values), path, ("split",))


def load_dataset(spark: SparkSession, path: str) -> Dataset:
    """The newest version of a saved dataset."""
    folder = latest(spark, path)
    if folder is None:
        raise FileNotFoundError(f"no dataset at {path}")
    return Dataset(*[spark.read.parquet(f"{folder}/{part}") for part in PARTS])


def load_datasets(spark: SparkSession, paths: list[str]) -> Dataset:
    """Several saved projects as one dataset. Sample columns are those all projects have."""
    loaded = [load_dataset(spark, path) for path in paths]

    def stack(part: str) -> DataFrame:
        tables = [getattr(d, part) for d in loaded]
        if part == "samples":
            shared = [c for c in tables[0].columns if all(c in t.columns for t in tables)]
            tables = [t.select(*shared) for t in tables]
        return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)

    return Dataset(*[stack(part) for part in PARTS])


save_project = save_cohort = save_dataset
load_processed_project = load_dataset
