"""Manifest, metadata, status log and audit files, and saved service responses."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from betaloom import schemas

TABLES = {
    "manifest": schemas.MANIFEST,
    "status_log": schemas.STATUS_LOG,
    "metadata": schemas.METADATA,
    "audit": schemas.AUDIT,
}


def read_table(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A tab-separated control table keyed on ``file_id``; empty fields are NULL."""
    return spark.read.csv(path, sep="\t", header=True, schema=schema, enforceSchema=False)


def write_table(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").csv(path, sep="\t", header=True)


def _reader(name: str):
    def load(spark: SparkSession, path: str) -> DataFrame:
        return read_table(spark, path, TABLES[name])

    load.__name__ = f"load_{name}"
    return load


def _writer(name: str):
    def save(df: DataFrame, path: str) -> None:
        write_table(df.select(*TABLES[name].names), path)

    save.__name__ = f"save_{name}"
    return save


load_manifest, save_manifest = _reader("manifest"), _writer("manifest")
load_status_log, save_status_log = _reader("status_log"), _writer("status_log")
load_metadata, save_metadata = _reader("metadata"), _writer("metadata")
load_audit_table, save_audit_table = _reader("audit"), _writer("audit")


def read_responses(
    spark: SparkSession, path: str, hit: T.StructType = schemas.FILE_HIT, one_per_line: bool = False
) -> DataFrame:
    """Saved responses ``{"data": {"hits": [...]}}`` as one row per hit.

    Files hold one response each, or one per line, which lets large files be split.
    """
    pages = spark.read.json(path, schema=schemas.response(hit), multiLine=not one_per_line)
    return pages.select(F.explode("data.hits").alias("hit")).select("hit.*")
