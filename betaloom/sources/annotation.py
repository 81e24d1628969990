"""Probe annotation tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from betaloom import schemas
from betaloom.settings import PLATFORMS, REFERENCE_GENOMES


def check_key(platform: str, reference_genome: str) -> None:
    if platform not in PLATFORMS:
        raise ValueError(f"unknown platform {platform!r}; supported: {list(PLATFORMS)}")
    if reference_genome not in REFERENCE_GENOMES:
        raise ValueError(f"unknown reference genome {reference_genome!r}; supported: {list(REFERENCE_GENOMES)}")


def write_annotation(annotation: DataFrame, path: str, mode: str = "overwrite") -> None:
    """One table for all arrays and builds; the partition columns are the lookup key."""
    annotation.write.mode(mode).option("compression", "zstd").partitionBy("reference_genome", "platform").parquet(path)


def load_annotation(spark: SparkSession, path: str, platform: str, reference_genome: str) -> DataFrame:
    """Annotation of one array and genome build; only that partition is read."""
    check_key(platform, reference_genome)
    return select_annotation(spark.read.parquet(path), platform, reference_genome)


def select_annotation(annotation: DataFrame, platform: str, reference_genome: str) -> DataFrame:
    check_key(platform, reference_genome)
    chosen = (F.col("platform") == platform) & (F.col("reference_genome") == reference_genome)
    return annotation.where(chosen).drop("platform", "reference_genome")


def csvs_to_parquet(spark: SparkSession, folder: str, target: str, schema=schemas.ANNOTATION) -> DataFrame:
    """Convert every annotation CSV of a folder in one job, keeping the file each row came from."""
    rows = spark.read.csv(f"{folder}/*.csv", header=True, schema=schema, enforceSchema=False, nullValue="NA")
    name = F.regexp_extract(F.col("_metadata.file_path"), r"([^/]+)\.csv$", 1)
    rows.select("*", F.url_decode(name).alias("table")).write.mode("overwrite").partitionBy("table").parquet(target)
    return spark.read.parquet(target)
