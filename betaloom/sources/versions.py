"""Tables that appear together: written aside, then made visible by renaming one folder."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

PREFIX = "version-"


def _files(spark: SparkSession, path: str):
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()), folder


def versions(spark: SparkSession, path: str) -> list[str]:
    """Published versions below ``path``, oldest first."""
    files, folder = _files(spark, path)
    if not files.exists(folder):
        return []
    return sorted(n for n in (s.getPath().getName() for s in files.listStatus(folder)) if n.startswith(PREFIX))


def latest(spark: SparkSession, path: str) -> str | None:
    """Folder of the newest version, or ``None``."""
    found = versions(spark, path)
    return f"{path}/{found[-1]}" if found else None


def write_version(tables: Mapping[str, DataFrame], path: str, partition_by: Mapping[str, tuple[str, ...]] = {}) -> str:
    """Write all tables, then publish them by one rename; returns the version's folder.

    What a writer that was cut off left behind is overwritten by the next. A table with partition columns is rebalanced on them, so that
    a partition is a few large files. Earlier versions stay, for readers that hold them. One writer at a time.
    """
    spark = next(iter(tables.values())).sparkSession
    found = versions(spark, path)
    name = f"{PREFIX}{int(found[-1].removeprefix(PREFIX)) + 1 if found else 1:09d}"
    aside = f"{path}/_writing-{name}"
    for table, rows in tables.items():
        keys = partition_by.get(table, ())
        writer = (rows.hint("rebalance", *keys) if keys else rows).write.mode("overwrite").option("compression", "zstd")
        (writer.partitionBy(*keys) if keys else writer).parquet(f"{aside}/{table}")
    files, written = _files(spark, aside)
    _, target = _files(spark, f"{path}/{name}")
    if files.exists(target) or not files.rename(written, target):
        raise FileExistsError(f"{path}/{name} is there already")
    return f"{path}/{name}"
