"""A store of batches with a commit log: a batch is in it once its log entry was renamed into place.

``<path>/data/batch=<id>/project_id=<p>/`` holds rows, ``<path>/log/batch=<id>/project_id=<p>/`` the files (``file_id``, ``n_rows``) that they
come from. A writer writes the data, then the log entry under a name that readers pass over, then renames that folder, which is one step on
file systems with a rename (HDFS, local). Readers list the log and read the data folders of published batches only, so a batch cut
off half-way is invisible; run again under the same id, it overwrites what was left. Questions about files read the log, never the data, and only
the folders of the projects asked for. One writer at a time may add to a store.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

KEYS = T.StructType([T.StructField("batch", T.StringType()), T.StructField("project_id", T.StringType())])
ENTRY = T.StructType([T.StructField("file_id", T.StringType()), T.StructField("n_rows", T.LongType())])


def _folder(spark: SparkSession, path: str):
    """Hadoop's file system and path for a folder."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()), folder


def published(spark: SparkSession, path: str) -> list[str]:
    """Ids of the batches in the store, by name; none if it isn't there yet."""
    files, log = _folder(spark, f"{path}/log")
    if not files.exists(log):
        return []
    names = [status.getPath().getName() for status in files.listStatus(log)]
    return sorted(name.removeprefix("batch=") for name in names if name.startswith("batch="))


def _read(spark: SparkSession, root: str, fields: T.StructType, batches: Iterable[str]) -> DataFrame:
    schema = T.StructType([*fields.fields, *KEYS.fields])
    paths = [f"{root}/batch={b}" for b in batches]
    if not paths:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", root).parquet(*paths)


def _of_projects(rows: DataFrame, projects: list[str] | None) -> DataFrame:
    return rows if projects is None else rows.where(F.col("project_id").isin(projects))


def logged_files(spark: SparkSession, path: str, projects: list[str] | None = None) -> DataFrame:
    """(file_id, n_rows, batch, project_id) of every file in the store; a project list prunes the log."""
    return _of_projects(_read(spark, f"{path}/log", ENTRY, published(spark, path)), projects)


def stored_rows(spark: SparkSession, path: str, fields: T.StructType, projects: list[str] | None = None) -> DataFrame:
    """Rows of the published batches with their ``project_id``; a project list prunes folders."""
    return _of_projects(_read(spark, f"{path}/data", fields, published(spark, path)), projects).drop("batch")


def write_batch(rows: DataFrame, path: str, batch: str) -> None:
    """Write the rows of a batch, invisible until it is published, as a few large files per project."""
    gathered = rows.hint("rebalance", "project_id")
    gathered.write.mode("overwrite").option("compression", "zstd").partitionBy("project_id").parquet(f"{path}/data/batch={batch}")


def publish(spark: SparkSession, path: str, batch: str, fields: T.StructType) -> None:
    """Log the files of a written batch and make it visible. A batch without rows isn't logged."""
    held = _read(spark, f"{path}/data", fields, [batch])
    commit(spark, path, batch, held.groupBy("project_id", "file_id").agg(F.count("*").alias("n_rows")))


def commit(spark: SparkSession, path: str, batch: str, entries: DataFrame | None = None) -> None:
    """Make a written batch visible, with log entries per project if it has any files to name."""
    entry = f"{path}/log/_writing-{batch}"
    files, written = _folder(spark, entry)
    if entries is None:
        files.mkdirs(written)
    else:
        entries.write.mode("overwrite").partitionBy("project_id").parquet(entry)
        if not any(status.getPath().getName().startswith("project_id=") for status in files.listStatus(written)):
            return
    _, target = _folder(spark, f"{path}/log/batch={batch}")
    if files.exists(target) or not files.rename(written, target):
        raise FileExistsError(f"batch {batch} is in the log of {path} already")


def add_batch(rows: DataFrame, path: str, fields: T.StructType, batch: str | None = None) -> str:
    """Append rows as one batch and return its id. An id that is published already adds nothing."""
    batch = uuid.uuid4().hex if batch is None else batch
    spark = rows.sparkSession
    if batch not in published(spark, path):
        typed = [F.col(f.name).cast(f.dataType).alias(f.name) for f in fields.fields]
        write_batch(rows.select(*typed, F.col("project_id").cast("string").alias("project_id")), path, batch)
        publish(spark, path, batch, fields)
    return batch
