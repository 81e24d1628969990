"""Beta files as they land: the raw reader as a stream that handles each file once."""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from betaloom import schemas
from betaloom.sources.beta import add_files, located


def read_raw_stream(spark: SparkSession, raw_dir: str, max_files: int | None = None) -> DataFrame:
    """Same columns as ``sources.beta.read_raw``, one row per line of every new file."""
    reader = spark.readStream.schema(schemas.RAW_BETA).option("sep", "\t").option("header", True)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return located(reader.csv(f"{raw_dir}/*/*"), raw_dir)


def ingest_available(rows: DataFrame, store_path: str, project_id: str, checkpoint: str) -> StreamingQuery:
    """Add all files not seen before to the beta store, then stop. The query checkpoint records
    what was ingested. Each batch is published under a name made from the checkpoint and its number, so one that is run again
    after a failure overwrites what it left, or adds nothing if it was published."""
    name = hashlib.sha256(f"{checkpoint}\n{project_id}".encode()).hexdigest()[:32]

    def add(batch: DataFrame, number: int) -> None:
        add_files(batch.withColumn("project_id", F.lit(project_id)), store_path, f"{name}-{number}")

    return rows.drop("file_name").writeStream.foreachBatch(add).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
