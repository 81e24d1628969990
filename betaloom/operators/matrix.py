"""Assembling, completing and packing the matrix."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from betaloom.functions.columns import null_if_nan
from betaloom.functions.running import numbered
from betaloom.operators.quality import PROBE, SAMPLE
from betaloom.tables import materialize

CHUNKS = 512


def assemble(beta: DataFrame, samples: DataFrame, project_id: str | None = None) -> DataFrame:
    """Long matrix of the samples whose metadata arrived.

    Values meet their metadata by file id. The outer join of sample columns on the probe is
    implicit: a probe absent from a sample simply has no row.
    """
    ready = samples.where(F.col("status") == "success")
    project = F.lit(project_id) if project_id is not None else F.col("project_id")
    ready = ready.select("file_id", project.alias("project_id"))
    return beta.join(ready, "file_id").select(
        "project_id", F.col("file_id").alias("sample_id"), "probe_id", null_if_nan(F.col("beta_value")).alias("value")
    )


def densify(values: DataFrame, samples: DataFrame, probes: DataFrame) -> DataFrame:
    """Give every (sample, probe) pair of a project a row, NULL where it had none.

    ``samples`` and ``probes`` list the two sides per project. Rows that exist pass through
    untouched, those of unlisted probes too. Probes are dealt to hashed chunks, and the listed
    probes a sample holds are counted per chunk: only chunks that lack one are completed, so that
    a sample with a few missing cells costs a few chunks and no product is formed on a single key.
    """
    def with_chunk(df: DataFrame) -> DataFrame:
        return df.withColumn("chunk", F.pmod(F.xxhash64("probe_id"), F.lit(CHUNKS)).cast("int"))

    universe = with_chunk(probes.select(*PROBE).distinct())
    sizes = universe.groupBy("project_id", "chunk").agg(F.count("*").alias("expected"))
    expected = sizes.groupBy("project_id").agg(F.collect_list(F.struct("chunk", "expected")).alias("chunks"))
    expected = materialize(expected, "expected")  # one row per project, of at most CHUNKS pairs
    cells = [*SAMPLE, "probe_id"]
    listed = with_chunk(values.select(*cells)).join(universe, [*PROBE, "chunk"], "left_semi")
    held = listed.groupBy(*SAMPLE, "chunk").agg(F.count_distinct("probe_id").alias("held"))
    short = (
        samples.select(*SAMPLE).distinct()
        .join(expected, "project_id")
        .select(*SAMPLE, F.inline("chunks"))
        .join(held, [*SAMPLE, "chunk"], "left")
        .where(F.coalesce("held", F.lit(0)) < F.col("expected"))
        .select(*SAMPLE, "chunk")
    )
    short = materialize(short, "short")
    pairs = short.join(universe, ["project_id", "chunk"]).select(*cells)
    present = with_chunk(values.select(*cells)).join(short, [*SAMPLE, "chunk"], "left_semi").select(*cells)
    absent = pairs.join(present, cells, "left_anti").withColumn("value", F.lit(None).cast("double"))
    return values.select(*cells, "value").unionByName(absent)


def attach_samples(values: DataFrame, samples: DataFrame) -> DataFrame:
    return values.join(samples, SAMPLE)


def dataset_row(df: DataFrame, platform: Column, reference_genome: Column) -> DataFrame:
    """Metadata row of a freshly assembled project, one per ``project_id`` of ``df``."""
    return df.select(
        "project_id",
        platform.alias("platform"),
        reference_genome.alias("reference_genome"),
        F.lit("project").alias("level"),
        F.lit("cpg_matrix").alias("data_type"),
        F.lit("beta_value").alias("conversion"),
        F.lit("raw").alias("state"),
        F.array().cast("array<string>").alias("preprocessing_steps"),
        F.lit(None).cast("string").alias("split"),
        F.lit(None).cast("double").alias("split_percentage"),
    )


def first_replicates(samples: DataFrame) -> DataFrame:
    """Keep the first file of each case, by file name."""
    ordered = F.struct("file_name", *[c for c in samples.columns if c not in ("file_name", "submitter_id")])
    first = samples.groupBy("submitter_id").agg(F.min(ordered).alias("first"))
    return first.select("submitter_id", "first.*").select(*samples.columns)


def pack(values: DataFrame, element: T.DataType = T.FloatType()) -> DataFrame:
    """One row per sample holding its values in probe order, as a model reads them.

    A row is as wide as the probe set, so pack after probes were selected.
    """
    cells = F.array_sort(F.collect_list(F.struct("probe_id", "value")))
    ordered = values.groupBy(*SAMPLE).agg(cells.alias("cells"))
    vector = F.transform("cells", lambda c: c["value"].cast(element))
    return ordered.select(*SAMPLE, F.transform("cells", lambda c: c["probe_id"]).alias("probe_ids"), vector.alias("vector"))


def probe_dictionary(probes: DataFrame) -> DataFrame:
    """(probe_id, index): a place from 0 for every probe, in the order of ids. Stored once for all vectors."""
    return materialize(numbered(probes.select("probe_id").where("probe_id IS NOT NULL").distinct(), ["probe_id"], "index"), "dictionary")


def pack_blocks(values: DataFrame, samples: DataFrame, dictionary: DataFrame, width: int = 4096) -> DataFrame:
    """Every sample's vector in blocks of ``width`` places: ``block``, ``vector`` (float) and ``present``, a bitmap.

    A probe has the same block and place in every sample, whatever cells are missing: those are 0 with their bit unset (bits
    count from the highest of each byte). Every sample has every block. A row holds ``width`` values at most and no probe id.
    """
    size = dictionary.count()
    index = F.col("index")
    cells = values.where("value IS NOT NULL").join(dictionary, "probe_id").select(
        *SAMPLE, F.floor(index / width).cast("int").alias("block"), F.pmod(index, F.lit(width)).cast("int").alias("at"), "value"
    )
    lists = cells.groupBy(*SAMPLE, "block").agg(F.collect_list(F.struct("at", "value")).alias("cells"))
    last = max(0, -(-size // width) - 1)
    frame = samples.select(*SAMPLE).distinct().withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(last)))) if size else samples.select(*SAMPLE, F.lit(0).alias("block")).limit(0)
    whole = frame.join(lists, [*SAMPLE, "block"], "left").select(*SAMPLE, "block", F.col("cells.at").alias("at"), F.col("cells.value").alias("value"))
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in whole.schema.fields[:3])

    def run(batches):
        for batch in batches:
            vectors, bitmaps = [], []
            for block, at, value in zip(*(batch.column(i) for i in (2, 3, 4)), strict=True):
                vector = np.zeros(min(width, size - block.as_py() * width), np.float32)
                present = np.zeros(len(vector), bool)
                if at.is_valid:
                    places = at.values.to_numpy(zero_copy_only=False)
                    vector[places], present[places] = value.values.to_numpy(zero_copy_only=False), True
                vectors.append(vector)
                bitmaps.append(np.packbits(present).tobytes())
            made = [pa.array(vectors, pa.list_(pa.float32())), pa.array(bitmaps, pa.binary())]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], *made], [*SAMPLE, "block", "vector", "present"])

    return whole.mapInArrow(run, f"{kinds}, vector array<float>, present binary")


def unpack_blocks(blocks: DataFrame, dictionary: DataFrame, width: int = 4096) -> DataFrame:
    """The long matrix of packed blocks: a row for every cell whose bit is set."""
    cells = blocks.select(*SAMPLE, "block", "present", F.posexplode("vector").alias("at", "value"))
    byte = F.conv(F.hex(F.substring("present", F.floor(F.col("at") / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    bit = byte.bitwiseAND(F.expr("shiftleft(1, 7 - at % 8)")) != 0
    found = cells.where(bit).withColumn("index", F.col("block").cast("long") * width + F.col("at"))
    return found.join(dictionary, "index").select(*SAMPLE, "probe_id", F.col("value").cast("double").alias("value"))


def shape(values: DataFrame, stage: str) -> DataFrame:
    """Samples and probes per project, labelled with the stage they were counted at."""
    return values.groupBy("project_id").agg(
        F.countDistinct("sample_id").alias("n_samples"), F.countDistinct("probe_id").alias("n_probes")
    ).select(F.lit(stage).alias("stage"), "project_id", "n_samples", "n_probes")
