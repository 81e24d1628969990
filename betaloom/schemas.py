"""Explicit schemas of every file the sources read."""

from __future__ import annotations

from pyspark.sql import types as T

from betaloom.settings import GENE_REGIONS


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


STRING = T.StringType()

RAW_BETA = _struct(probe_id=STRING, beta_value=STRING)
BETA = _struct(file_id=STRING, probe_id=STRING, beta_value=T.DoubleType())
MANIFEST = _struct(file_id=STRING, file_name=STRING)
STATUS_LOG = _struct(
    file_id=STRING, file_name=STRING, status=STRING, attempts=T.IntegerType(), timestamp=T.TimestampType()
)
METADATA = _struct(
    file_id=STRING, file_name=STRING, data_category=STRING, data_type=STRING, experimental_strategy=STRING,
    platform=STRING, reference_genome=STRING, project_id=STRING, submitter_id=STRING, sample_type=STRING,
    aliquot_id=STRING, status=STRING, barcode=STRING, batch_id=STRING,
)
AUDIT = _struct(
    file_id=STRING, file_name=STRING, downloaded=T.IntegerType(), download_status=STRING,
    download_attempts=T.IntegerType(), download_timestamp=T.TimestampType(), metadata_fetched=T.IntegerType(),
    metadata_status=STRING, qc_pass=T.IntegerType(), parquet_path=STRING, notes=STRING,
)
ANNOTATION = _struct(
    probe_id=STRING, chr=STRING, pos=T.IntegerType(), strand=STRING, probe_type=STRING, gene_symbol=STRING,
    is_sex_chr=T.BooleanType(), has_cpg_snp=T.BooleanType(), has_sbe_snp=T.BooleanType(),
    has_probe_snp=T.BooleanType(), is_cross_reactive=T.BooleanType(), is_multi_mapped=T.BooleanType(),
)
ANNOTATION_WITH_REGIONS = T.StructType([*ANNOTATION.fields, *[T.StructField(r, T.BooleanType()) for r in GENE_REGIONS]])

_ALIQUOT = _struct(aliquot_id=STRING, submitter_id=STRING)
_ANALYTE = _struct(aliquots=T.ArrayType(_ALIQUOT))
_PORTION = _struct(submitter_id=STRING, analytes=T.ArrayType(_ANALYTE))
_SAMPLE = _struct(sample_type=STRING, portions=T.ArrayType(_PORTION))
CASE = _struct(submitter_id=STRING, project=_struct(project_id=STRING), samples=T.ArrayType(_SAMPLE))

FILE_HIT = _struct(
    file_id=STRING, file_name=STRING, data_category=STRING, experimental_strategy=STRING, data_type=STRING,
    platform=STRING, reference_genome=STRING, access=STRING, status=STRING, cases=T.ArrayType(CASE),
)


def response(hit: T.StructType) -> T.StructType:
    """Envelope of a saved service response."""
    return _struct(data=_struct(hits=T.ArrayType(hit)))
