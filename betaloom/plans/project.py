"""The per-project job: quality control and preprocessing of one or many projects at once.

The raw matrix is scanned three times and never shuffled as a whole: once for sample
statistics, once for probe statistics (cells of failed samples and of probes the annotation
rules out are dropped in the scan), once to emit the surviving cells. The two statistics
tables are stored, so the planner broadcasts them when they are small and shuffles by sample
and probe when they are not.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from betaloom.dataset import Dataset, log_step
from betaloom.functions.columns import m_value
from betaloom.operators import control, matrix, preprocess as prep, quality as qc
from betaloom.settings import ProjectOptions
from betaloom.tables import materialize, spread


def sample_qc(ds: Dataset, options: ProjectOptions = ProjectOptions()) -> Dataset:
    stats = materialize(qc.sample_stats(ds.values, qc.probe_counts(ds.probes)), "sample-stats")
    verdicts = materialize(
        qc.sample_verdicts(stats, options.sample_missing_threshold, options.outlier_threshold), "sample-verdicts"
    )
    kept = spread(verdicts.where("passed").select(*qc.SAMPLE, "missing_rate", "mean"))
    samples = spread(ds.samples.drop("missing_rate", "mean"), verdicts).join(kept, qc.SAMPLE)
    return ds.replaced(values=qc.keep_samples(ds.values, kept), samples=samples).logged("sample_qc")


def _measured(ds: Dataset, annotation: DataFrame | None, options: ProjectOptions) -> DataFrame:
    """Probe statistics over the current samples, for the probes the annotation lets through."""
    values = ds.values
    if annotation is not None:
        usable = materialize(qc.usable_probes(annotation, options), "usable-probes")
        values = qc.align_to_annotation(values, spread(usable))
    return materialize(qc.probe_stats(values, qc.sample_counts(ds.samples)), "probe-stats")


def _kept(ds: Dataset, stats: DataFrame) -> Dataset:
    known = stats.select(*qc.PROBE, "missing_rate", "mean", "variance")
    return ds.replaced(values=qc.keep_probes(ds.values, spread(stats.select(*qc.PROBE))), probes=known)


def probe_qc(ds: Dataset, annotation: DataFrame, options: ProjectOptions = ProjectOptions()) -> Dataset:
    stats = _measured(ds, annotation, options)
    return _kept(ds, stats.where(F.col("missing_rate") <= options.probe_missing_threshold)).logged("probe_qc")


def quality_control(
    ds: Dataset, annotation: DataFrame, options: ProjectOptions = ProjectOptions(), audit: DataFrame | None = None
) -> tuple[Dataset, DataFrame | None]:
    """Sample QC, then probe QC, each if switched on; the audit table learns which files passed."""
    before = ds
    if options.sample_qc:
        ds = sample_qc(ds, options)
        audit = _audited(audit, before, ds)
    if options.probe_qc:
        ds = probe_qc(ds, annotation, options)
    return ds.replaced(meta=ds.meta.withColumn("state", F.lit("processed"))), audit


def _audited(audit: DataFrame | None, before: Dataset, after: Dataset) -> DataFrame | None:
    if audit is None:
        return None
    ids = lambda ds: spread(ds.samples.select(F.col("sample_id").alias("file_id")), audit)
    return control.update_qc(audit, ids(before), ids(after))


def _finished(ds: Dataset, stats: DataFrame, options: ProjectOptions) -> Dataset:
    """Imputation and M-values for probes whose statistics are known."""
    complete = options.filter_variance and options.na_policy == "propagate"
    values, probes = ds.values, ds.probes
    if options.impute:
        table = prep.imputation_table(stats)
        probes = probes.join(spread(table), qc.PROBE)
        if not complete:
            values = prep.impute(matrix.densify(values, ds.samples, stats), table)
    if options.convert_to_mval:
        values = values.withColumn("value", m_value(F.col("value"), options.epsilon))
    meta = ds.meta
    for step in ("filter_variance", "impute", "convert_to_mval"):
        if getattr(options, step):
            meta = log_step(meta, step)
    if options.convert_to_mval:
        meta = meta.withColumn("conversion", F.lit("m_value"))
    return Dataset(values, ds.samples, probes, meta.withColumn("state", F.lit("processed")))


def preprocess(ds: Dataset, options: ProjectOptions = ProjectOptions()) -> Dataset:
    """Variance filter, imputation and M-values, each if switched on."""
    stats = _measured(ds, None, options)
    if options.filter_variance:
        stats = prep.filter_variance(stats, options)
    return _finished(_kept(ds, stats), stats, options)


def prepare_dataset(
    ds: Dataset, annotation: DataFrame, options: ProjectOptions = ProjectOptions(), audit: DataFrame | None = None
) -> tuple[Dataset, DataFrame | None]:
    """Quality control and preprocessing with one shared pass for all probe statistics.

    Probe QC and the variance filter judge the same cells, so their conditions are applied
    together to one statistics table.
    """
    before = ds
    if options.sample_qc:
        ds = sample_qc(ds, options)
        audit = _audited(audit, before, ds)
    stats = _measured(ds, annotation if options.probe_qc else None, options)
    if options.probe_qc:
        stats = stats.where(F.col("missing_rate") <= options.probe_missing_threshold)
        ds = ds.logged("probe_qc")
    if options.filter_variance:
        stats = prep.filter_variance(stats, options)
    return _finished(_kept(ds, stats), stats, options), audit
