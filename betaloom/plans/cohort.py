"""The cohort job: from prepared projects to scaled, split, model-ready tables."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from betaloom.dataset import Dataset, log_step
from betaloom.operators import cohort as co
from betaloom.operators import combat
from betaloom.operators import split as sp
from betaloom.operators.quality import SAMPLE
from betaloom.settings import CohortOptions
from betaloom.sources.annotation import select_annotation
from betaloom.tables import materialize


def aggregate_cohort(projects: Dataset, cohort_id: str, order: str = "ordinal") -> Dataset:
    """Stack the projects of ``projects`` on their common probes."""
    common = materialize(co.common_probes(projects.probes, projects.meta), "common-probes")
    members = projects.meta.select("project_id")
    values = projects.values.join(members, "project_id", "left_semi").join(common, "probe_id", "left_semi")
    samples = projects.samples.join(members, "project_id", "left_semi")
    meta = co.cohort_row(projects.meta, cohort_id, order)
    return Dataset(values.select(*SAMPLE, "probe_id", "value"), samples, common, meta)


def filter_by_mad(ds: Dataset, top_n: int = 30_000) -> Dataset:
    scores = co.mad_scores(ds.values, largest=ds.samples.count())
    chosen = materialize(co.top_probes(scores, top_n), "top-probes")
    values = ds.values.join(chosen.select("probe_id"), "probe_id", "left_semi")
    meta = log_step(ds.meta, "MAD_probe_filtering", state="processed")
    return ds.replaced(values=values.select(*ds.values.columns), probes=chosen, meta=meta)


def cohort_batch_correction(ds: Dataset, options: CohortOptions = CohortOptions()) -> Dataset:
    conversion = ds.meta.select("conversion").first()[0]
    values = combat.batch_correction(ds.values, ds.samples, conversion, options.batch_key, options.covariates)
    return ds.replaced(values=values).logged("batch_correction", state="processed")


def aggregate_genes(ds: Dataset, annotation: DataFrame, options: CohortOptions = CohortOptions()) -> Dataset:
    """Gene matrix; the ``probe_id`` column then holds gene symbols.

    An annotation with ``platform`` and ``reference_genome`` columns is cut down to the
    dataset's own array and build.
    """
    if "platform" in annotation.columns:
        own = ds.meta.select("platform", "reference_genome").first()
        annotation = select_annotation(annotation, own.platform, own.reference_genome)
    genes = materialize(co.gene_map(annotation, options.regions), "gene-map")
    values = co.gene_aggregation(ds.values, genes).withColumnRenamed("gene_symbol", "probe_id")
    probes = values.select("probe_id").distinct()
    return ds.replaced(values=values, probes=probes).logged("gene_aggregation", data_type="gene_matrix", state="processed")


def clip_and_scale(ds: Dataset, options: CohortOptions = CohortOptions()) -> Dataset:
    """Winsorized and scaled to [-1, 1]; the bounds go into the metadata."""
    values, bounds = co.clip_and_scale(ds.values, options.clip_quantiles)
    if bounds is None or bounds[0] == bounds[1]:
        return ds
    meta = log_step(ds.meta, "clip_and_scale", state="processed").withColumns(
        {
            "lower_bound": F.lit(bounds[0]),
            "upper_bound": F.lit(bounds[1]),
            "target_range": F.array(F.lit(-1.0), F.lit(1.0)),
        }
    )
    return ds.replaced(values=values, meta=meta)


def split(ds: Dataset, options: CohortOptions = CohortOptions()) -> Dataset:
    """Samples get unique names, then a part; the matrix follows by joining its samples."""
    named = materialize(co.unique_names(ds.samples.drop("sample_name")), "named-samples")
    placed = materialize(sp.split(named, options.fractions, options.seed, "sample_name"), "split")
    return ds.replaced(samples=placed)


def part(ds: Dataset, name: str) -> Dataset:
    """One part of a split cohort."""
    samples = ds.samples.where(F.col("split") == name)
    values = ds.values.join(samples.select(*SAMPLE), SAMPLE, "left_semi")
    share = samples.agg(F.first("split_percentage")).scalar()
    return ds.replaced(values=values, samples=samples, meta=ds.meta.withColumns({"split": F.lit(name), "split_percentage": share}))


def prepare_cohort(
    projects: Dataset,
    cohort_id: str = "pancancer",
    annotation: DataFrame | None = None,
    options: CohortOptions = CohortOptions(),
    order: str = "ordinal",
) -> Dataset:
    """All cohort steps that are switched on, in their fixed order.

    The stacked matrix is stored once it is as small as it gets before a step that reads it
    several times.
    """
    ds = aggregate_cohort(projects, cohort_id, order)
    if options.mad_probe_filtering:
        ds = filter_by_mad(ds, options.top_n)
    if options.batch_correction:
        ds = cohort_batch_correction(_stored(ds), options)
    if options.gene_aggregation:
        if annotation is None:
            raise ValueError("gene aggregation needs an annotation")
        ds = aggregate_genes(ds, annotation, options)
    if options.clip_and_scale:
        ds = clip_and_scale(_stored(ds), options)
    return split(ds, options) if options.split else ds


def _stored(ds: Dataset) -> Dataset:
    return replace(ds, values=materialize(ds.values, "matrix"))
