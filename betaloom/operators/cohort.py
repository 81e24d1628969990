"""Joining projects into a cohort, probe selection, gene roll-up and scaling."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from betaloom.functions.columns import clipped
from betaloom.functions.quantiles import SMALL_GROUP, global_quantiles, grouped_quantiles, largest_group
from betaloom.functions.running import running_totals
from betaloom.operators.quality import PROBE, SAMPLE
from betaloom.settings import GENE_REGIONS, PLATFORM_PRIORITY
from betaloom.tables import materialize

# values of one probe that a single task may sort (spilling, a few dozen megabytes)
SORT_LIMIT = 1_000_000

# --- cohort assembly ---


def common_probes(probes: DataFrame, meta: DataFrame) -> DataFrame:
    """Probes every project of ``meta`` has. ``probes`` holds (project_id, probe_id) pairs."""
    projects = meta.select("project_id").distinct()
    per_probe = (
        probes.select(*PROBE).distinct()
        .join(projects, "project_id", "left_semi")
        .groupBy("probe_id")
        .agg(F.count("*").alias("n_projects"))
    )
    wanted = projects.agg(F.count("*")).scalar()
    return per_probe.where(F.col("n_projects") == wanted).select("probe_id")


def cohort_aggregation(values: DataFrame, probes: DataFrame, meta: DataFrame) -> DataFrame:
    """Stacked project matrices cut down to their common probes."""
    stacked = values.join(meta.select("project_id"), "project_id", "left_semi")
    return stacked.join(common_probes(probes, meta), "probe_id", "left_semi").select(*values.columns)


def platform_rank(platform: Column) -> Column:
    """1 for the highest resolution; NULL for a name outside the supported list."""
    return reduce(
        lambda rest, i: F.when(platform == PLATFORM_PRIORITY[i], i + 1).otherwise(rest),
        reversed(range(len(PLATFORM_PRIORITY))),
        F.lit(None).cast("int"),
    )


def resolve_platform(meta: DataFrame) -> DataFrame:
    """The array of highest resolution among the projects, the lowest if none is known."""
    best = F.min_by("platform", platform_rank(F.col("platform")))
    return meta.agg(F.coalesce(best, F.lit(PLATFORM_PRIORITY[-1])).alias("platform"))


def cohort_row(meta: DataFrame, cohort_id: str, order: str = "ordinal") -> DataFrame:
    """Cohort metadata: every project's own row in a map, shared fields from the first project."""
    details = [c for c in meta.columns if c not in ("project_id", order)]
    entry = F.struct("project_id", F.struct(*details))
    best = F.min_by("platform", platform_rank(F.col("platform")))
    return meta.agg(
        F.map_from_entries(F.collect_list(entry)).alias("projects"),
        F.coalesce(best, F.lit(PLATFORM_PRIORITY[-1])).alias("platform"),
        *[F.min_by(c, order).alias(c) for c in ("reference_genome", "data_type", "conversion")],
    ).select(
        F.lit(cohort_id).alias("cohort_id"),
        F.lit("cohort").alias("level"),
        F.lit("raw").alias("state"),
        F.array().cast("array<string>").alias("preprocessing_steps"),
        "*",
    )


def mixed_fields(meta: DataFrame) -> DataFrame:
    """Distinct values of the fields a cohort takes from its first project; more than one is a warning."""
    fields = ("reference_genome", "data_type", "conversion")
    counts = meta.agg(*[F.countDistinct(c).alias(c) for c in fields])
    rows = F.array(*[F.struct(F.lit(c).alias("field"), F.col(c).alias("distinct_values")) for c in fields])
    return counts.select(F.inline(rows))


# --- probe selection ---


def mad_scores(values: DataFrame, small_group: int = SORT_LIMIT, largest: int | None = None) -> DataFrame:
    """Median absolute deviation per probe, unscaled, over the values present.

    A probe has at most one value per sample. Up to ``small_group`` of them are sorted together:
    one scan and one shuffle give both medians. Beyond that both are found by narrowing, which
    gathers no probe. ``largest`` is an upper bound on the values per probe, if known.
    """
    size = largest_group(values, ["probe_id"], "value") if largest is None else largest
    if size <= small_group:
        return _sorted_mad(values)
    limit = min(small_group, SMALL_GROUP)
    middle = materialize(grouped_quantiles(values, ["probe_id"], "value", {"center": 0.5}, limit, size), "medians")
    distance = values.join(middle, "probe_id").select("probe_id", F.abs(F.col("value") - F.col("center")).alias("distance"))
    return grouped_quantiles(distance, ["probe_id"], "distance", {"mad_score": 0.5}, limit, size)


def _sorted_mad(values: DataFrame) -> DataFrame:
    probe = W.partitionBy("probe_id")
    in_middle = (F.col("rank") * 2 - F.col("n")).between(0, 2)
    center = F.avg(F.when(in_middle, F.col("value")))
    present = values.where(F.col("value").isNotNull()).select("probe_id", "value")
    ranked = present.withColumns({"rank": F.row_number().over(probe.orderBy("value")), "n": F.count("*").over(probe)})
    apart = ranked.select("probe_id", "n", F.abs(F.col("value") - center.over(probe)).alias("value"))
    ranked = apart.withColumn("rank", F.row_number().over(probe.orderBy("value")))
    return ranked.groupBy("probe_id").agg(center.alias("mad_score"))


def top_probes(scores: DataFrame, top_n: int = 30_000) -> DataFrame:
    """The ``top_n`` probes by score, ties by id; probes that do not vary are dropped."""
    return scores.where(F.col("mad_score") > 0).orderBy(F.desc("mad_score"), "probe_id").limit(top_n)


# --- gene roll-up ---


def gene_map(annotation: DataFrame, regions: tuple[str, ...], distinct_genes: bool = False) -> DataFrame:
    """(probe_id, gene_symbol, weight) for probes in any of ``regions``.

    A gene listed k times for a probe has weight k, unless ``distinct_genes``. An empty symbol
    is a gene like any other; a probe without symbols contributes nothing. Rows are shuffled by
    probe while a probe's symbols are one text; they are listed and counted where they arrive.
    """
    unknown = [r for r in regions if r not in GENE_REGIONS]
    if unknown:
        raise ValueError(f"unknown regions {unknown}; supported: {list(GENE_REGIONS)}")
    inside = reduce(lambda a, b: a | b, [F.col(r) for r in regions], F.lit(False))
    texts = annotation.where(inside & F.col("gene_symbol").isNotNull()).groupBy("probe_id").agg(F.collect_list("gene_symbol").alias("texts"))
    listed = texts.select("probe_id", F.explode("texts").alias("text")).select("probe_id", F.explode(F.split("text", ";")).alias("gene_symbol"))
    counted = listed.groupBy("probe_id", "gene_symbol").agg(F.count("*").alias("weight"))
    return counted.withColumn("weight", F.lit(1).cast("long")) if distinct_genes else counted


def gene_aggregation(values: DataFrame, genes: DataFrame) -> DataFrame:
    """Mean per sample and gene over the contributing probes, as a (weighted) partial aggregation."""
    weight = F.when(F.col("value").isNotNull(), F.col("weight"))
    rolled = values.join(genes, "probe_id").groupBy(*SAMPLE, "gene_symbol")
    total = F.sum(F.col("value") * F.col("weight")) / F.sum(weight)
    return rolled.agg(total.alias("value"))


# --- scaling ---


def winsor_bounds(values: DataFrame, quantiles: tuple[float, float] = (0.01, 0.99)) -> tuple[float, float] | None:
    """Exact quantiles of the whole matrix, or ``None`` for a matrix without values."""
    return global_quantiles(values, "value", quantiles)


def winsorize(values: DataFrame, low: float, high: float) -> DataFrame:
    return values.withColumn("value", clipped(F.col("value"), F.lit(low), F.lit(high)))


def min_max(values: DataFrame, low: float, high: float) -> DataFrame:
    """Map ``[low, high]`` to [-1, 1]; an empty range leaves the values alone."""
    if high == low:
        return values
    return values.withColumn("value", 2.0 * ((F.col("value") - low) / (high - low)) - 1.0)


def clip_and_scale(values: DataFrame, quantiles: tuple[float, float] = (0.01, 0.99)) -> tuple[DataFrame, tuple[float, float] | None]:
    """Scaled matrix and the bounds used. Without a range the input comes back unclipped."""
    bounds = winsor_bounds(values, quantiles)
    if bounds is None or bounds[0] == bounds[1]:
        return values, bounds
    return min_max(winsorize(values, *bounds), *bounds), tuple(bounds)


# --- sample names ---


# suffixes, or numbers between them, that one task sorts
NAMES_TOGETHER = 1000


def unique_names(samples: DataFrame) -> DataFrame:
    """Add ``sample_name``: the id, with -1, -2, ... on later samples that share it; suffixes that are ids themselves are passed over.

    Later means later in (project, file name) order. Counting runs project by project first,
    so an id that many projects share is never sorted as one group. The j-th free number of an id is j and the taken numbers t of
    which fewer than j free ones lie below, that is, whose t minus rank is less than j: a running total over both.
    """
    name = F.col("sample_id").cast("string")
    numbered = running_totals(samples, ["sample_id"], F.col("project_id"), ["file_name"], {"_seen": F.lit(1)})
    numbered = materialize(numbered.withColumns({"_name": name, "_j": F.col("_seen") - 1}), "seen-names")
    later = numbered.where("_j > 0").select(F.col("_name").alias("_stem"), "_j")
    stem, suffix = (F.regexp_extract(name, r"^(.*)-([1-9]\d{0,8})$", i) for i in (1, 2))
    taken = samples.select(stem.alias("_stem"), suffix.alias("_k")).where("_k <> ''").distinct()
    taken = taken.join(later.select("_stem").distinct(), "_stem", "left_semi").withColumn("_k", F.col("_k").cast("long"))
    bucket = lambda c: F.floor(F.col(c) / NAMES_TOGETHER)
    ranked = running_totals(taken, ["_stem"], bucket("_k"), ["_k"], {"_i": F.lit(1)})
    below = ranked.groupBy("_stem", (F.col("_k") - F.col("_i")).alias("_at")).agg(F.count("*").alias("_taken"))
    asked = later.select("_stem", (F.col("_j") - 1).alias("_at"), F.lit(0).cast("long").alias("_taken"), "_j")
    events = below.withColumn("_j", F.lit(None).cast("long")).unionByName(asked.withColumn("_j", F.col("_j").cast("long")))
    counted = running_totals(events, ["_stem"], bucket("_at"), ["_at", "_j"], {"_below": F.col("_taken")}).where("_j IS NOT NULL")
    free = counted.select("_stem", "_j", (F.col("_j") + F.col("_below")).alias("_free"))
    named = numbered.join(free.withColumnRenamed("_j", "_own"), (F.col("_name") == F.col("_stem")) & (F.col("_j") == F.col("_own")), "left")
    suffixed = F.concat("_name", F.lit("-"), F.col("_free").cast("string"))
    return named.select(*samples.columns, F.coalesce(suffixed, F.col("_name")).alias("sample_name"))
