"""Empirical-Bayes batch correction (parametric ComBat) from sufficient statistics.

All samples with the same batch and covariates share one row of the design, a *cell*. The
model needs only count, mean and variance of each (probe, cell), which one partial
aggregation over the matrix yields. No design matrix is built: batch effects are eliminated
from the normal equations by sums per (probe, batch), which leaves one equation per covariate
level. Only that small Schur complement reaches the driver, to be judged for rank and inverted;
batches, combinations, cells and all coefficients are tables. The Bayes step runs on (probe, batch) rows and the
corrected value is a linear function of the original one per (probe, cell). The matrix is
read twice and never leaves the JVM.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from betaloom.functions.columns import portion
from betaloom.operators.quality import SAMPLE
from betaloom.tables import materialize

# Batch functions travel with the task, so executors need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

TOLERANCE = 1e-4
MAX_ITERATIONS = 10_000
# least eigenvalue of the scaled Schur complement that counts as full rank
RANK_TOLERANCE = 1e-9
# residual spread below this share of the values' own size is rounding, not variance
ROUNDING = 1e-12


def batch_labels(samples: DataFrame, batch_key: str = "batch_id") -> DataFrame:
    """Add ``batch``: the key, or a coarser one when some batch has a single sample.

    A missing key is a batch of its own. If any batch is a singleton the part before the first
    dash is used; if that has singletons too, the first two parts.
    """
    key = F.coalesce(F.col(batch_key).cast("string"), F.lit("None"))
    named = samples.withColumn("_full", key).withColumn("_front", portion(F.col("_full")))
    fewest = lambda c: named.groupBy(c).count().agg(F.min("count")).scalar()
    label = (
        F.when(fewest("_full") > 1, F.col("_full"))
        .when(fewest("_front") > 1, F.col("_front"))
        .otherwise(F.substring_index("_full", "-", 2))
    )
    return named.withColumn("batch", label).drop("_full", "_front")


def check_preconditions(values: DataFrame, samples: DataFrame, conversion: str, batch_key: str, covariates: tuple[str, ...]) -> None:
    """Refuse input the correction is not defined for. A cell without a row is missing, too."""
    if conversion != "m_value":
        raise ValueError(f"batch correction needs M-values, the data holds {conversion!r}")
    for column in (batch_key, *covariates):
        if column not in samples.columns:
            raise ValueError(f"column {column!r} is not in the samples table; batch correction needs it")
    present, probes = values.agg(F.count("value"), F.countDistinct("probe_id")).first()
    if present != probes * samples.count():
        raise ValueError("batch correction needs a matrix without missing values; impute or drop them first")


@dataclass(frozen=True)
class Design:
    """Who is in which cell, in tables.

    ``samples``: (sample, batch_no, combo); ``cells``: (batch_no, combo, count); ``levels``: (combo, level), the
    covariate levels of a combination but for each covariate's first; ``inverse``: (level, other, weight), the inverse of
    the Schur complement; ``shares``: (batch_no, level, share), the part of a batch that has a level.
    """

    samples: DataFrame
    cells: DataFrame
    levels: DataFrame
    shares: DataFrame
    inverse: DataFrame


def design(labelled: DataFrame, covariates: tuple[str, ...]) -> Design:
    """Cells of the samples and the inverse of the covariates' Schur complement; refuses a confounded design."""
    spark = labelled.sparkSession
    names = [f"_c{i}" for i in range(len(covariates))]
    texts = [F.coalesce(F.col(c).cast("string"), F.lit("None")) for c in ("batch", *covariates)]
    keyed = materialize(labelled.select(*SAMPLE, *[t.alias(n) for t, n in zip(texts, ("_batch", *names))]), "combat-samples")
    number = F.monotonically_increasing_id()
    batches = materialize(keyed.select("_batch").distinct().withColumn("batch_no", number), "combat-batches")
    if covariates:
        combos = materialize(keyed.select(*names).distinct().withColumn("combo", number), "combat-combinations")
        samples = keyed.join(combos, names)
        found = [sorted(r[0] for r in combos.select(n).distinct().collect())[1:] for n in names]
    else:
        combos, samples, found = None, keyed.withColumn("combo", F.lit(0).cast("long")), []
    samples = materialize(samples.join(batches, "_batch").select(*SAMPLE, "batch_no", "combo"), "combat-cells")
    cells = materialize(samples.groupBy("batch_no", "combo").agg(F.count("*").alias("count")), "combat-counts")

    numbered = [(i, text) for i, own in enumerate(found) for text in own]
    levels = spark.createDataFrame([], "combo long, level int")
    for i, name in enumerate(names):
        known = spark.createDataFrame([(text, at) for at, (own, text) in enumerate(numbered) if own == i], f"{name} string, level int")
        levels = levels.unionByName(combos.join(known, name).select("combo", "level"))
    levels = materialize(levels, "combat-levels")
    size = len(numbered)

    in_batch = cells.groupBy("batch_no").agg(F.sum("count").alias("n"))
    of_level = cells.join(levels, "combo").groupBy("batch_no", "level").agg(F.sum("count").alias("k"))
    shares = materialize(of_level.join(in_batch, "batch_no").select("batch_no", "level", "k", (F.col("k") / F.col("n")).alias("share")), "combat-shares")
    other = levels.select("combo", F.col("level").alias("other"))
    both = cells.groupBy("combo").agg(F.sum("count").alias("count")).join(levels, "combo").join(other, "combo")
    whole = both.groupBy("level", "other").agg(F.sum("count").cast("double").alias("v"))
    within = shares.join(shares.select("batch_no", F.col("level").alias("other"), F.col("k").alias("k2")), "batch_no")
    within = within.groupBy("level", "other").agg(F.sum(F.col("share") * F.col("k2")).alias("v"))
    gram, schur = np.zeros((size, size)), np.zeros((size, size))
    for row in whole.collect():
        gram[row.level, row.other] = schur[row.level, row.other] = row.v
    for row in within.collect():
        schur[row.level, row.other] -= row.v
    if size:
        scale = 1 / np.sqrt(np.diag(gram))
        if np.linalg.eigvalsh(schur * scale[:, None] * scale)[0] < RANK_TOLERANCE:
            raise ValueError("batches and covariates are confounded; the design matrix is not of full rank")
    weights = np.linalg.inv(schur) if size else schur
    entries = [(i, j, float(weights[i, j])) for i in range(size) for j in range(size)]
    inverse = spark.createDataFrame(entries, "level int, other int, weight double")
    return Design(samples, cells, levels, shares, inverse)


def cell_stats(values: DataFrame, cells: Design) -> DataFrame:
    """Count, mean and squared deviations per (probe, cell)."""
    per_cell = values.join(cells.samples, SAMPLE).groupBy("probe_id", "batch_no", "combo")
    return per_cell.agg(F.count("value").alias("count"), F.avg("value").alias("mean"), (F.var_pop("value") * F.count("value")).alias("spread"))


def covariate_effects(stats: DataFrame, cells: Design) -> DataFrame:
    """(probe, combo, effect): least-squares covariate effects with the batch effects eliminated."""
    total = F.sum(F.col("count") * F.col("mean"))
    of_levels = stats.join(cells.levels, "combo").groupBy("probe_id", "level").agg(total.alias("v"))
    batches = stats.groupBy("probe_id", "batch_no").agg(total.alias("total"))
    explained = batches.join(cells.shares, "batch_no").groupBy("probe_id", "level").agg((-F.sum(F.col("total") * F.col("share"))).alias("v"))
    left = of_levels.unionByName(explained).groupBy("probe_id", "level").agg(F.sum("v").alias("v"))
    solved = left.join(cells.inverse, "level").groupBy("probe_id", "other").agg(F.sum(F.col("v") * F.col("weight")).alias("beta"))
    named = cells.levels.withColumnRenamed("level", "other")
    return solved.join(named, "other").groupBy("probe_id", "combo").agg(F.sum("beta").alias("effect"))


def standardized_stats(stats: DataFrame, effects: DataFrame) -> DataFrame:
    """Standardized statistics per (probe, batch): n, gamma, delta, total, squares, with the probe's sd and grand mean."""
    own = W.partitionBy("probe_id", "batch_no")
    rest = F.col("mean") - F.coalesce("effect", F.lit(0.0))
    apart = stats.join(effects, ["probe_id", "combo"], "left").withColumn("rest", rest)
    apart = apart.withColumn("alpha", F.sum(F.col("count") * F.col("rest")).over(own) / F.sum("count").over(own))
    inside = F.col("spread") + F.col("count") * (F.col("rest") - F.col("alpha")) ** 2
    per_batch = apart.groupBy("probe_id", "batch_no").agg(
        F.sum("count").alias("n"), F.first("alpha").alias("alpha"), F.sum(inside).alias("inside"), F.sum(F.col("spread") + F.col("count") * F.col("mean") ** 2).alias("size")
    )
    per_batch = materialize(per_batch, "combat-batch-stats")
    n = F.sum("n")
    sd, size = F.sqrt(F.sum("inside") / n), F.sqrt(F.sum("size") / n)
    grand = (F.sum(F.col("n") * F.col("alpha")) / n).alias("grand")
    per_probe = per_batch.groupBy("probe_id").agg(F.when(sd > ROUNDING * size, sd).otherwise(0.0).alias("sd"), grand)
    scale = F.when(F.col("sd") > 0, F.col("sd")).otherwise(1.0)
    gamma = (F.col("alpha") - F.col("grand")) / scale
    varied = F.col("inside") / scale**2
    return per_batch.join(per_probe, "probe_id").select(
        "probe_id", "sd", "grand", F.col("batch_no").alias("batch"), F.col("n").cast("double").alias("n"), gamma.alias("gamma"),
        F.when(F.col("n") > 1, varied / (F.col("n") - 1)).otherwise(1.0).alias("delta"), (F.col("n") * gamma).alias("total"),
        (varied + F.col("n") * gamma**2).alias("squares"),
    )


def batch_priors(stats: DataFrame) -> DataFrame:
    """Method-of-moments hyperparameters per batch, over the probes that vary."""
    m, s2 = F.avg("delta"), F.var_samp("delta")
    return stats.where("sd > 0").groupBy("batch").agg(
        F.avg("gamma").alias("gamma_bar"),
        F.coalesce(F.var_samp("gamma"), F.lit(0.0)).alias("t2"),
        F.try_divide(2 * s2 + m * m, s2).alias("a"),
        F.try_divide(m * s2 + m * m * m, s2).alias("b"),
    )


def _updates(p: pd.DataFrame):
    """One step of the coupled posterior-mean equations, vectorized over rows.

    One-sample batches are only shifted. Where all probes share one variance the prior is a
    point and the variance stays as it is.
    """
    n, gamma, t2 = p["n"].to_numpy(), p["gamma"].to_numpy(), p["t2"].to_numpy()
    bar, total, squares = p["gamma_bar"].to_numpy(), p["total"].to_numpy(), p["squares"].to_numpy()
    a, b = p["a"].to_numpy(), p["b"].to_numpy()
    single, point = n <= 1, np.isnan(a)

    def step(d):
        with np.errstate(divide="ignore", invalid="ignore"):
            g = np.where(t2 * n + d > 0, (t2 * n * gamma + d * bar) / (t2 * n + d), gamma)
        around = squares - 2 * g * total + n * g * g
        return g, np.where(single, 1.0, np.where(point, d, (b + 0.5 * around) / (n / 2 + a - 1)))

    return step


def _changes(new, old):
    with np.errstate(divide="ignore", invalid="ignore"):
        return np.nan_to_num(np.abs(new - old) / np.abs(old), nan=0.0)


def _count_steps(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Steps each row needs until its relative change is below the tolerance."""
    for part in parts:
        step = _updates(part)
        g, d = part["gamma"].to_numpy(), part["delta"].to_numpy()
        steps = np.zeros(len(part), dtype=np.int32)
        for i in range(1, MAX_ITERATIONS + 1):
            new_g, new_d = step(d)
            moving = np.maximum(_changes(new_g, g), _changes(new_d, d)) >= TOLERANCE
            g, d = new_g, new_d
            steps[moving] = i
            if not moving.any():
                break
        else:
            if len(part):
                raise ArithmeticError(f"batch effects haven't converged after {MAX_ITERATIONS} steps")
        yield pd.DataFrame({"batch": part["batch"], "steps": steps + 1})


def _run_steps(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for part in parts:
        step = _updates(part)
        g, d = part["gamma"].to_numpy(), part["delta"].to_numpy()
        last = part["steps"].to_numpy()
        for i in range(1, int(last.max(initial=0)) + 1):
            new_g, new_d = step(d)
            g, d = np.where(i <= last, new_g, g), np.where(i <= last, new_d, d)
        yield part[["probe_id", "batch", "sd", "grand"]].assign(gamma_star=g, delta_star=d)


def shrink(stats: DataFrame, priors: DataFrame) -> DataFrame:
    """Posterior batch effects. A batch iterates until its slowest probe has converged, so the
    step count is agreed on first; rows are independent after that."""
    rows = stats.where("sd > 0").join(priors, "batch")
    needed = rows.drop("probe_id").mapInPandas(_count_steps, "batch long, steps int")
    agreed = materialize(needed.groupBy("batch").agg(F.max("steps").alias("steps")), "combat-steps")
    return rows.join(agreed, "batch").mapInPandas(
        _run_steps, "probe_id string, batch long, sd double, grand double, gamma_star double, delta_star double"
    )


def correction_factors(shrunk: DataFrame, cells: DataFrame, effects: DataFrame) -> DataFrame:
    """``value * slope + offset`` per (probe, cell). A batch without spread is shifted only."""
    slope = F.when(F.col("delta_star") > 0, 1.0 / F.sqrt("delta_star")).otherwise(1.0)
    fit = F.col("grand") + F.coalesce("effect", F.lit(0.0))
    offset = fit - (fit + F.col("sd") * F.col("gamma_star")) * slope
    each = shrunk.withColumnRenamed("batch", "batch_no").join(cells.select("batch_no", "combo"), "batch_no")
    each = each.join(effects, ["probe_id", "combo"], "left")
    return each.select("probe_id", "batch_no", "combo", slope.alias("slope"), offset.alias("offset"))


def batch_correction(
    values: DataFrame,
    samples: DataFrame,
    conversion: str = "m_value",
    batch_key: str = "batch_id",
    covariates: tuple[str, ...] = ("project_id",),
) -> DataFrame:
    """Corrected matrix. Probes without residual variance come back unchanged."""
    check_preconditions(values, samples, conversion, batch_key, covariates)
    cells = design(batch_labels(samples, batch_key), covariates)
    stats = materialize(cell_stats(values, cells), "combat-cell-stats")
    effects = materialize(covariate_effects(stats, cells), "combat-effects")
    scores = materialize(standardized_stats(stats, effects), "combat-stats")
    priors = materialize(batch_priors(scores), "combat-priors")
    factors = materialize(correction_factors(shrink(scores, priors), cells.cells, effects), "combat-factors")
    adjusted = F.coalesce(F.col("value") * F.col("slope") + F.col("offset"), F.col("value"))
    return (
        values.join(cells.samples, SAMPLE)
        .join(factors, ["probe_id", "batch_no", "combo"], "left")
        .select(*SAMPLE, "probe_id", adjusted.alias("value"))
    )
