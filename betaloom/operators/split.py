"""Stratified train / validation / test split with exact sizes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from betaloom.functions.running import hash_prefix, running_totals
from betaloom.tables import materialize

NAMES = ("training", "validation", "test")


def _leave_out(counts: DataFrame, available: str, fraction: float, drawn: str) -> DataFrame:
    """Split ``available`` of every stratum into what stays and ``drawn``.

    ceil(fraction * all) samples are drawn in total. What stays is shared out by largest
    remainder, ties by project; integer arithmetic keeps the shares exact. One row per
    project goes through here.
    """
    everything = W.partitionBy()
    counts = counts.withColumn("_all", F.sum(available).over(everything))
    counts = counts.withColumn("_stay", F.col("_all") - F.ceil(F.lit(float(fraction)) * F.col("_all")).cast("long"))
    share = F.expr(f"({available} * _stay) div _all")
    counts = counts.withColumn("_floor", share).withColumn("_rest", F.expr(f"({available} * _stay) % _all"))
    rank = F.row_number().over(W.partitionBy().orderBy(F.desc("_rest"), "project_id"))
    short = F.col("_stay") - F.sum("_floor").over(everything)
    extra = F.when(rank <= short, 1).otherwise(0)
    counts = counts.withColumn("_extra", extra)
    counts = counts.withColumn(drawn, F.col(available) - F.col("_floor") - F.col("_extra"))
    return counts.drop("_all", "_stay", "_floor", "_rest", "_extra")


def quotas(samples: DataFrame, fractions: tuple[float, float, float]) -> DataFrame:
    """Per project how many samples each part gets.

    Two draws: test takes its fraction of all samples, validation its fraction of the rest.
    """
    counts = samples.groupBy("project_id").agg(F.count("*").alias("n"))
    counts = _leave_out(counts, "n", fractions[2], "n_test").withColumn("n_rest", F.col("n") - F.col("n_test"))
    counts = _leave_out(counts, "n_rest", fractions[1], "n_validation")
    training = (F.col("n_rest") - F.col("n_validation")).alias("n_training")
    return counts.select("project_id", "n", training, "n_validation", "n_test")


def draw_key(name: Column, seed: int) -> Column:
    """Seeded digest that puts samples in a reproducible random order."""
    return F.md5(F.concat(F.lit(f"{seed}:"), name.cast("string")))


def split(
    samples: DataFrame,
    fractions: tuple[float, float, float] = (0.60, 0.20, 0.20),
    seed: int = 42,
    name: str = "sample_id",
) -> DataFrame:
    """Add ``split`` and its nominal ``split_percentage``.

    Every project's samples are ranked in seeded digest order; the first ``n_test`` are test,
    the next ``n_validation`` validation. Ranking counts by digest prefix first, so a project
    with most of the samples is ranked by many tasks. Samples without a project are one project more.
    """
    keyed = samples.withColumn("_digest", draw_key(F.col(name), seed))
    ranked = running_totals(
        keyed, ["project_id"], hash_prefix(F.col("_digest")), ["_digest", name], {"_rank": F.lit(1)}
    )
    shares = materialize(quotas(samples, fractions).drop("n").withColumnRenamed("project_id", "_project"), "quotas")
    placed = ranked.join(shares, F.col("project_id").eqNullSafe(F.col("_project")))
    in_test = F.col("_rank") <= F.col("n_test")
    in_validation = F.col("_rank") <= F.col("n_test") + F.col("n_validation")
    part = F.when(in_test, NAMES[2]).when(in_validation, NAMES[1]).otherwise(NAMES[0])
    nominal = F.when(in_test, fractions[2]).when(in_validation, fractions[1]).otherwise(fractions[0])
    return placed.select(*samples.columns, part.alias("split"), nominal.cast("double").alias("split_percentage"))


def split_summary(placed: DataFrame) -> DataFrame:
    """Per part its nominal fraction, the fraction reached and its size."""
    total = placed.agg(F.count("*")).scalar()
    sizes = placed.groupBy("split", "split_percentage").agg(F.count("*").alias("n_samples"))
    return sizes.withColumn("actual_percentage", F.col("n_samples") / total)
