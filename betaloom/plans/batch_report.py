"""How much of the variance batches explain, before and after correction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from betaloom.functions.columns import portion
from betaloom.operators import combat
from betaloom.operators import diagnostics as dg
from betaloom.operators.quality import SAMPLE
from betaloom.tables import materialize


def explained(values: DataFrame, samples: DataFrame, top_n: int = 5_000, k: int = 10) -> DataFrame:
    """(factor, fraction) for project and portion over the first ``k`` components."""
    chosen = materialize(dg.highly_variable(values, top_n).select("probe_id"), "variable-probes")
    k = min(k, chosen.count())
    # every step of the iteration reads it twice
    scaled = materialize(dg.standardize(values.join(chosen, "probe_id", "left_semi")), "scaled")
    scores = dg.principal_components(scaled, k)
    factors = samples.select(*SAMPLE, portion(F.col("batch_id")).alias("portion"))
    scores = materialize(scores.join(factors, SAMPLE), "scores")
    columns = [f"PC{i + 1}" for i in range(k)]
    rows = [dg.fraction_variance(scores, columns, factor) for factor in ("project_id", "portion")]
    return rows[0].unionByName(rows[1])


def explain_batch(values: DataFrame, samples: DataFrame, top_n: int = 5_000, k: int = 10) -> DataFrame:
    """(stage, factor, fraction) with the same analysis run on the corrected matrix."""
    corrected = materialize(combat.batch_correction(values, samples), "corrected")
    stages = {"before": values, "after": corrected}
    parts = [explained(v, samples, top_n, k).withColumn("stage", F.lit(name)) for name, v in stages.items()]
    return parts[0].unionByName(parts[1]).select("stage", "factor", "fraction")
