"""The unit every step takes and returns: one long matrix and its three companion tables."""

from __future__ import annotations

from dataclasses import dataclass, replace
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Dataset:
    """``values(project_id, sample_id, probe_id, value)`` with its annotations.

    ``samples`` is keyed by ``(project_id, sample_id)``, ``probes`` by ``(project_id,
    probe_id)`` for projects and by ``probe_id`` for cohorts, ``meta`` holds one row per
    dataset. Missing values are NULL, never NaN.
    """

    values: DataFrame
    samples: DataFrame
    probes: DataFrame
    meta: DataFrame

    def replaced(self, **tables: DataFrame) -> Dataset:
        return replace(self, **tables)

    def logged(self, step: str, **changes: Any) -> Dataset:
        """Append ``step`` to the step log and set the given metadata columns."""
        return self.replaced(meta=log_step(self.meta, step, **changes))


def log_step(meta: DataFrame, step: str, **changes: Any) -> DataFrame:
    columns = {name: F.lit(value) for name, value in changes.items()}
    columns["preprocessing_steps"] = F.array_append("preprocessing_steps", F.lit(step))
    return meta.withColumns(columns)
