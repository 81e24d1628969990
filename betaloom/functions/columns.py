"""Column expressions shared by the operators. All of them stay inside code generation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from betaloom.settings import EPSILON


def null_if_nan(value: Column) -> Column:
    return F.when(~F.isnan(value), value)


def parsed_number(text: Column) -> Column:
    """Text to DOUBLE; anything that is not a finite-looking number literal becomes NULL.

    The JVM parser also takes literals with a type suffix ("1.5f"), which are not numbers
    in a data file, so these are refused first.
    """
    suffixed = text.rlike(r"[0-9.][dDfF]\s*$")
    return null_if_nan(F.when(~suffixed, F.trim(text).try_cast("double")))


def m_value(beta: Column, epsilon: float = EPSILON) -> Column:
    """log2 odds of a beta value clipped to ``[epsilon, 1 - epsilon]``; NULL stays NULL."""
    clipped = F.least(F.greatest(beta, F.lit(epsilon)), F.lit(1.0 - epsilon))
    return F.when(beta.isNotNull(), F.log2(clipped / (1.0 - clipped)))


def beta_from_m(m: Column) -> Column:
    """Inverse of :func:`m_value` inside the clipped range."""
    odds = F.pow(F.lit(2.0), m)
    return odds / (1.0 + odds)


def batch_id(barcode: Column) -> Column:
    """Portion and plate fields of a barcode, NULL when it has fewer than six fields."""
    parts = F.split(barcode, "-")
    return F.when(F.size(parts) >= 6, F.concat_ws("-", F.get(parts, 3), F.get(parts, 5)))


def portion(batch: Column) -> Column:
    return F.substring_index(batch, "-", 1)


def clipped(value: Column, low: Column, high: Column) -> Column:
    """``value`` limited to ``[low, high]``; NULL stays NULL (least/greatest would skip it)."""
    return F.when(value.isNotNull(), F.least(F.greatest(value, low), high))


# First-element paths into the nested case records. A level that is absent or empty gives NULL.
def _first(items: Column) -> Column:
    return F.get(items, 0)


def case_project_id(cases: Column) -> Column:
    return _first(cases)["project"]["project_id"]


def case_submitter_id(cases: Column) -> Column:
    return _first(cases)["submitter_id"]


def case_sample_type(cases: Column) -> Column:
    return _first(_first(cases)["samples"])["sample_type"]


def case_aliquot_id(cases: Column) -> Column:
    specimen = _first(cases)
    for level in ("samples", "portions", "analytes", "aliquots"):
        specimen = _first(specimen[level])
    return specimen["aliquot_id"]


def first_file_name(files: Column) -> Column:
    return _first(files)["file_name"]
