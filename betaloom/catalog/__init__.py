"""Queries over the given tables, one or more per operator, with their checks in SQL."""

from betaloom.catalog.registry import QUERIES, Query


def load() -> dict[str, Query]:
    """All registered queries."""
    from betaloom.catalog import (  # noqa: F401
        cohort_queries,
        control_queries,
        diagnostics_queries,
        interval_queries,
        matrix_queries,
    )

    return QUERIES
