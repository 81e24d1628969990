"""Registry of runnable queries, each with the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from betaloom.catalog.fixtures import Fixtures
from betaloom.catalog.prelude import with_views


@dataclass(frozen=True)
class Query:
    name: str
    covers: str
    build: Callable[[Fixtures], DataFrame]
    sql: str | None

    def run(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        return self.build(Fixtures(spark, sf_dir))


QUERIES: dict[str, Query] = {}


def query(covers: str, sql: str | None = None):
    """Register a builder under its function name. ``covers`` lists the inventory ids."""

    def register(build: Callable[[Fixtures], DataFrame]):
        name = build.__name__
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = Query(name, covers, build, None if sql is None else with_views(sql))
        return build

    return register
