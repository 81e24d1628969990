"""Every registered query over the smallest tables, against its SQL in DuckDB."""

import ast
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry_points
from betaloom import catalog
from tools.check_queries import TABLES, canonical

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SMALL}/{table}.parquet'")
    return connection


@pytest.mark.parametrize("name", sorted(catalog.load()))
def test_query_agrees_with_sql(spark, db, name):
    query = catalog.load()[name]
    got = query.run(spark, SMALL).toPandas()
    want = db.execute(query.sql).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert canonical(got).equals(canonical(want))


def test_entry_points(spark):
    assert entry_points.entry(spark).count() > 0
    assert {q.name for q in catalog.load().values()} <= set(entry_points.queries())
    assert set(entry_points.oracle_sql()) <= set(entry_points.queries())


def test_every_inventory_id_is_covered():
    ids = {i for q in catalog.load().values() for i in q.covers.split()}
    sizes = {"A": 9, "B": 21, "C": 7, "D": 10, "E": 4, "F": 17, "G": 9, "H": 11}
    assert ids == {f"{group}{n}" for group, count in sizes.items() for n in range(1, count + 1)}


def test_catalog_modules_define_each_name_once():
    """A second function of a name would take the place of the first in the queries that call it."""
    for path in Path(catalog.__file__).parent.glob("*.py"):
        names = [node.name for node in ast.parse(path.read_text()).body if isinstance(node, (ast.FunctionDef, ast.ClassDef))]
        assert len(names) == len(set(names)), path.name
