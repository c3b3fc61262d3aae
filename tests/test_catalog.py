"""Every registered query against its SQL in DuckDB, over whole tables: rows, names and types."""

from __future__ import annotations

import os

import duckdb
import pytest

import __spark_entry__ as driver
from pluvia.plans import catalog

SF_DIR = os.environ.get("CHECK_SF_DIR", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
DUCK_TYPES = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "float": "FLOAT", "string": "VARCHAR",
    "boolean": "BOOLEAN", "date": "DATE", "timestamp_ntz": "TIMESTAMP", "decimal(10,2)": "DECIMAL(10,2)", "decimal(5,2)": "DECIMAL(5,2)",
    "decimal(9,6)": "DECIMAL(9,6)", "decimal(10,5)": "DECIMAL(10,5)",
}


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES.split():
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    yield connection
    connection.close()


def by_name(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(r[i] for i in order) for r in rows), key=repr)


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query_matches_sql(spark, duck, name):
    result = catalog.QUERIES[name](spark, SF_DIR)
    expected = duck.execute(catalog.ORACLES[name])
    names = [d[0] for d in expected.description]
    types = {d[0]: str(d[1]) for d in expected.description}
    assert {f.name: DUCK_TYPES[f.dataType.simpleString()] for f in result.schema.fields} == types
    assert by_name(result.columns, result.collect()) == by_name(names, expected.fetchall())


def test_every_query_has_sql():
    assert set(catalog.QUERIES) == set(catalog.ORACLES)
    assert set(catalog.QUERIES) <= set(driver.queries()) and set(catalog.ORACLES) <= set(driver.oracle_sql())


def test_entry_has_rows(spark):
    assert driver.entry(spark).count() > 0
