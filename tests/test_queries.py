"""Every query against its SQL in DuckDB: names, types, rows."""

from pathlib import Path

import duckdb
import pytest

import __spark_entry__
from ledgerline.plans.base import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"
TYPES = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN"}


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for path in Path(SF).glob("*.parquet"):
        connection.sql(f"create view {path.stem} as select * from '{path}'")
    return connection


def rows_of(rows):
    return sorted(tuple((v is None, str(round(v, 6) + 0.0) if isinstance(v, float) else str(v)) for v in r) for r in rows)


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_its_sql(spark, duck, name):
    found = QUERIES[name](spark, SF)
    columns = sorted(found.columns)
    expected = duck.sql(ORACLES[name])
    assert sorted(expected.columns) == columns
    assert {c: TYPES[t] for c, t in found.dtypes} == dict(zip(expected.columns, map(str, expected.types)))
    assert rows_of(found.select(*columns).collect()) == rows_of(expected.select(*(duckdb.ColumnExpression(c) for c in columns)).fetchall())


def test_entry(spark):
    assert __spark_entry__.entry(spark).count() > 0
    assert set(QUERIES) <= set(__spark_entry__.queries())
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
