"""Every registered query against its SQL in DuckDB, on the smallest test tables."""

from __future__ import annotations

import os

import duckdb
import pytest

from __spark_entry__ import entry
from sellerlens.checks.oracle import all_sql
from sellerlens.checks.registry import all_queries

SF = "/root/testdata/sf0.001"
KNOWN = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
    "date": "DATE",
    "timestamp": "TIMESTAMP",
}


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for file in os.listdir(SF):
        connection.execute(
            f"CREATE VIEW {file.removesuffix('.parquet')} AS SELECT * FROM '{SF}/{file}'"
        )
    return connection


def test_every_query_has_sql():
    assert set(all_sql()) == set(all_queries())


@pytest.mark.parametrize("name", sorted(all_queries()))
def test_equals_sql(spark, duck, name):
    df = all_queries()[name](spark, SF)
    result = duck.execute(all_sql()[name])
    types = {c[0]: str(c[1]) for c in result.description}
    assert {f.name: KNOWN[f.dataType.simpleString()] for f in df.schema} == types
    names = sorted(types)
    position = [list(types).index(n) for n in names]
    want = sorted(tuple(map(str, (row[i] for i in position))) for row in result.fetchall())
    got = sorted(tuple(map(str, row)) for row in df.select(names).collect())
    assert got == want


def test_entry_is_ordered_by_risk(spark):
    scores = [r.risk_score for r in entry(spark).collect()]
    assert scores == sorted(scores, reverse=True) and len(scores) == 10
