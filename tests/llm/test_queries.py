"""Registered queries of the operators against their SQL in DuckDB, on whole tables."""

from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as registry

FOLDER = Path("/root/testdata/sf0.001")
QUERIES, ORACLES = registry.training_data_queries(), registry.oracle_sql()
SQL_TYPES = {"double": "DOUBLE", "bigint": "BIGINT", "string": "VARCHAR", "boolean": "BOOLEAN"}


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for file in FOLDER.glob("*.parquet"):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection


@pytest.mark.skipif(not FOLDER.exists(), reason="no test tables")
@pytest.mark.parametrize("name", [name for name in QUERIES if name in ORACLES])
def test_query(spark, duck, name):
    ours = QUERIES[name](spark, str(FOLDER))
    columns = sorted(ours.columns)
    result = duck.execute(ORACLES[name])
    theirs = {d[0]: (i, str(d[1])) for i, d in enumerate(result.description)}
    assert columns == sorted(theirs)
    types = {f.name: SQL_TYPES[f.dataType.simpleString()] for f in ours.schema}
    assert types == {c: t for c, (_, t) in theirs.items()}
    expected = sorted(repr([r[theirs[c][0]] for c in columns]) for r in result.fetchall())
    assert sorted(repr([r[c] for c in columns]) for r in ours.collect()) == expected
    assert expected
