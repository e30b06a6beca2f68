"""Every registered query against its SQL in DuckDB, on whole tables."""

from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as registry

FOLDER = Path("/root/testdata/sf0.001")
QUERIES, ORACLES = registry.queries(), registry.oracle_sql()
OWN_TESTS = registry.training_data_queries()  # compared beside their operators
TESTED = [name for name in QUERIES if name in ORACLES and name not in OWN_TESTS]
SQL_TYPES = {"double": "DOUBLE", "bigint": "BIGINT", "string": "VARCHAR"}


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for file in FOLDER.glob("*.parquet"):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection


def test_every_query_has_its_sql():
    assert set(QUERIES) - set(OWN_TESTS) <= set(ORACLES) <= set(QUERIES)


@pytest.mark.skipif(not FOLDER.exists(), reason="no test tables")
@pytest.mark.parametrize("name", TESTED)
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


def test_entry(spark):
    assert registry.entry(spark).count() == 5


def test_queries_ask_for_methods_that_are_compiled(spark):
    """In a session with Spark's own limit, long generated methods would be interpreted."""
    name = "spark.sql.codegen.hugeMethodLimit"
    before = spark.conf.get(name)
    try:
        spark.conf.set(name, "65535")
        QUERIES["clean_sales"](spark, str(FOLDER))
        assert spark.conf.get(name) == "8000"
        spark.conf.set(name, "7000")  # a limit of the session's own stays
        QUERIES["clean_sales"](spark, str(FOLDER))
        assert spark.conf.get(name) == "7000"
    finally:
        spark.conf.set(name, before)
