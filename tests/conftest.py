import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from salesengine.session import local_session


@pytest.fixture(scope="session")
def spark():
    session = local_session("tests", cores=4, shuffle_partitions=4, memory="4g")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def evaluate(spark):
    """Apply a column function to rows of plain values; returns the results in order."""
    from pyspark.sql import functions as F

    def run(function, values, types):
        rows = [(i, *(v if isinstance(v, tuple) else (v,))) for i, v in enumerate(values)]
        names = [f"c{i}" for i in range(len(types))]
        schema = "i int, " + ", ".join(f"{n} {t}" for n, t in zip(names, types, strict=True))
        df = spark.createDataFrame(rows, schema)
        out = df.select("i", function(*map(F.col, names)).alias("x")).orderBy("i").collect()
        return [r.x for r in out]

    return run
