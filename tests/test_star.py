"""The star mapping at scale: what its joins shuffle."""

import re

import pytest

from pyspark.sql import functions as F

from salesengine.plans import anomalies
from salesengine.session import materialize
from salesengine.sources import star

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture
def large(spark, monkeypatch):
    """Tables as if they were large: no side is broadcast, and lines are read by enough tasks."""
    monkeypatch.setattr(star, "SPREAD_BELOW", 0)
    names = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    before = {n: spark.conf.get(n, None) for n in names}
    for name in names:
        spark.conf.set(name, "-1")
    yield spark
    for name, value in before.items():
        spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def test_lines_are_shuffled_once_per_large_table(large):
    for frame, limit in ((star.star_raw(large, FOLDER), 2), (star.star_sales(large, FOLDER), 3)):
        plan = frame._jdf.queryExecution().executedPlan().toString()
        keys = re.findall(r"Exchange hashpartitioning\(([a-z_]+)#", plan)
        assert sum(k.startswith("l_") for k in keys) == limit, keys
        # Neither spread beforehand nor shuffled again to meet customers.
        assert "REPARTITION_BY_NUM" not in plan and keys.count("o_custkey") == 1


def test_large_tables_give_the_same_rows(spark, large):
    big = sorted(map(repr, star.star_lines(large, FOLDER).collect()))
    facts = sorted(map(repr, star.star_sales(large, FOLDER).collect()))
    for name in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"):
        spark.conf.unset(name)
    star.SPREAD_BELOW = 2**60
    assert big == sorted(map(repr, star.star_lines(spark, FOLDER).collect()))
    assert facts == sorted(map(repr, star.star_sales(spark, FOLDER).collect()))


def test_strongest_rows_are_found_before_texts_are_joined(spark):
    """The wide rows are asked for five ids, at the scan of the lines; ties and a missing id as before."""
    sales, scores = star.star_sales(spark, FOLDER), star.star_sales(spark, FOLDER, ("order_id", "quantity"))
    found = anomalies.high_quantity(sales, scores=scores)
    assert found.collect() == anomalies.high_quantity(sales).collect()
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.rindex("concat_ws(-, cast(l_orderkey") > plan.rindex("Aggregate")
    rows = sales.limit(20).withColumns({"quantity": F.lit(3)})
    nameless = materialize(rows.unionByName(rows.limit(1).withColumn("order_id", F.lit(None).cast("string"))))
    tied = anomalies.high_quantity(nameless, scores=nameless.select("order_id", "quantity"))
    assert tied.collect() == anomalies.high_quantity(nameless).collect()


def test_joins_shuffle_slim_lines(large):
    """What the joins shuffle of a line are days, cents and percents."""
    for frame in (star.star_raw(large, FOLDER), star.star_sales(large, FOLDER)):
        plan = frame._jdf.queryExecution().optimizedPlan().toString()
        above, below = plan.split("Join ", 1)
        assert "l_extendedprice" not in above and "l_discount" not in above
        assert "AS l_cents" in below
