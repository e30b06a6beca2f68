"""The clustered fact: no shuffle of what is stored, and row groups that are not read."""

import uuid

from pyspark.sql import functions as F

from salesengine.operators import indexed
from salesengine.operators.indexed import append_indexed, buckets_of, known_keys, open_indexed
from salesengine.schemas import SALES_SCHEMA


def rows(spark, ids):
    made = spark.createDataFrame([(i,) for i in ids], "order_id string")
    return made.select(
        *[(F.col if f.name == "order_id" else F.lit)(f.name if f.name == "order_id" else None).cast(f.dataType).alias(f.name) for f in SALES_SCHEMA]
    )


def opened(spark, tmp_path, **more):
    name = f"t{uuid.uuid4().hex}"
    open_indexed(spark, name, str(tmp_path / "fact"), **more)
    return name


def test_known_keys_stay_out(spark, tmp_path):
    name = opened(spark, tmp_path, buckets=4)
    assert append_indexed(rows(spark, ["a", "b", "b", None, None]), name) == 3
    assert append_indexed(rows(spark, ["b", "c", None]), name) == 1
    assert append_indexed(rows(spark, []), name) == 0
    many = rows(spark, [f"k{i % 1500}" for i in range(3000)] + ["a"])
    assert append_indexed(many, name) == 1500 and append_indexed(many, name) == 0
    again = opened(spark, tmp_path, buckets=4)  # as in another session
    assert sorted(r.order_id or "" for r in spark.table(again).collect())[:4] == ["", "a", "b", "c"]
    assert spark.table(again).count() == 1504 and buckets_of(spark, again) == 4


def test_a_load_shuffles_nothing_that_is_stored(spark, tmp_path):
    name = opened(spark, tmp_path, buckets=4)
    append_indexed(rows(spark, [f"k{i}" for i in range(2000)]), name)
    new = rows(spark, [f"k{i}" for i in range(1000, 4000)]).repartition(3)
    found = known_keys(new, name)
    assert found.count() == 1000
    lines = found._jdf.queryExecution().sparkPlan().toString().splitlines()
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        lines = known_keys(new, name)._jdf.queryExecution().executedPlan().toString().splitlines()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    depth = {kind: [len(x) - len(x.lstrip(" :+-*()0123456789")) for x in lines if kind in x] for kind in ("ShuffledHashJoin", "FileScan")}
    stored = next(i for i, x in enumerate(lines) if "FileScan" in x)
    joined = next(i for i, x in enumerate(lines) if "ShuffledHashJoin" in x)
    assert not any("Exchange" in x or "Sort" in x for x in lines[joined + 1 : stored]) and depth["FileScan"]
    assert "Bucketed: true" in lines[stored]


def test_a_load_of_many_keys_needs_no_hash_table(spark, tmp_path, monkeypatch):
    """Above a bound both sides are sorted, still without a shuffle of what is stored; a large load makes more files."""
    monkeypatch.setattr(indexed, "HASHED_KEYS", 100)
    monkeypatch.setattr(indexed, "FILE_ROWS", 500)
    name, seen = opened(spark, tmp_path, buckets=4), []

    def spied(new, table, listed, hashed):
        found = known_keys(new, table, listed, hashed)
        seen.append(found._jdf.queryExecution().executedPlan().toString())
        return found

    monkeypatch.setattr(indexed, "known_keys", spied)
    loads = [[f"k{i}" for i in range(3000)] + [None, None], [f"k{i}" for i in range(2000, 6000)] * 2 + [None], [f"k{i}" for i in range(6000)]]
    assert [append_indexed(rows(spark, keys), name) for keys in loads] == [3001, 3000, 0]
    for plan in seen[1:]:
        assert "SortMergeJoin" in plan and "ShuffledHashJoin" not in plan
        assert plan.count("Exchange hashpartitioning") == 1 and "Bucketed: true" in plan
    stored = spark.table(name)
    assert stored.count() == 6001 and stored.select("order_id").distinct().count() == 6001
    buckets = [f.rsplit("_", 1)[1][:5] for f in stored.inputFiles()]
    assert len(buckets) > 8 and len(set(buckets)) == 4
    append_indexed(rows(spark, ["k7", "new"]), name)
    assert "ShuffledHashJoin" in seen[-1]


def scanned(frame):
    """Rows that the scans of a plan have given out."""
    frame.collect()
    leaves = frame._jdf.queryExecution().executedPlan().collectLeaves()
    return sum(leaves.apply(i).metrics().apply("numOutputRows").value() for i in range(leaves.size()))


def test_row_groups_without_the_keys_are_not_read(spark, tmp_path):
    """Keys of one bucket in many small row groups: a look-up reads one group, by filter."""
    name = opened(spark, tmp_path, buckets=1, keys_per_group=2000)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    group = spark.sparkContext._jsc.hadoopConfiguration()
    group.setInt("parquet.block.size", 64 << 10)
    group.setInt("parquet.page.size.row.check.min", 100)
    try:
        append_indexed(rows(spark, [f"k{i:06d}" for i in range(0, 200_000, 2)]), name)
        table = spark.table(name).select("order_id")
        assert scanned(table) == 100_000
        assert 0 < scanned(table.where("order_id = 'k100000'")) < 20_000
        # Within the range of a group but not in it: the range cannot tell, its Bloom filter can.
        assert scanned(table.where("order_id = 'k100001'")) == 0
    finally:
        group.unset("parquet.block.size")
        group.unset("parquet.page.size.row.check.min")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
