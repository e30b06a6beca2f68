import random

from salesengine.operators import keyed
from salesengine.operators.keyed import first_by_place, first_new, first_of_wide, first_per_key, insert_ignore
from salesengine.operators.ranking import global_rank, rank_of, top_k
from pyspark.sql import functions as F


def test_first_row_by_position(spark):
    rows = [("a", 2, "late"), ("a", 1, "early"), ("b", 5, None), ("b", 5, "x"), (None, 1, "n")]
    df = spark.createDataFrame(rows, "order_id string, at int, v string")
    kept = {r.order_id: r.v for r in first_per_key(df, "order_id", ["at"]).collect()}
    assert kept == {"a": "early", "b": None, None: "n"}


def test_first_row_does_not_depend_on_arrival(spark):
    random.seed(3)
    rows = [(f"k{random.randrange(20)}", random.randrange(5), random.randrange(5)) for _ in range(500)]
    best = {}
    for key, at, v in rows:
        best[key] = min(best.get(key, (9, 9)), (at, v))
    for parts in (1, 7):
        df = spark.createDataFrame(rows, "order_id string, at int, v int").repartition(parts)
        got = {r.order_id: (r.at, r.v) for r in first_per_key(df, "order_id", ["at"]).collect()}
        assert got == best


def test_a_hot_key_is_reduced_before_the_shuffle(spark):
    hot = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("order_id"),
        F.col("id").alias("at"),
    )
    first = first_per_key(hot, "order_id", ["at"])
    plan = first._jdf.queryExecution().executedPlan().toString()
    before_shuffle = plan[plan.index("Exchange") :]
    assert "partial_min" in before_shuffle
    assert first.where("order_id = 'hot'").first().at == 0
    assert first.count() == 20_001


def test_known_keys_are_left_alone(spark):
    stored = spark.createDataFrame([("a", "old")], "order_id string, v string")
    new = spark.createDataFrame([("a", "new"), ("b", "2"), ("b", "1")], "order_id string, v string")
    for size in (None, 3, 10**9):
        added = insert_ignore(new, stored, new_rows=size).collect()
        assert [(r.order_id, r.v) for r in added] == [("b", "1")]


def test_small_loads_do_not_shuffle_the_stored_table(spark):
    stored = spark.range(100_000).select(F.col("id").cast("string").alias("order_id"))
    new = spark.range(3).select(F.col("id").cast("string").alias("order_id"), F.lit(1).alias("v"))
    plan = insert_ignore(new, stored, new_rows=3, unique=True)
    text = plan._jdf.queryExecution().sparkPlan().toString()
    assert "BroadcastHashJoin" in text and "LeftSemi, BuildRight" in text
    assert plan.count() == 0


def test_global_rank_with_ties_and_many_partitions(spark):
    random.seed(5)
    rows = [(f"p{i:04d}", 7 if i % 3 == 0 else random.randrange(50)) for i in range(2_000)]
    df = spark.createDataFrame(rows, "name string, v int").repartition(5)
    ranked = global_rank(df, [F.desc("v"), F.asc("name")], "rank").collect()
    order = sorted(rows, key=lambda r: (-r[1], r[0]))
    assert {r.name: r["rank"] for r in ranked} == {n: i for i, (n, _) in enumerate(order, start=1)}


def test_global_rank_of_nothing(spark):
    empty = spark.createDataFrame([], "name string, v int")
    assert global_rank(empty, [F.desc("v")], "rank").count() == 0


def test_standing_of_candidates(spark):
    random.seed(6)
    rows = [(f"p{i}", random.randrange(1_000), random.randrange(20)) for i in range(300)]
    df = spark.createDataFrame(rows, "name string, money int, units int")
    top = top_k(df, [F.desc("money"), F.asc("name")], 10, "money_rank")
    got = {r.name: (r.money_rank, r.units_rank) for r in rank_of(top, df, ("-units", "name"), "units_rank").collect()}
    by_money = [r[0] for r in sorted(rows, key=lambda r: (-r[1], r[0]))]
    by_units = [r[0] for r in sorted(rows, key=lambda r: (-r[2], r[0]))]
    assert got == {n: (by_money.index(n) + 1, by_units.index(n) + 1) for n in by_money[:10]}


def test_losers_are_found_on_narrow_rows(spark, tmp_path):
    """A hot key, nulls and single keys; no sort aggregate, and wide rows only meet a broadcast."""
    path = str(tmp_path / "rows")
    hot = F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 100 != 1, F.col("id").cast("string"))
    spark.range(30_000).select(
        hot.alias("order_id"), (40_000 - F.col("id")).cast("decimal(38,0)").alias("_place"), F.repeat(F.lit("w"), 50).alias("w")
    ).write.parquet(path)
    rows = spark.read.parquet(path)
    first = first_by_place(rows)
    plan = first._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan and "Exchange hashpartitioning" not in plan
    assert int(first.where("order_id = 'hot'").first()["_place"]) == 40_000 - 29_997
    assert int(first.where("order_id is null").first()["_place"]) == 40_000 - 29_801
    assert first.count() == rows.select("order_id").distinct().count()


def test_wide_rows_like_narrow_ones(spark):
    random.seed(4)
    rows = [(f"k{random.randrange(40)}", random.randrange(5), None) for _ in range(300)] + [(None, 1, "x"), (None, 0, "y")]
    rows += [(f"single{i}", i, "z") for i in range(50)]
    df = spark.createDataFrame(rows, "order_id string, at int, v string").repartition(3)
    expected = sorted(map(repr, first_per_key(df, "order_id").collect()))
    assert sorted(map(repr, first_of_wide(df).collect())) == expected


def test_many_rows_meet_known_keys_in_one_shuffle(spark):
    """One aggregate; the same rows as insert-ignore, also of a hot key and of rows without a key."""
    stored = spark.createDataFrame([("a", 9), (None, 1)], "order_id string, v int")
    rows = [("a", 1), ("b", 3), ("b", 2), (None, 7), (None, 6)] + [("hot", i) for i in range(9, 3, -1)]
    new = spark.createDataFrame(rows, "order_id string, v int").repartition(3)
    found = first_new(new, stored)
    assert sorted(map(repr, found.collect())) == sorted(map(repr, insert_ignore(new, stored).collect()))
    assert {(r.order_id, r.v) for r in found.collect()} == {("b", 2), ("hot", 4), (None, 6)}
    plan = found._jdf.queryExecution().sparkPlan().toString()
    assert "Join" not in plan
    by_place = first_new(new.withColumn("at", -F.col("v")), stored, position=("at",))
    assert {(r.order_id, r.v) for r in by_place.collect()} == {("b", 3), ("hot", 9), (None, 7)}


def test_many_shared_keys_are_reduced_by_one_aggregate(spark, monkeypatch):
    monkeypatch.setattr(keyed, "BROADCAST_KEYS", 10)
    rows = spark.range(200).select((F.col("id") % 100).cast("string").alias("order_id"), F.col("id").alias("v"))
    first = first_of_wide(rows)
    assert "Join" not in first._jdf.queryExecution().sparkPlan().toString()
    assert sorted(map(repr, first.collect())) == sorted(map(repr, first_per_key(rows, "order_id").collect()))
