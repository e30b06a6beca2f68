"""The log of commits, refresh by change, and anomalies in three scans."""

import threading
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from salesengine.operators.sinks import append_new, ingest
from salesengine.plans import anomalies, refresh, state
from salesengine.plans.refresh import refresh_all
from salesengine.plans.state import merged, refresh_changes, state_of
from salesengine.schemas import SALES_SCHEMA
from salesengine.sources.commits import commits, last_commit, new_data, sweep, try_commit
from salesengine.sources.generator import write_sample
from salesengine.sources.tables import read_sales, read_summaries
from salesengine.streaming.ingest import start_ingest


def fact_rows(spark, count, first=0):
    i = F.col("id")
    made = spark.range(first, first + count).select(
        F.concat(F.lit("o"), i).alias("order_id"),
        F.when(i % 11 != 0, F.concat(F.lit("p"), i % 13)).alias("product_name"),
        F.when(i % 7 != 0, F.concat(F.lit("c"), i % 5)).alias("category"),
        (i % 9).cast("int").alias("quantity"),
        ((i * 7919) % 100_000 / 100).cast("decimal(10,2)").alias("unit_price"),
        F.when(i % 17 != 0, (i % 71).cast("decimal(5,2)")).alias("discount_percent"),
        F.element_at(F.array(*map(F.lit, ["North", "South", "", "East"])), (i % 4 + 1).cast("int")).alias("region"),
        F.when(i % 10 != 0, F.date_add(F.lit("2023-01-15").cast("date"), (i % 700).cast("int"))).alias("sale_date"),
        F.lit("a@b.com").alias("customer_email"),
        ((i * 104_729) % 1_000_000 / 100 - 5).cast("decimal(12,2)").alias("revenue"),
    )
    return made.select(*SALES_SCHEMA.names)


def contents(tables):
    return {name: sorted(map(repr, table.collect())) for name, table in tables.items()}


def test_an_entry_is_created_once(spark, tmp_path):
    folder = str(tmp_path / "t")
    assert last_commit(spark, folder) is None and commits(spark, folder) == []
    assert try_commit(spark, folder, 1, new_data(folder), rows=3)
    assert not try_commit(spark, folder, 1, new_data(folder), rows=4)
    for number in (2, 3):
        data = new_data(folder)
        spark.range(1).write.parquet(data)
        assert try_commit(spark, folder, number, data)
    assert [c.number for c in commits(spark, folder)] == [1, 2, 3]
    assert commits(spark, folder)[0].note == {"rows": 3} and last_commit(spark, folder).number == 3
    old = commits(spark, folder)[1].data
    sweep(spark, folder, keep=1)
    assert [c.number for c in commits(spark, folder)] == [3]
    assert not (tmp_path / "t" / old.rsplit("/")[-1]).exists()


def test_a_plain_table_gets_a_log(spark, tmp_path):
    path = str(tmp_path / "t")
    fact_rows(spark, 10).write.parquet(path)
    assert append_new(fact_rows(spark, 15), path) == 5
    assert append_new(fact_rows(spark, 15), path) == 0
    assert read_sales(spark, path).count() == 15 and len(commits(spark, path)) == 2


def test_two_writers_give_one_row_per_key(spark, tmp_path):
    """Batch loads and a stream with the same keys at the same time."""
    path = str(tmp_path / "t")
    write_sample(spark, 300, str(tmp_path / "in"))
    loads = [fact_rows(spark, 200), fact_rows(spark, 200, 100), fact_rows(spark, 50, 250)]
    failed = []

    def guarded(run):
        try:
            run()
        except Exception as error:  # noqa: BLE001
            failed.append(error)

    def stream():
        folders = [str(tmp_path / n) for n in ("rejects", "checkpoint")]
        start_ingest(spark, str(tmp_path / "in"), path, *folders).awaitTermination(120)

    def batch():
        ingest(spark, str(tmp_path / "in"), path, str(tmp_path / "other rejects"))

    jobs = [lambda rows=rows: append_new(rows, path) for rows in loads] + [stream, batch]
    threads = [threading.Thread(target=guarded, args=(job,)) for job in jobs]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert not failed
    found = read_sales(spark, path)
    ids = [r.order_id for r in found.collect()]
    assert len(ids) == len(set(ids))
    assert {i for i in ids if i.startswith("o")} == {f"o{i}" for i in range(300)}
    assert len(ids) - 300 > 200
    assert sum(c.note["rows"] for c in commits(spark, path)) == len(ids)


def test_a_conflict_compares_the_new_rows_again(spark, tmp_path, monkeypatch):
    from salesengine.operators import sinks

    path, attempts = str(tmp_path / "t"), []

    def late(spark_, folder, number, data, **note):
        if not attempts:  # another writer is faster by a moment
            attempts.append(number)
            theirs = new_data(folder)
            fact_rows(spark, 6).write.parquet(theirs)
            assert try_commit(spark, folder, number, theirs, rows=6)
        return try_commit(spark_, folder, number, data, **note)

    monkeypatch.setattr(sinks, "try_commit", late)
    assert append_new(fact_rows(spark, 10), path) == 4
    assert read_sales(spark, path).count() == 10


@pytest.mark.parametrize("variant", ["service", "script"])
def test_changes_give_what_a_full_refresh_gives(spark, tmp_path, monkeypatch, variant):
    path, changed, whole = (str(tmp_path / n) for n in ("fact", "changed", "whole"))
    read = []
    original = state.read_sales
    monkeypatch.setattr(state, "read_sales", lambda s, p, listed: read.append([c.number for c in listed]) or original(s, p, listed))
    for step, (first, count) in enumerate([(0, 300), (300, 1), (301, 500)], 1):
        append_new(fact_rows(spark, count, first), path)
        assert refresh_changes(spark, path, changed, variant) == step
        append_new(fact_rows(spark, count, first), path)  # a batch that is replayed
        assert refresh_changes(spark, path, changed, variant) == step
        refresh_all(spark, path, whole, variant)
        assert contents(read_summaries(spark, changed)) == contents(read_summaries(spark, whole))
    assert read == [[1], [2], [3]]  # no commit is read twice


def test_state_can_be_merged_in_any_way(spark):
    parts = [state_of(fact_rows(spark, n, first).cache()) for first, n in ((0, 50), (50, 3), (53, 97))]
    left = contents(merged(merged(parts[0], parts[1]), parts[2]))
    right = contents(merged(parts[2], merged(parts[1], parts[0])))
    assert left == right == contents(state_of(fact_rows(spark, 150).cache()))


def test_a_failing_table_leaves_all_five(spark, tmp_path, monkeypatch):
    path, folder = str(tmp_path / "fact"), str(tmp_path / "s")
    append_new(fact_rows(spark, 100), path)
    refresh_all(spark, path, folder)
    before = contents(read_summaries(spark, folder))
    append_new(fact_rows(spark, 100, 100), path)
    plans = refresh.summary_plans()

    def broken(sales):
        raise RuntimeError("table four")

    plans["category_discount_map"] = broken
    monkeypatch.setattr(refresh, "summary_plans", lambda *_: plans)
    with pytest.raises(RuntimeError, match="table four"):
        refresh_all(spark, path, folder)
    assert contents(read_summaries(spark, folder)) == before
    monkeypatch.undo()
    for _ in range(4):
        refresh_all(spark, path, folder)
    assert contents(read_summaries(spark, folder)) != before
    assert len(commits(spark, folder)) == refresh.KEPT_VERSIONS


def plain_records(rows):
    """Five rows of each kind, by sorting."""
    prices = [int(r.unit_price * 100) for r in rows if r.unit_price is not None and r.unit_price > 0]
    mean = sum(prices) / len(prices)
    limit = (mean + 3 * (sum((p - mean) ** 2 for p in prices) / len(prices)) ** 0.5) / 100
    kinds = {
        "HIGH_REVENUE": lambda r: r.revenue if r.revenue is not None and r.revenue > 0 else None,
        "HIGH_QUANTITY": lambda r: r.quantity if r.quantity is not None and r.quantity > 0 else None,
        "HIGH_DISCOUNT": lambda r: r.discount_percent if (r.discount_percent or 0) >= 100 else None,
        "NEGATIVE_VALUES": lambda r: abs(min(r.quantity, r.unit_price, r.revenue))
        if min(r.quantity, r.unit_price, r.revenue) < 0
        else None,
        "PRICE_ANOMALY": lambda r: r.unit_price if (r.unit_price or 0) > limit else None,
    }
    found = []
    for kind, score in kinds.items():
        best = sorted((-score(r), r.order_id) for r in rows if score(r) is not None)
        found += [(kind, -s, i) for s, i in best[:5]]
    return sorted((k, float(s), i) for k, s, i in found)


def test_records_like_sorting_them(spark, monkeypatch):
    monkeypatch.setattr(anomalies, "LANES", 8)
    sales = fact_rows(spark, 3000).withColumn(
        "unit_price", F.when(F.col("order_id").isin("o7", "o8"), 90_000).otherwise(F.col("unit_price")).cast("decimal(10,2)")
    )
    sales = sales.withColumn("discount_percent", F.when(F.length("order_id") < 3, 100).otherwise(3).cast("decimal(5,2)"))
    found = [(r.anomaly_type, float(r.anomaly_score), r.order_id) for r in anomalies.anomaly_records(sales).collect()]
    assert sorted(found) == plain_records(sales.collect())
    few = sales.limit(3).cache()
    found = [(r.anomaly_type, float(r.anomaly_score), r.order_id) for r in anomalies.anomaly_records(few).collect()]
    assert sorted(found) == plain_records(few.collect())
    assert anomalies.anomaly_records(sales.limit(0)).collect() == []


def test_ties_read_few_wide_rows(spark, tmp_path):
    """All rows tie in all scores: the third scan is asked for five rows by their ids."""
    path = str(tmp_path / "t")
    same = fact_rows(spark, 5000).withColumns(
        {"revenue": F.lit(5).cast("decimal(12,2)"), "quantity": F.lit(2), "unit_price": F.lit(3).cast("decimal(10,2)"), "discount_percent": F.lit(1).cast("decimal(5,2)")}
    )
    same.write.parquet(path)
    rows, _ = anomalies.strongest(spark.read.parquet(path))
    first = sorted(f"o{i}" for i in range(5000))[:5]
    assert sorted({r.order_id for r in rows.collect()}) == first
    plan = rows._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert plan.count("FileScan") == 1 and "In(order_id" in plan


def test_threshold_does_not_depend_on_the_rows_order(spark):
    prices = fact_rows(spark, 4000).select("unit_price")
    found = {anomalies.price_threshold(prices.repartition(n)).first().threshold for n in (1, 3, 7)}
    assert len(found) == 1
    plain = [float(r.unit_price) for r in prices.collect() if r.unit_price > 0]
    mean = sum(plain) / len(plain)
    deviation = (sum((p - mean) ** 2 for p in plain) / len(plain)) ** 0.5
    assert found.pop() == pytest.approx(mean + 3 * deviation, rel=1e-12)
    assert anomalies.price_threshold(prices.limit(0)).first().threshold is None


def test_moments_of_huge_sums(spark):
    n, price = 10**12, 10**10 - 1
    row = (n, Decimal(n * price), Decimal(n * price * price))
    sums = spark.createDataFrame([row], "n bigint, s decimal(38,0), q decimal(38,0)")
    assert sums.select(anomalies.threshold_of(*map(F.col, "nsq")).alias("t")).first().t == price / 100
