import os
import time

from salesengine.schemas import RAW_COLUMNS
from salesengine.sources.tables import read_sales, read_summaries
from salesengine.operators.sinks import ingest
from salesengine.streaming.ingest import refreshing, start_ingest, stream_metrics

HEADER = ",".join(RAW_COLUMNS)


def line(order, name):
    return f"{order},{name},gadgets,2,10.50,10,North,2024-01-15,a@b.com,0"


def write(folder, name, *lines):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join([HEADER, *lines]) + "\n")


def run(spark, tmp_path, **more):
    query = start_ingest(
        spark,
        str(tmp_path / "in"),
        str(tmp_path / "table"),
        str(tmp_path / "rejects"),
        str(tmp_path / "checkpoint"),
        **more,
    )
    query.awaitTermination(120)
    assert query.exception() is None


def test_files_arrive_and_keys_stay(spark, tmp_path):
    write(tmp_path / "in", "a.csv", line("A", "one"), line("A", "two"), line("B", "x"), "short,line")
    run(spark, tmp_path)
    write(tmp_path / "in", "b.csv", line("A", "three"), line("C", "y"))
    run(spark, tmp_path)
    stored = {r.order_id: r.product_name for r in read_sales(spark, str(tmp_path / "table")).collect()}
    assert stored == {"A": "one", "B": "x", "C": "y"}
    bad = spark.read.parquet(str(tmp_path / "rejects")).collect()
    assert [r.line for r in bad] == ["short,line"]


def test_a_lost_checkpoint_adds_nothing_twice(spark, tmp_path):
    write(tmp_path / "in", "a.csv", line("A", "one"), line("B", "x"))
    run(spark, tmp_path)
    query = start_ingest(
        spark,
        str(tmp_path / "in"),
        str(tmp_path / "table"),
        str(tmp_path / "rejects"),
        str(tmp_path / "checkpoint of a new query"),
    )
    query.awaitTermination(120)
    assert read_sales(spark, str(tmp_path / "table")).count() == 2


def test_summaries_follow_each_batch(spark, tmp_path):
    table, folder = str(tmp_path / "table"), str(tmp_path / "summaries")
    for i in range(2):
        write(tmp_path / "in", f"{i}.csv", *[line(f"{i}-{k}", f"p{k}") for k in range(3)])
    run(spark, tmp_path, max_files_per_trigger=1, after_batch=refreshing(table, folder))
    monthly = read_summaries(spark, folder)["monthly_sales_summary"].first()
    assert (monthly.order_count, monthly.total_quantity) == (6, 12)


def test_batches_of_any_size_store_the_same(spark, tmp_path):
    for name, age, who in (("b.csv", 300, "older"), ("a.csv", 200, "newer"), ("c.csv", 100, "newest")):
        write(tmp_path / "in", name, line("A", who), line("X" * 21, "long"), "")
        stamp = time.time() - age
        os.utime(tmp_path / "in" / name, (stamp, stamp))
    for files in (1, 2, 10):
        own = tmp_path / f"run{files}"
        own.mkdir()
        (own / "in").symlink_to(tmp_path / "in")
        run(spark, own, max_files_per_trigger=files)
        assert [r.product_name for r in read_sales(spark, str(own / "table")).collect()] == ["older"]
        reasons = [r.reason for r in spark.read.parquet(str(own / "rejects")).collect()]
        assert sorted(reasons) == ["blank line"] * 3 + ["does not fit the table"] * 3


def test_own_sink_sees_cleaned_batches(spark, tmp_path):
    write(tmp_path / "in", "a.csv", line("A", "One"))
    seen = []
    run(spark, tmp_path, sink=lambda rows: seen.extend(rows.collect()))
    assert [(r.order_id, r.product_name) for r in seen] == [("A", "one")]


def test_metrics_add_up_to_those_of_a_load(spark, tmp_path):
    for i in range(3):
        write(tmp_path / "in", f"{i}.csv", line("A", "one"), line(f"B{i}", "x"), "short,line", "", line("C" * 21, "long"))
    run(spark, tmp_path, max_files_per_trigger=1, metrics=str(tmp_path / "metrics"))
    found = stream_metrics(spark, str(tmp_path / "metrics"))
    whole = ingest(spark, str(tmp_path / "in"), str(tmp_path / "other"), str(tmp_path / "r"))
    assert [r.rows_written for r in found] == [2, 1, 1] and [r.rows_before for r in found] == [0, 2, 3]
    for name in ("rows_read", "rows_rejected", "rows_written"):
        assert sum(getattr(r, name) for r in found) == getattr(whole, name)
    assert found[-1].rows_after == whole.rows_after and all(r.elapsed_ms > 0 for r in found)
