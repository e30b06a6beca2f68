from decimal import Decimal
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from salesengine.operators import sinks
from salesengine.operators.cleaning import clean_sales, does_not_fit, to_stored
from salesengine.pipeline import main, run
from salesengine.plans.anomalies import high_revenue
from salesengine.plans.refresh import refresh_all
from salesengine.schemas import CLEAN_SCHEMA, RAW_COLUMNS, RAW_SCHEMA, SALES_SCHEMA, SUMMARY_SCHEMAS
from salesengine.session import checkpoint_dir, materialize, path_exists, scratch
from salesengine.sources import csv_lines
from salesengine.sources.csv_lines import read_cleaned, read_raw
from salesengine.sources.generator import generate_sales, write_sample
from salesengine.sources.tables import read_sales, read_summaries, summary_folder


def raw_line(order, name="TV", email="a@b.com"):
    return f"{order},{name},electronic,2,10.50,10,North,2024-01-15,{email},0"


def write(path, lines):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text("\n".join([",".join(RAW_COLUMNS), *lines]) + "\n")


def test_ingest_keeps_the_first_row_in_file_order(spark, tmp_path):
    write(tmp_path / "in" / "a.csv", [raw_line("A", "first"), raw_line("B"), raw_line("A", "aaa"), "too,short"])
    write(tmp_path / "in" / "b.csv", [raw_line("A", "aab"), raw_line("C")])
    table, rejects = str(tmp_path / "t"), str(tmp_path / "r")
    result = sinks.ingest(spark, str(tmp_path / "in"), table, rejects)
    assert (result.rows_read, result.rows_rejected, result.rows_clean, result.rows_written) == (6, 1, 5, 3)
    assert result.rows_per_second > 0
    stored = {r.order_id: r.product_name for r in read_sales(spark, table).collect()}
    assert stored == {"A": "first", "B": "tv", "C": "tv"}
    bad = spark.read.parquet(rejects).collect()
    assert [(r.line, r.reason) for r in bad] == [("too,short", "insufficient columns")]

    again = sinks.ingest(spark, str(tmp_path / "in"), table, rejects)
    assert (again.rows_written, again.rows_before, again.rows_after) == (0, 3, 3)
    write(tmp_path / "more" / "c.csv", [raw_line("A", "late"), raw_line("D")])
    assert sinks.ingest(spark, str(tmp_path / "more"), table, rejects).rows_written == 1
    assert read_sales(spark, table).where("order_id = 'A'").first().product_name == "first"
    assert read_sales(spark, table).count() == 4


def test_rows_that_do_not_fit_are_set_aside(spark, tmp_path):
    keys = [raw_line("X" * 20 + end) for end in "abc"]
    name = raw_line("B", "n" * 101)
    write(tmp_path / "in" / "a.csv", [raw_line("A"), *keys, name])
    source, table, rejects = (str(tmp_path / n) for n in ("in", "t", "r"))
    result = sinks.ingest(spark, source, table, rejects)
    assert (result.rows_read, result.rows_rejected, result.rows_written) == (5, 4, 1)
    bad = spark.read.parquet(rejects).collect()
    assert sorted(r.line for r in bad) == sorted([*keys, name]) and {r.reason for r in bad} == {"does not fit the table"}
    cut = sinks.ingest(spark, source, f"{table}2", f"{rejects}2", truncate=True)
    assert (cut.rows_rejected, cut.rows_written) == (3, 2)
    assert len(read_sales(spark, f"{table}2").where("order_id = 'B'").first().product_name) == 100
    assert sorted(r.line for r in spark.read.parquet(f"{rejects}2").collect()) == sorted(keys)


@pytest.mark.parametrize("sink", ["csv", "memory", "own"])
def test_every_sink_keeps_its_rejects(spark, tmp_path, sink):
    write(tmp_path / "in" / "a.csv", [raw_line("A"), "", "too,short", raw_line("X" * 21)])
    seen = []
    chosen = (lambda rows: seen.append(rows.count())) if sink == "own" else sink
    target = {"csv": str(tmp_path / "out"), "memory": "kept_rows", "own": ""}[sink]
    rejects = None if sink == "csv" else str(tmp_path / "r")
    result, _ = run(spark, str(tmp_path / "in"), target, chosen, rejects)
    if sink == "memory":
        assert result.count() == 1
        result.unpersist()
    assert sink != "own" or seen == [1]
    bad = spark.read.parquet(rejects or f"{target}_rejects").collect()
    assert sorted(r.reason for r in bad) == ["blank line", "does not fit the table", "insufficient columns"]
    if sink != "csv":
        with pytest.raises(ValueError, match="rejects"):
            run(spark, str(tmp_path / "in"), target, chosen)


def test_blank_lines_are_counted_and_the_first_line_is_the_header(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.csv").write_text("\n".join(["", raw_line("A"), "", "  ", raw_line("B"), ""]))
    (tmp_path / "in" / "b.csv").write_text("\n".join([",".join(RAW_COLUMNS), raw_line("C")]))
    result = sinks.ingest(spark, str(tmp_path / "in"), str(tmp_path / "t"), str(tmp_path / "r"))
    assert (result.rows_read, result.rows_rejected, result.rows_written) == (5, 2, 3)
    assert {r.reason for r in spark.read.parquet(str(tmp_path / "r")).collect()} == {"blank line"}


def test_rows_per_second_without_time():
    assert sinks.IngestionResult(10, 0, 10, 0).rows_per_second == 0
    assert sinks.IngestionResult(10, 4, 6, 2000).rows_per_second == 5


def test_stored_types_cut_and_clamp(spark):
    rows = [
        ("k" * 30, "p" * 120, "c", 1, 1e12, float("nan"), "r" * 25, None, None, float("-inf")),
        ("k", "p", "c", 1, 2.005, 70.0, "r", None, None, 1.25),
    ]
    clean = spark.createDataFrame(rows, CLEAN_SCHEMA)
    cut, same = to_stored(clean, truncate=True).orderBy(F.desc(F.length("order_id"))).collect()
    assert (len(cut.order_id), len(cut.product_name), len(cut.region)) == (30, 100, 20)
    assert cut.unit_price == Decimal("99999999.99") and cut.discount_percent is None
    assert cut.revenue == Decimal("-9999999999.99")
    assert same.discount_percent == 70 and same.revenue == Decimal("1.25")
    assert to_stored(clean).schema == SALES_SCHEMA
    assert clean.where(does_not_fit()).count() == clean.where(does_not_fit(truncate=True)).count() == 1


def test_csv_round_trip(spark, tmp_path):
    names = ['say "hi"', "a,b", "plain", "back\\slash"]
    rows = [(f"k{i}", n, "c", "2", "10.5", "10", "North", "", "", "") for i, n in enumerate(names)]
    stored = to_stored(clean_sales(spark.createDataFrame(rows, RAW_SCHEMA)))
    path = sinks.write_csv(stored, str(tmp_path / "out"))
    assert sorted(read_cleaned(spark, path).collect()) == sorted(stored.collect())
    toggled = {r.order_id: r.product_name for r in read_raw(spark, path).collect()}
    assert toggled["k0"] == "say hi" and toggled["k1"] == "a,b"
    text = "\n".join(p.read_text() for p in Path(path).glob("*.csv"))
    assert ",".join(RAW_COLUMNS) in text and 'k0,"say ""hi""",c,2,10.50,10.00,North,,,18.90' in text


def test_merged_csv_is_one_file(spark, tmp_path):
    frame = spark.range(10).select(F.col("id").alias("order_id")).repartition(3)
    for _ in range(2):
        path = Path(sinks.write_csv(frame, str(tmp_path / "out"), merge=True))
        assert path.name == "final_output_10_rows.csv"
        header, *lines = path.read_text().splitlines()
        assert header == "order_id" and sorted(map(int, lines)) == list(range(10))
    parts = sinks.write_csv(frame, str(tmp_path / "parts"))
    assert len(list(Path(parts).glob("*.csv"))) == 3
    merged = sinks.write_sales(frame, "csv", str(tmp_path / "again"), merge=True)
    assert Path(merged).is_file()


def test_sink_choice(spark, tmp_path):
    rows = to_stored(clean_sales(generate_sales(spark, 50)))
    assert sinks.write_sales(rows, "table", str(tmp_path / "t")) == 50
    assert sinks.write_sales(rows, "csv", str(tmp_path / "c")) == str(tmp_path / "c")
    kept = sinks.write_sales(rows, "memory", "kept")
    assert spark.table("kept").count() == 50
    kept.unpersist()
    seen = []
    sinks.write_sales(rows, lambda df: seen.append(df.count()))
    assert seen == [50]
    with pytest.raises(ValueError, match="unknown sink"):
        sinks.write_sales(rows, "tape")


def test_fifth_score_skips_row_groups(spark, tmp_path):
    rows = to_stored(clean_sales(generate_sales(spark, 40_000)))
    rows.repartitionByRange(20, "revenue").write.parquet(str(tmp_path / "t"))
    sales = read_sales(spark, str(tmp_path / "t"))
    best = high_revenue(sales, stored=True)
    assert best.collect() == high_revenue(sales).collect()
    plan = best._jdf.queryExecution().executedPlan().finalPhysicalPlan()
    scans = [n for n in leaves(plan) if "FileScan" in n.toString()]
    scanned = scans[0].metrics().apply("numOutputRows").value()
    assert 5 <= scanned < 40_000


def leaves(node):
    if node.getClass().getSimpleName().endswith("QueryStageExec"):
        return leaves(node.plan())
    children = [node.children().apply(i) for i in range(node.children().size())]
    return [leaf for child in children for leaf in leaves(child)] if children else [node]


def test_jdbc_options_write_in_batches():
    options = sinks.jdbc_options("jdbc:mysql://host/db", "sales_data", user="u")
    assert options == {"url": "jdbc:mysql://host/db", "dbtable": "sales_data", "batchsize": "100", "user": "u"}


def test_generator_is_deterministic_and_distributed(spark):
    rows = generate_sales(spark, 30_000, seed=7)
    assert rows.columns == list(RAW_COLUMNS)
    assert rows.exceptAll(generate_sales(spark, 30_000, seed=7)).count() == 0
    assert rows.where(~F.col("order_id").rlike("^[A-Z0-9]{10}$")).count() == 0
    repeats = 30_000 - rows.select("order_id").distinct().count()
    assert 1_700 < repeats < 2_300
    first = rows.limit(0)  # the first ring holds no repeats
    assert first.schema == rows.schema
    assert generate_sales(spark, 10_000).select("order_id").distinct().count() == 10_000
    share = rows.agg(
        F.avg((F.col("sale_date") == "").cast("int")).alias("undated"),
        F.avg((F.col("customer_email") == "").cast("int")).alias("silent"),
        F.avg((F.col("quantity") == "0").cast("int")).alias("zero"),
        F.min(F.col("discount_percent").cast("int")).alias("low"),
        F.max(F.col("discount_percent").cast("int")).alias("high"),
        F.countDistinct("product_name").alias("names"),
    ).first()
    assert 0.08 < share.undated < 0.12 and 0.22 < share.silent < 0.28 and 0.32 < share.zero < 0.37
    assert (share.low, share.high, share.names) == (0, 120, 24)


def test_generated_file_to_summaries(spark, tmp_path):
    write_sample(spark, 12_000, str(tmp_path / "in"))
    table, folder = str(tmp_path / "t"), str(tmp_path / "s")
    result = sinks.ingest(spark, str(tmp_path / "in"), table, str(tmp_path / "r"))
    assert (result.rows_read, result.rows_rejected) == (12_000, 0)
    sales = read_sales(spark, table)
    assert sales.count() == result.rows_written == sales.select("order_id").distinct().count() < 12_000
    cleaned = sales.agg(
        F.count_if(F.col("sale_date").isNull()), F.max("discount_percent"), F.min("quantity")
    ).first()
    assert 0.07 < cleaned[0] / result.rows_written < 0.13 and cleaned[1] == 70 and cleaned[2] == 1
    for variant in ("service", "script"):
        counts = {r.table_name: r.row_count for r in refresh_all(spark, table, folder, variant).collect()}
        assert set(counts) == set(SUMMARY_SCHEMAS)
        assert counts["monthly_sales_summary"] == 48 and counts["region_wise_performance"] == 4
        tables = read_summaries(spark, folder)
        assert {n: t.schema for n, t in tables.items()} == SUMMARY_SCHEMAS
        assert tables["category_discount_map"].where("avg_discount IS NULL").count() == 0
        stamped = spark.read.parquet(f"{summary_folder(spark, folder)}/top_products")
        assert {"created_at", "updated_at"} <= set(stamped.columns)
    regions = {r.region for r in tables["region_wise_performance"].collect()}
    assert regions == {"North", "South", "East", "West"}
    with pytest.raises(ValueError, match="unknown variant"):
        refresh_all(spark, table, folder, "other")


def test_scratch_is_deleted_with_its_block(spark):
    with scratch(spark):
        kept = materialize(spark.range(5))
        (folder,) = {str(Path(f).parent) for f in kept.inputFiles()}
        assert kept.count() == 5 and path_exists(spark, folder)
    assert not path_exists(spark, folder)
    outside = materialize(spark.range(5))
    assert outside.count() == 5 and spark.sparkContext.applicationId in outside.inputFiles()[0]


def test_whole_run(spark, tmp_path, capsys):
    write(tmp_path / "in" / "a.csv", [raw_line("A"), raw_line("B"), raw_line("A")])
    source, table = str(tmp_path / "in"), str(tmp_path / "t")
    main(["--source", source, "--target", table, "--summaries", str(tmp_path / "s")])
    printed = capsys.readouterr().out
    assert "read 3, rejected 0, wrote 2" in printed and "from 0 to 2 rows" in printed
    assert "top_products: 1 rows" in printed
    result, counts = run(spark, source, table, summaries=str(tmp_path / "s"), skip_refresh=True)
    assert (result.rows_written, counts) == (0, None)
    path, counts = run(spark, source, str(tmp_path / "csv"), sink="csv")
    assert counts is None and spark.read.option("header", True).csv(path).count() == 3
    header_too, _ = run(spark, source, str(tmp_path / "raw"), skip_header=False)
    assert header_too.rows_written == 3


class FakeSession:
    """Just the settings that the choice of the shared folder looks at."""

    def __init__(self, master, configured=None):
        self.conf = self.sparkContext = self
        self.master, self.configured, self.folder = master, configured, None

    def get(self, key, default):
        return (self.configured if key == "spark.checkpoint.dir" else None) or default

    def getCheckpointDir(self):
        return self.folder

    def setCheckpointDir(self, folder):
        self.folder = folder


def test_shared_folder_comes_from_the_session():
    assert checkpoint_dir(FakeSession("yarn", "hdfs://shared")) == "hdfs://shared"
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        checkpoint_dir(FakeSession("yarn"))
    local = FakeSession("local[4]")
    assert checkpoint_dir(local) == local.folder == "spark-warehouse/_scratch"


def test_bulk_load_turns_misfits_away(spark, tmp_path):
    header = "order_id,product_name,category,quantity,unit_price,discount_percent,region,sale_date,customer_email,revenue"
    lines = [
        "A,one,c,2,1.50,0.00,North,2024-01-15,a@b.com,3.00", "B,,,,,,,,,", "C,x,c,two,1,0,n,,,1", f"{'D' * 21},x,c,1,1,0,n,,,1",
        "E,x,c,1,123456789.00,0,n,,,1", "F,x,c,1,1,0,n,not-a-date,,1", "A,again,c,2,1.50,0,n,,,1",
    ]
    (tmp_path / "in.csv").write_text("\n".join([header, *lines]) + "\n")
    table, rejects = str(tmp_path / "t"), str(tmp_path / "r")
    result = sinks.bulk_load(spark, str(tmp_path / "in.csv"), table, rejects)
    assert (result.rows_read, result.rows_rejected, result.rows_written) == (7, 4, 2)
    stored = {r.order_id: r.product_name for r in read_sales(spark, table).collect()}
    assert stored == {"A": "again", "B": None}
    reasons = {r.line.split(",")[0]: r.reason.split()[0] for r in spark.read.parquet(rejects).collect()}
    assert reasons == {"C": "quantity", "D" * 21: "order_id", "E": "unit_price", "F": "sale_date"}
    assert sinks.bulk_load(spark, str(tmp_path / "in.csv"), table, rejects).rows_written == 0


def test_merged_parts_keep_their_order(spark, tmp_path):
    rows = spark.range(0, 5000, 1, 7).select(F.col("id").cast("string").alias("a"), F.lit('say "x", y').alias("b"))
    path = sinks.write_csv(rows, str(tmp_path / "out"), merge=True)
    lines = Path(path).read_text().splitlines()
    assert lines[0] == "a,b" and lines[1:] == [f'{i},"say ""x"", y"' for i in range(5000)]
    empty = sinks.write_csv(rows.limit(0), str(tmp_path / "none"), merge=True)
    assert Path(empty).read_text() == "a,b\n"


def test_a_load_reads_its_source_once(spark, tmp_path, monkeypatch):
    """Rows and rejects come from one pass; a load of many rows meets the stored keys in one shuffle."""
    write(tmp_path / "in" / "a.csv", [raw_line("A"), raw_line("A", "late"), "", 'q"x,y', raw_line("X" * 21)])
    write(tmp_path / "in" / "b.csv", [raw_line("A", "later"), raw_line("B")])
    seen = []
    real = sinks.judged
    monkeypatch.setattr(sinks, "judged", lambda *a, **k: seen.append(1) or real(*a, **k))
    for limit in (10**6, 0):
        monkeypatch.setattr(sinks, "BROADCAST_KEYS", limit)
        table, rejects = str(tmp_path / f"t{limit}"), str(tmp_path / f"r{limit}")
        one = sinks.ingest(spark, str(tmp_path / "in" / "a.csv"), table, rejects)
        two = sinks.ingest(spark, str(tmp_path / "in"), table, rejects)
        assert (one.rows_read, one.rows_rejected, one.rows_written) == (5, 3, 1)
        assert (two.rows_read, two.rows_rejected, two.rows_written) == (7, 3, 1)
        stored = {r.order_id: r.product_name for r in read_sales(spark, table).collect()}
        assert stored == {"A": "tv", "B": "tv"}
        bad = sorted((r.line, r.reason) for r in spark.read.parquet(rejects).collect())
        assert bad == sorted(2 * [("", "blank line"), ('q"x,y', "insufficient columns"), (raw_line("X" * 21), "does not fit the table")])
    assert len(seen) == 4


def test_bulk_load_parses_and_stores_once(spark, tmp_path, monkeypatch):
    header = "order_id,product_name,category,quantity,unit_price,discount_percent,region,sale_date,customer_email,revenue"
    lines = ["A,one,c,2,1.50,0.00,North,2024-01-15,a@b.com,3.00", "A,one,c,2,1.50,0.00,North,2024-01-15,a@b.com,3.00", "C,x,c,two,1,0,n,,,1"]
    (tmp_path / "in.csv").write_text("\n".join([header, *lines]) + "\n")
    stored = []
    real = sinks.materialize
    monkeypatch.setattr(sinks, "materialize", lambda df: stored.append(1) or real(df))
    result = sinks.bulk_load(spark, str(tmp_path / "in.csv"), str(tmp_path / "t"), str(tmp_path / "r"))
    assert (result.rows_read, result.rows_rejected, result.rows_written) == (3, 1, 1)
    assert len(stored) == 1  # the judged rows, and not once more by the load


def test_words_never_reach_the_casts_of_a_bulk_load(spark):
    texts = ["7", " 7 ", "+7", "-7", "7.0", ".5", "1e3", "abc", "n/a", "", " ", None, "7x", "NaN", "Infinity", "0x1F", "١٢", "99999999999", "\t8\n"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for kind in (SALES_SCHEMA["quantity"].dataType, SALES_SCHEMA["unit_price"].dataType):
        value = csv_lines._number(F.col("t"), kind)
        rows = df.select("t", value.alias("ours"), F.col("t").try_cast(kind).alias("plain")).collect()
        assert [r.ours for r in rows] == [r.plain for r in rows]
        assert "RLIKE" in df.select(value)._jdf.queryExecution().optimizedPlan().toString()
