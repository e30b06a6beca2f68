import random

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from salesengine.operators.cleaning import rejected, split_and_clean
from salesengine.schemas import CLEAN_SCHEMA, RAW_COLUMNS
from salesengine.sources import csv_lines
from salesengine.sources.csv_lines import read_lines, read_raw, split_fields, with_fields


def toggle_parser(line):
    """Brute force: walk the characters, a quote switches commas off and on."""
    fields, current, quoted = [], "", False
    for c in line:
        if c == '"':
            quoted = not quoted
        elif c == "," and not quoted:
            fields.append(current)
            current = ""
        else:
            current += c
    blanks = "".join(map(chr, range(33)))
    return [f.strip(blanks) for f in [*fields, current]]


def parsed(spark, lines):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(lines)], "i int, value string")
    bare = F.transform(split_fields(F.col("value")), csv_lines.unquoted)
    return [r.f for r in df.select("i", bare.alias("f")).orderBy("i").collect()]


EDGES = [
    "",
    ",",
    '"',
    '""',
    '"a,b",c',
    'a"b,c"d,e',
    'a,"open, to the end',
    '"say ""hi"", ok",x',
    ' \ta , "b " ,c\x01',
    "é,ü," * 3,
    '"' + "x," * 50_000 + '",y',
    ",".join(["word"] * 2_000),
]


def test_edge_lines(spark):
    assert parsed(spark, EDGES) == [toggle_parser(line) for line in EDGES]


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet='ab ",\t\\', max_size=40), min_size=1, max_size=200))
def test_random_lines(spark, lines):
    assert parsed(spark, lines) == [toggle_parser(line) for line in lines]


def write(path, lines):
    path.write_bytes("\n".join(lines).encode() + b"\n")
    return str(path)


GOOD = "A1,TV,electronic,2,10.5,10,North,2024-01-15,a@b.com,0"


def test_header_is_dropped_by_position(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    header = ",".join(RAW_COLUMNS)
    write(folder / "a.csv", [header, GOOD, header, 'q\\,"x'])
    write(folder / "b.csv", ["another header", "  padded  "])
    kept = {r.value for r in read_lines(spark, str(folder)).collect()}
    assert kept == {GOOD, header, 'q\\,"x', "  padded  "}
    assert read_lines(spark, str(folder), skip_header=False).count() == 6


def test_width_and_rejects(spark, tmp_path):
    nine = ",".join(["x"] * 9)
    path = write(tmp_path / "f.csv", ["h", GOOD, nine, GOOD + ",extra", ",,,,,,,,,"])
    fields = with_fields(read_lines(spark, path))
    bad = rejected(fields).collect()
    assert [(r.line, r.reason) for r in bad] == [(nine, "insufficient columns")]
    assert bad[0].file.endswith("f.csv")
    clean = split_and_clean(fields)
    assert clean.count() == 3
    assert [(f.name, f.dataType) for f in clean.schema] == [(f.name, f.dataType) for f in CLEAN_SCHEMA]
    blank = clean.where("order_id = ''").first()
    assert blank.product_name == "Unknown Product"
    assert (blank.quantity, blank.unit_price, blank.revenue) == (0, 0.0, 0.0)


def test_dialects_differ_on_doubled_quotes(spark, tmp_path):
    line = 'A1,"say ""hi""",c,1,1,0,n,2024-01-15,a@b.com,0'
    path = write(tmp_path / "f.csv", ["h", line])
    assert read_raw(spark, path).first().product_name == "say hi"
    assert read_raw(spark, path, dialect="rfc4180").first().product_name == 'say "hi"'


def test_cleaned_csv_blanks_are_null_but_the_key(spark, tmp_path):
    header = ",".join(RAW_COLUMNS)
    path = write(tmp_path / "f.csv", [header, ",,,,,,,,,", "A,tv,c,2,1.50,5.00,North,2024-01-15,,2.85"])
    rows = csv_lines.read_cleaned(spark, path).orderBy("order_id").collect()
    assert rows[0].order_id == "" and all(v is None for v in list(rows[0])[1:])
    assert str(rows[1].unit_price) == "1.50" and str(rows[1].sale_date) == "2024-01-15"


def test_position_follows_the_file(spark, tmp_path):
    random.seed(1)
    path = write(tmp_path / "f.csv", ["h"] + [f"{i},{random.random()}" for i in range(500)])
    rows = with_fields(read_lines(spark, path)).orderBy(*csv_lines.POSITION).collect()
    assert [int(r.fields[0]) for r in rows] == list(range(500))
