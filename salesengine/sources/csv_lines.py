"""CSV as raw lines, split by a quote toggle, and cleaned CSV for bulk loads."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DataType

from ..functions.dates import str_to_date
from ..functions.text import trimmed_fast
from ..schemas import RAW_COLUMNS, RAW_SCHEMA, SALES_SCHEMA, VARCHAR_LENGTHS
from ..session import materialize

# A field is any run of unquoted text and quoted spans; an open quote runs to
# the end. Possessive quantifiers keep long fields from growing the stack.
_FIELD = r',((?:[^",]++|"[^"]*+(?:"|$))*+)'

MAX_BATCH_BYTES = 32 * 2**30

# Earlier files first, as a stream takes them, so a load does not depend on its batches.
POSITION = ("_time", "_file", "_block", "_row")


_BLOCK_UNIT, _FILE_UNIT = 10**10, 10**26


def with_place(rows: DataFrame, name: str = "_place") -> DataFrame:
    """The columns of ``POSITION`` packed into one number, which no two lines share.

    Files are numbered by age and path, one row per file, which the driver has listed
    anyway. The number leaves 10^12 files, 10^16 bytes of a file and 2^33 lines of a split.
    """
    oldest_first = Window.orderBy("_time", "_file")
    files = rows.select("_time", "_file").distinct()
    files = files.withColumn("_number", F.row_number().over(oldest_first))
    files = materialize(files.withColumnsRenamed({"_time": "_t", "_file": "_f"}))
    row = F.col("_row").bitwiseAND(F.lit(2**33 - 1))
    parts = [
        F.col(c).cast("decimal(38,0)") * F.lit(str(unit)).cast("decimal(38,0)")
        for c, unit in (("_number", _FILE_UNIT), ("_block", _BLOCK_UNIT))
    ]
    place = (parts[0].cast("decimal(38,0)") + parts[1].cast("decimal(38,0)") + row).cast("decimal(38,0)")
    same = F.col("_time").eqNullSafe(F.col("_t")) & F.col("_file").eqNullSafe(F.col("_f"))
    return rows.join(files, same).select(*rows.columns, place.alias(name))


def read_lines(spark: SparkSession, path: str | list[str], skip_header: bool = True) -> DataFrame:
    """One row per physical line, blank ones too, with its file and split.

    Files are cut into splits as usual; of each file the first physical line is
    dropped as the header, whatever it holds.
    """
    lines = spark.read.text(path).select("value", *_where())
    return drop_header(lines) if skip_header else lines


def drop_header(lines: DataFrame) -> DataFrame:
    """Lines without the first one of each file.

    The first lines are found by a scan that keeps no text, and go to all tasks
    as one number per file; the driver holds more than that for each file it lists.
    """
    numbered = lines.withColumn("_line", F.monotonically_increasing_id())
    first = numbered.where(F.col("_block") == 0).groupBy("_file").agg(F.min("_line").alias("_line"))
    return numbered.join(F.broadcast(first.select("_line")), "_line", "left_anti").drop("_line")


def stream_lines(
    spark: SparkSession,
    directory: str,
    max_files_per_trigger: int | None = None,
    max_bytes_per_trigger: int = MAX_BATCH_BYTES,
) -> DataFrame:
    """The same lines from a folder that new files arrive in, headers included.

    A batch takes so many bytes of files, or as many files as asked for, oldest
    first, so a long backlog is worked off in steps.
    """
    reader = spark.readStream
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    else:
        reader = reader.option("maxBytesPerTrigger", max_bytes_per_trigger)
    return reader.text(directory).select("value", *_where())


def _where() -> list[Column]:
    return [
        F.col("_metadata.file_modification_time").alias("_time"),
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_block"),
    ]


def split_fields(line: Column) -> Column:
    """Fields of a line as an array, still with their quotes.

    Only a line with a quote needs the pattern, which takes several times as long.
    """
    quoted = F.regexp_extract_all(F.concat(F.lit(","), line), F.lit(_FIELD), F.lit(1))
    return F.when(line.contains('"'), quoted).otherwise(F.split(line, ","))


def unquoted(text: Column) -> Column:
    """A field without quotes and edge blanks."""
    return trimmed_fast(F.replace(text, F.lit('"'), F.lit("")))


def field(fields: Column, index: int) -> Column:
    """One unquoted field; NULL past the end."""
    return unquoted(F.get(fields, F.lit(index)))


def with_fields(lines: DataFrame) -> DataFrame:
    """Lines with their ``fields``, and ``_row``, their order within a split.

    Both stand in one projection: filters on ``fields`` cannot sink below the
    row number, so a line is split once.
    """
    return lines.select(
        "*",
        split_fields(F.col("value")).alias("fields"),
        F.monotonically_increasing_id().alias("_row"),
    )


def raw_row(fields: Column) -> list[Column]:
    """The ten named text columns of a split line."""
    return [field(fields, i).alias(name) for i, name in enumerate(RAW_COLUMNS)]


def read_raw(
    spark: SparkSession, path: str | list[str], skip_header: bool = True, dialect: str = "toggle"
) -> DataFrame:
    """Ten text columns per line, from either dialect.

    ``toggle``: a quote only switches commas on and off, and is dropped.
    ``rfc4180``: doubled quotes stand for one and fields may hold line ends.
    """
    if dialect == "rfc4180":
        return (
            spark.read.option("header", skip_header)
            .option("escape", '"')
            .option("multiLine", True)
            .schema(RAW_SCHEMA)
            .csv(path)
        )
    if dialect != "toggle":
        raise ValueError(f"unknown dialect {dialect}")
    fields = with_fields(read_lines(spark, path, skip_header))
    return fields.where(F.size("fields") >= len(RAW_COLUMNS)).select(*raw_row(F.col("fields")))


def read_cleaned_text(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Cleaned CSV with a header, all of it text."""
    reader = spark.read.option("header", True).option("escape", '"').option("nullValue", "")
    return reader.schema(RAW_SCHEMA).csv(path)


def read_cleaned(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Cleaned CSV with a header, ready for the fact table; ``judged_text`` tells what becomes NULL."""
    return empty_to_null(read_cleaned_text(spark, path))


def judged_text(text: DataFrame) -> DataFrame:
    """Text rows of cleaned CSV once: the fact row, or else ``line`` and the ``reason``.

    The reason names the first column whose text does not fit its fact type. A value is
    parsed once, for the row and for the reason.
    """
    both = text.select("*", *[value.alias(f"_{name}") for name, value in _parsed().items()])
    reason = F.coalesce(*_reasons())
    known = both.withColumn("reason", reason)
    good = F.col("reason").isNull()
    line = F.to_csv(F.struct(*RAW_COLUMNS), {"escape": '"'})
    rows = [F.when(good, F.col(f"_{f.name}")).alias(f.name) for f in SALES_SCHEMA.fields]
    return known.select(*rows, F.when(~good, line).alias("line"), "reason")


def _reasons() -> list[Column]:
    """For each column that can fail, why it does; ``_`` stands before the parsed values."""
    reasons = []
    for target in SALES_SCHEMA.fields:
        value = F.nullif(F.col(target.name), F.lit(""))
        if target.name in VARCHAR_LENGTHS:
            wrong = F.length(value) > VARCHAR_LENGTHS[target.name]
        elif target.dataType.typeName() != "string":
            wrong = value.isNotNull() & F.col(f"_{target.name}").isNull()
        else:
            continue
        reasons.append(F.when(wrong, F.lit(f"{target.name} does not fit")))
    return reasons


def _number(value: Column, kind: DataType) -> Column:
    """Text to a number. Words never reach the cast, which would throw and catch for each."""
    likely = value.rlike(r"\p{Nd}")
    if kind.typeName() == "integer":
        likely = likely & ~value.rlike("[A-Za-z.]")
    return F.when(likely, value.try_cast(kind))


def _parsed() -> dict[str, Column]:
    """Text columns as fact types; '' becomes NULL, except in the key."""
    columns = {}
    for target in SALES_SCHEMA.fields:
        value = F.nullif(F.col(target.name), F.lit(""))
        if target.name == "order_id":
            value = F.coalesce(value, F.lit(""))
        elif target.name == "sale_date":
            value = str_to_date(value)
        elif target.dataType.typeName() != "string":
            value = _number(value, target.dataType)
        columns[target.name] = value
    return columns


def empty_to_null(text: DataFrame) -> DataFrame:
    """Text columns to fact types; '' becomes NULL, except in the key."""
    return text.select(*[value.alias(name) for name, value in _parsed().items()])
