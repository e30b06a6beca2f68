"""The whole run: load raw CSV, then rebuild the summaries.

    spark-submit salesengine/pipeline.py --source 'in/*.csv' --target fact \
        --rejects rejects --summaries summaries
"""

from __future__ import annotations

import argparse
import sys
from pathlib import Path

if __package__ in (None, ""):
    sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from pyspark.sql import DataFrame, SparkSession

from salesengine.operators.cleaning import fitting, split_and_clean, to_stored
from salesengine.operators.sinks import IngestionResult, Sink, ingest, write_rejects, write_sales
from salesengine.plans.refresh import refresh_all
from salesengine.session import SETTINGS
from salesengine.sources.csv_lines import POSITION, read_lines, with_fields


def run(
    spark: SparkSession,
    source: str | list[str],
    target: str,
    sink: str | Sink = "table",
    rejects: str | None = None,
    summaries: str | None = None,
    skip_header: bool = True,
    skip_refresh: bool = False,
    variant: str = "service",
    truncate: bool = False,
    merge: bool = False,
    **options: str,
) -> tuple[IngestionResult | DataFrame | int | str | None, DataFrame | None]:
    """What the sink returned, and the row counts of the summaries when they were rebuilt.

    Only the fact table feeds the summaries. Every sink sets its rejects aside, in a
    folder beside the target unless ``rejects`` names one; a view, a database and a
    callable have no folder, so there it must be named.
    """
    if rejects is None:
        if sink not in ("table", "csv"):
            raise ValueError("name a folder for the rejects")
        rejects = f"{target.rstrip('/')}_rejects"
    if sink == "table":
        result = ingest(spark, source, target, rejects, skip_header, truncate)
        if skip_refresh or summaries is None:
            return result, None
        return result, refresh_all(spark, target, summaries, variant)
    fields = with_fields(read_lines(spark, source, skip_header))
    clean = fitting(split_and_clean(fields, POSITION), truncate)
    rows = to_stored(clean, POSITION, truncate) if sink == "jdbc" or truncate else clean
    result = write_sales(rows, sink, target, merge, **options)
    write_rejects(fields, rejects, truncate)
    return result, None


def main(arguments: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description="Load raw order files and rebuild the summaries.")
    parser.add_argument("--source", required=True)
    parser.add_argument("--target", required=True)
    parser.add_argument("--sink", default="table", choices=["table", "csv", "memory", "jdbc"])
    parser.add_argument("--rejects")
    parser.add_argument("--summaries")
    parser.add_argument("--variant", default="service", choices=["service", "script"])
    parser.add_argument("--no-header", action="store_true")
    parser.add_argument("--skip-refresh", action="store_true")
    parser.add_argument("--truncate", action="store_true", help="cut texts that are too long")
    parser.add_argument("--merge", action="store_true", help="write one CSV file")
    parser.add_argument("--url", help="of the database; --target is its table then")
    given = parser.parse_args(arguments)
    builder = SparkSession.builder.appName("salesengine")
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    to_database = given.sink == "jdbc"
    result, counts = run(
        spark,
        given.source,
        given.url if to_database else given.target,
        given.sink,
        given.rejects,
        given.summaries,
        not given.no_header,
        given.skip_refresh,
        given.variant,
        given.truncate,
        given.merge,
        **({"table": given.target} if to_database else {}),
    )
    if isinstance(result, IngestionResult):
        print(
            f"read {result.rows_read}, rejected {result.rows_rejected}, wrote {result.rows_written}"
            f" in {result.elapsed_ms / 1000:.2f} s ({result.rows_per_second:.2f} rows/s);"
            f" the table went from {result.rows_before} to {result.rows_after} rows"
        )
    if counts is not None:
        for row in counts.collect():
            print(f"{row.table_name}: {row.row_count} rows")


if __name__ == "__main__":
    main()
