"""Stored tables: reads for analytics and for the dashboard."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..schemas import SALES_SCHEMA, SUMMARY_SCHEMAS
from .commits import Commit, commits, last_commit


def read_sales(spark: SparkSession, path: str, listed: list[Commit] | None = None) -> DataFrame:
    """The fact rows of all commits, or of those ``listed``; a plain folder is read whole."""
    listed = commits(spark, path) if listed is None else listed
    reader = spark.read.schema(SALES_SCHEMA)
    return reader.parquet(*[c.data for c in listed]) if listed else reader.parquet(path)


def summary_folder(spark: SparkSession, folder: str) -> str:
    """Where the tables of the newest complete refresh are."""
    newest = last_commit(spark, folder)
    return newest.data if newest else folder


def read_summaries(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """The five summary tables under ``folder``, all of one refresh, without their time stamps."""
    newest = summary_folder(spark, folder)
    return {
        name: spark.read.schema(schema).parquet(f"{newest}/{name}")
        for name, schema in SUMMARY_SCHEMAS.items()
    }
