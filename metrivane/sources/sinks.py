"""Sinks: landing area, stage tables, warehouse tables, small report documents."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_landing(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Raw rows; parquet is laid out by date, CSV carries ISO dates."""
    if fmt == "csv":
        df.write.mode("overwrite").option("header", True).option("dateFormat", "yyyy-MM-dd").option("escape", '"').csv(path)
    else:
        by_date(df).write.mode("overwrite").partitionBy("date").parquet(path)


def by_date(df: DataFrame, date: str = "date") -> DataFrame:
    """Bring rows of a date together before a partitioned write.

    ``rebalance`` keeps the number of files per date small, and adaptive execution
    splits a date that is much larger than the others.
    """
    return df.hint("rebalance", date)


def write_stage(df: DataFrame, path: str) -> DataFrame:
    """Write a stage table and return it as read back: later stages start from storage."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def write_document(df: DataFrame, path: str, fmt: str = "json") -> None:
    """A report of a few rows as one file.  Nested columns need JSON."""
    writer = df.coalesce(1).write.mode("overwrite")
    if fmt == "csv":
        writer.option("header", True).option("escape", '"').csv(path)
    else:
        writer.json(path)


def write_warehouse(spark: SparkSession, tables: Mapping[str, DataFrame], folder: str) -> DataFrame:
    """Full refresh of every table as a parquet folder; returns (table, rows) as stored."""
    for name, df in tables.items():
        df.write.mode("overwrite").parquet(f"{folder}/{name}")
    return row_counts({name: spark.read.parquet(f"{folder}/{name}") for name in tables})


def save_tables(tables: Mapping[str, DataFrame], database: str) -> None:
    """The same full refresh into catalog tables."""
    for name, df in tables.items():
        df.write.mode("overwrite").saveAsTable(f"{database}.{name}")


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """One row per table, counted in one job."""
    parts = [df.agg(F.count("*").alias("rows")).select(F.lit(n).alias("table"), "rows") for n, df in tables.items()]
    return reduce(DataFrame.unionByName, parts)
