"""Scans: contract-driven CSV, nested JSON payloads, stored tables that may be absent."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from metrivane.config import Contract
from metrivane.functions.scalars import day, flag, number

_SPARK_TYPES = {"date": "date", "integer": "bigint", "number": "double", "boolean": "boolean", "string": "string"}


class NoSeriesError(RuntimeError):
    """Every requested series failed."""


def path_exists(spark: SparkSession, path: str) -> bool:
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def contract_schema(contract: Contract) -> T.StructType:
    """The typed schema a contract declares, in its column order."""
    names = contract.column_order or tuple(contract.types)
    return T.StructType([T.StructField(c, T._parse_datatype_string(_SPARK_TYPES[contract.types.get(c, "string")])) for c in names])


def scan_text(spark: SparkSession, path: str, line_breaks: bool = False) -> DataFrame:
    """A CSV file with every column as text, for checking; an empty cell stays an empty string.

    Quotes within a quoted cell are doubled.  ``line_breaks``: quoted cells may hold line breaks; a file is
    then read by one task.
    """
    if not path_exists(spark, path):
        raise FileNotFoundError(f"Raw KPI data not found at {path}")
    df = spark.read.option("header", True).option("escape", '"').option("multiLine", line_breaks).csv(path)
    return df.select(*[F.coalesce(F.col(c), F.lit("")).alias(c) for c in df.columns])


def scan_csv(spark: SparkSession, path: str, contract: Contract) -> DataFrame:
    """The same file typed by the contract: contract columns first, extra columns after.

    A value that does not parse becomes NULL; booleans follow the flag spelling.
    """
    return typed(scan_text(spark, path), contract)


def typed(text: DataFrame, contract: Contract) -> DataFrame:
    parse = {"date": day, "number": number, "boolean": flag}

    def column(c):
        kind = contract.types.get(c, "string")
        if kind == "integer":
            return F.when(number(c) % 1 == 0, number(c).try_cast("bigint")).alias(c)
        return parse[kind](c).alias(c) if kind in parse else F.col(c)

    first = [c for c in contract.column_order if c in text.columns]
    return text.select(*[column(c) for c in first], *[F.col(c) for c in text.columns if c not in first])


PAYLOAD_SCHEMA = (
    "items array<struct<project:string, access:string, agent:string, granularity:string, "
    "timestamp:string, views:double>>, _corrupt string"
)


def read_payloads(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Landed payload documents, one per file; a broken one is kept as a corrupt row."""
    return (
        spark.read.schema(PAYLOAD_SCHEMA)
        .option("multiLine", True)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", "_corrupt")
        .json(path)
        .withColumn("source_file", F.input_file_name())
    )


def parse_payloads(documents: DataFrame, text: str) -> DataFrame:
    """Payload documents that are cells of a table; a broken one is kept as a corrupt row."""
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"}
    parsed = documents.withColumn("_document", F.from_json(text, PAYLOAD_SCHEMA, options))
    others = [c for c in documents.columns if c != text]
    return parsed.select(*others, F.col("_document.items").alias("items"), F.col("_document._corrupt").alias("_corrupt"))


def flatten_payloads(payloads: DataFrame, kpi_name: str = "pageviews") -> DataFrame:
    """One row per item: date from the first 8 digits of the timestamp, the count as the value."""
    items = payloads.select(F.inline("items"))
    return items.select(
        F.try_to_date(F.substring("timestamp", 1, 8), "yyyyMMdd").alias("date"),
        F.lit(kpi_name).alias("kpi_name"),
        "project",
        "access",
        "agent",
        F.col("views").cast("double").alias("kpi_value"),
    )


def failed_payloads(payloads: DataFrame, source: str | list[str] = "source_file") -> DataFrame:
    """Sources without any item, and why."""
    empty = F.coalesce(F.size("items"), F.lit(0)) <= 0  # the size of a missing list may be -1
    reason = F.when(F.col("_corrupt").isNotNull(), "Unreadable payload").otherwise("Empty payload")
    named = [source] if isinstance(source, str) else source
    return payloads.where(empty).select(*named, reason.alias("error"))


def ingest_payloads(
    spark: SparkSession,
    path: str | list[str],
    end: dt.date | str,
    lookback_days: int,
    kpi_name: str = "pageviews",
    requested: DataFrame | None = None,
) -> tuple[DataFrame, DataFrame]:
    """(series rows of the lookback, failures).

    Without ``requested`` the failures are the sources without items.  With it (see ``requested.requested_series``) only
    requested series are kept, and the failures are the requested series that never came, with the reason.
    A failure does not sink the others; if everything failed, raises.
    """
    from metrivane.plans.reports import lookback
    from metrivane.sources.requested import ledger

    payloads = read_payloads(spark, path)
    rows = lookback(flatten_payloads(payloads, kpi_name), end, lookback_days)
    if requested is not None:
        rows = rows.join(requested, requested.columns, "left_semi")
    if rows.isEmpty():
        raise NoSeriesError("No series could be read")
    if requested is None:
        return rows, failed_payloads(payloads)
    lost = ledger(requested, rows).where(F.col("status") == "failed")
    return rows, lost.select(*requested.columns, "error")


def concatenate(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def read_or_empty(spark: SparkSession, path: str, schema: T.StructType | str, fmt: str = "parquet") -> DataFrame:
    """The stored table, or an empty one of that schema when it does not exist."""
    if not path_exists(spark, path):
        return spark.createDataFrame([], schema)
    reader = spark.read.schema(schema)
    return (reader.option("header", True) if fmt == "csv" else reader).format(fmt).load(path)


INCIDENT_DETAILS = "incident_id string, anomaly_count bigint, executive_summary string"


def read_incident_details(spark: SparkSession, path: str) -> DataFrame:
    """(incident_id, anomaly_count, executive_summary) of a stored incident document."""
    if not path_exists(spark, path):
        return spark.createDataFrame([], INCIDENT_DETAILS)
    document = spark.read.schema(f"incidents array<struct<{_struct(INCIDENT_DETAILS)}>>").option("multiLine", True).json(path)
    return document.select(F.inline("incidents"))


def _struct(ddl: str) -> str:
    return ", ".join(":".join(part.split()) for part in ddl.split(","))


def register(spark: SparkSession, sources: Mapping[str, str], fmt: str = "parquet") -> dict[str, DataFrame]:
    """Declared sources (name -> path) as temporary views."""
    frames = {}
    for name, path in sources.items():
        frames[name] = spark.read.format(fmt).load(path)
        frames[name].createOrReplaceTempView(name)
    return frames
