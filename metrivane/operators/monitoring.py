"""Trailing baselines, variances and direction-aware status."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from metrivane.config import FALLBACK_THRESHOLD, Settings, check_dimensions
from metrivane.functions.scalars import adverse, banded_severity, day, half_even, lookup, number, ratio
from metrivane.operators.windows import Trailing, add_trailing

MEASURES = [
    "actual_value",
    "rolling_avg_7d",
    "rolling_avg_14d",
    "rolling_avg_28d",
    "moving_baseline",
    "expected_value",
    "absolute_variance",
    "percent_variance",
    "threshold_value",
    "threshold_direction",
    "threshold_breached",
    "monitoring_status",
]

# The trailing windows, in rows; the baseline leaves out the current row.
TRAILING = [
    Trailing("rolling_avg_7d", "avg", "actual_value", -6, 0),
    Trailing("rolling_avg_14d", "avg", "actual_value", -13, 0),
    Trailing("rolling_avg_28d", "avg", "actual_value", -27, 0),
    Trailing("moving_baseline", "ordered_avg", "actual_value", -28, -1, min_count=7),
]


def require(df: DataFrame, columns, what: str) -> None:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"Cannot build {what}. Missing columns: {missing}")


def monitor(panel: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """The monitoring table: same grain as the panel, twelve measures."""
    dims = check_dimensions(settings.dimensions)
    require(panel, ["date", "kpi_value", *dims], "the monitoring table")
    rows = panel.select(day("date").alias("date"), *dims, number("kpi_value").alias("actual_value"))
    rows = add_trailing(rows, dims, TRAILING, block_days=settings.block_days)
    return add_status(add_variance(rows), settings).select("date", *dims, *MEASURES)


def add_variance(df: DataFrame) -> DataFrame:
    expected = F.col("moving_baseline")
    change = F.col("actual_value") - expected
    return df.withColumns(
        {
            "expected_value": expected,
            "absolute_variance": change,
            "percent_variance": ratio(change, expected),
        }
    )


def add_status(df: DataFrame, settings: Settings) -> DataFrame:
    """Threshold lookup (with fallback) and status; a NULL variance is NORMAL."""
    t = settings.thresholds
    warning = lookup("kpi_name", {k: v.warning for k, v in t.items()}, FALLBACK_THRESHOLD.warning)
    critical = lookup("kpi_name", {k: v.critical for k, v in t.items()}, FALLBACK_THRESHOLD.critical)
    direction = lookup("kpi_name", settings.directions, FALLBACK_THRESHOLD.direction)
    status = banded_severity(adverse(F.col("percent_variance"), direction), warning, critical)
    return (
        df.withColumn("threshold_direction", direction)
        .withColumn("monitoring_status", status)
        .withColumn("threshold_breached", F.col("monitoring_status") != "NORMAL")
        .withColumn("threshold_value", F.when(F.col("monitoring_status") == "CRITICAL", critical).otherwise(warning))
    )


def summary(monitoring: DataFrame) -> DataFrame:
    """One row: rows, KPI names, date range, warning/critical/breach counts."""
    return monitoring.agg(
        F.count("*").alias("total_monitoring_rows"),
        F.array_join(F.array_sort(F.collect_set("kpi_name")), ",").alias("kpi_names"),
        F.min("date").alias("date_min"),
        F.max("date").alias("date_max"),
        F.count_if(F.col("monitoring_status") == "WARNING").alias("warning_count"),
        F.count_if(F.col("monitoring_status") == "CRITICAL").alias("critical_count"),
        F.count_if(F.col("threshold_breached")).alias("threshold_breach_count"),
    )


def breaches_by_kpi(monitoring: DataFrame) -> DataFrame:
    return (
        monitoring.where("threshold_breached").groupBy("kpi_name").agg(F.count("*").alias("breaches"))
    )


def worst_variances(monitoring: DataFrame, dims, n: int = 10) -> DataFrame:
    """The rows farthest from their baseline; ties resolved by the business key."""
    return (
        monitoring.where(F.col("percent_variance").isNotNull())
        .orderBy(F.desc(F.abs("percent_variance")), "date", *dims)
        .limit(n)
        .select(
            "date",
            *dims,
            *[half_even(c, 6).alias(c) for c in ("actual_value", "expected_value", "percent_variance")],
            "monitoring_status",
        )
    )


