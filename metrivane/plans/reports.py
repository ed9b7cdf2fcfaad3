"""Named reports over the warehouse tables, slices of the stage tables, run summaries."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from metrivane.functions.scalars import all_present, fixed, ratio
from metrivane.operators.joins import with_one_row

Tables = Mapping[str, DataFrame]


def _dated(t: Tables, fact: DataFrame, key: str, name: str) -> DataFrame:
    """A fact or mart with its date and KPI name.

    The dimension tables are stored tables (or were measured when built), so the
    planner broadcasts them by their size.
    """
    dates = t["dim_date"].select(F.col("date_key").alias(key), F.col("date_value").alias(name))
    kpis = t["dim_kpi"].select("kpi_key", "kpi_name")
    return fact.join(dates, key).join(kpis, "kpi_key")


def health_by_day(t: Tables) -> DataFrame:
    return (
        _dated(t, t["mart_kpi_health"], "date_key", "day")
        .select("day", "kpi_name", "monitored_rows", "warning_rows", "critical_rows", "breach_rows", "health_score",
                "avg_percent_variance")
        .orderBy(F.desc("day"), "kpi_name")
    )


def anomalies_by_severity(t: Tables) -> DataFrame:
    counted = t["fact_kpi_anomalies"].groupBy("kpi_key", "combined_severity").agg(F.count("*").alias("anomaly_count"))
    named = counted.join(t["dim_kpi"].select("kpi_key", "kpi_name"), "kpi_key")
    return named.select("kpi_name", "combined_severity", "anomaly_count").orderBy(
        F.desc("anomaly_count"), "kpi_name", "combined_severity"
    )


def top_contributors(t: Tables, n: int = 3) -> DataFrame:
    rows = t["fact_rca_contributions"].where(F.col("contribution_rank") <= n)
    return (
        _dated(t, rows, "analysis_date_key", "analysis_date")
        .select("analysis_date", "kpi_name", "dimension_type", "dimension_value", "degradation_amount",
                "contribution_share", "contribution_rank")
        .orderBy(F.desc("analysis_date"), "kpi_name", F.desc("contribution_share"), "dimension_type", "dimension_value")
    )


def incident_summary(t: Tables) -> DataFrame:
    return (
        _dated(t, t["mart_incident_summary"], "incident_date_key", "incident_date")
        .select("incident_date", "kpi_name", "severity", "confidence_label", "confidence_score", "detector_used",
                "top_root_cause", "recommended_action")
        .orderBy(F.desc("incident_date"), F.desc("severity"), "kpi_name")
    )


def quality_summary(t: Tables) -> DataFrame:
    return (
        t["mart_data_quality_summary"]
        .select("run_timestamp", "status", "health_score", "schema_status", "null_issue_count",
                "duplicate_issue_count", "freshness_status", "completeness_status", "volume_status")
        .orderBy(F.desc("run_timestamp"))
    )


def executive_rollup(t: Tables) -> DataFrame:
    rate = ratio(F.col("breach_rows").cast("double"), F.col("monitored_rows"))
    rolled = t["mart_kpi_health"].groupBy("kpi_key").agg(
        F.count("*").alias("monitored_rows"),
        F.count_if(F.col("critical_rows") > 0).alias("critical_days"),
        F.avg("health_score").alias("avg_health_score"),
        F.avg(rate).alias("avg_breach_rate"),
    )
    return (
        rolled.join(t["dim_kpi"].select("kpi_key", "kpi_name"), "kpi_key")
        .select("kpi_name", "monitored_rows", "critical_days", "avg_health_score", "avg_breach_rate")
        .orderBy("avg_health_score", "kpi_name")
    )


def dimension_drilldown(t: Tables) -> DataFrame:
    return (
        t["fact_rca_contributions"]
        .groupBy("dimension_type", "dimension_value")
        .agg(
            F.sum("degradation_amount").alias("total_degradation"),
            F.sum("contribution_share").alias("total_contribution_share"),
        )
        .orderBy(F.desc("total_degradation"), F.desc("total_contribution_share"), "dimension_type", "dimension_value")
    )


def segment_search(t: Tables, kpi: str, words: list[str]) -> DataFrame:
    """Contributions of one KPI whose member contains every word, ignoring case."""
    rows = t["fact_rca_contributions"]
    for w in words:
        rows = rows.where(F.col("dimension_value").ilike(f"%{w}%"))
    return (
        _dated(t, rows, "analysis_date_key", "analysis_date")
        .where(F.col("kpi_name") == kpi)
        .select("analysis_date", "kpi_name", "dimension_type", "dimension_value", "degradation_amount",
                "contribution_share", "recommended_action")
        .orderBy(F.desc("contribution_share"), "analysis_date", "dimension_type", "dimension_value")
    )


# ------------------------------------------------------------------ slices


def slice_panel(
    df: DataFrame, kpi: str | None = None, start=None, end=None, members: Mapping[str, list] | None = None
) -> DataFrame:
    """KPI, inclusive date range and member lists; an empty list does not filter."""
    if kpi is not None:
        df = df.where(F.col("kpi_name") == kpi)
    if start is not None:
        df = df.where(F.col("date") >= F.lit(start).cast("date"))
    if end is not None:
        df = df.where(F.col("date") <= F.lit(end).cast("date"))
    for column, values in (members or {}).items():
        if values:
            df = df.where(F.col(column).isin(*values))
    return df


def slice_detector(anomalies: DataFrame, detector: str) -> DataFrame:
    return anomalies.where(F.col(detector))


def slice_rca(table: DataFrame, kpi: str, date, dimension_type: str, detector: str, n: int | None = None) -> DataFrame:
    rows = table.where(
        (F.col("kpi_name") == kpi)
        & (F.col("analysis_date") == F.lit(date).cast("date"))
        & (F.col("dimension_type") == dimension_type)
        & (F.col("detector_used") == detector)
    ).orderBy(F.desc("contribution_share"), F.desc("degradation_amount"), "dimension_value")
    return rows if n is None else rows.limit(n)


def slice_incidents(history: DataFrame, severities=(), confidences=(), incident_id: str | None = None) -> DataFrame:
    if severities:
        history = history.where(F.col("severity").isin(*severities))
    if confidences:
        history = history.where(F.col("confidence_label").isin(*confidences))
    if incident_id is not None:
        history = history.where(F.col("incident_id") == incident_id)
    return history


def report_window(df: DataFrame, days: int) -> DataFrame:
    """Rows of the last ``days`` days of the table."""
    last = df.agg(F.max("date").alias("_last"))
    return with_one_row(df, last).where(F.col("date") >= F.date_sub("_last", days - 1)).drop("_last")


def lookback(df: DataFrame, end, days: int) -> DataFrame:
    """The ``days`` days up to ``end``, both included; ``end`` is the last complete day."""
    end = F.lit(end).cast("date")
    return df.where(F.col("date").between(F.date_sub(end, days - 1), end))


def yesterday(as_of):
    """The last complete day before ``as_of``."""
    import datetime as dt

    as_of = dt.date.fromisoformat(as_of) if isinstance(as_of, str) else as_of
    return as_of - dt.timedelta(days=1)


# ------------------------------------------------------------------ dashboards


def overview(monitored: DataFrame, anomalies: DataFrame) -> DataFrame:
    """One row: KPIs, date range, combined anomalies."""
    # one row per KPI first: no distinct-aggregate expansion of the table
    per_kpi = monitored.groupBy("kpi_name").agg(F.min("date").alias("lo"), F.max("date").alias("hi"))
    shape = per_kpi.agg(F.count("kpi_name").alias("kpis"), F.min("lo").alias("date_min"), F.max("hi").alias("date_max"))
    return with_one_row(shape, anomalies.agg(F.count_if(F.col("combined_anomaly")).alias("anomalies")))


def health_by_kpi(monitored: DataFrame) -> DataFrame:
    return monitored.groupBy("kpi_name").agg(
        F.count_if(F.col("threshold_breached")).alias("threshold_breaches"),
        F.avg("percent_variance").alias("avg_variance"),
        F.max(F.abs("percent_variance")).alias("max_variance"),
    )


def rows_by(df: DataFrame, column: str, name: str = "rows") -> DataFrame:
    return df.groupBy(column).agg(F.count("*").alias(name))


def long_series(monitored: DataFrame, keys: list[str]) -> DataFrame:
    """Actual, expected and baseline as rows (date, series, value) for charting."""
    names = ["actual_value", "expected_value", "moving_baseline"]
    return monitored.unpivot(["date", *keys], names, "series", "value")


def largest(df: DataFrame, column: str, n: int, ties: list[str]) -> DataFrame:
    """First ``n`` rows by absolute value, NULLs last."""
    return df.orderBy(F.desc_nulls_last(F.abs(column)), *ties).limit(n)


def metric_trend(wide: DataFrame, metric: str) -> DataFrame:
    """Daily mean of rates and latencies, daily sum of everything else."""
    mean = metric.endswith("_rate") or metric in ("ctr", "latency_ms")
    return wide.groupBy("date").agg((F.avg(metric) if mean else F.sum(metric)).alias(metric))


def zscore_trend(scored: DataFrame, metric: str) -> DataFrame:
    return scored.groupBy("date").agg(
        F.max(F.abs(f"{metric}_zscore")).alias("max_abs_zscore"),
        F.count_if(F.col(f"{metric}_anomaly")).alias("anomaly_count"),
    )


def worst_drops(df: DataFrame, keys: list[str], rate: str, n: int = 10) -> DataFrame:
    """Rows with the largest drop against the series' previous row; first rows come last."""
    from metrivane.operators.windows import previous_value

    rows = previous_value(df, keys, rate, f"previous_{rate}")
    change = F.col(rate) - F.col(f"previous_{rate}")
    return rows.withColumn("change", change).orderBy(F.asc_nulls_last("change"), "date", *keys).limit(n)


def run_summary(anomalies: DataFrame, dims: list[str], window_days: int) -> DataFrame:
    """One row: rows, series, scored and warm-up rows, window rows and anomalies by detector."""
    last = anomalies.agg(F.max("date").alias("_last"))
    recent = F.col("date") >= F.date_sub("_last", window_days - 1)
    # per series first, so that series are a plain count
    per_series = with_one_row(anomalies, last).groupBy(*dims).agg(
        F.count("*").alias("rows"),
        F.count("z_score").alias("scored"),
        F.count_if(recent).alias("recent"),
        F.count_if(recent & F.col("zscore_anomaly")).alias("z"),
        F.count_if(recent & F.col("residual_anomaly")).alias("r"),
        F.count_if(recent & F.col("combined_anomaly")).alias("c"),
        F.min("date").alias("lo"),
        F.max("date").alias("hi"),
    )
    complete = F.count_if(all_present(dims))
    return per_series.agg(
        F.min("lo").alias("date_min"),
        F.max("hi").alias("date_max"),
        F.date_sub(F.max("hi"), window_days - 1).alias("report_window_start"),
        F.sum("rows").alias("total_rows"),
        complete.alias("series_count"),
        F.sum("scored").alias("rows_scored"),
        (F.sum("rows") - F.sum("scored")).alias("rows_unscored_baseline_warmup"),
        F.sum("recent").alias("rows_in_report_window"),
        F.sum("z").alias("zscore_anomalies"),
        F.sum("r").alias("residual_anomalies"),
        F.sum("c").alias("combined_anomalies"),
    )


def metric_digest(worst: DataFrame, metric: str) -> DataFrame:
    """One formatted row for a metric: its worst anomaly, or that there is none.

    ``worst`` has date, device_type, region, browser, z_score, actual_value and
    rolling_mean, worst row first (at most a few rows).
    """
    from metrivane.functions.text import investigation, z_band

    segment = ["device_type", "region", "browser"]
    place = F.struct(-F.abs("z_score"), "date", *segment)
    lead = worst.agg(F.min_by(F.struct(*segment, "z_score", "actual_value", "rolling_mean"), place).alias("w"))
    found = F.col("w").isNotNull()
    hint = investigation(metric, F.col("w.device_type"), F.col("w.region"), F.col("w.browser"))
    return lead.select(
        F.lit(metric).alias("kpi"),
        F.when(found, fixed("w.actual_value", 4)).otherwise("N/A").alias("current_value"),
        F.when(found, fixed("w.rolling_mean", 4)).otherwise("N/A").alias("rolling_baseline"),
        F.when(found, fixed("w.z_score", 2)).otherwise("0.00").alias("z_score"),
        z_band(F.coalesce("w.z_score", F.lit(0.0))).alias("severity"),
        F.when(found, F.concat_ws(" / ", "w.device_type", "w.region", "w.browser"))
        .otherwise("No anomaly detected").alias("primary_offender"),
        F.when(found, hint).otherwise("No immediate investigation suggested.").alias("suggested_investigation"),
    )
