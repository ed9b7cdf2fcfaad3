"""End-to-end runs.  Every stage is written and read back, so a lost executor costs one
stage at most and readers of a stage share its one computation."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from metrivane.config import Contract, Settings
from metrivane.operators import anomaly, evaluation, incidents, monitoring, quality, rca
from metrivane.plans import reports, warehouse
from metrivane.sources import scans, sinks
from metrivane.sources.requested import ledger, requested_coverage, requested_series


def evaluation_run(
    spark: SparkSession,
    panel: DataFrame,
    out: str,
    settings: Settings = Settings(),
    contract: Contract = Contract(),
    as_of: dt.date | str | None = None,
    run_timestamp: str | None = None,
) -> dict[str, DataFrame]:
    """Labelled track: quality, monitoring, detection, evaluation, RCA, incidents."""
    as_of = as_of or dt.date.today()
    stamp = run_timestamp or dt.datetime.now(dt.timezone.utc).isoformat()
    t: dict[str, DataFrame] = {}

    def put(name, df):
        t[name] = sinks.write_stage(df, f"{out}/{name}")
        return t[name]

    validated = put("validated", panel)
    checks = put("quality_checks", quality.run_checks(validated, contract, as_of))
    report = put("quality_report", quality.report(checks))
    monitored = put("monitoring", monitoring.monitor(validated, settings))
    summary = put("monitoring_summary", monitoring.summary(monitored))
    put("worst_variances", monitoring.worst_variances(monitored, settings.dimensions))
    put("breaches_by_kpi", monitoring.breaches_by_kpi(monitored))
    anomalies = put("anomalies", anomaly.detect(monitored, validated, settings))
    scored = put("evaluation", evaluation.evaluate(anomalies))
    best = put("best_detector", evaluation.best_detector(scored))
    _diagnose(put, anomalies, settings, incident_context(best, report, summary, settings), stamp)
    sinks.write_document(t["incident_document"], f"{out}/latest_incident")
    sinks.write_document(t["incident_history"], f"{out}/incident_history_csv", "csv")
    sinks.write_document(t["top_root_causes"], f"{out}/top_root_causes_csv", "csv")
    return t


def incident_context(best: DataFrame, report: DataFrame, summary: DataFrame, settings: Settings) -> DataFrame:
    """The incident context from the one-row results of the earlier stages."""
    one = best.select(
        F.col("detector").alias("best_detector"),
        F.col("f1_score").alias("best_detector_f1_score"),
        F.lit(settings.detector.model).alias("residual_model_used"),
    )
    two = report.select(F.col("status").alias("quality_status"), F.col("health_score").cast("double"))
    three = summary.select("warning_count", "critical_count")
    return one.crossJoin(F.broadcast(two)).crossJoin(F.broadcast(three))


def _diagnose(put, anomalies: DataFrame, settings: Settings, ctx: DataFrame, stamp: str) -> None:
    table = put("rca", rca.contributions(anomalies, settings))
    put("rca_candidates", rca.candidate_summary(anomalies, settings))
    causes = put("top_root_causes", rca.top_causes(table, settings))
    put("action_examples", rca.action_examples(causes))
    chosen = incidents.select_incidents(
        incidents.build(anomalies, table, ctx, settings), settings.incident.max_incidents
    )
    chosen = put("incidents", chosen)
    put("incident_history", incidents.history(chosen))
    put("incident_document", incidents.payload(chosen, settings.incident.detector, stamp))


def live_run(
    spark: SparkSession,
    landing: str | list[str],
    out: str,
    settings: Settings,
    end: dt.date | str,
    lookback_days: int = 90,
    report_days: int = 30,
    expected_series: int | None = None,
    best_detector_f1_score: float | None = None,
    run_timestamp: str | None = None,
    requested: Mapping[str, list[str]] | None = None,
) -> dict[str, DataFrame]:
    """Unlabelled track: the lookback warms the baselines, the last days are reported.

    The detector's F1 is carried over from a labelled run; it cannot be measured here.  ``requested`` lists the members asked
    for by dimension: coverage is then measured against them, and a series that never came is a failure.
    """
    asked = requested_series(spark, requested) if requested else None
    rows, failures = scans.ingest_payloads(spark, landing, end, lookback_days, requested=asked)
    t: dict[str, DataFrame] = {}

    def put(name, df):
        t[name] = sinks.write_stage(df, f"{out}/{name}")
        return t[name]

    failed, raw = put("failures", failures), put("raw", rows)
    if asked is not None:
        put("series", ledger(asked, raw, failed))
    return rescore(
        put, t, raw, settings, report_days, expected_series, 0 if asked is not None else failed.count(), best_detector_f1_score,
        run_timestamp,
    )


def rescore(
    put,
    t: dict[str, DataFrame],
    raw: DataFrame,
    settings: Settings,
    report_days: int,
    expected_series: int | None = None,
    failures: int = 0,
    best_detector_f1_score: float | None = None,
    run_timestamp: str | None = None,
) -> dict[str, DataFrame]:
    """Everything after the scan; also the way to score a stored fetch again."""
    stamp = run_timestamp or dt.datetime.now(dt.timezone.utc).isoformat()
    dims = list(settings.dimensions)
    monitored = put("monitoring", monitoring.monitor(raw, settings))
    anomalies = put("anomalies", anomaly.detect(monitored, raw, settings))
    recent = put("report_window", reports.report_window(anomalies, report_days))
    put("run_summary", reports.run_summary(anomalies, dims, report_days))
    if "series" in t:  # a ledger of what was asked for
        covered = put("coverage", requested_coverage(t["series"], raw))
    else:
        expected = expected_series or raw.select(*dims[1:]).distinct().count()
        covered = put("coverage", quality.coverage(raw, dims[1:], expected, failures))
    ctx = covered.select(
        F.lit(settings.incident.detector).alias("best_detector"),
        F.lit(best_detector_f1_score).cast("double").alias("best_detector_f1_score"),
        F.lit(settings.detector.model).alias("residual_model_used"),
        F.col("status").alias("quality_status"),
        "health_score",
        F.lit(0).cast("bigint").alias("warning_count"),
        F.lit(0).cast("bigint").alias("critical_count"),
    )
    _diagnose(put, recent, settings, ctx, stamp)
    return t


def warehouse_run(spark: SparkSession, stages: dict[str, DataFrame], out: str, settings: Settings, **options) -> DataFrame:
    """Publish the star schema of an evaluation run; returns stored row counts."""
    details = stages["incidents"].select("incident_id", "anomaly_count", "executive_summary")
    tables = warehouse.build_warehouse(
        stages["validated"],
        stages["monitoring"],
        stages["anomalies"],
        stages["rca"],
        stages["incident_history"],
        list(settings.dimensions),
        stages["quality_checks"],
        stages["quality_report"],
        details=details,
        **options,
    )
    return sinks.write_warehouse(spark, tables, out)
