"""Incident records: one per (date, KPI) with causes, severity, confidence and actions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from metrivane.config import LOWER, IncidentConfig, Settings
from metrivane.functions.scalars import flag, half_even, lookup, severity_label, severity_rank
from metrivane.functions.text import actions_for, executive_summary, incident_id
from metrivane.operators.joins import with_one_row
from metrivane.operators.ranking import top_n
from metrivane.operators.rca import severity_column

CONTEXT_SCHEMA = (
    "best_detector string, best_detector_f1_score double, residual_model_used string, "
    "quality_status string, health_score double, warning_count bigint, critical_count bigint"
)
NO_CAUSE = "the affected segment"


def context(spark: SparkSession, **values) -> DataFrame:
    """The one-row context an incident is judged in; absent figures are NULL."""
    names = [c.strip().split()[0] for c in CONTEXT_SCHEMA.split(",")]
    unknown = sorted(set(values) - set(names))
    if unknown:
        raise ValueError(f"Unknown context values: {unknown}")
    return spark.createDataFrame([tuple(values.get(n) for n in names)], CONTEXT_SCHEMA)


def candidates(anomalies: DataFrame, detector: str) -> DataFrame:
    severity = severity_column(detector)
    return anomalies.where(
        flag(detector)
        & F.col(severity).isin("WARNING", "CRITICAL")
        & F.col("expected_value").isNotNull()
        & F.col("percent_variance").isNotNull()
    )


def aggregates(anomalies: DataFrame, detector: str) -> DataFrame:
    """Means, count and worst severity of the flagged rows per (date, KPI)."""
    severity = severity_column(detector)
    return (
        candidates(anomalies, detector)
        .groupBy("date", "kpi_name")
        .agg(
            F.avg("actual_value").alias("_actual"),
            F.avg("expected_value").alias("_expected"),
            F.avg("percent_variance").alias("_variance"),
            F.count("*").alias("anomaly_count"),
            F.max(F.abs("percent_variance")).alias("_worst"),
            F.max(severity_rank(severity)).alias("_severity"),
        )
    )


def top_causes(rca: DataFrame, cfg: IncidentConfig = IncidentConfig(), detector: str | None = None) -> DataFrame:
    """At most ``max_causes`` causes per (date, KPI) as an ordered array of structs.

    Interaction dimensions are preferred; single dimensions are used only where
    an incident has no interaction row.
    """
    key = ["analysis_date", "kpi_name"]
    rows = rca.where(F.col("detector_used") == (detector or cfg.detector))
    measures = ["contribution_share", "degradation_amount", "severity_max", "recommended_action"]
    # one row per member, the best one if a table carries copies
    rows = rows.groupBy(*key, "dimension_type", "dimension_value").agg(
        F.max(F.struct(*measures)).alias("_best")
    ).select(*key, "dimension_type", "dimension_value", "_best.*")
    rows = rows.withColumn("_pref", F.col("dimension_type").isin(*cfg.interaction_types))
    order = [
        F.desc("_pref"),
        F.desc("contribution_share"),
        F.desc("degradation_amount"),
        F.col("dimension_type"),
        F.col("dimension_value"),
    ]
    few = top_n(rows, key, order, cfg.max_causes, "_at")
    few = few.withColumn("_any", F.max("_pref").over(Window.partitionBy(*key))).where(F.col("_pref") == F.col("_any"))
    cause = F.struct(
        "_at",
        "dimension_type",
        "dimension_value",
        half_even("contribution_share", 6).alias("contribution_share"),
        half_even("degradation_amount", 6).alias("degradation_amount"),
        F.col("severity_max").alias("severity"),
        "recommended_action",
    )
    return few.groupBy(*key).agg(
        F.transform(F.array_sort(F.collect_list(cause)), lambda c: c.dropFields("_at")).alias("top_root_causes")
    )


def incident_severity(detector_severity: Column, worst: Column, share: Column, cfg: IncidentConfig) -> Column:
    concentrated = (share >= cfg.critical_share) & (worst >= cfg.warning_variance)
    critical = (detector_severity == "CRITICAL") | (worst >= cfg.critical_variance) | concentrated
    warning = (detector_severity == "WARNING") | (worst >= cfg.warning_variance)
    return F.when(critical, "CRITICAL").when(warning, "WARNING").otherwise("NORMAL")


def confidence_score(
    f1: Column, share: Column, health: Column, count: Column, detector_severity: Column, cfg: IncidentConfig
) -> Column:
    """Weighted triage score in [0, 1]; a missing F1 or health score adds nothing."""
    zero = F.lit(0.0)
    score = (
        cfg.weight_model * F.coalesce(f1, zero)
        + cfg.weight_share * share
        + cfg.weight_quality * F.coalesce(health / 100, zero)
        + cfg.weight_support * F.least(count / F.lit(cfg.support_saturation), F.lit(1.0))
        + cfg.weight_severity * F.when(detector_severity == "CRITICAL", 1.0).otherwise(0.65)
    )
    return half_even(F.greatest(zero, F.least(F.lit(1.0), score)), 3)


def confidence_label(score: Column) -> Column:
    return F.when(score >= 0.80, "High").when(score >= 0.55, "Medium").otherwise("Low")


def build(
    anomalies: DataFrame, rca: DataFrame, ctx: DataFrame, settings: Settings = Settings(), detector: str | None = None
) -> DataFrame:
    """Every incident, unordered; ``select_incidents`` orders and cuts."""
    cfg = settings.incident
    detector = detector or cfg.detector
    causes = top_causes(rca, cfg, detector).withColumnRenamed("analysis_date", "date")
    df = aggregates(anomalies, detector).join(causes, ["date", "kpi_name"], "left")
    df = with_one_row(df, ctx)

    found = F.coalesce(F.size("top_root_causes") > 0, F.lit(False))
    first = F.try_element_at("top_root_causes", F.lit(1))
    df = df.withColumns(
        {
            "_share": F.coalesce(F.array_max(F.transform("top_root_causes", lambda c: c["contribution_share"])), F.lit(0.0)),
            "_first_share": F.when(found, first["contribution_share"]).otherwise(0.0),
            "_cause": F.when(found, first["dimension_value"]).otherwise(NO_CAUSE),
            "_values": F.coalesce(F.transform("top_root_causes", lambda c: c["dimension_value"]), F.array().cast("array<string>")),
            "_cause_actions": F.coalesce(
                F.transform("top_root_causes", lambda c: c["recommended_action"]), F.array().cast("array<string>")
            ),
            "_label": severity_label("_severity"),
        }
    )
    df = df.withColumns(
        {
            "severity": incident_severity(F.col("_label"), F.col("_worst"), F.col("_share"), cfg),
            "confidence_score": confidence_score(
                F.col("best_detector_f1_score"),
                F.col("_share"),
                F.col("health_score"),
                F.col("anomaly_count"),
                F.col("_label"),
                cfg,
            ),
            "recommended_actions": actions_for(
                F.col("kpi_name"), F.array_join("_values", " "), F.col("_cause_actions"), cfg.max_actions
            ),
        }
    )
    direction = lookup("kpi_name", settings.directions, LOWER)
    summary = executive_summary(
        "date",
        "kpi_name",
        "severity",
        F.lit(detector),
        "_cause",
        "_first_share",
        direction,
        F.coalesce(F.try_element_at("recommended_actions", F.lit(1)), F.lit("review the affected segment.")),
    )
    return df.select(
        incident_id("date", "kpi_name", F.lit(detector)).alias("incident_id"),
        F.col("date").alias("incident_date"),
        F.col("kpi_name").alias("kpi_affected"),
        "severity",
        "confidence_score",
        confidence_label(F.col("confidence_score")).alias("confidence_label"),
        F.lit(detector).alias("detector_used"),
        half_even("_actual", 6).alias("actual_value_summary"),
        half_even("_expected", 6).alias("expected_value_summary"),
        half_even("_variance", 6).alias("percent_variance_summary"),
        "anomaly_count",
        F.col("_values").alias("suspected_dimensions"),
        "top_root_causes",
        "recommended_actions",
        summary.alias("executive_summary"),
        F.struct(
            half_even("_worst", 6).alias("max_abs_percent_variance"),
            F.col("_label").alias("max_detector_severity"),
            F.col("_cause").alias("top_root_cause"),
            F.coalesce("warning_count", F.lit(0)).alias("monitoring_warning_count"),
            F.coalesce("critical_count", F.lit(0)).alias("monitoring_critical_count"),
        ).alias("supporting_metrics"),
        F.struct(F.col("quality_status").alias("status"), "health_score").alias("data_quality_context"),
        F.struct("best_detector", "best_detector_f1_score", "residual_model_used").alias("model_context"),
    )


def report_order() -> list[Column]:
    """Worst severity, then confidence, then size; ties by date and KPI."""
    return [
        F.desc(severity_rank("severity")),
        F.desc("confidence_score"),
        F.desc("anomaly_count"),
        F.col("incident_date"),
        F.col("kpi_affected"),
    ]


def select_incidents(incidents: DataFrame, n: int = 12) -> DataFrame:
    """The reported list: the best incident of each KPI first, then the next best overall.

    Only the per-KPI best and the overall first ``n`` can be chosen, so only those
    few rows meet in one task; ``position`` is the place in the list.
    """
    order = report_order()
    best = top_n(incidents, ["kpi_affected"], order, 1).withColumn("_first", F.lit(True))
    most = incidents.orderBy(*order).limit(n).withColumn("_first", F.lit(False))
    both = top_n(best.unionByName(most), ["incident_id"], [F.desc("_first")], 1)
    place = Window.partitionBy(F.lit(1)).orderBy(F.desc("_first"), *order)
    return both.withColumn("position", F.row_number().over(place)).where(F.col("position") <= n).drop("_first")


def history(selected: DataFrame) -> DataFrame:
    """Flat incident rows, in list order."""
    first = F.try_element_at("top_root_causes", F.lit(1))["dimension_value"]
    return selected.orderBy("position").select(
        "incident_id",
        F.col("incident_date").alias("date"),
        "kpi_affected",
        "severity",
        "confidence_label",
        "confidence_score",
        F.coalesce(first, F.lit("")).alias("top_root_cause"),
        F.coalesce(F.try_element_at("recommended_actions", F.lit(1)), F.lit("")).alias("recommended_action"),
        "detector_used",
    )


def headline(selected: DataFrame) -> DataFrame:
    """One row: how many incidents and which leads the list."""
    top = F.min_by(F.struct("severity", "incident_id"), "position")
    return selected.agg(F.count("*").alias("incidents_generated"), top.alias("_t")).select(
        "incidents_generated",
        F.coalesce("_t.severity", F.lit("NORMAL")).alias("highest_severity"),
        F.col("_t.incident_id").alias("highest_confidence_incident"),
    )


def payload(selected: DataFrame, detector: str, run_timestamp: str) -> DataFrame:
    """The report document as one row; the list holds at most the configured number of incidents."""
    items = F.sort_array(F.collect_list(F.struct("position", F.struct(*[c for c in selected.columns if c != "position"]).alias("i"))))
    listed = selected.agg(F.transform(items, lambda x: x["i"]).alias("incidents"))
    return with_one_row(listed, headline(selected)).select(
        F.lit(run_timestamp).alias("run_timestamp"),
        F.lit(detector).alias("detector_used"),
        "incidents_generated",
        "highest_severity",
        "highest_confidence_incident",
        "incidents",
    )
