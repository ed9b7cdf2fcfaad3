"""Star schema: staging projections, dimensions with dense keys, facts and marts."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from metrivane.config import HIGHER, LABEL_COLUMNS, LOWER
from metrivane.functions.scalars import date_key, day, flag, lookup, ratio, title
from metrivane.operators import anomaly, monitoring, rca
from metrivane.operators.joins import BROADCAST_ROWS
from metrivane.operators.ranking import global_row_number, rank_with_totals, top_n
from metrivane.session import stage


@dataclass(frozen=True)
class DimensionTable:
    column: str  # the panel column
    table: str
    key: str
    member: str


# Table, key and member names of the default dimensions.
DEFAULT_TABLES = (
    DimensionTable("region", "dim_region", "region_key", "region_name"),
    DimensionTable("device_type", "dim_device", "device_key", "device_type"),
    DimensionTable("browser", "dim_browser", "browser_key", "browser_name"),
    DimensionTable("channel", "dim_channel", "channel_key", "channel_name"),
    DimensionTable("business_segment", "dim_business_segment", "business_segment_key", "business_segment_name"),
)


def table_for(column: str) -> DimensionTable:
    named = {t.column: t for t in DEFAULT_TABLES}
    return named.get(column) or DimensionTable(column, f"dim_{column}", f"{column}_key", f"{column}_name")


# ------------------------------------------------------------------ staging (typed projections)

COUNTERS = {"impressions": "bigint", "clicks": "bigint", "conversions": "bigint", "orders": "bigint",
            "revenue": "double", "latency_ms": "double"}
_TEXT = {"monitoring_status", "threshold_direction", "zscore_severity", "residual_severity", "combined_severity",
         "incident_id", "incident_type", "incident_description"}
_FLAGS = {"threshold_breached", "zscore_anomaly", "residual_anomaly", "combined_anomaly", "is_incident"}


def _typed(names) -> dict[str, str]:
    return {n: "string" if n in _TEXT else "boolean" if n in _FLAGS else "double" for n in names}


def _project(df: DataFrame, types: dict[str, str]) -> DataFrame:
    missing = [c for c in types if c not in df.columns]
    if missing:
        raise ValueError(f"Missing columns: {missing}")

    def cast(c, t):
        if t == "boolean":
            return flag(c)
        return day(c) if t == "date" else F.col(c).try_cast(t)

    return df.select(*[cast(c, t).alias(c) for c, t in types.items()])


def stage_daily(df: DataFrame, dims) -> DataFrame:
    """Typed projection of the panel: counters present in it, value, labels."""
    counters = {c: t for c, t in COUNTERS.items() if c in df.columns}
    types = {"date": "date", **{d: "string" for d in dims}, **counters, "kpi_value": "double", **_typed(LABEL_COLUMNS)}
    return _project(anomaly.label_columns(df), types)


def stage_monitoring(df: DataFrame, dims) -> DataFrame:
    return _project(df, {"date": "date", **{d: "string" for d in dims}, **_typed(monitoring.MEASURES)})


def stage_anomalies(df: DataFrame, dims) -> DataFrame:
    types = {"date": "date", **{d: "string" for d in dims}, **_typed(anomaly.MEASURES), **_typed(LABEL_COLUMNS)}
    return _project(df, types)


def stage_rca(df: DataFrame) -> DataFrame:
    types = {c: "string" for c in rca.COLUMNS}
    types.update(analysis_date="date", contribution_rank="int", anomaly_count="int")
    for c in ("actual_value_sum_or_avg", "expected_value_sum_or_avg", "degradation_amount", "contribution_share"):
        types[c] = "double"
    return _project(df, types)


def stage_incidents(history: DataFrame) -> DataFrame:
    """Typed projection with the two renames date -> incident_date, kpi_affected -> kpi_name."""
    text = ["incident_id", "severity", "confidence_label", "top_root_cause", "recommended_action", "detector_used"]
    typed = _project(
        history, {**{c: "string" for c in text}, "date": "date", "kpi_affected": "string", "confidence_score": "double"}
    )
    return typed.withColumnsRenamed({"date": "incident_date", "kpi_affected": "kpi_name"})


# ------------------------------------------------------------------ dimensions

# KPI attributes (family, direction, unit) of the SQL models.
KPI_FAMILY = {
    "conversion_rate": "engagement_metric",
    "click_through_rate": "engagement_metric",
    "average_order_value": "monetization_metric",
    "latency_ms": "performance_metric",
    "revenue_per_session": "monetization_metric",
}
KPI_DIRECTION = {"latency_ms": HIGHER}
KPI_UNIT = {"latency_ms": "milliseconds", "average_order_value": "currency", "revenue_per_session": "currency"}
# The loader's own KPI descriptions (family, direction, unit, description).
KPI_METADATA = {
    "conversion_rate": ("business_metric", LOWER, "ratio", "Conversion rate"),
    "click_through_rate": ("business_metric", LOWER, "ratio", "Click-through rate"),
    "average_order_value": ("business_metric", LOWER, "currency", "Average order value"),
    "latency_ms": ("performance_metric", HIGHER, "milliseconds", "Latency in milliseconds"),
    "revenue_per_session": ("monetization_metric", LOWER, "currency", "Revenue per session"),
}


@dataclass
class Star:
    """Dimension tables with their measured sizes."""

    dims: dict[str, DataFrame]
    sizes: dict[str, int]
    columns: list[str] = field(default_factory=list)
    limit: int = BROADCAST_ROWS

    def lookup(self, column: str, key: str, member: str, table: str, as_column: str) -> DataFrame:
        small = self.dims[table].select(F.col(key), F.col(member).alias(as_column))
        return F.broadcast(small) if self.sizes[table] <= self.limit else small

    def attach(self, df: DataFrame, columns: list[str], how: str = "inner", date: str = "date") -> DataFrame:
        """Replace members by keys.  Dimensions measured as small are broadcast, so the fact is
        not shuffled; a larger one is joined by shuffle.  ``left`` keeps orphans with a NULL key."""
        for c in columns:
            if c == "date":
                side = self.lookup(c, "date_key", "date_value", "dim_date", date)
                df = df.join(side, date, how)
            else:
                t = table_for(c) if c != "kpi_name" else DimensionTable(c, "dim_kpi", "kpi_key", "kpi_name")
                df = df.join(self.lookup(c, t.key, t.member, t.table, c), c, how)
        return df

    def keys(self, columns: list[str]) -> list[str]:
        named = {"date": "date_key", "kpi_name": "kpi_key"}
        return [named.get(c) or table_for(c).key for c in columns]


def members(panel: DataFrame, columns: list[str]) -> DataFrame:
    """Distinct (dimension, member) pairs of all columns in one pass and one shuffle."""
    pairs = [F.struct(F.lit(c).alias("dimension"), F.col(c).cast("string").alias("member")) for c in columns]
    cells = panel.select(F.inline(F.array(*pairs))).where(F.col("member").isNotNull())
    return cells.groupBy("dimension", "member").agg(F.lit(1).alias("_one")).drop("_one")


def keyed(df: DataFrame, order: str, key: str, size: int, limit: int = BROADCAST_ROWS) -> DataFrame:
    """Dense keys 1..n in member order; past ``limit`` members the sort is distributed."""
    if size > limit:
        return global_row_number(df, [order], key).withColumn(key, F.col(key).cast("int"))
    return df.withColumn(key, F.row_number().over(Window.partitionBy(F.lit(1)).orderBy(order)))


def calendar(dates: DataFrame, week_start: str = "sunday") -> DataFrame:
    """Calendar attributes.  ``week_start`` numbers the week days from 0 on that day."""
    d = F.col("date_value")
    number = F.dayofweek(d) - 1 if week_start == "sunday" else F.weekday(d)
    return dates.select(
        date_key(d).alias("date_key"),
        "date_value",
        F.year(d).alias("year"),
        F.quarter(d).alias("quarter"),
        F.month(d).alias("month"),
        F.dayofmonth(d).alias("day"),
        number.alias("day_of_week"),
        F.date_format(d, "EEEE").alias("day_name"),
        F.weekday(d).isin(5, 6).alias("is_weekend"),
    )


def kpi_attributes(kpis: DataFrame, metadata: str = "models") -> DataFrame:
    """``models``: rule-based attributes; ``loader``: the metadata table with its default."""
    if metadata == "models":
        return kpis.select(
            "kpi_key",
            "kpi_name",
            lookup("kpi_name", KPI_FAMILY, "other").alias("kpi_family"),
            lookup("kpi_name", KPI_DIRECTION, LOWER).alias("direction"),
            lookup("kpi_name", KPI_UNIT, "ratio").alias("measure_unit"),
            title("kpi_name").alias("description"),
        )
    columns = ("kpi_family", "direction", "measure_unit", "description")
    defaults = ("business_metric", LOWER, "ratio", None)
    exprs = [
        F.coalesce(lookup("kpi_name", {k: v[i] for k, v in KPI_METADATA.items()}, default), F.col("kpi_name")).alias(c)
        for i, (c, default) in enumerate(zip(columns, defaults))
    ]
    return kpis.select("kpi_key", "kpi_name", *exprs)


def build_dimensions(
    panel: DataFrame,
    dims: list[str],
    week_start: str = "sunday",
    metadata: str = "models",
    limit: int = BROADCAST_ROWS,
) -> Star:
    """All dimension tables from one pass over the panel."""
    columns = ["date", *dims]
    found = stage(members(panel, columns))
    sizes = {r["dimension"]: r["count"] for r in found.groupBy("dimension").count().collect()}  # one row per dimension

    def of(column):
        return found.where(F.col("dimension") == column)

    tables = {"dim_date": calendar(of("date").select(F.col("member").cast("date").alias("date_value")), week_start)}
    counts = {"dim_date": sizes.get("date", 0), "dim_kpi": sizes.get("kpi_name", 0)}
    kpis = of("kpi_name").select(F.col("member").alias("kpi_name"))
    tables["dim_kpi"] = kpi_attributes(keyed(kpis, "kpi_name", "kpi_key", counts["dim_kpi"], limit), metadata)
    for column in dims[1:]:
        t = table_for(column)
        counts[t.table] = sizes.get(column, 0)
        rows = of(column).select(F.col("member").alias(t.member))
        tables[t.table] = keyed(rows, t.member, t.key, counts[t.table], limit).select(t.key, t.member)
    return Star(tables, counts, columns, limit)


# ------------------------------------------------------------------ facts


def _fact(df: DataFrame, star: Star, measures: list[str], how: str) -> DataFrame:
    return star.attach(df, star.columns, how).select(*star.keys(star.columns), *measures)


def fact_kpi_daily(daily: DataFrame, star: Star, how: str = "inner") -> DataFrame:
    measures = [c for c in COUNTERS if c in daily.columns] + ["kpi_value", *LABEL_COLUMNS]
    return _fact(daily, star, measures, how)


def fact_kpi_monitoring(rows: DataFrame, star: Star, how: str = "inner") -> DataFrame:
    return _fact(rows, star, monitoring.MEASURES, how)


def fact_kpi_anomalies(rows: DataFrame, star: Star, how: str = "inner") -> DataFrame:
    return _fact(rows, star, [*anomaly.MEASURES, *LABEL_COLUMNS], how)


def rca_ranked(staged_rca: DataFrame) -> DataFrame:
    """Positive degradations, ranked within (date, KPI, detector, dimension type)."""
    rows = staged_rca.where(F.col("degradation_amount") > 0).drop("contribution_rank")
    group = ["analysis_date", "kpi_name", "detector_used", "dimension_type"]
    ties = [F.desc("degradation_amount"), "dimension_value"]
    ranked = rank_with_totals(rows, group, "contribution_share", ties, "contribution_rank", "_total")
    return ranked.select(*rca.COLUMNS)


def fact_rca_contributions(ranked: DataFrame, star: Star, how: str = "inner") -> DataFrame:
    keyed_rows = star.attach(ranked, ["date", "kpi_name"], how, date="analysis_date")
    return keyed_rows.select(F.col("date_key").alias("analysis_date_key"), "kpi_key", *rca.COLUMNS[2:])


def anomaly_events(staged: DataFrame) -> DataFrame:
    """The anomaly table with the severity and name of the leading detector."""
    severity = (
        F.when(F.col("residual_anomaly"), F.col("residual_severity"))
        .when(F.col("combined_anomaly"), F.col("combined_severity"))
        .otherwise(F.col("monitoring_status"))
    )
    detector = (
        F.when(F.col("residual_anomaly"), "residual_anomaly")
        .when(F.col("combined_anomaly"), "combined_anomaly")
        .when(F.col("zscore_anomaly"), "zscore_anomaly")
        .otherwise("threshold_breached")
    )
    return staged.withColumn("analysis_severity", severity).withColumn("analysis_detector", detector)


def anomaly_counts(events: DataFrame, detector: str = "residual_anomaly") -> DataFrame:
    return events.where(F.col(detector)).groupBy("date", "kpi_name").agg(F.count("*").alias("anomaly_count"))


def incident_enriched(incidents: DataFrame, ranked: DataFrame, counts: DataFrame) -> DataFrame:
    """Incidents with their leading cause and anomaly count; absent ones fall back to the history."""
    key = ["analysis_date", "kpi_name", "detector_used"]
    order = [
        F.desc("contribution_share"),
        F.desc("degradation_amount"),
        F.col("dimension_type"),
    ]
    best = top_n(ranked.where(F.col("contribution_rank") == 1), key, order, 1).select(
        F.col("analysis_date").alias("incident_date"),
        "kpi_name",
        "detector_used",
        F.col("dimension_value").alias("_value"),
        F.col("dimension_type").alias("_type"),
        F.col("contribution_share").alias("_share"),
        F.col("degradation_amount").alias("_amount"),
        F.col("recommended_action").alias("_action"),
    )
    counted = counts.select(F.col("date").alias("incident_date"), "kpi_name", F.col("anomaly_count").alias("_n"))
    joined = incidents.join(best, ["incident_date", "kpi_name", "detector_used"], "left").join(
        counted, ["incident_date", "kpi_name"], "left"
    )
    full = joined.select(
        "incident_id",
        "incident_date",
        "kpi_name",
        "severity",
        "confidence_label",
        "confidence_score",
        "detector_used",
        F.coalesce("_n", F.lit(1)).alias("anomaly_count"),
        F.coalesce("_value", "top_root_cause").alias("top_root_cause"),
        F.coalesce("_type", F.lit("incident_history")).alias("top_dimension_type"),
        F.coalesce("_share", F.lit(0.0)).alias("top_contribution_share"),
        F.coalesce("_action", "recommended_action").alias("recommended_action"),
        F.coalesce("_amount", F.lit(0.0)).alias("_amount"),
    )
    order = [F.desc("top_contribution_share"), F.desc("_amount"), F.col("top_dimension_type")]
    return top_n(full, ["incident_id"], order, 1).drop("_amount")


def with_incident_details(incidents: DataFrame, details: DataFrame) -> DataFrame:
    """Attach (incident_id, anomaly_count, executive_summary); absent ones are 1 and ''."""
    return (
        incidents.drop("anomaly_count", "executive_summary")
        .join(details.select("incident_id", "anomaly_count", "executive_summary"), "incident_id", "left")
        .withColumn("anomaly_count", F.coalesce("anomaly_count", F.lit(1)))
        .withColumn("executive_summary", F.coalesce("executive_summary", F.lit("")))
    )


INCIDENT_MEASURES = [
    "severity",
    "confidence_score",
    "confidence_label",
    "detector_used",
    "anomaly_count",
    "top_root_cause",
    "recommended_action",
]


def fact_incidents(enriched: DataFrame, star: Star, how: str = "inner") -> DataFrame:
    rows = star.attach(enriched, ["date", "kpi_name"], how, date="incident_date")
    extra = ["executive_summary"] if "executive_summary" in enriched.columns else []
    return rows.select(
        "incident_id", F.col("date_key").alias("incident_date_key"), "kpi_key", *INCIDENT_MEASURES, *extra
    )


# ------------------------------------------------------------------ marts


def kpi_health(rows: DataFrame, fill_nulls: bool = False, keys: tuple[str, ...] = ("date", "kpi_name")) -> DataFrame:
    """Row counts by status, mean values and a 0..100 health score per (date, KPI)."""
    status = F.col("monitoring_status")
    grouped = rows.groupBy(*keys).agg(
        F.count("*").alias("monitored_rows"),
        F.count_if(status == "NORMAL").alias("normal_rows"),
        F.count_if(status == "WARNING").alias("warning_rows"),
        F.count_if(status == "CRITICAL").alias("critical_rows"),
        F.count_if(F.col("threshold_breached")).alias("breach_rows"),
        F.avg("actual_value").alias("avg_actual_value"),
        F.avg("expected_value").alias("avg_expected_value"),
        F.avg("percent_variance").alias("avg_percent_variance"),
        F.max(F.abs("percent_variance")).alias("max_abs_percent_variance"),
    )
    penalty = ratio(F.col("warning_rows") * 0.5 + F.col("critical_rows") * 1.5, F.col("monitored_rows"))
    grouped = grouped.withColumn("health_score", F.greatest(F.lit(0.0), F.least(F.lit(100.0), 100 - penalty * 100)))
    if fill_nulls:
        grouped = grouped.fillna(0.0, ["avg_expected_value", "avg_percent_variance", "max_abs_percent_variance"])
    return grouped


def mart_kpi_health(health: DataFrame, star: Star, how: str = "inner") -> DataFrame:
    rows = star.attach(health, ["date", "kpi_name"], how)
    return rows.select("date_key", "kpi_key", *[c for c in health.columns if c not in ("date", "kpi_name")])


def mart_incident_summary(fact: DataFrame) -> DataFrame:
    extra = ["executive_summary"] if "executive_summary" in fact.columns else []
    return fact.select(
        "incident_id",
        "incident_date_key",
        "kpi_key",
        "severity",
        "confidence_label",
        "confidence_score",
        "detector_used",
        "anomaly_count",
        "top_root_cause",
        "recommended_action",
        *extra,
    )


def mart_root_cause_summary(fact: DataFrame, star: Star) -> DataFrame:
    """The leading cause per (date, KPI) with a sentence that names the KPI."""
    order = [
        F.desc("contribution_share"),
        F.desc("degradation_amount"),
        F.col("detector_used"),
        F.col("dimension_type"),
        F.col("dimension_value"),
    ]
    best = top_n(fact, ["analysis_date_key", "kpi_key"], order, 1)
    kpis = star.lookup("kpi_name", "kpi_key", "kpi_name", "dim_kpi", "kpi_name")
    percent = F.round((F.col("contribution_share") * 100).cast("decimal(20,10)"), 1).cast("string")
    sentence = F.concat(
        F.lit("For "), F.col("kpi_name"), F.lit(" on "), F.col("analysis_date_key").cast("string"), F.lit(", "),
        F.col("dimension_value"), F.lit(" contributed "), percent, F.lit("% of measured degradation."),
    )
    kept = ["degradation_amount", "contribution_share", "contribution_rank", "anomaly_count", "severity_max",
            "recommended_action"]
    return best.join(kpis, "kpi_key").select(
        "analysis_date_key", "kpi_key", "detector_used", "dimension_type", "dimension_value", *kept,
        sentence.alias("root_cause_statement"),
    )


def mart_data_quality_summary(checks: DataFrame, report: DataFrame, validated_at: str) -> DataFrame:
    """One row: overall status and the outcome of single checks."""

    def status(name):
        hit = F.max(F.when(F.col("check") == name, F.col("passed")))
        return F.when(F.coalesce(hit, F.lit(False)), "PASS").otherwise("FAIL")

    def count(name):
        return F.coalesce(F.max(F.when(F.col("check") == name, F.col("issue_count"))), F.lit(0))

    rolled = checks.agg(
        status("schema").alias("schema_status"),
        count("nulls").alias("null_issue_count"),
        count("duplicates").alias("duplicate_issue_count"),
        status("freshness").alias("freshness_status"),
        status("completeness").alias("completeness_status"),
        status("volume").alias("volume_status"),
        F.count_if(~F.col("passed")).alias("overall_issue_count"),
    )
    return report.select("status", "health_score").crossJoin(F.broadcast(rolled)).select(
        F.lit(validated_at).alias("run_timestamp"), "status", "health_score", *rolled.columns
    )


def build_warehouse(
    panel: DataFrame,
    monitored: DataFrame,
    anomalies: DataFrame,
    rca_table: DataFrame,
    incident_history: DataFrame,
    dims: list[str],
    checks: DataFrame | None = None,
    report: DataFrame | None = None,
    validated_at: str = "",
    details: DataFrame | None = None,
    how: str = "inner",
    fill_nulls: bool = False,
    week_start: str = "sunday",
    metadata: str = "models",
) -> dict[str, DataFrame]:
    """Every raw, dimension, fact and mart table by name; inputs are stage outputs."""
    dims = list(dims)
    daily, mon = stage_daily(panel, dims), stage_monitoring(monitored, dims)
    events = anomaly_events(stage_anomalies(anomalies, dims))
    ranked, incidents = rca_ranked(stage_rca(rca_table)), stage_incidents(incident_history)
    star = build_dimensions(daily, dims, week_start, metadata)
    enriched = incident_enriched(incidents, ranked, anomaly_counts(events))
    if details is not None:
        enriched = with_incident_details(enriched, details)
    facts = {
        "fact_kpi_daily": fact_kpi_daily(daily, star, how),
        "fact_kpi_monitoring": fact_kpi_monitoring(mon, star, how),
        "fact_kpi_anomalies": fact_kpi_anomalies(events, star, how),
        "fact_rca_contributions": fact_rca_contributions(ranked, star, how),
        "fact_incidents": fact_incidents(enriched, star, how),
    }
    marts = {
        "mart_kpi_health": mart_kpi_health(kpi_health(mon, fill_nulls), star, how),
        "mart_incident_summary": mart_incident_summary(facts["fact_incidents"]),
        "mart_root_cause_summary": mart_root_cause_summary(facts["fact_rca_contributions"], star),
    }
    if checks is not None and report is not None:
        marts["mart_data_quality_summary"] = mart_data_quality_summary(checks, report, validated_at)
    raw = {
        "raw_kpi_daily_metrics": daily,
        "raw_kpi_monitoring": mon,
        "raw_anomaly_results": stage_anomalies(anomalies, dims),
        "raw_rca_contributions": stage_rca(rca_table),
        "raw_incident_history": incidents,
    }
    return {**raw, **star.dims, **facts, **marts}
