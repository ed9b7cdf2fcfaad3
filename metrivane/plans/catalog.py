"""Named queries: each operator applied to whole tables of a data folder.

A query is ``(spark, folder) -> DataFrame``.  Doubles are shown rounded, so that
results can be compared across engines whose sums differ in their last bits.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import replace
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from metrivane.config import DEFAULT_THRESHOLDS, HIGHER, LOWER, Contract, DetectorConfig, RcaConfig, Settings, Threshold
from metrivane.functions.scalars import joined
from metrivane.operators import (
    anomaly,
    assertions,
    evaluation,
    incidents,
    labels,
    medians,
    monitoring,
    quality,
    rca,
    residual,
    windows,
)
from metrivane.operators.joins import with_one_row
from metrivane.plans import reports, warehouse
from metrivane.session import stage
from metrivane.sources import panels, requested, scans, sinks

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

EVENTS = Settings(
    dimensions=panels.EVENT_DIMENSIONS,
    rca=RcaConfig(
        detector="threshold_breached",
        specs=(("tier", ("tier",)), ("band", ("band",)), ("full_segment", ("tier", "band"))),
    ),
)
ORDERS = Settings(
    dimensions=panels.ORDER_DIMENSIONS,
    thresholds={
        "average_order_value": DEFAULT_THRESHOLDS["average_order_value"],
        "finished_rate": Threshold(0.1013, 0.2537, HIGHER),
    },
    rca=RcaConfig(
        detector="threshold_breached",
        specs=panels.ORDER_SPECS,
        interaction_types=("region_segment", "full_segment"),
    ),
)
LINES = Settings(
    dimensions=panels.LINE_DIMENSIONS,
    thresholds={
        # off the grid of the data, whose discounts and quantities are short decimals
        "units_per_line": Threshold(0.1537, 0.3071, LOWER),
        "discount_rate": Threshold(0.2537, 0.5071, HIGHER),
        "price_per_unit": Threshold(0.1013, 0.2029, LOWER),
    },
    rca=RcaConfig(
        detector="threshold_breached",
        specs=panels.LINE_SPECS,
        interaction_types=("region_segment_priority", "full_segment"),
    ),
)
DIMS = {"events": EVENTS.dimensions, "orders": ORDERS.dimensions, "lines": LINES.dimensions}

# Label rules over the events panel (NULL: any member).
RULES = [
    ("INC-CONVERSION-T1-LOW", "conversion_drop", "Conversion rate drop in T1 low.",
     "2024-01-20", "2024-01-24", "conversion_rate", "T1", "low"),
    ("INC-LATENCY-T0", "latency_spike", "Latency spike in T0.",
     "2024-01-15", "2024-01-18", "latency_ms", "T0", None),
    ("INC-LATENCY-T0-HIGH", "latency_spike_high", "Latency spike in T0 high.",
     "2024-01-17", "2024-01-22", "latency_ms", "T0", "high"),
]
RULE_SCHEMA = (
    "incident_id string, incident_type string, incident_description string, "
    "start_date string, end_date string, kpi_name string, tier string, band string"
)

CONTRACT = Contract(
    name="events_panel",
    required=("date", "kpi_name", "tier", "band", "kpi_value", "is_incident"),
    types={"date": "date", "kpi_name": "string", "impressions": "integer", "revenue": "number",
           "latency_ms": "number", "kpi_value": "number"},
    accepted={"tier": ("T0", "T1"), "band": ("low", "mid", "high")},
    non_null=("date", "kpi_name", "latency_ms", "kpi_value"),
    key=("date", "kpi_name", "tier"),
    max_age_days=14,
    min_coverage=0.98,
    min_days=60,
    min_rows=1500,
    min_rows_per_day=45,
    ranges={"impressions": (1, None), "latency_ms": (1, 200), "kpi_value": (0, None)},
)
AS_OF = "2024-02-20"


HALF = 0.4871  # where rounding turns: off the decimal grid, so that no short decimal sits on the edge


def r(column: str, digits: int = 6):
    """Rounded for display with plain double arithmetic, the same in every engine."""
    scale = float(10**digits)
    return (F.floor(F.col(column) * scale + HALF) / scale).alias(column)


def shown(df: DataFrame, digits: int = 6, **special: int) -> DataFrame:
    """Every double column rounded."""
    return df.select(*[r(c, special.get(c, digits)) if t == "double" else F.col(c) for c, t in df.dtypes])


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


# ------------------------------------------------------------------ panels and stage tables


def rules_table(spark: SparkSession) -> DataFrame:
    rules = spark.createDataFrame(RULES, RULE_SCHEMA)
    return rules.withColumns({c: F.col(c).cast("date") for c in ("start_date", "end_date")})


def labelled_events(spark: SparkSession, folder: str) -> DataFrame:
    panel = panels.events_panel(spark, folder, with_counters=True)
    return labels.label_windows(panel, rules_table(spark), list(EVENTS.dimensions))


def monitored_events(spark: SparkSession, folder: str) -> DataFrame:
    return monitoring.monitor(panels.events_panel(spark, folder), EVENTS)


def monitored_orders(spark: SparkSession, folder: str) -> DataFrame:
    return monitoring.monitor(panels.orders_panel(spark, folder), ORDERS)


def monitored_lines(spark: SparkSession, folder: str) -> DataFrame:
    return monitoring.monitor(panels.lineitem_panel(spark, folder), LINES)


def events_rca(spark: SparkSession, folder: str) -> DataFrame:
    return rca.contributions(monitored_events(spark, folder), EVENTS)


def orders_rca(spark: SparkSession, folder: str) -> DataFrame:
    return rca.contributions(monitored_orders(spark, folder), ORDERS)


def events_anomalies(spark: SparkSession, folder: str) -> DataFrame:
    """The anomaly table with a one-feature residual model, which has a closed form."""
    panel = stage(labelled_events(spark, folder))
    scored = anomaly.add_zscore(stage(monitoring.monitor(panel, EVENTS)), EVENTS.dimensions)
    scored = residual.predict_ridge(scored, EVENTS, ("moving_baseline",), ())
    scored = anomaly.add_combined(anomaly.add_residual_flags(scored, EVENTS))
    return anomaly.anomaly_table(scored, panel, EVENTS.dimensions)


def events_context(spark: SparkSession, folder: str, monitored: DataFrame, panel: DataFrame) -> DataFrame:
    """Incident context measured on the panel: F1 of the threshold detector, quality, counts."""
    flagged = anomaly.join_labels(monitored, panel, EVENTS.dimensions)
    scored = evaluation.evaluate(flagged, {"threshold_breached": "threshold_breached"})
    report = quality.report(quality.run_checks(panel, CONTRACT, AS_OF))
    counts = monitoring.summary(monitored)
    one = evaluation.best_detector(scored).select(
        F.col("detector").alias("best_detector"),
        F.col("f1_score").alias("best_detector_f1_score"),
        F.lit("ridge").alias("residual_model_used"),
    )
    two = report.select(F.col("status").alias("quality_status"), F.col("health_score").cast("double"))
    return one.crossJoin(F.broadcast(two)).crossJoin(
        F.broadcast(counts.select("warning_count", "critical_count"))
    )


def events_incidents(spark: SparkSession, folder: str) -> DataFrame:
    panel = stage(labelled_events(spark, folder))
    monitored = stage(monitoring.monitor(panel, EVENTS))
    table = rca.contributions(monitored, EVENTS)
    ctx = events_context(spark, folder, monitored, panel)
    settings = replace(EVENTS, incident=replace(EVENTS.incident, interaction_types=("full_segment",)))
    return incidents.build(monitored, table, ctx, settings, "threshold_breached")


def selected_incidents(spark: SparkSession, folder: str) -> DataFrame:
    return incidents.select_incidents(stage(events_incidents(spark, folder)), EVENTS.incident.max_incidents)


@query
def kpi_panel_events(spark, folder):
    return shown(panels.events_panel(spark, folder))


@query
def kpi_panel_orders(spark, folder):
    return shown(panels.orders_panel(spark, folder), 4)


@query
def kpi_panel_lineitem(spark, folder):
    return shown(panels.lineitem_panel(spark, folder), 6, quantity=2, gross=2, discounted=2, taxed=2)


@query
def labelled_panel(spark, folder):
    return shown(labelled_events(spark, folder).select("date", *EVENTS.dimensions, "kpi_value", *anomaly.LABEL_COLUMNS))


def payload_item():
    """An event as an item of a payload document."""
    return F.struct(
        F.concat(F.lit("p"), (F.col("user_id") % 6).cast("string")).alias("project"),
        F.col("event_type").alias("access"),
        F.lit("user").alias("agent"),
        F.lit("daily").alias("granularity"),
        F.concat(F.date_format("ts", "yyyyMMdd"), F.lit("00")).alias("timestamp"),
        F.col("value").alias("views"),
    )


@query
def payload_flatten(spark, folder):
    """Nested documents, one item each, flattened to panel rows."""
    events = panels.read_table(spark, folder, "events")
    return shown(scans.flatten_payloads(events.select(F.array(payload_item()).alias("items"))))


# What a series source is asked for: one project that never comes, one agent.
REQUESTED = {
    "project": [f"p{i}" for i in range(7)],
    "access": ["view", "click", "signup", "purchase", "error"],
    "agent": ["user"],
}


def event_documents(spark, folder) -> DataFrame:
    """A payload document per event as text; every 7th is cut off, every 11th has no items."""
    events = panels.read_table(spark, folder, "events")
    whole = F.to_json(F.struct(F.array(payload_item()).alias("items")))
    text = F.when(F.col("event_id") % 7 == 0, F.substring(whole, 1, 40)).when(F.col("event_id") % 11 == 0, F.lit('{"items": []}'))
    return events.select("event_id", F.col("event_type").alias("access"), F.coalesce(text, whole).alias("document"))


@query
def payload_failures(spark, folder):
    """Broken and empty documents by name and reason, and how many items the others gave."""
    parsed = scans.parse_payloads(event_documents(spark, folder), "document")
    failed = scans.failed_payloads(parsed, ["event_id", "access"])
    return failed.select("event_id", "access", "error")


def requested_rows(spark, folder) -> tuple[DataFrame, DataFrame]:
    """(requested series, rows that came from the readable documents)."""
    parsed = scans.parse_payloads(event_documents(spark, folder), "document")
    return requested.requested_series(spark, REQUESTED), scans.flatten_payloads(parsed)


@query
def series_ledger(spark, folder):
    """What came of each requested series; the series of one project never do."""
    asked, rows = requested_rows(spark, folder)
    return requested.ledger(asked, rows)


@query
def requested_coverage(spark, folder):
    """One row per (series, day) came at most; a lost series lowers the share."""
    asked, rows = requested_rows(spark, folder)
    cells = rows.groupBy("date", *REQUESTED).agg(F.sum("kpi_value").alias("kpi_value"))
    return shown(requested.requested_coverage(requested.ledger(asked, cells), cells), 2)


@query
def requested_missing_cells(spark, folder):
    asked, rows = requested_rows(spark, folder)
    return requested.missing_cells(asked, rows, "2024-01-10", "2024-01-20")


CELLS = Contract(
    types={"shipped": "date", "quantity": "integer", "price": "number", "returned": "boolean", "mode": "string"},
    column_order=("shipped", "quantity", "price", "returned", "mode"),
)


@query
def typed_cells(spark, folder):
    """Text cells, some of them broken, typed by a contract."""
    lines = panels.read_table(spark, folder, "lineitem")
    n = F.col("l_orderkey") + F.col("l_linenumber")
    text = lines.select(
        "l_orderkey",
        "l_linenumber",
        F.when(n % 5 == 0, "n/a").when(n % 7 == 0, "").otherwise(F.date_format("l_shipdate", "yyyy-MM-dd")).alias("shipped"),
        F.when(n % 3 == 0, "12x").when(n % 4 == 0, "2.5").otherwise(F.col("l_quantity").cast("int").cast("string")).alias("quantity"),
        F.when(n % 6 == 0, "NaN").when(n % 8 == 0, "").otherwise(F.col("l_extendedprice").cast("decimal(18,2)").cast("string")).alias("price"),
        F.when(n % 9 == 0, "yes").when(F.col("l_returnflag") == "R", "True").when(n % 2 == 0, "1").otherwise("false").alias("returned"),
        F.col("l_linestatus").alias("mode"),
    )
    return shown(scans.typed(text, CELLS), 6, price=2)


@query
def lookback_rows(spark, folder):
    return shown(reports.lookback(panels.events_panel(spark, folder), "2024-01-28", 10))


@query
def report_window_rows(spark, folder):
    return shown(reports.report_window(panels.orders_panel(spark, folder), 365), 4)


@query
def panel_slice(spark, folder):
    members = {"region": ["ASIA", "EUROPE"], "segment": [], "priority": ["1-URGENT"]}
    rows = reports.slice_panel(
        panels.orders_panel(spark, folder), "average_order_value", "1996-01-01", "1998-12-31", members
    )
    return shown(rows, 4)


@query
def concatenated_panels(spark, folder):
    """Two series sources as one panel."""
    events = panels.events_panel(spark, folder).select("date", "kpi_name", "kpi_value")
    orders = panels.orders_panel(spark, folder).select("date", "kpi_name", "kpi_value")
    return shown(scans.concatenate([events, orders]), 4)


# ------------------------------------------------------------------ monitoring


@query
def rolling_means(spark, folder):
    columns = ["rolling_avg_7d", "rolling_avg_14d", "rolling_avg_28d"]
    return shown(monitored_events(spark, folder).select("date", *EVENTS.dimensions, *columns))


@query
def lagged_baseline(spark, folder):
    columns = ["actual_value", "moving_baseline", "absolute_variance", "percent_variance"]
    rows = monitored_orders(spark, folder).select("date", *ORDERS.dimensions, *columns)
    return shown(rows, 3, percent_variance=6)


@query
def monitoring_table_events(spark, folder):
    return shown(monitored_events(spark, folder))


@query
def monitoring_table_blocked(spark, folder):
    """The same table from calendar blocks of five days instead of whole series."""
    return shown(monitoring.monitor(panels.events_panel(spark, folder), replace(EVENTS, block_days=5)))


@query
def monitoring_table_lineitem(spark, folder):
    columns = ["moving_baseline", "percent_variance", "threshold_value", "threshold_breached", "monitoring_status"]
    return shown(monitored_lines(spark, folder).select("date", *LINES.dimensions, *columns), 6, moving_baseline=5)


@query
def monitoring_status_fallback(spark, folder):
    """Thresholds with fallback: one KPI is not configured, one is bad when higher."""
    columns = ["threshold_value", "threshold_direction", "threshold_breached", "monitoring_status"]
    return monitored_orders(spark, folder).select("date", *ORDERS.dimensions, *columns)


@query
def monitoring_summary(spark, folder):
    return monitoring.summary(monitored_orders(spark, folder))


@query
def breaches_by_kpi(spark, folder):
    return monitoring.breaches_by_kpi(monitored_orders(spark, folder))


@query
def worst_variances(spark, folder):
    return shown(monitoring.worst_variances(monitored_orders(spark, folder), ORDERS.dimensions), 3, percent_variance=6)


@query
def kpi_health_by_day(spark, folder):
    return shown(warehouse.kpi_health(monitored_events(spark, folder)))


@query
def kpi_health_filled(spark, folder):
    return shown(warehouse.kpi_health(monitored_events(spark, folder), fill_nulls=True))


@query
def kpi_health_lineitem(spark, folder):
    return shown(warehouse.kpi_health(monitored_lines(spark, folder)), 5)


# ------------------------------------------------------------------ detection


@query
def zscore_events(spark, folder):
    rows = anomaly.add_zscore(monitored_events(spark, folder), EVENTS.dimensions)
    return shown(rows.select("date", *EVENTS.dimensions, "z_score", "zscore_severity", "zscore_anomaly"))


@query
def zscore_blocked(spark, folder):
    rows = anomaly.add_zscore(monitored_events(spark, folder), EVENTS.dimensions, block_days=6)
    return shown(rows.select("date", *EVENTS.dimensions, "z_score", "zscore_severity", "zscore_anomaly"))


@query
def zscore_lineitem(spark, folder):
    """Z-scores of every line series."""
    rows = anomaly.add_zscore(monitored_lines(spark, folder), LINES.dimensions)
    return shown(rows.select("date", *LINES.dimensions, "z_score", "zscore_severity", "zscore_anomaly"))


def wide_events(spark, folder) -> DataFrame:
    counters = panels.event_counters(panels.read_table(spark, folder, "events"))
    return counters.withColumn("conversion_rate", F.coalesce(F.try_divide("conversions", "clicks"), F.lit(0.0)))


WIDE_SERIES = ("tier", "band")


def wide_scored(spark, folder) -> DataFrame:
    return anomaly.detect_wide(wide_events(spark, folder), "conversion_rate", 7, 2.0, WIDE_SERIES)


@query
def wide_detector(spark, folder):
    columns = ["conversion_rate", "rolling_mean", "rolling_std", "conversion_rate_zscore", "conversion_rate_anomaly"]
    return shown(wide_scored(spark, folder).select("date", *WIDE_SERIES, *columns))


@query
def wide_worst(spark, folder):
    worst = anomaly.worst_wide(wide_scored(spark, folder), "conversion_rate", WIDE_SERIES)
    return worst


@query
def metric_digest(spark, folder):
    """One formatted row per metric of the wide table: its worst anomaly and a hint."""
    wide = wide_events(spark, folder)
    parts = []
    for metric in ("conversion_rate", "latency_ms", "revenue"):
        scored = anomaly.detect_wide(wide, metric, 7, 2.0, WIDE_SERIES)
        worst = anomaly.worst_wide(scored, metric, WIDE_SERIES)
        named = worst.select(
            "date", F.col("tier").alias("device_type"), F.col("band").alias("region"), F.lit("any").alias("browser"),
            "z_score", "actual_value", "rolling_mean",
        )
        parts.append(reports.metric_digest(named, metric))
    return scans.concatenate(parts)


@query
def train_split_date(spark, folder):
    return residual.split_date(panels.orders_panel(spark, folder), 0.70)


def baselines(monitored: DataFrame) -> DataFrame:
    return monitored.select("kpi_name", "moving_baseline")


@query
def baseline_median(spark, folder):
    return shown(medians.exact_median(stage(baselines(monitored_lines(spark, folder))), ["kpi_name"], "moving_baseline"))


@query
def baseline_median_overall(spark, folder):
    return shown(medians.exact_median(stage(baselines(monitored_orders(spark, folder))), [], "moving_baseline"), 3)


@query
def model_features(spark, folder):
    """Numeric features and the one-hot part of the feature frame."""
    rows = stage(monitored_events(spark, folder))
    f = residual.describe_features(rows, EVENTS)
    members = [F.array_sort(F.collect_set(d)).alias(f"_{d}") for d in f.dims]  # three of each

    def bit(dim):
        return F.transform(f"_{dim}", lambda m: (F.col(dim) == m).cast("int").cast("string"))

    numeric = [e.alias(f"feature_{n}") for n, e in residual.numeric_columns(f).items()]
    one_hot = F.array_join(F.concat(*[bit(d) for d in f.dims]), "").alias("one_hot")
    return shown(with_one_row(rows, rows.agg(*members)).select("date", *EVENTS.dimensions, *numeric, one_hot))


def univariate(spark, folder, settings=EVENTS) -> DataFrame:
    rows = anomaly.add_zscore(stage(monitored_events(spark, folder)), settings.dimensions)
    rows = residual.predict_ridge(rows, settings, ("moving_baseline",), ())
    return anomaly.add_residual_flags(rows, settings)


RESIDUAL = ["predicted_value", "residual", "residual_percent", "residual_anomaly", "residual_severity"]


@query
def residual_ridge_univariate(spark, folder):
    return shown(univariate(spark, folder).select("date", *EVENTS.dimensions, *RESIDUAL))


@query
def residual_ridge_per_series(spark, folder):
    """One model per series, with the baseline for series that have too little history."""
    settings = replace(ORDERS, detector=DetectorConfig(group_columns=ORDERS.dimensions, min_train_rows=50))
    rows = residual.predict_ridge(stage(monitored_orders(spark, folder)), settings, ("moving_baseline",), ())
    return shown(rows.select("date", *ORDERS.dimensions, "predicted_value"), 3)


@query
def residual_robust_mad(spark, folder):
    settings = replace(EVENTS, detector=replace(EVENTS.detector, residual_mode="robust_mad"))
    columns = ["residual", "residual_modified_zscore", "residual_anomaly", "residual_severity"]
    return shown(univariate(spark, folder, settings).select("date", *EVENTS.dimensions, *columns))


@query
def residual_ridge_full(spark, folder):
    """Baseline, calendar and one-hot features, one model per KPI."""
    rows = stage(monitored_lines(spark, folder))
    rows = anomaly.add_residual_flags(residual.predict(rows, LINES), LINES)
    return shown(rows.select("date", *LINES.dimensions, *RESIDUAL))


@query
def residual_boosted_stump(spark, folder):
    """One round of one split on all rows and features: what every later round repeats."""
    settings = replace(EVENTS, detector=replace(EVENTS.detector, model="gbt", trees=1, depth=1, learning_rate=0.5, subsample=1.0, colsample=1.0))
    rows = residual.predict(stage(monitored_events(spark, folder)), settings)
    return shown(rows.select("date", *EVENTS.dimensions, "actual_value", "predicted_value"))


@query
def residual_boosted_trees(spark, folder):
    settings = replace(EVENTS, detector=replace(EVENTS.detector, model="gbt"))
    rows = residual.predict(stage(monitored_events(spark, folder)), settings)
    return shown(rows.select("date", *EVENTS.dimensions, "actual_value", "predicted_value"))


@query
def combined_detector(spark, folder):
    rows = anomaly.add_combined(univariate(spark, folder))
    return rows.select("date", *EVENTS.dimensions, "zscore_severity", "residual_severity", "combined_anomaly",
                       "combined_severity")


@query
def anomaly_results(spark, folder):
    return shown(events_anomalies(spark, folder))


LINES_RESIDUAL = replace(LINES, rca=replace(LINES.rca, detector="residual_anomaly"))


def detected_lines(spark, folder) -> DataFrame:
    """The default detection chain: z-score, full residual model, combination; a source without labels."""
    panel = panels.lineitem_panel(spark, folder).select("date", *LINES.dimensions, "kpi_value")
    return anomaly.detect(stage(monitoring.monitor(panel, LINES)), panel, LINES)


@query
def detected_lineitem(spark, folder):
    return shown(detected_lines(spark, folder))


@query
def residual_anomaly_counts(spark, folder):
    """Residual flags by date and KPI, which incidents without an own count fall back to."""
    return warehouse.anomaly_counts(detected_lines(spark, folder))


@query
def rca_contributions_residual(spark, folder):
    """Causes of the residual model's anomalies, ranked by exact sums."""
    return shown(rca.contributions(detected_lines(spark, folder), LINES_RESIDUAL), 4, contribution_share=5)


@query
def rca_top_causes_residual(spark, folder):
    causes = rca.top_causes(stage(rca.contributions(detected_lines(spark, folder), LINES_RESIDUAL)), LINES_RESIDUAL)
    return shown(causes.drop("root_cause_statement"), 4, contribution_share=5)


@query
def anomaly_results_unlabelled(spark, folder):
    """A source without labels: the label columns are false and ''."""
    rows = anomaly.add_zscore(monitored_orders(spark, folder), ORDERS.dimensions)
    rows = anomaly.join_labels(rows, panels.orders_panel(spark, folder), ORDERS.dimensions)
    return shown(rows.select("date", *ORDERS.dimensions, "z_score", "zscore_severity", *anomaly.LABEL_COLUMNS))


# ------------------------------------------------------------------ evaluation


@query
def detector_evaluation(spark, folder):
    return evaluation.evaluate(events_anomalies(spark, folder))


@query
def best_detector(spark, folder):
    return evaluation.best_detector(evaluation.evaluate(events_anomalies(spark, folder)))


@query
def document_label_evaluation(spark, folder):
    """Text-length rules scored against the quality labels of documents."""
    documents = panels.read_table(spark, folder, "documents").select("doc_id", "n_chars")
    labelled = panels.read_table(spark, folder, "labels")
    rows = labelled.join(documents, "doc_id").select(
        (F.col("quality") == 1).alias("is_incident"),
        (F.col("n_chars") >= 500).alias("long_text"),
        (F.col("n_chars") >= 2000).alias("very_long_text"),
    )
    return evaluation.evaluate(rows, {"long_text": "long_text", "very_long_text": "very_long_text"})


# ------------------------------------------------------------------ root causes


@query
def rca_candidates(spark, folder):
    rows = rca.with_degradation(rca.candidates(monitored_orders(spark, folder), "threshold_breached"), ORDERS)
    return shown(rows.select("date", *ORDERS.dimensions, "degradation_amount", "monitoring_status"), 3)


@query
def rca_candidate_summary(spark, folder):
    return rca.candidate_summary(monitored_orders(spark, folder), ORDERS)


@query
def rca_candidate_count(spark, folder):
    return rca.candidate_count(monitored_orders(spark, folder), ORDERS)


@query
def rca_contributions(spark, folder):
    return shown(events_rca(spark, folder))


@query
def rca_contributions_orders(spark, folder):
    table = orders_rca(spark, folder)
    return shown(table, 2, contribution_share=6)


@query
def rca_contributions_lineitem(spark, folder):
    table = rca.contributions(monitored_lines(spark, folder), LINES)
    return shown(table, 4, contribution_share=5)


@query
def rca_statements(spark, folder):
    table = rca.add_statement(events_rca(spark, folder), EVENTS)
    return table.select("analysis_date", "kpi_name", "dimension_type", "dimension_value", "root_cause_statement")


TOP = ["analysis_date", "kpi_name", "dimension_type", "dimension_value", "degradation_amount", "contribution_share"]


@query
def rca_overall_top(spark, folder):
    return shown(rca.overall_top(orders_rca(spark, folder), ORDERS.rca).select(*TOP), 3, contribution_share=6)


@query
def rca_top_by_kpi(spark, folder):
    return shown(rca.top_by_kpi(orders_rca(spark, folder), ORDERS.rca).select(*TOP), 3, contribution_share=6)


@query
def rca_top_by_dimension(spark, folder):
    return shown(rca.top_by_dimension(orders_rca(spark, folder)).select(*TOP), 3, contribution_share=6)


@query
def rca_top_contributors_by_kpi(spark, folder):
    rows = rca.top_contributors(orders_rca(spark, folder), "kpi_name", 10)
    return shown(rows.select(*TOP, "position"), 3, contribution_share=6)


@query
def rca_top_contributors_by_dimension(spark, folder):
    rows = rca.top_contributors(orders_rca(spark, folder), "dimension_type", 10)
    return shown(rows.select(*TOP, "position"), 3, contribution_share=6)


@query
def rca_top_causes(spark, folder):
    rows = rca.top_causes(stage(orders_rca(spark, folder)), ORDERS)
    return shown(rows.select(*TOP, "position", "root_cause_statement"), 3, contribution_share=6)


@query
def rca_action_examples(spark, folder):
    return rca.action_examples(rca.top_causes(stage(orders_rca(spark, folder)), ORDERS))


@query
def rca_slice(spark, folder):
    rows = reports.slice_rca(
        orders_rca(spark, folder), "average_order_value", "1998-03-01", "full_segment", "threshold_breached", 20
    )
    return shown(rows, 3, contribution_share=6)


# ------------------------------------------------------------------ incidents


@query
def incident_aggregates(spark, folder):
    rows = incidents.aggregates(monitored_events(spark, folder), "threshold_breached")
    return shown(
        rows.select("date", "kpi_name", F.col("_actual").alias("mean_actual"), F.col("_expected").alias("mean_expected"),
                    F.col("_variance").alias("mean_variance"), "anomaly_count", F.col("_worst").alias("worst_variance"),
                    F.col("_severity").alias("severity_rank"))
    )


@query
def incident_causes(spark, folder):
    cfg = replace(EVENTS.incident, interaction_types=("full_segment",))
    rows = incidents.top_causes(events_rca(spark, folder), cfg, "threshold_breached")
    flat = rows.select("analysis_date", "kpi_name", F.posexplode("top_root_causes").alias("at", "cause"))
    return shown(flat.select("analysis_date", "kpi_name", "at", "cause.*"))


@query
def incident_records(spark, folder):
    rows = events_incidents(spark, folder)
    flat = rows.select(
        "incident_id", "incident_date", "kpi_affected", "severity", "confidence_score", "confidence_label",
        "detector_used", "actual_value_summary", "expected_value_summary", "percent_variance_summary", "anomaly_count",
        F.array_join("suspected_dimensions", " / ").alias("suspected_dimensions"),
        F.array_join("recommended_actions", " ").alias("recommended_actions"),
        "executive_summary",
        F.col("supporting_metrics.max_abs_percent_variance").alias("max_abs_percent_variance"),
        F.col("supporting_metrics.max_detector_severity").alias("max_detector_severity"),
        F.col("supporting_metrics.top_root_cause").alias("top_root_cause"),
        F.col("supporting_metrics.monitoring_critical_count").alias("monitoring_critical_count"),
        F.col("data_quality_context.status").alias("quality_status"),
        F.col("data_quality_context.health_score").alias("health_score"),
        F.col("model_context.best_detector_f1_score").alias("best_detector_f1_score"),
    )
    return shown(flat)


@query
def incident_selection(spark, folder):
    rows = selected_incidents(spark, folder)
    return rows.select("position", "incident_id", "severity", r("confidence_score", 3), "anomaly_count")


@query
def incident_history(spark, folder):
    return shown(incidents.history(selected_incidents(spark, folder)), 3)


@query
def incident_headline(spark, folder):
    return incidents.headline(selected_incidents(spark, folder))


@query
def incident_document(spark, folder):
    """The report document as one row of JSON."""
    document = incidents.payload(selected_incidents(spark, folder), "threshold_breached", AS_OF)
    return document.select("run_timestamp", "incidents_generated", F.to_json("incidents").alias("incidents"))


@query
def incident_slice(spark, folder):
    history = incidents.history(selected_incidents(spark, folder))
    return shown(reports.slice_incidents(history, ["CRITICAL"], ["Low", "Medium"]), 3)


# ------------------------------------------------------------------ quality


@query
def quality_checks(spark, folder):
    checks = quality.run_checks(stage(labelled_events(spark, folder)), CONTRACT, AS_OF)
    return shown(checks.select("check", "passed", "score", "weight", "issue_count", "summary"))


@query
def quality_failures(spark, folder):
    """Failing cells per check and column."""
    checks = quality.run_checks(stage(labelled_events(spark, folder)), CONTRACT, AS_OF)
    return checks.select("check", F.explode("failures").alias("column", "failing"))


@query
def quality_report(spark, folder):
    report = quality.report(quality.run_checks(stage(labelled_events(spark, folder)), CONTRACT, AS_OF))
    return report.withColumn("issues", F.array_join("issues", "; "))


@query
def quality_gate(spark, folder):
    gated = quality.gate(panels.events_panel(spark, folder, with_counters=True), 10, 0.01)
    return shown(gated.withColumn("issues", F.array_join("issues", "; ")), 4)


@query
def offending_values(spark, folder):
    contract = Contract(accepted={"lang": ("en", "fr"), "source": ("src0", "src1", "src2")})
    return quality.offending_values(panels.read_table(spark, folder, "documents").select("lang", "source"), contract)


@query
def duplicate_keys(spark, folder):
    lines = panels.read_table(spark, folder, "lineitem")
    return quality.duplicate_groups(lines, ["l_orderkey", "l_linenumber"])


@query
def duplicate_key_sample(spark, folder):
    lines = panels.read_table(spark, folder, "lineitem")
    return quality.duplicate_sample(lines, ["l_orderkey", "l_linenumber"])


@query
def coverage_quality(spark, folder):
    panel = panels.lineitem_panel(spark, folder)
    return shown(quality.coverage(panel, list(LINES.dimensions), 5 * 5 * 5 * 3 * 2 * 3), 2)


@query
def table_assertions(spark, folder):
    """Every kind of assertion over stored and derived tables."""
    lines, orders = (panels.read_table(spark, folder, n) for n in ("lineitem", "orders"))
    customer, labelled = (panels.read_table(spark, folder, n) for n in ("customer", "labels"))
    documents = panels.read_table(spark, folder, "documents")
    table = events_rca(spark, folder)
    return assertions.run(
        [
            ("orders.o_orderkey unique", assertions.unique(orders, "o_orderkey")),
            ("lineitem.l_orderkey not_null", assertions.not_null(lines, "l_orderkey")),
            ("lineitem.l_returnflag accepted", assertions.accepted_values(lines, "l_returnflag", ["A", "N"])),
            ("lineitem key unique", assertions.unique_combination(lines, ["l_orderkey", "l_linenumber"])),
            ("lineitem.l_discount bounds", assertions.bounds(lines, "l_discount", 0.0, 0.05)),
            ("lineitem.l_orderkey relationship", assertions.relationship(lines, "l_orderkey", orders, "o_orderkey")),
            ("orders.o_custkey relationship", assertions.relationship(orders, "o_custkey", customer, "c_custkey")),
            ("documents.doc_id labelled", assertions.relationship(documents, "doc_id", labelled, "doc_id")),
            ("rca.contribution_share bounds", assertions.bounds(table, "contribution_share")),
            ("rca key unique", assertions.unique_combination(
                table, ["analysis_date", "kpi_name", "detector_used", "dimension_type", "dimension_value"])),
        ]
    )


# ------------------------------------------------------------------ warehouse


def orders_star(spark, folder, **options) -> warehouse.Star:
    return warehouse.build_dimensions(panels.orders_panel(spark, folder), list(ORDERS.dimensions), **options)


def events_star(spark, folder, **options) -> warehouse.Star:
    return warehouse.build_dimensions(panels.events_panel(spark, folder), list(EVENTS.dimensions), **options)


class EventTables(Mapping):
    """The star schema over the events panel; a table is built when it is asked for."""

    def __init__(self, spark, folder):
        self.spark, self.folder = spark, folder

    @cached_property
    def panel(self):
        return stage(labelled_events(self.spark, self.folder))

    @cached_property
    def monitored(self):
        return stage(monitoring.monitor(self.panel, EVENTS))

    @cached_property
    def anomalies(self):
        scored = anomaly.add_zscore(self.monitored, EVENTS.dimensions)
        scored = residual.predict_ridge(scored, EVENTS, ("moving_baseline",), ())
        scored = anomaly.add_combined(anomaly.add_residual_flags(scored, EVENTS))
        return stage(anomaly.anomaly_table(scored, self.panel, EVENTS.dimensions))

    @cached_property
    def ranked(self):
        return warehouse.rca_ranked(warehouse.stage_rca(rca.contributions(self.monitored, EVENTS)))

    @cached_property
    def checks(self):
        return stage(quality.run_checks(self.panel, CONTRACT, AS_OF))

    @cached_property
    def star(self):
        return warehouse.build_dimensions(self.panel, list(EVENTS.dimensions))

    @cached_property
    def incidents(self):
        history = incidents.history(selected_incidents(self.spark, self.folder))
        return stage(warehouse.stage_incidents(history))

    @cached_property
    def events(self):
        return warehouse.anomaly_events(warehouse.stage_anomalies(self.anomalies, EVENTS.dimensions))

    @cached_property
    def enriched(self):
        return warehouse.incident_enriched(self.incidents, self.ranked, warehouse.anomaly_counts(self.events))

    @cached_property
    def builders(self):
        dims = list(EVENTS.dimensions)
        w = warehouse

        def health():
            return w.kpi_health(w.stage_monitoring(self.monitored, dims))

        return {
            "raw_kpi_daily_metrics": lambda: w.stage_daily(self.panel, dims),
            "raw_kpi_monitoring": lambda: w.stage_monitoring(self.monitored, dims),
            "raw_anomaly_results": lambda: w.stage_anomalies(self.anomalies, dims),
            "raw_rca_contributions": lambda: self.ranked,
            "raw_incident_history": lambda: self.incidents,
            "dim_date": lambda: self.star.dims["dim_date"],
            "dim_kpi": lambda: self.star.dims["dim_kpi"],
            "dim_tier": lambda: self.star.dims["dim_tier"],
            "dim_band": lambda: self.star.dims["dim_band"],
            "fact_kpi_daily": lambda: w.fact_kpi_daily(self["raw_kpi_daily_metrics"], self.star),
            "fact_kpi_monitoring": lambda: w.fact_kpi_monitoring(self["raw_kpi_monitoring"], self.star),
            "fact_kpi_anomalies": lambda: w.fact_kpi_anomalies(self.events, self.star),
            "fact_rca_contributions": lambda: w.fact_rca_contributions(self.ranked, self.star),
            "fact_incidents": lambda: w.fact_incidents(self.enriched, self.star),
            "mart_kpi_health": lambda: w.mart_kpi_health(health(), self.star),
            "mart_incident_summary": lambda: w.mart_incident_summary(self["fact_incidents"]),
            "mart_root_cause_summary": lambda: w.mart_root_cause_summary(self["fact_rca_contributions"], self.star),
            "mart_data_quality_summary": lambda: w.mart_data_quality_summary(
                self.checks, quality.report(self.checks), AS_OF
            ),
        }

    def __getitem__(self, name):
        return self.builders[name]()

    def __iter__(self):
        return iter(self.builders)

    def __len__(self):
        return len(self.builders)


def events_tables(spark, folder) -> EventTables:
    return EventTables(spark, folder)


@query
def dim_date(spark, folder):
    return orders_star(spark, folder).dims["dim_date"]


@query
def dim_date_monday_first(spark, folder):
    return orders_star(spark, folder, week_start="monday").dims["dim_date"]


@query
def dim_kpi(spark, folder):
    return events_star(spark, folder).dims["dim_kpi"]


@query
def dim_kpi_metadata(spark, folder):
    return orders_star(spark, folder, metadata="loader").dims["dim_kpi"]


@query
def dim_members(spark, folder):
    """The small dimensions, one below the other."""
    star = orders_star(spark, folder)
    parts = []
    for column in ORDERS.dimensions[1:]:
        t = warehouse.table_for(column)
        parts.append(star.dims[t.table].select(F.lit(column).alias("dimension"), F.col(t.key).alias("key"), F.col(t.member).alias("member")))
    return scans.concatenate(parts)


@query
def dim_customer_keys(spark, folder):
    """Dense keys of a dimension that is too large for one task: a distributed sort."""
    customers = panels.read_table(spark, folder, "customer").select(F.col("c_name").alias("member"))
    return warehouse.keyed(customers.distinct(), "member", "customer_key", size=1, limit=0)


@query
def staged_daily(spark, folder):
    return shown(warehouse.stage_daily(labelled_events(spark, folder), EVENTS.dimensions))


@query
def staged_monitoring(spark, folder):
    return shown(warehouse.stage_monitoring(monitored_events(spark, folder), EVENTS.dimensions))


@query
def staged_anomalies(spark, folder):
    return shown(warehouse.stage_anomalies(events_anomalies(spark, folder), EVENTS.dimensions))


@query
def staged_rca(spark, folder):
    return shown(warehouse.stage_rca(events_rca(spark, folder)))


@query
def staged_incidents(spark, folder):
    return shown(warehouse.stage_incidents(incidents.history(selected_incidents(spark, folder))), 3)


@query
def rca_ranked_by_detector(spark, folder):
    return shown(warehouse.rca_ranked(warehouse.stage_rca(events_rca(spark, folder))))


@query
def anomaly_events(spark, folder):
    rows = warehouse.anomaly_events(warehouse.stage_anomalies(events_anomalies(spark, folder), EVENTS.dimensions))
    return rows.select("date", *EVENTS.dimensions, "analysis_severity", "analysis_detector")


@query
def anomaly_counts(spark, folder):
    return warehouse.anomaly_counts(events_anomalies(spark, folder), "combined_anomaly")


@query
def fact_kpi_daily(spark, folder):
    return shown(events_tables(spark, folder)["fact_kpi_daily"])


@query
def fact_kpi_monitoring(spark, folder):
    star = orders_star(spark, folder)
    rows = warehouse.stage_monitoring(monitored_orders(spark, folder), ORDERS.dimensions)
    fact = warehouse.fact_kpi_monitoring(rows, star)
    kept = ["actual_value", "moving_baseline", "percent_variance", "threshold_breached", "monitoring_status"]
    return shown(fact.select(*star.keys(star.columns), *kept), 3, percent_variance=6)


@query
def fact_kpi_anomalies(spark, folder):
    return shown(events_tables(spark, folder)["fact_kpi_anomalies"])


@query
def fact_rca_contributions(spark, folder):
    return shown(events_tables(spark, folder)["fact_rca_contributions"])


@query
def fact_incidents(spark, folder):
    return shown(events_tables(spark, folder)["fact_incidents"], 3)


@query
def fact_left_keys(spark, folder):
    """The left variant of the key lookup: every row of the panel with its keys."""
    panel = stage(panels.orders_panel(spark, folder))
    star = warehouse.build_dimensions(panel, list(ORDERS.dimensions))
    keyed_rows = star.attach(panel, ["kpi_name", "region"], "left")
    return shown(keyed_rows.select("date", "kpi_key", "region_key", "segment", "priority", "kpi_value"), 4)


@query
def incident_enriched(spark, folder):
    panel = stage(labelled_events(spark, folder))
    monitored = stage(monitoring.monitor(panel, EVENTS))
    table = stage(rca.contributions(monitored, EVENTS))
    history = warehouse.stage_incidents(incidents.history(selected_incidents(spark, folder)))
    counts = warehouse.anomaly_counts(monitored, "threshold_breached")
    return shown(warehouse.incident_enriched(history, warehouse.rca_ranked(table), counts))


@query
def incident_details_joined(spark, folder):
    """Incidents with stored details."""
    chosen = stage(selected_incidents(spark, folder))
    history = warehouse.stage_incidents(incidents.history(chosen))
    rows = warehouse.with_incident_details(history, chosen.select("incident_id", "anomaly_count", "executive_summary"))
    return rows.select("incident_id", "anomaly_count", "executive_summary")


@query
def mart_kpi_health(spark, folder):
    star = orders_star(spark, folder)
    health = warehouse.kpi_health(monitored_orders(spark, folder))
    return shown(warehouse.mart_kpi_health(health, star), 2, avg_percent_variance=6, max_abs_percent_variance=6, health_score=6)


@query
def mart_incident_summary(spark, folder):
    return shown(events_tables(spark, folder)["mart_incident_summary"], 3)


@query
def mart_root_cause_summary(spark, folder):
    return shown(events_tables(spark, folder)["mart_root_cause_summary"])


@query
def mart_data_quality_summary(spark, folder):
    return events_tables(spark, folder)["mart_data_quality_summary"]


@query
def warehouse_row_counts(spark, folder):
    return sinks.row_counts(events_tables(spark, folder))


@query
def warehouse_integrity(spark, folder):
    t = events_tables(spark, folder)
    keys = ["date_key", "kpi_key", "tier_key", "band_key"]
    fact_keys = {
        "fact_kpi_daily": keys,
        "fact_kpi_monitoring": keys,
        "fact_kpi_anomalies": keys,
        "fact_rca_contributions": ["analysis_date_key", "kpi_key"],
        "fact_incidents": ["incident_date_key", "kpi_key"],
    }
    return assertions.integrity(t, fact_keys)


# ------------------------------------------------------------------ reports


@query
def report_health_by_day(spark, folder):
    return shown(reports.health_by_day(events_tables(spark, folder)))


@query
def report_anomalies_by_severity(spark, folder):
    return reports.anomalies_by_severity(events_tables(spark, folder))


@query
def report_top_contributors(spark, folder):
    return shown(reports.top_contributors(events_tables(spark, folder)))


@query
def report_incident_summary(spark, folder):
    return shown(reports.incident_summary(events_tables(spark, folder)), 3)


@query
def report_quality_summary(spark, folder):
    return reports.quality_summary(events_tables(spark, folder))


@query
def report_executive_rollup(spark, folder):
    return shown(reports.executive_rollup(events_tables(spark, folder)))


@query
def report_dimension_drilldown(spark, folder):
    return shown(reports.dimension_drilldown(events_tables(spark, folder)), 5)


@query
def report_segment_conversion(spark, folder):
    return shown(reports.segment_search(events_tables(spark, folder), "conversion_rate", ["t1", "LOW"]))


@query
def report_segment_latency(spark, folder):
    return shown(reports.segment_search(events_tables(spark, folder), "latency_ms", ["T0", "High"]))


@query
def detector_slice(spark, folder):
    return shown(reports.slice_detector(monitored_events(spark, folder), "threshold_breached"))


@query
def dashboard_overview(spark, folder):
    return reports.overview(monitored_events(spark, folder), events_anomalies(spark, folder))


@query
def dashboard_health_by_kpi(spark, folder):
    return shown(reports.health_by_kpi(monitored_orders(spark, folder)))


@query
def dashboard_status_distribution(spark, folder):
    return reports.rows_by(monitored_orders(spark, folder), "monitoring_status")


@query
def dashboard_anomalies_per_date(spark, folder):
    rows = reports.slice_detector(monitored_orders(spark, folder), "threshold_breached")
    return reports.rows_by(rows, "date", "anomalies")


@query
def dashboard_long_series(spark, folder):
    return shown(reports.long_series(monitored_events(spark, folder), list(EVENTS.dimensions)))


@query
def dashboard_worst_rows(spark, folder):
    rows = reports.slice_panel(monitored_orders(spark, folder), "finished_rate")
    worst = reports.largest(rows, "percent_variance", 20, ["date", *ORDERS.dimensions])
    return shown(worst.select("date", *ORDERS.dimensions, "actual_value", "expected_value", "percent_variance"))


@query
def metric_trend_rate(spark, folder):
    return shown(reports.metric_trend(wide_events(spark, folder), "conversion_rate"))


@query
def metric_trend_total(spark, folder):
    return shown(reports.metric_trend(wide_events(spark, folder), "revenue"), 2)


@query
def zscore_trend(spark, folder):
    return shown(reports.zscore_trend(wide_scored(spark, folder), "conversion_rate"))


@query
def worst_conversion_drops(spark, folder):
    rows = wide_events(spark, folder).select("date", *WIDE_SERIES, "conversion_rate")
    return shown(reports.worst_drops(rows, list(WIDE_SERIES), "conversion_rate"))


@query
def run_summary(spark, folder):
    return reports.run_summary(events_anomalies(spark, folder), list(EVENTS.dimensions), 14)


@query
def previous_month_value(spark, folder):
    rows = panels.orders_panel(spark, folder)
    return shown(windows.previous_value(rows, list(ORDERS.dimensions), "kpi_value", "previous"), 4)


@query
def segment_labels(spark, folder):
    """Members joined to one label, with a missing member spelled out."""
    rows = panels.orders_panel(spark, folder)
    label = joined([F.col("region"), F.nullif("segment", F.lit("BUILDING")), F.col("priority")], " / ")
    return shown(rows.select("date", "kpi_name", label.alias("segment_label"), "kpi_value"), 4)
