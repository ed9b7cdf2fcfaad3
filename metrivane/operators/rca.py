"""Contribution of dimension members to the measured degradation."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from metrivane.config import DETECTOR_SEVERITY, LOWER, RcaConfig, Settings
from metrivane.functions.scalars import flag, joined, lookup, severity_label, severity_rank
from metrivane.functions.text import cause_action, cause_statement
from metrivane.operators.monitoring import require
from metrivane.operators.ranking import rank_with_totals, top_n
from metrivane.operators.sums import exact_sum

COLUMNS = [
    "analysis_date",
    "kpi_name",
    "detector_used",
    "dimension_type",
    "dimension_value",
    "actual_value_sum_or_avg",
    "expected_value_sum_or_avg",
    "degradation_amount",
    "contribution_share",
    "contribution_rank",
    "anomaly_count",
    "severity_max",
    "recommended_action",
]


def severity_column(detector: str, allowed=tuple(DETECTOR_SEVERITY)) -> str:
    if detector not in allowed or detector not in DETECTOR_SEVERITY:
        raise ValueError(f"Detector {detector} is not allowed. Allowed detectors: {list(allowed)}")
    return DETECTOR_SEVERITY[detector]


def _has_expectation():
    return (
        F.col("expected_value").isNotNull()
        & F.col("moving_baseline").isNotNull()
        & F.col("percent_variance").isNotNull()
    )


def candidates(anomalies: DataFrame, detector: str, rca: RcaConfig = RcaConfig()) -> DataFrame:
    """Flagged WARNING/CRITICAL rows that have an expectation to compare with."""
    severity = severity_column(detector, rca.allowed)
    require(
        anomalies, [detector, "expected_value", "moving_baseline", "percent_variance", severity], "the RCA table"
    )
    return anomalies.where(flag(detector) & F.col(severity).isin("WARNING", "CRITICAL") & _has_expectation())


def with_degradation(df: DataFrame, settings: Settings) -> DataFrame:
    """How far the row moved in the bad direction; 0 for an improvement."""
    change = F.col("actual_value") - F.col("expected_value")
    higher = lookup("kpi_name", settings.directions, LOWER) == "higher_is_bad"
    return df.withColumn("degradation_amount", F.greatest(F.when(higher, change).otherwise(-change), F.lit(0.0)))


def contributions(anomalies: DataFrame, settings: Settings = Settings(), detector: str | None = None) -> DataFrame:
    """The contribution table over every dimension spec.

    Candidates are filtered before the grouping sets multiply them, each set is
    pre-aggregated map-side, and rank and share come from one range-partitioned sort.
    """
    cfg = settings.rca
    detector = detector or cfg.detector
    rows = with_degradation(candidates(anomalies, detector, cfg), settings).where(
        (F.col("degradation_amount") > 0) & F.col("date").isNotNull() & F.col("kpi_name").isNotNull()
    )
    dims = list(dict.fromkeys(c for _, cols in cfg.specs for c in cols))
    fixed = ["date", "kpi_name"]
    rows = rows.select(
        *fixed,
        *dims,
        "actual_value",
        "expected_value",
        "degradation_amount",
        severity_rank(severity_column(detector, cfg.allowed)).alias("_rank"),
    )
    sets, names = _grouping_sets(cfg.specs, dims)
    grouped = rows.groupingSets([[*fixed, *s] for s in sets], *fixed, *dims).agg(
        F.grouping_id().alias("_set"),
        F.avg("actual_value").alias("actual_value_sum_or_avg"),
        F.avg("expected_value").alias("expected_value_sum_or_avg"),
        exact_sum("degradation_amount").alias("degradation_amount"),
        F.count("*").alias("anomaly_count"),
        F.max("_rank").alias("_rank"),
    )
    # One row per spec name (two specs may name the same columns).
    labelled = grouped.withColumn("_spec", F.explode(lookup_array("_set", names)))
    value = lookup_expr("_spec", {name: joined(cols, " + ") for name, cols in cfg.specs})
    table = labelled.select(
        F.col("date").alias("analysis_date"),
        "kpi_name",
        F.lit(detector).alias("detector_used"),
        F.col("_spec").alias("dimension_type"),
        value.alias("dimension_value"),
        "actual_value_sum_or_avg",
        "expected_value_sum_or_avg",
        "degradation_amount",
        "anomaly_count",
        severity_label("_rank").alias("severity_max"),
    )
    table = rank_with_totals(
        table,
        ["analysis_date", "kpi_name", "dimension_type"],
        "degradation_amount",
        ["dimension_value"],
        "contribution_rank",
        "_total",
    )
    share = F.least(F.lit(1.0), F.col("degradation_amount") / F.col("_total"))
    action = cause_action("kpi_name", "dimension_type", "dimension_value")
    return table.withColumn("contribution_share", share).withColumn("recommended_action", action).select(*COLUMNS)


def _grouping_sets(specs, dims):
    """Distinct column sets and, per grouping id, the spec names using that set."""
    # date and kpi_name lead every set, so their bits of the id are 0
    sets, names = [], {}
    for name, cols in specs:
        gid = sum(1 << (len(dims) - 1 - i) for i, d in enumerate(dims) if d not in cols)
        if gid not in names:
            sets.append([d for d in dims if d in cols])
        names.setdefault(gid, []).append(name)
    return sets, names


def lookup_array(key: str, table: dict[int, list[str]]):
    return lookup_expr(key, {k: F.array(*[F.lit(n) for n in v]) for k, v in table.items()})


def lookup_expr(key: str, table: dict):
    cases = list(table.items())
    first = F.when(F.col(key) == cases[0][0], cases[0][1])
    return reduce(lambda e, kv: e.when(F.col(key) == kv[0], kv[1]), cases[1:], first)


def candidate_summary(anomalies: DataFrame, settings: Settings = Settings(), detector: str | None = None) -> DataFrame:
    """One row: flagged, comparable, degrading and excluded counts."""
    detector = detector or settings.rca.detector
    rows = with_degradation(anomalies.where(flag(detector)), settings)
    valid = _has_expectation()
    return rows.agg(
        F.count("*").alias("detector_anomaly_count"),
        F.count_if(valid).alias("valid_expected_baseline_count"),
        F.count_if(valid & (F.col("degradation_amount") > 0)).alias("degrading_anomaly_count"),
        F.count_if(~valid).alias("excluded_missing_expected_or_baseline"),
        F.count_if(valid & ~(F.coalesce("degradation_amount", F.lit(0.0)) > 0)).alias("excluded_non_degrading"),
    )


def candidate_count(anomalies: DataFrame, settings: Settings = Settings(), detector: str | None = None) -> DataFrame:
    return candidates(anomalies, detector or settings.rca.detector, settings.rca).agg(
        F.count("*").alias("total_anomalies_analyzed")
    )


def add_statement(table: DataFrame, settings: Settings) -> DataFrame:
    direction = lookup("kpi_name", settings.directions, LOWER)
    return table.withColumn(
        "root_cause_statement",
        cause_statement("kpi_name", "analysis_date", "dimension_value", "contribution_share", direction),
    )


# Total orders: ties beyond share and degradation go by date, KPI and member.  Both come from
# exact sums, so they are compared as they are and the same table ranks the same way on every run.
_TIES = ["analysis_date", "kpi_name", "dimension_type", "dimension_value"]


def _share():
    return F.desc("contribution_share")


def _amount():
    return F.desc("degradation_amount")


def by_share():
    return [_share(), _amount(), *_TIES]


def by_degradation():
    return [_amount(), _share(), *_TIES]


def overall_top(table: DataFrame, rca: RcaConfig = RcaConfig()) -> DataFrame:
    """Largest shares among the interaction dimensions."""
    wanted = F.col("dimension_type").isin(*rca.interaction_types) & (F.col("contribution_share") >= rca.min_share)
    return table.where(wanted).orderBy(*by_share()).limit(rca.max_top)


def top_by_kpi(table: DataFrame, rca: RcaConfig = RcaConfig()) -> DataFrame:
    """The worst cause per KPI; interaction dimensions only, unless the table has none at all.

    Each KPI keeps its best interaction row and its best row of any kind; whether
    any interaction row exists is then known from these few rows.
    """
    preferred = F.col("dimension_type").isin(*rca.interaction_types)
    best = top_n(table.withColumn("_pref", preferred), ["kpi_name", "_pref"], by_degradation(), 1)
    whole = Window.partitionBy(F.lit(1))  # at most two rows per KPI
    best = best.withColumn("_any", F.max("_pref").over(whole)).where(F.col("_pref") == F.col("_any"))
    return best.drop("_pref", "_any")


def top_by_dimension(table: DataFrame) -> DataFrame:
    return top_n(table, ["dimension_type"], by_degradation(), 1)


def top_contributors(table: DataFrame, key: str, n: int) -> DataFrame:
    """First ``n`` rows by share per KPI or per dimension type."""
    return top_n(table, [key], by_share(), n, "position")


def top_causes(table: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Best per KPI, then best per dimension, then overall; first occurrence wins; first ``max_top``."""
    rca = settings.rca
    parts = [
        (0, top_by_kpi(table, rca), by_degradation()),
        (1, top_by_dimension(table), by_degradation()),
        (2, overall_top(table, rca), by_share()),
    ]
    # every part is a handful of rows: one per KPI, one per dimension type, max_top overall
    listed = [
        part.withColumn("_pos", F.row_number().over(Window.partitionBy(F.lit(1)).orderBy(*order))).withColumn(
            "_priority", F.lit(priority)
        )
        for priority, part, order in parts
    ]
    union = reduce(DataFrame.unionByName, listed)
    first = top_n(union, _TIES, [F.col("_priority"), F.col("_pos")], 1)
    chosen = first.orderBy("_priority", "_pos").limit(rca.max_top)
    chosen = chosen.withColumn("position", F.row_number().over(Window.partitionBy(F.lit(1)).orderBy("_priority", "_pos")))
    return add_statement(chosen.drop("_priority", "_pos"), settings)


def action_examples(causes: DataFrame, n: int = 5) -> DataFrame:
    """The first ``n`` distinct recommended actions, in order of first appearance."""
    return (
        causes.groupBy("recommended_action")
        .agg(F.min("position").alias("position"))
        .orderBy("position", "recommended_action")
        .limit(n)
    )
