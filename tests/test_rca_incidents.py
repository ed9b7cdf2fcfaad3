import datetime as dt
import json
from collections import defaultdict

import pytest
from helpers import DAY, anomalies, anomaly_row
from pyspark.sql import functions as F

from metrivane.config import IncidentConfig, RcaConfig, Settings
from metrivane.functions import text
from metrivane.operators import incidents, rca
from metrivane.operators.ranking import global_row_number, rank_with_totals


def test_degradation_follows_the_direction(spark):
    df = anomalies(spark, anomaly_row(80.0, 100.0), anomaly_row(130.0, 100.0, "latency_ms"))
    assert [r.degradation_amount for r in rca.with_degradation(df, Settings()).collect()] == [20.0, 30.0]


def test_improvement_gives_an_empty_table(spark):
    table = rca.contributions(anomalies(spark, anomaly_row(120.0, 100.0)))
    assert table.columns == rca.COLUMNS and table.isEmpty()


def test_shares_sum_to_one_and_ranks_are_permutations(spark):
    rows = [
        anomaly_row(100.0 - 3 * i - j, 100.0, region=reg, device=dev, date=DAY + dt.timedelta(days=d))
        for d in range(2)
        for i, reg in enumerate(("EMEA", "APAC", "NA"))
        for j, dev in enumerate(("Mobile", "Desktop"))
        if i + j
    ]
    groups = defaultdict(list)
    for r in rca.contributions(anomalies(spark, *rows)).collect():
        groups[r.analysis_date, r.kpi_name, r.dimension_type].append(r)
    assert len(groups) == 2 * 7
    for members in groups.values():
        assert sum(m.contribution_share for m in members) == pytest.approx(1.0)
        members.sort(key=lambda m: m.contribution_rank)
        assert [m.contribution_rank for m in members] == list(range(1, len(members) + 1))
        amounts = [m.degradation_amount for m in members]
        assert amounts == sorted(amounts, reverse=True)


def test_statement_and_action(spark):
    df = anomalies(spark, anomaly_row(80.0, 100.0), anomaly_row(130.0, 100.0, "latency_ms"))
    rows = rca.add_statement(rca.contributions(df), Settings()).where("dimension_type = 'region'").collect()
    told = {r.kpi_name: r.root_cause_statement for r in rows}
    assert told["conversion_rate"] == "For conversion_rate on 2024-01-01, EMEA contributed 100.0% of measured degradation."
    assert told["latency_ms"] == "For latency_ms on 2024-01-01, EMEA accounted for 100.0% of excess latency."
    assert rows[0].recommended_action.startswith(f"Review {rows[0].kpi_name} drivers for region = EMEA;")


def test_null_member_is_kept_apart_from_the_total(spark):
    df = anomalies(spark, anomaly_row(80.0, 100.0, region=None), anomaly_row(90.0, 100.0))
    rows = {r.dimension_value: r for r in rca.contributions(df).where("dimension_type = 'region'").collect()}
    assert set(rows) == {"nan", "EMEA"} and rows["nan"].contribution_share == pytest.approx(2 / 3)


def test_candidate_summary(spark):
    df = anomalies(spark, anomaly_row(80.0, 100.0), anomaly_row(120.0, 100.0), anomaly_row(80.0, None))
    assert tuple(rca.candidate_summary(df).first()) == (3, 2, 1, 1, 1)
    assert rca.candidate_count(df).first()[0] == 2


def test_unknown_detector_raises(spark):
    with pytest.raises(ValueError, match="not allowed"):
        rca.contributions(anomalies(spark, anomaly_row(80.0, 100.0)), detector="is_incident")
    with pytest.raises(ValueError, match="not allowed"):
        rca.candidates(anomalies(spark), "zscore_anomaly", RcaConfig(allowed=("residual_anomaly",)))


def test_top_causes_keep_first_occurrence(spark):
    rows = [anomaly_row(100.0 - 10 * i, 100.0, region=reg) for i, reg in enumerate(("A", "B", "C"), 1)]
    rows += [anomaly_row(150.0, 100.0, "latency_ms")]
    table = rca.contributions(anomalies(spark, *rows))
    causes = rca.top_causes(table).orderBy("position").collect()
    keys = [(c.kpi_name, c.dimension_type, c.dimension_value) for c in causes]
    assert len(keys) == len(set(keys)) <= 10
    assert [c.kpi_name for c in causes[:2]] == ["latency_ms", "conversion_rate"]
    assert all(c.dimension_type in ("region_device_browser", "full_segment") for c in causes[:2])
    examples = rca.action_examples(rca.top_causes(table)).collect()
    assert len(examples) == 5 and len({e.recommended_action for e in examples}) == 5


def test_blocked_rank_equals_a_plain_sort(spark):
    """One group holds most rows, with ties, tiny and huge amounts."""
    rows = [("hot", f"m{i:04d}", float((i * 7919) % 101) + 1e-3) for i in range(2000)]
    rows += [("hot", "tiny", 1e-30), ("hot", "huge", 1e30), ("cold", "a", 1.0)]
    df = spark.createDataFrame(rows, "g string, m string, x double")
    out = rank_with_totals(df, ["g"], "x", ["m"], "rank", "total").collect()
    expected = sorted((r for r in rows if r[0] == "hot"), key=lambda r: (-round(r[2], 9), r[1]))
    got = sorted((r for r in out if r.g == "hot"), key=lambda r: r["rank"])
    assert [r.m for r in got] == [r[1] for r in expected]
    assert [r["rank"] for r in got] == list(range(1, len(expected) + 1))
    assert got[0].total == pytest.approx(sum(r[2] for r in expected))


def test_global_row_number(spark):
    df = spark.range(5000).select((F.col("id") * 7919 % 5003).alias("v")).repartition(7)
    rows = sorted((r.n, r.v) for r in global_row_number(df, ["v"], "n").collect())
    assert [n for n, _ in rows] == list(range(1, 5001))
    assert [v for _, v in rows] == sorted(v for _, v in rows)


# ------------------------------------------------------------------ incidents


def build(spark, *rows, settings=Settings(), **ctx):
    df = anomalies(spark, *rows)
    return incidents.build(df, rca.contributions(df, settings), incidents.context(spark, **ctx), settings)


def test_one_incident_per_date_and_kpi(spark):
    rows = build(spark, anomaly_row(80.0, 100.0), anomaly_row(85.0, 100.0, region="APAC"),
                 anomaly_row(130.0, 100.0, "latency_ms")).collect()
    assert {(r.kpi_affected, r.anomaly_count) for r in rows} == {("conversion_rate", 2), ("latency_ms", 1)}
    assert {r.incident_id for r in rows} == {
        "INC-20240101-CONVERSION-RATE-RESIDUAL-ANOMALY", "INC-20240101-LATENCY-MS-RESIDUAL-ANOMALY"}


def test_record_content(spark):
    r = build(spark, anomaly_row(80.0, 100.0), best_detector_f1_score=0.5, health_score=90.0, warning_count=3).first()
    assert r.severity == "CRITICAL"  # one cause explains everything and the variance is above the warning band
    assert r.confidence_score == round(0.3 * 0.5 + 0.3 * 1 + 0.2 * 0.9 + 0.1 * 0.1 + 0.1 * 0.65, 3)
    assert r.confidence_label == "Medium"
    assert [c.dimension_type for c in r.top_root_causes] == ["full_segment", "region_device_browser"]
    assert r.recommended_actions[0] == "Review mobile Safari checkout/session flow." and len(r.recommended_actions) == 3
    assert r.executive_summary.startswith("On 2024-01-01, conversion_rate showed a critical issue.")
    assert r.executive_summary.endswith("Recommended next step: Review mobile Safari checkout/session flow.")
    assert r.supporting_metrics.monitoring_warning_count == 3 and r.supporting_metrics.monitoring_critical_count == 0


def test_missing_context_costs_only_its_share(spark):
    r = build(spark, anomaly_row(80.0, 100.0)).first()
    assert r.confidence_score == round(0.3 + 0.1 * 0.1 + 0.1 * 0.65, 3)


def test_without_causes(spark):
    df = anomalies(spark, anomaly_row(120.0, 100.0))
    r = incidents.build(df, rca.contributions(df), incidents.context(spark)).first()
    assert r.suspected_dimensions == [] and r.supporting_metrics.top_root_cause == "the affected segment"
    assert "explaining 0.0% of measured degradation" in r.executive_summary


def test_single_dimensions_only_without_interactions(spark):
    df = anomalies(spark, anomaly_row(80.0, 100.0))
    table = rca.contributions(df).where("dimension_type in ('region', 'browser')")
    causes = incidents.top_causes(table).first().top_root_causes
    assert [c.dimension_type for c in causes] == ["browser", "region"]


@pytest.mark.parametrize("score, label", [(0.80, "High"), (0.75, "Medium"), (0.55, "Medium"), (0.54, "Low")])
def test_confidence_label(spark, score, label):
    assert spark.range(1).select(incidents.confidence_label(F.lit(score))).first()[0] == label


@pytest.mark.parametrize(
    "detector, worst, share, expected",
    [("CRITICAL", 0.01, 0.0, "CRITICAL"), ("WARNING", 0.30, 0.0, "CRITICAL"), ("WARNING", 0.15, 0.60, "CRITICAL"),
     ("WARNING", 0.14, 0.90, "WARNING"), ("NORMAL", 0.15, 0.59, "WARNING"), ("NORMAL", 0.14, 0.99, "NORMAL")],
)
def test_severity_rule(spark, detector, worst, share, expected):
    col = incidents.incident_severity(F.lit(detector), F.lit(worst), F.lit(share), IncidentConfig())
    assert spark.range(1).select(col).first()[0] == expected


@pytest.mark.parametrize(
    "kpi, cause, first",
    [("conversion_rate", "APAC + Mobile + Safari", "Review mobile Safari checkout/session flow."),
     ("conversion_rate", "APAC", "Review conversion funnel changes for the affected segment."),
     ("latency_ms", "x", "Inspect regional latency, CDN routing, and browser-specific performance logs."),
     ("revenue_per_session", "Paid Search + Enterprise", "Review paid-search landing page quality and enterprise account purchase flow."),
     ("revenue_per_session", "Paid Search", "Review paid-search landing page quality for the affected segment."),
     ("revenue_per_session", "Enterprise", "Review enterprise account purchase flow and pricing logic."),
     ("revenue_per_session", "SMB", "Review revenue per session drivers for the affected segment."),
     ("sign_ups", "SMB", "Review recent product, tracking, and campaign changes affecting sign_ups.")],
)
def test_action_rules(spark, kpi, cause, first):
    col = text.actions_for(F.lit(kpi), F.lit(cause), F.array(F.lit("own"), F.lit("own")), 5)
    actions = spark.range(1).select(col).first()[0]
    assert actions[0] == first and actions[-1] == "own" and actions.count("own") == 1


def listed(spark, *items):
    schema = "incident_id string, kpi_affected string, severity string, confidence_score double, anomaly_count bigint, incident_date date"
    return spark.createDataFrame([(*i, DAY) for i in items], schema)


def test_selection_spreads_over_kpis(spark):
    df = listed(spark, ("a1", "a", "CRITICAL", 0.9, 5), ("a2", "a", "CRITICAL", 0.8, 5), ("a3", "a", "WARNING", 0.9, 9),
                ("b1", "b", "WARNING", 0.7, 1), ("b2", "b", "WARNING", 0.6, 1))
    chosen = incidents.select_incidents(df, 4).orderBy("position")
    assert [r.incident_id for r in chosen.collect()] == ["a1", "b1", "a2", "a3"]
    head = incidents.headline(chosen).first()
    assert tuple(head) == (4, "CRITICAL", "a1")
    assert [r.incident_id for r in incidents.select_incidents(df, 1).collect()] == ["a1"]


def test_empty_headline(spark):
    chosen = incidents.select_incidents(listed(spark), 4)
    assert tuple(incidents.headline(chosen).first()) == (0, "NORMAL", None)


def test_history_and_document(spark):
    df = build(spark, anomaly_row(80.0, 100.0), anomaly_row(130.0, 100.0, "latency_ms"))
    chosen = incidents.select_incidents(df)
    flat = incidents.history(chosen).collect()
    assert len(flat) == 2 and flat[0].top_root_cause.startswith("EMEA + Mobile + Safari")
    doc = incidents.payload(chosen, "residual_anomaly", "2024-02-01T00:00:00").toJSON().first()
    doc = json.loads(doc)
    assert doc["incidents_generated"] == 2 and doc["incidents"][0]["incident_id"] == flat[0].incident_id
    assert doc["incidents"][0]["top_root_causes"][0]["dimension_type"] == "full_segment"
