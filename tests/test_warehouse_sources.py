import datetime as dt
import json

import pytest
from helpers import DAY, anomalies, anomaly_row, panel, series
from pyspark.sql import functions as F

from metrivane.config import (
    DIMENSIONS, Contract, Settings, Threshold, live_settings, load_settings,
)
from metrivane.functions import scalars, text
from metrivane.operators import evaluation, rca
from metrivane.plans import reports, runs, warehouse
from metrivane.sources import scans, sinks
from metrivane.streaming import feed


def col(spark, c):
    return spark.range(1).select(c).first()[0]


def test_scalars(spark):
    cases = {"True": True, "true": True, "1": True, "0": False, "yes": False, None: False}
    for given, expected in cases.items():
        assert col(spark, scalars.flag(F.lit(given).cast("string"))) is expected
    assert col(spark, scalars.number(F.lit("abc"))) is None and col(spark, scalars.number(F.lit("NaN"))) is None
    assert col(spark, scalars.day(F.lit("2024-13-01"))) is None
    assert col(spark, scalars.ratio(F.lit(1.0), F.lit(0.0))) is None
    assert col(spark, scalars.ratio_or_zero(F.lit(1.0), F.lit(0.0))) == 0.0
    assert col(spark, scalars.date_key(F.lit("2024-03-09").cast("date"))) == 20240309
    assert col(spark, scalars.half_even(F.lit(90.5))) == 90.0
    assert col(spark, scalars.title(F.lit("click_through_rate"))) == "Click Through Rate"
    assert col(spark, text.z_band(F.lit(-3.2))) == "High"
    hint = text.investigation("conversion_rate", F.lit("Mobile"), F.lit("EMEA"), F.lit("Safari"))
    assert col(spark, hint).startswith("Check mobile Safari checkout flow")
    assert col(spark, text.investigation("ctr", F.lit("x"), F.lit("y"), F.lit("z"))) == text.INVESTIGATION_DEFAULT


def test_evaluation_counts(spark):
    rows = [(True, True), (True, False), (False, True), (False, False)]
    df = spark.createDataFrame(rows, "is_incident boolean, f boolean")
    r = evaluation.evaluate(df, {"f": "f"}).first()
    assert (r.true_positives, r.false_positives, r.false_negatives, r.true_negatives) == (1, 1, 1, 1)
    assert (r.precision, r.recall, r.f1_score, r.support, r.total_rows) == (0.5, 0.5, 0.5, 2, 4)
    none = evaluation.evaluate(df.where("not is_incident"), {"f": "f", "g": "is_incident"})
    assert {(x.precision, x.recall, x.f1_score) for x in none.collect()} == {(0.0, 0.0, 0.0)}
    assert evaluation.best_detector(none).first().detector == "f"


def test_dimensions_and_keys(spark):
    df = panel(spark, series([1.0, 2.0]), series([3.0], "latency_ms", ("APAC", "Desktop", "Chrome", "Email", None)))
    star = warehouse.build_dimensions(df, list(DIMENSIONS))
    date = star.dims["dim_date"].orderBy("date_key").first()
    assert (date.date_key, date.day_of_week, date.day_name, date.is_weekend) == (20240101, 1, "Monday", False)
    monday = warehouse.build_dimensions(df, list(DIMENSIONS), week_start="monday").dims["dim_date"].orderBy("date_key").first()
    assert monday.day_of_week == 0
    kpis = {r.kpi_name: r for r in star.dims["dim_kpi"].collect()}
    assert kpis["latency_ms"].direction == "higher_is_bad" and kpis["conversion_rate"].kpi_key == 1
    assert kpis["conversion_rate"].description == "Conversion Rate"
    assert [tuple(r) for r in star.dims["dim_region"].orderBy("region_key").collect()] == [(1, "APAC"), (2, "EMEA")]
    assert star.attach(df, star.columns).count() == 2  # the row without a segment has no key
    assert star.attach(df, star.columns, "left").count() == 3
    # the same keys from the distributed sort and the shuffle joins used past the size limit
    large = warehouse.build_dimensions(df, list(DIMENSIONS), limit=0)
    for name in star.dims:
        assert sorted(map(tuple, large.dims[name].collect())) == sorted(map(tuple, star.dims[name].collect()))
    assert sorted(map(tuple, large.attach(df, large.columns).collect())) == sorted(map(tuple, star.attach(df, star.columns).collect()))


def test_health_score_and_nulls(spark):
    rows = [("2024-01-01", "k", s, s != "NORMAL", 1.0, None, None) for s in ("NORMAL", "NORMAL", "WARNING", "CRITICAL")]
    df = spark.createDataFrame(rows, "date string, kpi_name string, monitoring_status string, threshold_breached boolean, "
                                     "actual_value double, expected_value double, percent_variance double")
    r = warehouse.kpi_health(df).first()
    assert (r.monitored_rows, r.breach_rows, r.health_score, r.avg_expected_value) == (4, 2, 50.0, None)
    assert warehouse.kpi_health(df, fill_nulls=True).first().avg_expected_value == 0.0
    worse = df.withColumn("monitoring_status", F.lit("CRITICAL"))
    assert warehouse.kpi_health(worse).first().health_score == 0.0


def test_incident_enrichment_falls_back_to_history(spark):
    history = spark.createDataFrame(
        [("I1", DAY, "conversion_rate", "CRITICAL", "High", 0.9, "own cause", "own action", "residual_anomaly"),
         ("I2", DAY, "latency_ms", "WARNING", "Low", 0.3, "own cause", "own action", "residual_anomaly")],
        "incident_id string, date date, kpi_affected string, severity string, confidence_label string, "
        "confidence_score double, top_root_cause string, recommended_action string, detector_used string")
    df = anomalies(spark, anomaly_row(80.0, 100.0), anomaly_row(90.0, 100.0, region="APAC"))
    ranked = warehouse.rca_ranked(warehouse.stage_rca(rca.contributions(df)))
    counts = warehouse.anomaly_counts(df)
    rows = {r.incident_id: r for r in warehouse.incident_enriched(warehouse.stage_incidents(history), ranked, counts).collect()}
    assert rows["I1"].anomaly_count == 2 and rows["I1"].top_dimension_type == "browser" and rows["I1"].top_contribution_share == 1.0
    assert (rows["I2"].top_root_cause, rows["I2"].top_dimension_type, rows["I2"].anomaly_count) == ("own cause", "incident_history", 1)


def test_slices_and_windows(spark):
    df = panel(spark, series(range(1, 11)), series([5.0] * 10, "latency_ms"))
    assert reports.slice_panel(df, "latency_ms", "2024-01-02", "2024-01-03", {"region": ["EMEA"], "browser": []}).count() == 2
    assert reports.slice_panel(df, members={"region": ["APAC"]}).isEmpty()
    assert reports.report_window(df, 3).count() == 6
    assert reports.lookback(df, reports.yesterday("2024-01-06"), 2).agg(F.min("date"), F.max("date")).first()[0] == dt.date(2024, 1, 4)
    drops = reports.worst_drops(df.where("kpi_name = 'latency_ms'"), ["region"], "kpi_value", 10).collect()
    assert drops[-1].change is None and drops[0].change == 0.0
    assert reports.metric_digest(
        spark.createDataFrame([], "date date, device_type string, region string, browser string, z_score double, "
                                  "actual_value double, rolling_mean double"), "ctr").first().primary_offender == "No anomaly detected"


def test_csv_scan(spark, tmp_path):
    path = tmp_path / "p.csv"
    path.write_text("extra,kpi_value,date,is_incident,orders,region\nx,1.5,2024-01-01,True,3,\ny,oops,never,1,2.0,EMEA\n")
    contract = Contract(column_order=("date", "region", "orders", "kpi_value", "is_incident"),
                        types={"date": "date", "orders": "integer", "kpi_value": "number", "is_incident": "boolean"})
    df = scans.scan_csv(spark, str(path), contract)
    assert df.columns == ["date", "region", "orders", "kpi_value", "is_incident", "extra"]
    assert [tuple(r) for r in df.collect()] == [(DAY, "", 3, 1.5, True, "x"), (None, "EMEA", 2, None, True, "y")]
    assert [f.dataType.simpleString() for f in scans.contract_schema(contract)] == ["date", "string", "bigint", "double", "boolean"]
    with pytest.raises(FileNotFoundError):
        scans.scan_csv(spark, str(tmp_path / "absent.csv"), contract)


def test_sinks_and_missing_tables(spark, tmp_path):
    df = panel(spark, series([1.0, 2.0]))
    sinks.write_landing(df, f"{tmp_path}/landing")
    assert spark.read.parquet(f"{tmp_path}/landing").count() == 2
    sinks.write_landing(df, f"{tmp_path}/csv", "csv")
    assert spark.read.option("header", True).csv(f"{tmp_path}/csv").orderBy("date").first().date == "2024-01-01"
    counts = {r.table: r.rows for r in sinks.write_warehouse(spark, {"a": df, "b": df.limit(1)}, f"{tmp_path}/w").collect()}
    assert counts == {"a": 2, "b": 1}
    assert scans.read_or_empty(spark, f"{tmp_path}/none", "x int").isEmpty()
    assert scans.read_or_empty(spark, f"{tmp_path}/w/a", df.schema).count() == 2
    assert scans.read_incident_details(spark, f"{tmp_path}/none").columns == ["incident_id", "anomaly_count", "executive_summary"]
    scans.register(spark, {"stored_a": f"{tmp_path}/w/a"})
    assert spark.sql("select count(*) from stored_a").first()[0] == 2


def payload(project, days, access="desktop", agent="user", level=100.0):
    items = [
        {"project": project, "access": access, "agent": agent, "granularity": "daily",
         "timestamp": (DAY + dt.timedelta(days=d)).strftime("%Y%m%d") + "00", "views": level + (d % 7)}
        for d in range(days)
    ]
    return json.dumps({"items": items})


def land(folder, **documents):
    folder.mkdir(exist_ok=True)
    for name, text_ in documents.items():
        (folder / f"{name}.json").write_text(text_)
    return str(folder)


def test_payload_failures_are_isolated(spark, tmp_path):
    folder = land(tmp_path / "in", a=payload("a", 10), b=json.dumps({"items": []}), c="{broken")
    rows, failed = scans.ingest_payloads(spark, folder, "2024-01-10", 5)
    assert rows.count() == 5 and {r.project for r in rows.collect()} == {"a"}
    assert {r.source_file.split("/")[-1]: r.error for r in failed.collect()} == {
        "b.json": "Empty payload", "c.json": "Unreadable payload"}
    with pytest.raises(scans.NoSeriesError):
        scans.ingest_payloads(spark, land(tmp_path / "bad", c="{broken"), "2024-01-10", 5)


def test_live_run(spark, tmp_path):
    drop = json.loads(payload("b", 60, level=200.0))
    drop["items"][-1]["views"] = 1.0
    folder = land(tmp_path / "in", a=payload("a", 60), b=json.dumps(drop), c=payload("c", 5))
    t = runs.live_run(spark, folder, f"{tmp_path}/out", live_settings(), DAY + dt.timedelta(days=59), 60, 30,
                      expected_series=4, best_detector_f1_score=0.5, run_timestamp="now")
    summary = t["run_summary"].first()
    assert (summary.total_rows, summary.series_count, summary.rows_in_report_window) == (125, 3, 60)
    assert summary.rows_scored + summary.rows_unscored_baseline_warmup == 125
    assert t["coverage"].first().status == "FAIL"
    assert not t["anomalies"].where("is_incident").count()
    flagged = t["report_window"].where("residual_anomaly").collect()
    assert [(r.project, r.residual_severity) for r in flagged] == [("b", "CRITICAL")]
    assert t["incident_history"].first().kpi_affected == "pageviews"


def test_evaluation_run_and_warehouse(spark, tmp_path):
    parts = [series([100.0 + (d * 7 + i) % 5 for d in range(45)], kpi, (region, "Mobile", "Safari", "Email", "SMB"))
             for i, region in enumerate(("EMEA", "APAC")) for kpi in ("conversion_rate", "latency_ms")]
    parts[0][-1] = (*parts[0][-1][:-1], 40.0)
    last_day = parts[0][-1][0]
    hit = (F.col("date") == F.lit(last_day)) & (F.col("region") == "EMEA") & (F.col("kpi_name") == "conversion_rate")
    p = panel(spark, *parts).withColumns(
        {"is_incident": hit, "incident_id": F.when(hit, "X").otherwise(""), "incident_type": F.lit(""), "incident_description": F.lit("")})
    t = runs.evaluation_run(spark, p, f"{tmp_path}/out", as_of=last_day, run_timestamp="now")
    scores = {r.detector: r for r in t["evaluation"].collect()}
    assert scores["residual_anomaly"].true_positives == 1 and scores["residual_anomaly"].recall == 1.0
    assert all(r.true_positives + r.false_positives + r.false_negatives + r.true_negatives == 180 for r in scores.values())
    first = t["incident_history"].first()
    assert (first.kpi_affected, str(first.date)) == ("conversion_rate", str(last_day))
    counts = {r.table: r.rows for r in runs.warehouse_run(spark, t, f"{tmp_path}/wh", Settings()).collect()}
    assert counts["fact_kpi_daily"] == counts["fact_kpi_anomalies"] == 180 and counts["dim_region"] == 2
    assert counts["fact_incidents"] == t["incident_history"].count()
    details = scans.read_incident_details(spark, f"{tmp_path}/out/latest_incident")
    assert details.where(F.col("incident_id") == first.incident_id).first().executive_summary.startswith("On ")


def test_stream_appends_and_rescores(spark, tmp_path):
    landing = tmp_path / "in"
    land(landing, a=payload("a", 10))
    seen = []

    def on_window(window, epoch):
        seen.append((epoch, window.count(), window.agg(F.max("kpi_value")).first()[0]))

    store, mark = f"{tmp_path}/store", f"{tmp_path}/mark"
    feed.start_feed(spark, str(landing), store, mark, 5, on_window).awaitTermination()
    land(landing, b=payload("a", 12, level=500.0))  # the same days again, newer values, two more days
    feed.start_feed(spark, str(landing), store, mark, 5, on_window).awaitTermination()
    assert [s[:2] for s in seen] == [(0, 5), (1, 5)] and seen[1][2] > 500


def test_settings_file(tmp_path):
    path = tmp_path / "m.yaml"
    path.write_text(
        "kpi_monitoring: {thresholds: {x: {warning_threshold_pct: 0.1, critical_threshold_pct: 0.2, direction: higher_is_bad}}}\n"
        "anomaly_detection: {rolling_window: 14, model: {ridge_alpha: 2.0}, model_group_columns: [kpi_name, region]}\n"
        "incident_reporting: {max_incidents: 3, severity_thresholds: {warning: 0.2}}\n")
    s = load_settings(path)
    assert s.thresholds == {"x": Threshold(0.1, 0.2, "higher_is_bad")}
    assert (s.detector.window, s.detector.ridge_alpha, s.detector.z_warning) == (14, 2.0, 2.0)
    assert s.detector.group_columns == ("kpi_name", "region") and s.incident.warning_variance == 0.2
    path.write_text("incident_reporting: {severity_thresholds: {wrning: 0.2}}\n")
    with pytest.raises(ValueError, match="wrning"):
        load_settings(path)
