import datetime as dt
import random
import statistics

import numpy as np
import pytest
from helpers import DAY, by_date, panel, series
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from metrivane.config import DIMENSIONS, DetectorConfig, Settings
from metrivane.operators import anomaly, boosting, medians, monitoring, residual
from metrivane.session import stage

SPIKE = [100.0, 101.0, 99.0, 100.0, 102.0, 98.0, 101.0, 150.0]


def scored(spark, *parts):
    return anomaly.add_zscore(monitoring.monitor(panel(spark, *parts)), DIMENSIONS)


def test_warm_up_is_not_flagged(spark):
    df = scored(spark, series(SPIKE[:6]))
    assert {r for r in by_date(df, "z_score", "zscore_anomaly")} == {(None, False)}


def test_spike_is_critical(spark):
    df = scored(spark, series(SPIKE))
    assert by_date(df, "zscore_severity", "zscore_anomaly")[-1] == ("CRITICAL", True)
    mean, std = statistics.mean(SPIKE[:7]), statistics.stdev(SPIKE[:7])
    assert by_date(df, "z_score")[-1][0] == pytest.approx((150 - mean) / std)


def test_constant_series_has_no_score(spark):
    df = scored(spark, series([5.0] * 12 + [9.0]))
    assert by_date(df, "z_score", "zscore_severity")[-1] == (None, "NORMAL")


def test_combined_takes_the_worse_severity(spark):
    rows = [(False, "NORMAL", True, "WARNING"), (True, "WARNING", False, "NORMAL"), (True, "CRITICAL", True, "WARNING")]
    df = spark.createDataFrame(
        rows, "zscore_anomaly boolean, zscore_severity string, residual_anomaly boolean, residual_severity string"
    )
    out = [(r.combined_anomaly, r.combined_severity) for r in anomaly.add_combined(df).collect()]
    assert out == [(True, "WARNING"), (True, "WARNING"), (True, "CRITICAL")]


def test_labels_join_and_defaults(spark):
    mon = scored(spark, series([1.0] * 3))
    labels = panel(spark, series([1.0])).withColumns(
        {"is_incident": F.lit("True"), "incident_id": F.lit("X"), "incident_type": F.lit("t"),
         "incident_description": F.lit("d")}
    )
    df = anomaly.join_labels(mon, labels, DIMENSIONS)
    assert by_date(df, "is_incident", "incident_id") == [(True, "X"), (False, ""), (False, "")]
    df = anomaly.join_labels(mon, panel(spark, series([1.0])), DIMENSIONS)
    assert {r for r in by_date(df, "is_incident", "incident_id", "incident_type")} == {(False, "", "")}


def test_labels_match_null_keys(spark):
    rows = series([1.0], segment=(None, "Mobile", "Safari", "Email", "SMB"))
    labels = panel(spark, rows).withColumns(
        {"is_incident": F.lit(True), "incident_id": F.lit("X"), "incident_type": F.lit(""), "incident_description": F.lit("")}
    )
    df = anomaly.join_labels(scored(spark, rows), labels, DIMENSIONS)
    assert by_date(df, "incident_id") == [("X",)]


def test_wide_detector_needs_a_full_window_and_a_strict_excess(spark):
    rows = [(r[0], "Mobile", "EMEA", "Safari", float(v)) for r, v in zip(series(SPIKE), SPIKE)]
    df = spark.createDataFrame(rows, "date date, device_type string, region string, browser string, ctr double")
    out = anomaly.detect_wide(df, "ctr", window=7, threshold=2.0)
    flags = by_date(out, "ctr_zscore", "ctr_anomaly")
    assert flags[:7] == [(0.0, False)] * 7 and flags[7][1] is True
    z = flags[7][0]
    exact = anomaly.detect_wide(df, "ctr", window=7, threshold=z)
    assert by_date(exact, "ctr_anomaly")[-1] == (False,)
    worst = anomaly.worst_wide(out, "ctr", ["device_type", "region", "browser"]).collect()
    assert [(w.date, w.actual_value) for w in worst] == [(rows[-1][0], 150.0)]


def noisy_panel(spark, kpis=("conversion_rate", "latency_ms"), days=60, seed=3):
    rng = random.Random(seed)
    parts = []
    for kpi in kpis:
        for region in ("EMEA", "APAC"):
            for device in ("Mobile", "Desktop"):
                level = rng.uniform(50, 200)
                values = [level + rng.gauss(0, 5) + 0.2 * d for d in range(days)]
                parts.append(series(values, kpi, (region, device, "Safari", "Email", "SMB")))
    return panel(spark, *parts)


def closed_form(pdf, vocabulary, fill, start, split, alpha=1.0):
    """Standardised ridge with an unpenalised intercept, from the normal equations."""
    x = [
        pdf["moving_baseline"].fillna(fill).to_numpy(float),
        np.array([(d - start).days for d in pdf["date"]], float),
        np.array([d.weekday() for d in pdf["date"]], float),
        np.array([d.month for d in pdf["date"]], float),
    ]
    for dim, members in vocabulary.items():
        x += [(pdf[dim] == m).to_numpy(float) for m in members]
    x = np.column_stack(x)
    y = pdf["actual_value"].to_numpy(float)
    train = np.array([d < split for d in pdf["date"]])
    mean, std = x[train].mean(0), x[train].std(0)
    std[std == 0] = 1.0
    z = np.column_stack([np.ones(len(x)), (x - mean) / std])
    penalty = alpha * np.eye(z.shape[1])
    penalty[0, 0] = 0
    zt = z[train]
    return z @ np.linalg.solve(zt.T @ zt + penalty, zt.T @ y[train])


def test_ridge_equals_the_closed_form_and_ignores_partitioning(spark):
    cfg = Settings()
    mon = monitoring.monitor(noisy_panel(spark))
    f = residual.describe_features(mon, cfg)
    results = []
    for n in (1, 7):
        part = mon.repartition(n)
        out = residual.score_ridge(part, residual.fit_ridge(part, f, cfg.detector), f, cfg.detector)
        results.append(out.orderBy("date", *DIMENSIONS).toPandas())
    assert np.allclose(results[0]["predicted_value"], results[1]["predicted_value"], atol=1e-8)
    vocabulary = {d: sorted(results[0][d].unique()) for d in f.dims}
    for kpi, pdf in results[0].groupby("kpi_name"):
        expected = closed_form(pdf, vocabulary, f.fill, f.start, f.split)
        assert np.allclose(pdf["predicted_value"], expected, atol=1e-8), kpi


def test_singular_system_gives_the_least_squares_fit(spark):
    cfg = Settings(detector=DetectorConfig(ridge_alpha=0.0))
    mon = monitoring.monitor(noisy_panel(spark, ("latency_ms",)))
    f = residual.describe_features(mon, cfg)
    out = residual.score_ridge(mon, residual.fit_ridge(mon, f, cfg.detector), f, cfg.detector).toPandas()
    x = [out["moving_baseline"].fillna(f.fill).to_numpy(float), np.array([(d - f.start).days for d in out["date"]], float),
         np.array([d.weekday() for d in out["date"]], float), np.array([d.month for d in out["date"]], float)]
    x += [(out[d] == m).to_numpy(float) for d in f.dims for m in sorted(out[d].unique())]
    z = np.column_stack([np.ones(len(out)), *x])
    train = np.array([d < f.split for d in out["date"]])
    beta = np.linalg.lstsq(z[train], out["actual_value"].to_numpy(float)[train], rcond=None)[0]
    assert np.allclose(out["predicted_value"][train], (z @ beta)[train], atol=1e-6)


def test_labels_are_never_features(spark):
    mon = monitoring.monitor(noisy_panel(spark))
    f = residual.describe_features(mon, Settings())
    assert set(f.dims) == set(DIMENSIONS[1:])
    assert f.numeric == ("moving_baseline", "days_since_start", "day_of_week", "month")


def test_cold_start_predicts_the_baseline(spark):
    early = series([100.0 + d % 3 for d in range(60)], segment=("EMEA", "Mobile", "Safari", "Email", "SMB"))
    late = series([7.0 + d % 2 for d in range(12)], segment=("APAC", "Mobile", "Safari", "Email", "SMB"),
                  start=early[-12][0])
    cfg = Settings(detector=DetectorConfig(group_columns=DIMENSIONS))
    out = residual.predict(monitoring.monitor(panel(spark, early, late)), cfg)
    rows = out.where("region = 'APAC'").select("predicted_value", "moving_baseline").collect()
    assert all(r.predicted_value == r.moving_baseline for r in rows)
    assert out.where("region = 'EMEA' and predicted_value is null").isEmpty()


def test_split_date(spark):
    df = spark.createDataFrame([(r[0],) for r in series(range(10))] * 2, "date date")
    row = residual.split_date(df, 0.70).first()
    assert (row.start, row.split) == (DAY, series(range(10))[7][0])


def test_residual_modes_and_unconfigured_direction(spark):
    rows = [("conversion_rate", 70.0, 100.0), ("conversion_rate", 130.0, 100.0), ("latency_ms", 150.0, 100.0),
            ("sign_ups", 10.0, 100.0), ("conversion_rate", 1.0, 0.0)]
    df = spark.createDataFrame(rows, "kpi_name string, actual_value double, predicted_value double")
    out = anomaly.add_residual_flags(df, Settings()).collect()
    assert [r.residual_severity for r in out] == ["WARNING", "NORMAL", "CRITICAL", "NORMAL", "NORMAL"]
    assert out[4].residual_percent is None
    values = [1.0, 1.1, 0.9, 1.05, 0.95, -9.0, 9.0]
    df = spark.createDataFrame([("conversion_rate", v, 0.0) for v in values], "kpi_name string, actual_value double, predicted_value double")
    cfg = Settings(detector=DetectorConfig(residual_mode="robust_mad"))
    out = {r.actual_value: r for r in anomaly.add_residual_flags(df, cfg).collect()}
    assert out[-9.0].residual_severity == "CRITICAL" and out[9.0].residual_severity == "NORMAL"
    mad = statistics.median(abs(v - 1.0) for v in values)
    assert out[9.0].residual_modified_zscore == pytest.approx(0.6745 * 8.0 / mad)


def test_constant_residuals_have_no_score(spark):
    df = spark.createDataFrame([("a", 1.0)] * 5 + [("b", 1.0), ("b", 2.0), ("b", 9.0)], "g string, x double")
    out = anomaly.add_modified_zscore(df, ["g"], "x", "z").collect()
    assert {r.z for r in out if r.g == "a"} == {None}
    assert all(r.z is not None for r in out if r.g == "b")


def wide_rows(spark, members=1500, days=20, seed=8):
    """Many members of two dimensions, some missing, some seen only after the split."""
    rng = random.Random(seed)
    rows = []
    for i in range(members):
        region = None if i % 97 == 0 else f"r{i}"
        level = rng.uniform(-20, 20)
        for d in rng.sample(range(days), 4):
            y = 50 + level + 3 * (i % 3) + 0.5 * d + rng.gauss(0, 1)
            rows.append((DAY + dt.timedelta(days=d), "latency_ms", region, f"d{i % 3}", "Safari", "Email", "SMB", y, 40.0 + 0.7 * level))
    rows.append((DAY + dt.timedelta(days=days), "latency_ms", "late", "d0", "Safari", "Email", "SMB", 60.0, None))
    columns = ["date date", "kpi_name string", *[f"{d} string" for d in DIMENSIONS[1:]], "actual_value double", "moving_baseline double"]
    return spark.createDataFrame(rows, ", ".join(columns))


def test_ridge_of_many_members_by_conjugate_gradients(spark, monkeypatch):
    cfg, df = Settings(), wide_rows(spark)
    f = residual.describe_features(df, cfg)
    out = residual.score_ridge(df, residual.fit_ridge(df, f, cfg.detector), f, cfg.detector).toPandas()
    monkeypatch.setattr(residual, "DENSE", 10_000)
    direct = residual.score_ridge(df, residual.fit_ridge(df, f, cfg.detector), f, cfg.detector).toPandas()
    key = ["date", "region", "device_type", "actual_value"]
    out, direct = (x.sort_values(key, na_position="first").reset_index(drop=True) for x in (out, direct))
    assert np.allclose(out["predicted_value"], direct["predicted_value"], atol=1e-7)
    train = out["date"] < f.split
    vocabulary = {d: sorted(out[d][train].dropna().unique()) for d in f.dims}
    expected = closed_form(out, vocabulary, f.fill, f.start, f.split)
    assert sum(map(len, vocabulary.values())) > 1000
    assert np.allclose(out["predicted_value"], expected, atol=1e-6)


def test_ridge_of_several_groups_and_a_group_without_key(spark):
    early = [(DAY + dt.timedelta(days=d), k, "EMEA", f"d{d % 2}", "Safari", "Email", "SMB", 10.0 * i + d, 5.0 + d) for i, k in enumerate(("a", "b", None)) for d in range(30)]
    columns = ["date date", "kpi_name string", *[f"{d} string" for d in DIMENSIONS[1:]], "actual_value double", "moving_baseline double"]
    df = spark.createDataFrame(early, ", ".join(columns))
    out = residual.predict_ridge(df, Settings()).toPandas()
    assert out["predicted_value"][out["kpi_name"].isna()].isna().all()
    known = out[out["kpi_name"].notna()]
    assert np.allclose(known["predicted_value"], known["actual_value"], atol=1.0)


GBT = DetectorConfig(model="gbt", trees=4, depth=3, learning_rate=0.3, subsample=0.8, colsample=0.7)


def test_boosted_trees_follow_the_series(spark):
    cfg = Settings(detector=DetectorConfig(model="gbt", trees=80))
    mon = monitoring.monitor(noisy_panel(spark, ("conversion_rate",), 40))
    out = residual.predict(mon, cfg).toPandas()
    assert len(out) == mon.count() and out["predicted_value"].notna().all()
    mean_error = (out["actual_value"] - out["actual_value"].mean()).abs().mean()
    assert (out["actual_value"] - out["predicted_value"]).abs().mean() < 0.4 * mean_error  # the noise alone is 0.3 of it


def test_boosted_trees_are_the_same_in_tasks_and_in_rounds(spark):
    cfg, df = Settings(detector=GBT), stage(wide_rows(spark, 120).unionByName(wide_rows(spark, 60, seed=3).withColumn("kpi_name", F.lit("b"))))
    mixed = 120 * 4 + 1  # the first group is fitted in rounds, the second in a task
    results = []
    for rows, in_task in ((df, 10**6), (df.repartition(7), 0), (df.repartition(3), mixed - 1)):
        out = boosting.predict_trees(rows, cfg, in_task).toPandas()
        key = ["kpi_name", "date", "region", "device_type", "actual_value"]
        results.append(out.sort_values(key, na_position="first")["predicted_value"].to_numpy())
    assert len(np.unique(results[0])) > 20
    assert (results[0] == results[1]).all() and (results[0] == results[2]).all()


def test_boosted_trees_of_thousands_of_groups(spark):
    rows = spark.range(5000 * 12).select(
        F.date_add(F.lit(DAY), (F.col("id") % 12).cast("int")).alias("date"),
        F.concat(F.lit("k"), F.floor(F.col("id") / 12)).alias("kpi_name"),
        *[F.lit("x").alias(d) for d in DIMENSIONS[1:]],
        (F.floor(F.col("id") / 12) + F.when(F.col("id") % 12 < 4, 0.0).otherwise(5.0)).alias("actual_value"),
        F.lit(1.0).alias("moving_baseline"),
    )
    cfg = Settings(detector=DetectorConfig(model="gbt", trees=4, depth=1, learning_rate=1.0, subsample=1.0, colsample=1.0))
    out = residual.predict(rows, cfg)
    assert out.count() == 60_000
    error = F.max(F.abs(F.col("predicted_value") - F.col("actual_value")))
    assert out.agg(error).first()[0] < 0.1


def test_boosted_trees_without_enough_rows(spark):
    df = wide_rows(spark, 1, 5)
    out = residual.predict(df, Settings(detector=GBT)).collect()
    assert all(r.predicted_value == r.moving_baseline for r in out)
    assert residual.predict(df.limit(0), Settings(detector=GBT)).count() == 0


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(0, 2), st.integers(-50, 50)), min_size=1, max_size=60))
def test_exact_median(spark, rows):
    df = spark.createDataFrame([(g, float(v)) for g, v in rows], "g int, v double")
    got = {r.g: r["median"] for r in medians.exact_median(df, ["g"], "v").collect()}
    for g in {g for g, _ in rows}:
        assert got[g] == statistics.median(v for h, v in rows if h == g)
    assert medians.exact_median(df, [], "v").first()[0] == statistics.median(v for _, v in rows)


def test_exact_median_of_a_long_skewed_group(spark):
    df = spark.range(60_001).select((F.pow(F.col("id") % 977, 3) + F.col("id") % 13).cast("double").alias("v"))
    expected = statistics.median(float((i % 977) ** 3 + i % 13) for i in range(60_001))
    assert medians.exact_median(df, [], "v").first()[0] == expected


@pytest.mark.parametrize("few", [1, 3, 50])
def test_exact_median_by_repeated_narrowing(spark, monkeypatch, few):
    """Heavy values next to the middle, wide ranges, even and odd counts, and groups without values."""
    monkeypatch.setattr(medians, "FEW", few)
    rng = random.Random(6)
    groups = {
        0: [1.0] * 500 + [2.0] * 500,
        1: [1.0] * 500 + [2.0] * 501,
        2: [rng.gauss(0, 1) * 10 ** rng.randint(-200, 200) for _ in range(3001)],
        3: [float(i) for i in range(2000)],
        4: [0.0] * 999 + [-1e300, 1e300],
        5: [7.0, 9.0],
        6: [-0.5],
    }
    rows = [(g, v) for g, vs in groups.items() for v in vs] + [(7, None)]
    rng.shuffle(rows)
    df = stage(spark.createDataFrame(rows, "g int, v double"))
    got = {r.g: r["median"] for r in medians.exact_median(df, ["g"], "v").collect()}
    assert got == {g: statistics.median(vs) for g, vs in groups.items()}
    whole = [v for vs in groups.values() for v in vs]
    assert medians.exact_median(df, [], "v").first()[0] == statistics.median(whole)
    assert medians.exact_median(df.where("g = 7"), [], "v").collect()[0][0] is None


def test_exact_median_when_a_proposal_misses(spark, monkeypatch):
    monkeypatch.setattr(medians, "FEW", 2)
    monkeypatch.setattr(medians, "_ACCURACY", 3)  # percentiles that are far off
    monkeypatch.setattr(medians, "_STEPS", 3)
    values = [float((i * 7919) % 4001) for i in range(4001)]
    df = stage(spark.createDataFrame([(v,) for v in values], "v double"))
    assert medians.exact_median(df, [], "v").first()[0] == statistics.median(values)


def test_full_detection_has_one_row_per_input(spark):
    p = noisy_panel(spark)
    mon = monitoring.monitor(p)
    out = anomaly.detect(mon, p, Settings())
    assert out.count() == p.count()
    assert out.columns == ["date", *DIMENSIONS, *anomaly.MEASURES, "is_incident", "incident_id", "incident_type",
                           "incident_description"]
