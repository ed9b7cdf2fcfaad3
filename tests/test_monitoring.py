import pytest
from helpers import by_date, panel, series
from pyspark.sql import functions as F

from metrivane.config import DIMENSIONS, Settings
from metrivane.operators import monitoring
from metrivane.operators.windows import Trailing, add_trailing


def last(df, *columns):
    return by_date(df, *columns)[-1]


def test_means_stay_within_a_series(spark):
    other = ("APAC", "Mobile", "Safari", "Email", "SMB")
    df = monitoring.monitor(panel(spark, series(range(1, 10)), series([100] * 9, segment=other)))
    own = df.where("region = 'EMEA'")
    assert last(own, "rolling_avg_7d", "rolling_avg_14d") == (6.0, 5.0)
    assert last(df.where("region = 'APAC'"), "rolling_avg_7d") == (100.0,)


def test_baseline_leaves_out_the_current_row(spark):
    df = monitoring.monitor(panel(spark, series([float(v) for v in range(1, 30)])))
    assert last(df, "moving_baseline", "rolling_avg_28d") == (14.5, 15.5)
    assert [r[0] for r in by_date(df, "moving_baseline")][:7] == [None] * 7
    assert by_date(df, "moving_baseline")[7][0] == 4.0


def test_variance(spark):
    df = monitoring.monitor(panel(spark, series([100.0] * 28 + [90.0])))
    assert last(df, "absolute_variance", "percent_variance") == (-10.0, -0.10)


def test_zero_baseline_is_normal(spark):
    df = monitoring.monitor(panel(spark, series([0.0] * 29)))
    assert last(df, "percent_variance", "monitoring_status", "threshold_breached") == (None, "NORMAL", False)


@pytest.mark.parametrize("kpi, value", [("conversion_rate", 80.0), ("latency_ms", 131.0)])
def test_both_directions(spark, kpi, value):
    df = monitoring.monitor(panel(spark, series([100.0] * 28 + [value], kpi)))
    assert last(df, "monitoring_status") == ("CRITICAL",)


@pytest.mark.parametrize(
    "value, status, threshold", [(100.0, "NORMAL", 0.08), (90.0, "WARNING", 0.08), (80.0, "CRITICAL", 0.16)]
)
def test_three_statuses(spark, value, status, threshold):
    df = monitoring.monitor(panel(spark, series([100.0] * 28 + [value])))
    assert last(df, "monitoring_status", "threshold_value") == (status, threshold)


def test_unknown_kpi_uses_the_fallback(spark):
    df = monitoring.monitor(panel(spark, series([100.0] * 28 + [94.0], "sign_ups")))
    assert last(df, "threshold_value", "threshold_direction", "monitoring_status") == (0.05, "lower_is_bad", "WARNING")


def test_grain_is_preserved(spark):
    df = monitoring.monitor(panel(spark, series([1.0] * 10), series([2.0] * 10, "latency_ms")))
    assert df.count() == 20
    assert df.groupBy("date", *DIMENSIONS).count().where("count > 1").isEmpty()


def test_unparsable_value_becomes_null(spark):
    text = panel(spark, series([1.0] * 9)).withColumn(
        "kpi_value", F.when(F.col("date") == "2024-01-03", "n/a").otherwise("1.5")
    )
    rows = by_date(monitoring.monitor(text), "actual_value", "rolling_avg_7d")
    assert rows[2] == (None, 1.5)


def test_null_dimension_keeps_null_measures(spark):
    rows = series([1.0] * 10, segment=(None, "Mobile", "Safari", "Email", "SMB"))
    df = monitoring.monitor(panel(spark, rows))
    assert {r[0] for r in by_date(df, "rolling_avg_7d")} == {None}


def test_missing_columns_and_bad_dimensions_raise(spark):
    with pytest.raises(ValueError, match="Missing columns"):
        monitoring.monitor(panel(spark, series([1.0])).drop("region"))
    with pytest.raises(ValueError, match="kpi_name"):
        Settings(dimensions=("region", "kpi_name"))


def test_blocks_equal_whole_series(spark):
    """Series with gaps, short blocks and windows longer than a block."""
    dates = [0, 1, 2, 9, 10, 30, 31, 32, 33, 34, 35, 60, 61, 90, 91, 92, 93, 94, 95, 96, 97, 98, 99, 120]
    rows = [r for i, d in enumerate(dates) for r in series([float(i * i % 17)], start=_day(d))]
    rows += series([float(i % 5) for i in range(80)], "latency_ms")
    df = panel(spark, rows).withColumnRenamed("kpi_value", "v")
    measures = [
        Trailing("m", "avg", "v", -6, 0),
        Trailing("b", "avg", "v", -8, -1, 3),
        Trailing("s", "stddev_samp", "v", -8, -1, 3),
    ]
    key = ["date", "kpi_name"]

    def values(block):
        out = add_trailing(df, list(DIMENSIONS), measures, block_days=block)
        return {tuple(r[k] for k in key): tuple(None if r[m] is None else round(r[m], 9) for m in "mbs") for r in out.collect()}

    whole = values(None)
    assert len(whole) == len(rows)
    for block in (1, 4, 30, 1000):
        assert values(block) == whole


def _day(n):
    import datetime as dt

    return dt.date(2024, 1, 1) + dt.timedelta(days=n)


def test_summary(spark):
    df = monitoring.monitor(panel(spark, series([100.0] * 28 + [90.0, 50.0])))
    row = monitoring.summary(df).first()
    assert (row.total_monitoring_rows, row.warning_count, row.critical_count, row.threshold_breach_count) == (30, 1, 1, 2)
    worst = monitoring.worst_variances(df, DIMENSIONS).first()
    assert worst.monitoring_status == "CRITICAL"
    assert [tuple(r) for r in monitoring.breaches_by_kpi(df).collect()] == [("conversion_rate", 2)]
