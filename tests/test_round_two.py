"""Small scales, cold starts, ties of decimals, quoted cells and many rules."""

import datetime as dt

from pyspark.sql import functions as F

from metrivane.functions.scalars import fixed, percent_text
from metrivane.operators.labels import label_windows
from metrivane.operators.medians import exact_median
from metrivane.operators.ranking import rank_with_totals
from metrivane.plans.warehouse import with_incident_details
from metrivane.sources.scans import scan_text


def test_rank_does_not_depend_on_the_scale(spark):
    for scale in (1e-10, 1.0, 1e10):
        df = spark.createDataFrame([("g", "a", 1 * scale), ("g", "b", 4 * scale), ("g", "c", 3 * scale), ("g", "d", 3 * scale)], "g string, m string, v double")
        got = {r.m: r.rk for r in rank_with_totals(df, ["g"], "v", ["m"], "rk", "total").collect()}
        assert got == {"b": 1, "c": 2, "d": 3, "a": 4}


def test_median_of_nothing(spark):
    none = spark.createDataFrame([(None,)], "v double")
    assert exact_median(none, [], "v").first()[0] is None
    assert exact_median(none.withColumn("k", F.lit(1)), ["k"], "v").count() == 0


def test_decimal_ties_go_to_the_even_digit(spark):
    row = spark.range(1).select(percent_text(F.lit(0.0625)), fixed(F.lit(0.125), 2), percent_text(F.lit(0.1))).first()
    assert tuple(row) == ("6.2", "0.12", "10.0")


def test_quoted_cells(spark, tmp_path):
    (tmp_path / "x.csv").write_text('a,b\n"say ""hi"" now","two\nlines"\n,2\n')
    got = [tuple(r) for r in scan_text(spark, str(tmp_path / "x.csv"), line_breaks=True).collect()]
    assert got == [('say "hi" now', "two\nlines"), ("", "2")]


def test_many_label_rules(spark):
    day = dt.date(2024, 1, 5)
    rules = spark.range(30_000).select(
        F.format_string("r%05d", "id").alias("incident_id"), F.lit("t").alias("incident_type"), F.lit("d").alias("incident_description"),
        F.date_add(F.lit(day), F.col("id").cast("int")).alias("start_date"), F.date_add(F.lit(day), (F.col("id") + 1).cast("int")).alias("end_date"),
        F.when(F.col("id") % 2 == 0, "x").alias("dim"),
    )
    rows = spark.createDataFrame([(day, "x"), (day + dt.timedelta(1), "y"), (dt.date(2000, 1, 1), "x")], "date date, dim string")
    got = {(r.date, r.dim): (r.is_incident, r.incident_id) for r in label_windows(rows, rules, ["dim"]).collect()}
    assert got == {(day, "x"): (True, "r00000"), (day + dt.timedelta(1), "y"): (True, "r00001"), (dt.date(2000, 1, 1), "x"): (False, "")}


def test_incidents_without_details_get_the_defaults(spark):
    history = spark.createDataFrame([("i1",), ("i2",)], "incident_id string")
    details = spark.createDataFrame([("i1", 3, "three")], "incident_id string, anomaly_count int, executive_summary string")
    got = sorted(map(tuple, with_incident_details(history, details).collect()))
    assert got == [("i1", 3, "three"), ("i2", 1, "")]
