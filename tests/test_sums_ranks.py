"""Sums that do not depend on the order of rows, and ranks over groups of any shape."""

import math
import random

from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from helpers import anomalies, anomaly_row
from metrivane.operators import rca, sums, windows
from metrivane.operators.ranking import rank_with_totals
from metrivane.session import stage

AMOUNTS = st.floats(min_value=-1e30, max_value=1e30, allow_nan=False).filter(lambda x: x == 0 or abs(x) > 1e-25)


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(AMOUNTS, min_size=1, max_size=40))
def test_sum_is_that_of_whole_numbers(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "x double")
    got = df.agg(sums.exact_sum("x")).first()[0]
    want = math.fsum(values)
    assert got == want or math.isclose(got, want, rel_tol=4e-16)


def test_sum_is_the_same_in_any_order(spark):
    rng = random.Random(4)
    values = [rng.uniform(-1, 1) * 10 ** rng.randint(-12, 12) for _ in range(4000)]
    found = set()
    for n in (1, 3, 8):
        rng.shuffle(values)
        df = spark.createDataFrame([(v,) for v in values], "x double").repartition(n)
        found.add(df.agg(sums.exact_sum("x"), sums.exact_avg("x")).first())
    assert len(found) == 1
    assert math.isclose(next(iter(found))[0], math.fsum(values), rel_tol=1e-15)


def test_sum_of_nothing_is_missing(spark):
    df = spark.createDataFrame([(None,), (None,)], "x double")
    assert tuple(df.agg(sums.exact_sum("x"), sums.exact_avg("x")).first()) == (None, None)


def ranked(df):
    out = rank_with_totals(df, ["g"], "x", ["m"], "rank", "total")
    out = out.select("g", "m", "x", "rank", "total")
    return sorted(map(tuple, out.collect()), key=str)


def by_hand(rows):
    out = []
    for g in {r[0] for r in rows}:
        own = sorted((r for r in rows if r[0] == g), key=lambda r: (-r[2], r[1]))
        total = math.fsum(r[2] for r in own)
        out += [(*r, i, total) for i, r in enumerate(own, 1)]
    return sorted(out, key=str)


def test_one_amount_in_all_rows_of_a_hot_group(spark):
    rows = [("hot", f"m{i:05d}", 0.25) for i in range(6000)] + [(None, "a", 1.0), (None, "b", 2.0), ("cold", "a", 5.0)]
    df = spark.createDataFrame(rows, "g string, m string, x double").repartition(6)
    assert ranked(df) == by_hand(rows)


def test_a_group_with_one_amount_is_sorted_in_many_partitions(spark):
    rows = spark.range(40_000).select(F.lit("hot").alias("g"), F.col("id").cast("string").alias("m"), F.lit(0.1).alias("x"))
    # the staged sort that ranks rest on
    placed = rows.orderBy("g", F.desc("x"), "m")
    parts = placed.groupBy(F.spark_partition_id().alias("p")).count().collect()
    out = rank_with_totals(rows, ["g"], "x", ["m"], "rank", "total")
    row = out.agg(F.count_distinct("rank").alias("n"), F.max("rank").alias("last"), F.count_distinct("total").alias("t")).first()
    assert (row.n, row.last, row.t) == (40_000, 40_000, 1)
    assert len(parts) > 1 and max(p["count"] for p in parts) < 30_000


def test_amounts_of_any_size_rank_by_size(spark):
    rows = [("g", f"m{i}", v) for i, v in enumerate([1e-10, 2e-10, 1e-18, 3e12, 1.0, 1.0000000000000002, 5e-324 + 1e-30])]
    df = spark.createDataFrame(rows, "g string, m string, x double")
    assert [r[:4] for r in ranked(df)] == [r[:4] for r in by_hand(rows)]


def test_tiny_amounts_order_the_top_causes(spark):
    rows = [anomaly_row(1.0 - a, 1.0, kpi=k) for a, k in ((1e-10, "a_rate"), (3e-10, "b_rate"), (2e-10, "c_rate"))]
    table = rca.contributions(anomalies(spark, *rows))
    order = [r.kpi_name for r in table.where("dimension_type = 'region'").orderBy(*rca.by_degradation()).collect()]
    assert order == ["b_rate", "c_rate", "a_rate"]


def test_equal_histories_in_another_order_have_the_same_mean(spark):
    values = [0.1, 0.2, 0.3, 0.7, 1e-17, 3.3]
    rows = [(k, i, v) for k, vs in (("a", values), ("b", values[::-1])) for i, v in enumerate(vs)] + [("a", 6, 0.0), ("b", 6, 0.0)]
    df = spark.createDataFrame(rows, "k string, i int, v double")
    out = windows.add_trailing(df, ["k"], [windows.Trailing("m", "ordered_avg", "v", -6, -1, 6)], order="i")
    means = {r.m for r in out.where("i = 6").collect()}
    assert len(means) == 1 and math.isclose(means.pop(), math.fsum(values) / 6)


def test_rows_without_a_key_share_no_window(spark):
    rows = [(None if i % 2 else "a", i // 2, float(i)) for i in range(4000)]
    df = stage(spark.createDataFrame(rows, "k string, i int, v double"))
    out = windows.add_trailing(df, ["k"], [windows.Trailing("m", "avg", "v", -3, -1)], order="i")
    assert out.where("k is null and m is not null").isEmpty() and out.where("k is null").count() == 2000
    exchange = out._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(k" in exchange and "_apart" in exchange
