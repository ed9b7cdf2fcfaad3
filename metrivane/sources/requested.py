"""What was asked of a series source against what came.

The requested series are declared (projects x access types x agents), so a series that never came is known by name: it counts
against the coverage, and it is listed with the reason.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from metrivane.functions.scalars import half_even
from metrivane.operators.joins import null_safe_left, with_one_row


def requested_series(spark: SparkSession, members: Mapping[str, Iterable[str]]) -> DataFrame:
    """One row per combination of the requested members, by dimension; the lists are configuration."""
    if not members or not all(members.values()):
        raise ValueError(f"every dimension needs requested members: {sorted(members)}")
    rows = spark.range(1).select(*[F.array(*[F.lit(m) for m in dict.fromkeys(listed)]).alias(d) for d, listed in members.items()])
    for d in members:
        rows = rows.withColumn(d, F.explode(d))
    return rows


def ledger(requested: DataFrame, rows: DataFrame, failures: DataFrame | None = None) -> DataFrame:
    """One row per requested series: rows and days that came, first and last day, status (received, failed) and the error
    of a failed one.

    ``failures`` has the series' columns, as far as they are known, and an ``error``; a series that is missing
    without one is named absent.  Rows of series that nobody asked for are not counted.
    """
    keys = requested.columns
    came = rows.groupBy(*keys).agg(
        F.count("*").alias("rows"), F.count_distinct("date").alias("days"), F.min("date").alias("first_day"), F.max("date").alias("last_day")
    )
    listed = null_safe_left(requested, came, keys)
    if failures is None:
        listed = listed.withColumn("_error", F.lit(None).cast("string"))
    else:
        listed = null_safe_left(listed, failures.groupBy(*keys).agg(F.min("error").alias("_error")), keys)
    got = F.coalesce(F.col("rows"), F.lit(0)) > 0
    return listed.select(
        *keys,
        F.coalesce("rows", F.lit(0)).alias("rows"),
        F.coalesce("days", F.lit(0)).alias("days"),
        "first_day",
        "last_day",
        F.when(got, "received").otherwise("failed").alias("status"),
        F.when(~got, F.coalesce("_error", F.lit("No payload"))).alias("error"),
    )


def missing_cells(requested: DataFrame, rows: DataFrame, start: dt.date | str, end: dt.date | str) -> DataFrame:
    """Every (series, day) of the request, both days included, that did not come."""
    days = F.sequence(F.to_date(F.lit(start)), F.to_date(F.lit(end)))
    grid = requested.withColumn("date", F.explode(days))
    return grid.join(rows.select(*requested.columns, "date").distinct(), [*requested.columns, "date"], "left_anti")


def requested_coverage(series: DataFrame, rows: DataFrame) -> DataFrame:
    """One row from a ledger: the share of the requested series x observed days that came, and the failures.

    A wholly lost series lowers the share, as its cells are expected too.
    """
    keys = [c for c in series.columns if c in rows.columns and c not in ("rows", "date")]
    asked = rows.join(series.select(*keys), keys, "left_semi")
    days = asked.groupBy("date").agg(F.lit(1).alias("_one")).agg(F.count("date").alias("observed_days"))
    counts = series.agg(
        F.count("*").alias("expected_series"),
        F.count_if(F.col("status") == "received").alias("observed_series"),
        F.count_if(F.col("status") == "failed").alias("fetch_failures"),
        F.coalesce(F.sum("rows"), F.lit(0)).alias("_rows"),
    )
    share: Column = F.coalesce(F.try_divide("_rows", F.col("expected_series") * F.col("observed_days")), F.lit(0.0))
    percent = half_even(share * 100, 2)
    good = (share >= 0.98) & (F.col("fetch_failures") == 0)
    return with_one_row(counts, days).select(
        percent.alias("health_score"),
        F.when(good, "PASS").otherwise("FAIL").alias("status"),
        "expected_series",
        "observed_series",
        "observed_days",
        percent.alias("coverage_pct"),
        "fetch_failures",
    )
