"""Long KPI panels derived from raw tables: (date, kpi_name, dimensions..., kpi_value).

Raw rows are pre-aggregated map-side to one row per (date, dimensions); the KPIs
are then ratios of those counters, turned from columns into rows in place.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from metrivane.functions.scalars import ratio, ratio_or_zero


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def to_long(wide: DataFrame, keys: list[str], kpis: dict[str, Column], extra: tuple[str, ...] = ()) -> DataFrame:
    """One row per KPI; the row count grows by the number of KPIs only after aggregation."""
    pairs = [F.struct(F.lit(k).alias("kpi_name"), v.cast("double").alias("kpi_value")) for k, v in kpis.items()]
    long = wide.select(*keys, *extra, F.inline(F.array(*pairs)))
    return long.select(keys[0], "kpi_name", *keys[1:], *extra, "kpi_value")


def cents(c: Column | str) -> Column:
    """An amount with two decimals as whole hundredths."""
    return F.floor((F.col(c) if isinstance(c, str) else c) * 100.0 + 0.5)


def exact_sum(c: Column | str) -> Column:
    """Sum of amounts with two decimals, over whole hundredths: the result does not depend on
    the order partial sums arrive in, and an overflow raises instead of rounding."""
    return F.sum(cents(c)) / 100.0


EVENT_DIMENSIONS = ("kpi_name", "tier", "band")
EVENT_COUNTERS = ("impressions", "clicks", "conversions", "orders", "revenue", "latency_ms")


def event_counters(events: DataFrame) -> DataFrame:
    """Daily counters by user tier and value band, the wide form of the events panel."""
    k = F.get_json_object("props", "$.k").try_cast("int")
    rows = events.select(
        F.to_date("ts").alias("date"),
        F.concat(F.lit("T"), (F.col("user_id") % 3).cast("string")).alias("tier"),
        F.when(k < 34, "low").when(k < 67, "mid").otherwise("high").alias("band"),
        "event_type",
        "value",
    )

    def of(kind):
        return F.col("event_type") == kind

    errors = exact_sum(F.when(of("error"), F.col("value")))
    return rows.groupBy("date", "tier", "band").agg(
        F.count_if(of("view")).alias("impressions"),
        F.count_if(of("click")).alias("clicks"),
        F.count_if(of("signup")).alias("conversions"),
        F.count_if(of("purchase")).alias("orders"),
        F.coalesce(exact_sum(F.when(of("purchase"), F.col("value"))), F.lit(0.0)).alias("revenue"),
        ratio(errors, F.count_if(of("error"))).alias("latency_ms"),
    )


def event_kpis(counters: DataFrame, with_counters: bool = False) -> DataFrame:
    kpis = {
        "conversion_rate": ratio_or_zero("conversions", "clicks"),
        "click_through_rate": ratio_or_zero("clicks", "impressions"),
        "average_order_value": ratio_or_zero("revenue", "orders"),
        "latency_ms": F.col("latency_ms"),
        "revenue_per_session": ratio_or_zero("revenue", "impressions"),
    }
    return to_long(counters, ["date", "tier", "band"], kpis, EVENT_COUNTERS if with_counters else ())


def events_panel(spark: SparkSession, folder: str, with_counters: bool = False) -> DataFrame:
    return event_kpis(event_counters(read_table(spark, folder, "events")), with_counters)


ORDER_DIMENSIONS = ("kpi_name", "region", "segment", "priority")
ORDER_SPECS = (
    ("region", ("region",)),
    ("segment", ("segment",)),
    ("priority", ("priority",)),
    ("region_segment", ("region", "segment")),
    ("full_segment", ("region", "segment", "priority")),
)


def _located_customers(spark: SparkSession, folder: str) -> DataFrame:
    customer = read_table(spark, folder, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    nation = read_table(spark, folder, "nation").select("n_nationkey", "n_regionkey")
    region = read_table(spark, folder, "region")
    # nation and region are stored tables of a few rows: the planner broadcasts them by their file size
    places = nation.join(region, nation.n_regionkey == region.r_regionkey).select("n_nationkey", "r_name")
    return customer.join(places, customer.c_nationkey == places.n_nationkey).select(
        "c_custkey", F.col("r_name").alias("region"), F.col("c_mktsegment").alias("segment")
    )


def orders_panel(spark: SparkSession, folder: str) -> DataFrame:
    """Monthly KPIs by region, market segment and order priority."""
    orders = read_table(spark, folder, "orders").select(
        F.trunc(F.to_date("o_orderdate"), "month").alias("date"),
        "o_custkey",
        F.col("o_orderpriority").alias("priority"),
        "o_totalprice",
        "o_orderstatus",
    )
    cell = ["date", "region", "segment", "priority"]
    joined = orders.join(_located_customers(spark, folder), F.col("o_custkey") == F.col("c_custkey"))
    # per customer first, so that distinct customers are a plain count and no key is expanded
    per_customer = joined.groupBy(*cell, "o_custkey").agg(
        F.count("*").alias("orders"),
        F.sum(cents("o_totalprice")).alias("revenue"),
        F.count_if(F.col("o_orderstatus") == "F").alias("finished"),
    )
    wide = per_customer.groupBy(*cell).agg(
        F.sum("orders").alias("orders"),
        F.count("*").alias("customers"),
        (F.sum("revenue") / 100.0).alias("revenue"),
        F.sum("finished").alias("finished"),
    )
    kpis = {
        "average_order_value": ratio("revenue", "orders"),
        "revenue_per_customer": ratio("revenue", "customers"),
        "finished_rate": ratio("finished", "orders"),
    }
    return to_long(wide, cell, kpis)


LINE_DIMENSIONS = ("kpi_name", "region", "segment", "priority", "return_flag", "line_status")
LINE_SPECS = (
    ("region", ("region",)),
    ("segment", ("segment",)),
    ("priority", ("priority",)),
    ("return_flag", ("return_flag",)),
    ("line_status", ("line_status",)),
    ("region_segment_priority", ("region", "segment", "priority")),
    ("full_segment", ("region", "segment", "priority", "return_flag", "line_status")),
)
LINE_COUNTERS = ("lines", "quantity", "gross", "discounted", "taxed")


def lineitem_panel(spark: SparkSession, folder: str) -> DataFrame:
    """Monthly KPIs of order lines over five dimensions; the counters stay on each row."""
    lines = read_table(spark, folder, "lineitem")
    orders = read_table(spark, folder, "orders").select(
        "o_orderkey", "o_custkey", F.col("o_orderpriority").alias("priority")
    )
    customers = _located_customers(spark, folder)
    # The order dimensions are joined to the lines once; both joins are on high-cardinality keys.
    placed = orders.join(customers, orders.o_custkey == customers.c_custkey)
    rows = lines.join(placed, lines.l_orderkey == placed.o_orderkey).select(
        F.trunc(F.to_date("l_shipdate"), "month").alias("date"),
        "region",
        "segment",
        "priority",
        F.col("l_returnflag").alias("return_flag"),
        F.col("l_linestatus").alias("line_status"),
        F.col("l_quantity").alias("q"),
        F.col("l_extendedprice").alias("p"),
        F.col("l_discount").alias("d"),
        F.col("l_tax").alias("t"),
    )
    cell = ["date", "region", "segment", "priority", "return_flag", "line_status"]
    wide = rows.groupBy(*cell).agg(
        F.count("*").alias("lines"),
        exact_sum("q").alias("quantity"),
        exact_sum("p").alias("gross"),
        exact_sum("d").alias("discounted"),
        exact_sum("t").alias("taxed"),
    )
    kpis = {
        "units_per_line": ratio("quantity", "lines"),
        "discount_rate": ratio("discounted", "lines"),
        "price_per_unit": ratio("gross", "quantity"),
    }
    return to_long(wide, cell, kpis, LINE_COUNTERS)
