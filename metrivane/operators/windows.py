"""Trailing row windows over series.

A series is one combination of the dimension columns, ordered by date.  The
panel contract makes (date, dimensions) unique, so a series holds at most one
row per calendar day and its window partition is bounded by the calendar.
Where that is not wanted -- very long or irregular series -- ``block_days``
cuts every series into calendar blocks that are computed independently, each
with a copy of the few rows that precede it.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from metrivane.functions.scalars import all_present
from metrivane.operators.ranking import top_n
from metrivane.session import stage


@dataclass(frozen=True)
class Trailing:
    """``stat`` of ``value`` over rows ``first..last`` relative to the current row."""

    name: str
    stat: str  # "avg" | "ordered_avg" | "stddev_samp" | "max"
    value: str
    first: int
    last: int
    min_count: int = 1


def add_trailing(
    df: DataFrame,
    keys: list[str],
    measures: list[Trailing],
    order: str = "date",
    block_days: int | None = None,
) -> DataFrame:
    """Add the trailing statistics; rows with a NULL key keep NULL statistics.

    All measures share one partitioning and one sort, so they cost one shuffle.
    """
    if block_days is None:
        return _evaluate(df, list(keys), measures, order)
    return _evaluate_blocked(df, list(keys), measures, order, block_days)


def _evaluate(df, partition, measures, order, guard=None) -> DataFrame:
    valid = all_present(guard or partition)
    # rows without a key belong to no series: each is a window of its own, so they don't meet in one task
    apart = df.withColumn("_apart", F.when(~valid, F.monotonically_increasing_id()))
    series = Window.partitionBy(*partition, "_apart").orderBy(order)
    return apart.withColumns({m.name: _measure(m, series, valid) for m in measures}).drop("_apart")


def ordered_avg(values: Column) -> Column:
    """The mean of an array, added up from the smallest value: the same for equal values in any order."""
    total = F.aggregate(F.sort_array(values), F.lit(0.0), lambda a, v: a + v)
    return F.try_divide(total, F.size(values))


def _measure(m: Trailing, series, valid: Column) -> Column:
    frame = series.rowsBetween(m.first, m.last)
    if m.stat == "ordered_avg":
        stat = ordered_avg(F.collect_list(F.col(m.value).cast("double")).over(frame))
    else:
        stat = getattr(F, m.stat)(m.value).over(frame)
    enough = F.count(m.value).over(frame) >= m.min_count
    return F.when(valid & enough, stat)


def _evaluate_blocked(df, keys, measures, order, block_days) -> DataFrame:
    halo = max(-m.first for m in measures)
    # read three times below (rows, block sizes, last rows of blocks), hence staged
    blocked = stage(df.withColumn("_block", F.floor(F.unix_date(order) / F.lit(block_days))))
    cell = [*keys, "_block"]

    # One row per block: how many rows of the series come before it and up to its end.
    sizes = blocked.groupBy(*cell).agg(F.count("*").alias("_n"))
    in_order = Window.partitionBy(*keys).orderBy("_block")
    sizes = sizes.withColumn("_end", F.sum("_n").over(in_order)).withColumn("_start", F.col("_end") - F.col("_n"))
    # Every block has a row, so at most `halo` later blocks can need rows of this one.
    later = F.collect_list(F.struct(F.col("_block").alias("b"), F.col("_start").alias("s")))
    sizes = sizes.withColumn("_later", later.over(in_order.rowsBetween(1, halo)))

    tails = top_n(blocked, cell, [F.desc(order)], halo, "_from_end")
    same = [F.col(f"t.{c}").eqNullSafe(F.col(f"s.{c}")) for c in cell]
    borrowed = (
        tails.alias("t")
        .join(sizes.alias("s"), same)
        .select("t.*", "s._end", F.explode("s._later").alias("_to"))
        .where(F.col("_from_end") + F.col("_to.s") - F.col("_end") <= halo)
        .withColumn("_block", F.col("_to.b"))
        .select(*blocked.columns, F.lit(True).alias("_halo"))
    )
    whole = blocked.withColumn("_halo", F.lit(False)).unionByName(borrowed)
    done = _evaluate(whole, cell, measures, order, guard=keys)
    return done.where(~F.col("_halo")).drop("_halo", "_block")


def previous_value(
    df: DataFrame, keys: list[str], value: str, name: str, order: str = "date", block_days: int | None = None
) -> DataFrame:
    """The value of the preceding row of the series: a trailing window of that one row."""
    return add_trailing(df, keys, [Trailing(name, "max", value, -1, -1)], order, block_days)
