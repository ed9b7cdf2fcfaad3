"""Ranking that does not put an unbounded group into one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from metrivane.operators import sums
from metrivane.session import stage

_LOW_BITS = (1 << 33) - 1  # monotonically_increasing_id: partition id above, row index below


def top_n(df: DataFrame, group: list[str], order: list[Column], n: int, rank: str | None = None) -> DataFrame:
    """First ``n`` rows of each group.

    The ``row_number <= n`` filter lets Spark cut each map task's groups to ``n``
    rows before the shuffle, so a hot group arrives as ``n`` rows per task.
    """
    name = rank or "_rank"
    ranked = df.withColumn(name, F.row_number().over(Window.partitionBy(*group).orderBy(*order)))
    ranked = ranked.where(F.col(name) <= n)
    return ranked if rank else ranked.drop(name)


def rank_with_totals(
    df: DataFrame, group: list[str], amount: str, ties: list[str | Column], rank: str, total: str
) -> DataFrame:
    """Rank rows of a group by ``amount`` descending and attach the group's sum of ``amount``.

    One sort by group, amount and ties, range-partitioned, is staged: a group that holds most rows, or one amount in all its
    rows, is spread over as many partitions as its rows need.  A row's rank is its place among its group's rows in its
    partition, after those in earlier partitions; these are counted per (partition, group).  Equal amounts
    must be equal doubles: take them from ``sums.exact_sum``.
    """
    # the group is compared as one struct value, in which NULL members are equal
    grouped = df.withColumn("_group", F.struct(*group))
    sorted_rows = grouped.orderBy(*group, F.desc(amount), *ties).withColumn("_at", F.monotonically_increasing_id())
    placed = stage(sorted_rows)
    placed = placed.withColumns({"_part": F.shiftright("_at", 33), "_row": F.col("_at").bitwiseAND(_LOW_BITS)})
    parts = placed.groupBy("_part", "_group").agg(
        F.count("*").alias("_n"), F.min("_row").alias("_first"), *[F.sum(n).alias(f"_s{i}") for i, n in enumerate(sums.numbers(amount))]
    )
    whole = Window.partitionBy("_group")  # a row for each partition that the group reaches
    before = F.coalesce(F.sum("_n").over(whole.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    totals = sums.value([F.sum(f"_s{i}").over(whole) for i in range(sums.NUMBERS)])
    offsets = parts.select("_part", "_group", (before - F.col("_first") + 1).alias("_shift"), totals.alias(total))
    joined = placed.join(offsets, ["_part", "_group"])  # adaptive execution broadcasts the offsets where they are few
    return joined.withColumn(rank, (F.col("_row") + F.col("_shift")).cast("int")).drop("_group", "_at", "_part", "_row", "_shift")


def global_row_number(df: DataFrame, order: list[str], name: str) -> DataFrame:
    """Dense 1..n over the whole table without a single-task sort.

    A range-partitioned sort is staged, each partition's row count becomes the
    next partition's offset (one row per partition, hence broadcast).
    """
    position = F.monotonically_increasing_id()
    placed = stage(df.orderBy(*order).withColumn("_at", position))
    placed = placed.withColumn("_part", F.shiftright("_at", 33)).withColumn("_row", F.col("_at").bitwiseAND(_LOW_BITS))
    counts = placed.groupBy("_part").agg(F.count("*").alias("_n"))
    upto = Window.orderBy("_part")
    offsets = counts.select("_part", (F.sum("_n").over(upto) - F.col("_n")).alias("_before"))
    return (
        placed.join(F.broadcast(offsets), "_part")
        .withColumn(name, F.col("_before") + F.col("_row") + 1)
        .drop("_part", "_row", "_at", "_before")
    )
