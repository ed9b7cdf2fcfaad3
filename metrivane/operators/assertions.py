"""Table assertions: each returns the violating rows (an empty result is a pass)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def not_null(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column).isNull())


def unique(df: DataFrame, column: str) -> DataFrame:
    """Non-NULL values that occur more than once."""
    return unique_combination(df.where(F.col(column).isNotNull()), [column])


def unique_combination(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.groupBy(*columns).agg(F.count("*").alias("row_count")).where(F.col("row_count") > 1)


def accepted_values(df: DataFrame, column: str, values) -> DataFrame:
    """Values outside the list with their number of rows; NULL passes."""
    return (
        df.where(~F.col(column).isin(*values)).groupBy(F.col(column).alias("value")).agg(F.count("*").alias("row_count"))
    )


def bounds(df: DataFrame, column: str, low: float = 0.0, high: float = 1.0) -> DataFrame:
    return df.where((F.col(column) < low) | (F.col(column) > high))


def relationship(fact: DataFrame, key: str, dim: DataFrame, dim_key: str) -> DataFrame:
    """Non-NULL fact keys that the dimension does not have.

    The fact's distinct keys are reduced map-side first, so the anti join moves
    keys, not fact rows, and a key shared by many rows is no hot spot.
    """
    keys = fact.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("row_count"))
    return keys.join(dim.select(F.col(dim_key).alias(key)), key, "left_anti")


def run(tests: list[tuple[str, DataFrame]]) -> DataFrame:
    """One row per named assertion: its violation count and outcome."""
    parts = [
        rows.agg(F.count("*").alias("violations")).select(F.lit(name).alias("assertion"), "violations")
        for name, rows in tests
    ]
    table = reduce(DataFrame.unionByName, parts)
    return table.withColumn("passed", F.col("violations") == 0)


def integrity(tables: dict[str, DataFrame], fact_keys: dict[str, list[str]]) -> DataFrame:
    """Per table: row count, whether it is empty, rows with a NULL key."""
    parts = []
    for name, df in tables.items():
        keys = fact_keys.get(name, [])
        dangling = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys], F.lit(False))
        parts.append(
            df.agg(F.count("*").alias("rows"), F.count_if(dangling).alias("null_key_rows")).select(
                F.lit(name).alias("table"), "rows", "null_key_rows"
            )
        )
    table = reduce(DataFrame.unionByName, parts)
    return table.withColumn("passed", (F.col("rows") > 0) & (F.col("null_key_rows") == 0))

