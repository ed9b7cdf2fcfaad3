"""Joins whose broadcast side is measured first."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BROADCAST_ROWS = 200_000


def small_enough(df: DataFrame, limit: int = BROADCAST_ROWS) -> bool:
    """Whether ``df`` has at most ``limit`` rows; looks at no more than ``limit`` + 1 of them.

    Call it on staged or stored tables: the count runs at once.
    """
    return df.limit(limit + 1).count() <= limit


def hinted(df: DataFrame, limit: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` with a broadcast hint when it is small, else as it is.

    Beyond the limit the join is a shuffle join, where adaptive execution splits
    the partitions of hot keys.
    """
    return F.broadcast(df) if small_enough(df, limit) else df


def with_one_row(df: DataFrame, one: DataFrame) -> DataFrame:
    """Attach the columns of a global aggregate, which has exactly one row."""
    return df.crossJoin(F.broadcast(one))


def null_safe_left(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Left join in which NULL keys match NULL keys."""
    renamed = right.select(*[F.col(k).alias(f"_r_{k}") for k in keys], *[c for c in right.columns if c not in keys])
    cond = [F.col(k).eqNullSafe(F.col(f"_r_{k}")) for k in keys]
    return left.join(renamed, cond, "left").drop(*[f"_r_{k}" for k in keys])
