"""Sums of doubles that do not depend on the order of their rows.

A double is written as whole numbers, each worth 2 ** 24 of the next; those are summed as integers and put together at
the end.  So members with the same amounts have the same sum to the last bit, whatever partitions they lie in, and sums may be
ordered and compared as they are.  Exact for amounts from about 1e-28 to 1e55; of smaller ones what lies below 1e-44 is rounded off, always alike.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

BITS = 24
HIGHEST = 5  # the first number counts 2 ** (24 * HIGHEST)
NUMBERS = 12


def numbers(amount: Column | str) -> list[Column]:
    """The whole numbers of an amount, largest first."""
    x = F.col(amount) if isinstance(amount, str) else amount
    scaled = [F.rint(x.cast("double") * 2.0 ** (BITS * (i - HIGHEST))) for i in range(NUMBERS)]
    return [scaled[0].cast("bigint"), *[(b - a * 2.0**BITS).cast("bigint") for a, b in zip(scaled, scaled[1:])]]


def value(sums: list[Column]) -> Column:
    """The double that sums of numbers stand for, rounded alike for equal totals."""

    def carry(done: Column, s: Column) -> Column:
        """What is over 24 bits of the number before goes to this one."""
        low = F.element_at(done, 1)
        rest = F.slice(done, F.lit(2), F.size(done))
        return F.concat(F.array(s + F.shiftright(low, BITS)), F.array(low.bitwiseAND(F.lit((1 << BITS) - 1))), rest)

    low_first = list(reversed(sums))
    clean = F.aggregate(F.array(*low_first[1:]), F.array(low_first[0]), carry)
    worth = F.array(*[F.lit(2.0 ** (BITS * (HIGHEST - i))) for i in range(NUMBERS)])
    return F.aggregate(F.zip_with(clean, worth, lambda n, w: n * w), F.lit(0.0), lambda a, x: a + x)


def exact_sum(amount: Column | str) -> Column:
    """An aggregate: the sum of the amounts, NULL without any."""
    return value([F.sum(n) for n in numbers(amount)])


def exact_avg(amount: Column | str) -> Column:
    """An aggregate: the mean from the exact sum."""
    x = F.col(amount) if isinstance(amount, str) else amount
    return F.try_divide(exact_sum(x), F.count(x))
