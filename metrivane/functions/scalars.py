"""Column expressions shared by the operators.  All are built-in, codegen-able expressions."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from metrivane.config import SEVERITIES


def number(c: Column | str) -> Column:
    """Double, or NULL when the text is no number.  NaN becomes NULL: no stage emits NaN."""
    d = _c(c).try_cast("double")
    return F.when(~F.isnan(d), d)


def day(c: Column | str) -> Column:
    """Date, or NULL when the text is no date."""
    return _c(c).try_cast("date")


def flag(c: Column | str) -> Column:
    """Boolean parse of true/True/1; anything else, NULL included, is false."""
    return F.coalesce(_c(c).cast("string").isin("true", "True", "1"), F.lit(False))


def is_flag(c: Column | str) -> Column:
    """Whether the text is one of the accepted spellings of a boolean."""
    return F.coalesce(
        _c(c).cast("string").isin("true", "True", "1", "false", "False", "0"), F.lit(False)
    )


def ratio(a: Column | str, b: Column | str) -> Column:
    """a / b, NULL when b is 0 or NULL (plain ``/`` raises under ANSI mode)."""
    return F.try_divide(_c(a), _c(b))


def ratio_or_zero(a: Column | str, b: Column | str) -> Column:
    return F.coalesce(ratio(a, b), F.lit(0.0))


def severity_rank(c: Column | str) -> Column:
    """NORMAL and anything unknown 0, WARNING 1, CRITICAL 2."""
    c = _c(c)
    return F.when(c == "CRITICAL", 2).when(c == "WARNING", 1).otherwise(0)


def severity_label(rank: Column | str) -> Column:
    return F.element_at(F.array(*[F.lit(s) for s in SEVERITIES]), _c(rank).cast("int") + 1)


def banded_severity(score: Column, warning: Column | float, critical: Column | float) -> Column:
    """CRITICAL at or above ``critical``, WARNING at or above ``warning``; NULL score is NORMAL."""
    return (
        F.when(score >= critical, "CRITICAL").when(score >= warning, "WARNING").otherwise("NORMAL")
    )


def adverse(change: Column, direction: Column) -> Column:
    """``change`` turned so that a bad move is positive; NULL where the direction is NULL."""
    return F.when(direction == "higher_is_bad", change).when(direction == "lower_is_bad", -change)


def lookup(key: Column | str, table: Mapping, default=None) -> Column:
    """Constant lookup as a CASE chain; ``table`` comes from configuration, never from data."""
    key = _c(key)
    expr = None
    for k, v in table.items():
        expr = F.when(key == k, F.lit(v)) if expr is None else expr.when(key == k, F.lit(v))
    if expr is None:
        return F.lit(default)
    return expr.otherwise(F.lit(default))


def date_key(c: Column | str) -> Column:
    """yyyymmdd as an integer, by arithmetic (no string formatting per row)."""
    c = _c(c)
    return (F.year(c) * 10000 + F.month(c) * 100 + F.dayofmonth(c)).cast("int")


def title(c: Column | str) -> Column:
    return F.initcap(F.replace(_c(c), F.lit("_"), F.lit(" ")))


def half_even(c: Column | str, digits: int = 0) -> Column:
    """Round half to even, the rounding of the report figures."""
    return F.bround(_c(c), digits)


def fixed(c: Column | str, digits: int) -> Column:
    """Text with so many decimals; a tie goes to the even digit (of the shortest decimal spelling)."""
    return F.format_string(f"%.{digits}f", half_even(_c(c), digits))


def percent_text(share: Column | str) -> Column:
    return fixed(_c(share) * 100, 1)


def joined(columns, sep: str) -> Column:
    """Join values as text; a NULL member prints as ``nan`` rather than vanishing."""
    return F.concat_ws(sep, *[F.coalesce(_c(c).cast("string"), F.lit("nan")) for c in columns])


def all_present(columns) -> Column:
    cond = F.lit(True)
    for c in columns:
        cond = cond & _c(c).isNotNull()
    return cond


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c
