"""Data-quality checks of a table against its contract.

All per-row checks are counters of one aggregate, so a table is scanned once for
them; dates and volume come from per-day counts, duplicates from per-key counts.
A table is thus read three times: pass a stored or staged one.
The result is one row per check; ``report`` rolls it up.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from metrivane.config import CHECK_WEIGHTS, Contract
from metrivane.functions.scalars import day, half_even, is_flag, lookup, number, percent_text
from metrivane.operators.joins import with_one_row
from metrivane.operators.ranking import top_n


def _invalid(column: str, kind: str) -> Column:
    """Whether a cell cannot be read as its declared type."""
    if kind == "date":
        return day(column).isNull()
    if kind == "integer":
        n = number(column)
        infinite = F.abs(n) == float("inf")
        return F.coalesce(infinite | (n % 1 != 0), F.lit(True))
    if kind == "number":
        return number(column).isNull()
    if kind == "boolean":
        return ~is_flag(column)
    return F.col(column).isNull()


def _missing(df: DataFrame, column: str) -> Column:
    kind = dict(df.dtypes)[column]
    absent = F.col(column).isNull()
    return absent | F.isnan(column) if kind in ("double", "float") else absent


def _out_of_range(column: str, low, high) -> Column:
    n = number(column)
    bad = n.isNull()
    if low is not None:
        bad = bad | (n < low)
    if high is not None:
        bad = bad | (n > high)
    return F.coalesce(bad, F.lit(True))


def _present(df: DataFrame, names) -> list[str]:
    return [c for c in names if c in df.columns]


def cell_counts(df: DataFrame, contract: Contract) -> DataFrame:
    """One row: the row count and, per check, an array of failing-cell counts by column."""
    types = _present(df, contract.types)
    nulls = _present(df, contract.non_null)
    ranges = _present(df, contract.ranges)
    accepted = _present(df, contract.accepted)
    counters = [F.count("*").alias("rows")]
    counters += [F.count_if(_invalid(c, contract.types[c])).alias(f"_t{i}") for i, c in enumerate(types)]
    counters += [F.count_if(_missing(df, c)).alias(f"_n{i}") for i, c in enumerate(nulls)]
    counters += [F.count_if(_out_of_range(c, *contract.ranges[c])).alias(f"_r{i}") for i, c in enumerate(ranges)]
    counters += [F.count_if(~_is_accepted(c, contract)).alias(f"_a{i}") for i, c in enumerate(accepted)]

    def failures(prefix, names):
        pairs = [x for i, c in enumerate(names) for x in (F.lit(c), F.col(f"{prefix}{i}"))]
        full = F.create_map(*pairs) if pairs else F.create_map().cast("map<string,bigint>")
        return F.map_filter(full, lambda _, n: n > 0)

    return df.agg(*counters).select(
        "rows",
        failures("_t", types).alias("type_failures"),
        failures("_n", nulls).alias("null_failures"),
        failures("_r", ranges).alias("range_failures"),
        failures("_a", accepted).alias("accepted_failures"),
    )


def day_counts(df: DataFrame) -> DataFrame:
    """One row: observed days, first and last day, fewest rows on a day."""
    if "date" not in df.columns:
        return df.sparkSession.range(1).select(
            F.lit(0).cast("bigint").alias("days"),
            F.lit(None).cast("date").alias("first_day"),
            F.lit(None).cast("date").alias("last_day"),
            F.lit(0).cast("bigint").alias("fewest"),
        )
    per_day = df.select(day("date").alias("d")).where(F.col("d").isNotNull()).groupBy("d").agg(F.count("*").alias("n"))
    return per_day.agg(
        F.count("*").alias("days"),
        F.min("d").alias("first_day"),
        F.max("d").alias("last_day"),
        F.coalesce(F.min("n"), F.lit(0)).alias("fewest"),
    )


def duplicate_groups(df: DataFrame, key: list[str]) -> DataFrame:
    """Key values that occur more than once, with their number of rows."""
    return df.groupBy(*key).agg(F.count("*").alias("copies")).where(F.col("copies") > 1)


def duplicate_sample(df: DataFrame, key: list[str], n: int = 5) -> DataFrame:
    """A few duplicated keys, the smallest first."""
    return duplicate_groups(df, key).orderBy(*key).limit(n)


def _accepted_text(values) -> list[str]:
    return [str(v).lower() if isinstance(v, bool) else str(v) for v in values]


def _as_text(column: str, values) -> Column:
    """The cell as text; flags are compared without case, as text scans spell them True or true."""
    text = F.col(column).cast("string")
    return F.lower(text) if values and all(isinstance(v, bool) for v in values) else text


def _is_accepted(column: str, contract: Contract) -> Column:
    """Whether a cell is in its accepted list; a missing cell passes."""
    values = contract.accepted[column]
    hit = _as_text(column, values).isin(*_accepted_text(values))
    return F.coalesce(hit, F.lit(True))


def offending_values(df: DataFrame, contract: Contract, n: int = 10) -> DataFrame:
    """Values outside the accepted lists: (column, value, rows, position), first ``n`` per column.

    Distinct offenders are counted distributed; only ``n`` per column are kept.
    """
    columns = _present(df, contract.accepted)
    if not columns:
        return df.sparkSession.createDataFrame([], "column string, value string, rows bigint, position int")
    pairs = [
        F.struct(
            F.lit(c).alias("column"),
            F.when(~_is_accepted(c, contract), _as_text(c, contract.accepted[c])).alias("value"),
        )
        for c in columns
    ]
    cells = df.select(F.inline(F.array(*pairs))).where(F.col("value").isNotNull())
    counted = cells.groupBy("column", "value").agg(F.count("*").alias("rows"))
    return top_n(counted, ["column"], [F.col("value")], n, "position")


def _score(bad: Column, cells: Column) -> Column:
    return F.greatest(F.lit(0.0), 1 - bad / F.greatest(cells, F.lit(1)))


def _total(name: str) -> Column:
    return F.aggregate(F.map_values(name), F.lit(0).cast("bigint"), lambda a, v: a + v)


def run_checks(df: DataFrame, contract: Contract, as_of: dt.date | str) -> DataFrame:
    """One row per check: check, passed, score, weight, issue_count, failures, summary."""
    missing = [c for c in contract.required if c not in df.columns]
    key = _present(df, contract.key)
    facts = with_one_row(cell_counts(df, contract), day_counts(df))
    copies = (
        duplicate_groups(df, key).agg(F.coalesce(F.sum("copies"), F.lit(0)).alias("copies"))
        if key
        else df.sparkSession.range(1).select(F.lit(0).cast("bigint").alias("copies"))
    )
    facts = with_one_row(facts, copies)

    rows, today = F.col("rows"), F.lit(str(as_of)).cast("date")
    none = F.create_map().cast("map<string,bigint>")
    age = F.datediff(today, "last_day")
    span = F.coalesce(F.datediff("last_day", "first_day") + 1, F.lit(0))
    coverage = F.when(F.col("days") == 0, 0.0).otherwise(
        F.col("days") / F.greatest(span, F.lit(contract.min_days), F.lit(1))
    )
    fresh = F.coalesce(age <= contract.max_age_days, F.lit(False))
    complete = (coverage >= contract.min_coverage) & (F.col("days") >= contract.min_days)
    voluminous = (rows >= contract.min_rows) & (F.col("fewest") >= contract.min_rows_per_day)

    def part(actual, wanted):
        return F.least(F.lit(1.0), actual / F.lit(wanted)) if wanted else F.lit(1.0)

    def cells(name, columns):
        bad = _total(name)
        return bad == 0, _score(bad, rows * max(len(columns), 1)), bad, F.col(name)

    clean = F.size("accepted_failures") == 0
    one = F.lit(1.0)
    checks = {
        "schema": (F.lit(not missing), F.lit(0.0 if missing else 1.0), F.lit(len(missing)), none),
        "data_types": cells("type_failures", _present(df, contract.types)),
        "accepted_values": (
            clean, F.when(clean, 1.0).otherwise(0.0), F.size("accepted_failures"), F.col("accepted_failures"),
        ),
        "nulls": cells("null_failures", _present(df, contract.non_null)),
        "duplicates": (
            (F.col("copies") == 0) & F.lit(bool(key)),
            F.greatest(F.lit(0.0), 1 - F.coalesce(F.try_divide("copies", "rows"), F.lit(0.0))) if key else F.lit(0.0),
            F.col("copies"),
            none,
        ),
        "freshness": (fresh, F.when(fresh, 1.0).otherwise(0.0), F.coalesce(age, F.lit(-1)), none),
        "completeness": (
            complete,
            F.least(one, F.greatest(F.lit(0.0), coverage / contract.min_coverage)) if contract.min_coverage else one,
            F.col("days"),
            none,
        ),
        "volume": (
            voluminous,
            F.least(part(rows, contract.min_rows), part(F.col("fewest"), contract.min_rows_per_day)),
            F.col("fewest"),
            none,
        ),
        "numeric_ranges": cells("range_failures", _present(df, contract.ranges)),
    }
    # The sentence of a passed and of a failed check.
    text = {
        "schema": ("Required schema present", f"Missing required columns: {missing}"),
        "data_types": ("Data types are parseable", "Data type parse failures"),
        "accepted_values": ("Accepted value checks passed", "Invalid categorical values"),
        "nulls": ("No required-field nulls found", "Required-field nulls found"),
        "duplicates": ("No duplicate business keys found", "Duplicate business-key rows found"),
        "freshness": ("Freshness check passed", "Latest data is too old or undated"),
        "completeness": ("Date completeness check passed", "Date completeness below expectation"),
        "volume": ("Volume check passed", "Volume below configured expectation"),
        "numeric_ranges": ("Numeric range checks passed", "Numeric range failures"),
    }
    rows_out = [
        F.struct(
            F.lit(name).alias("check"),
            passed.alias("passed"),
            score.cast("double").alias("score"),
            F.lit(CHECK_WEIGHTS[name]).alias("weight"),
            count.cast("bigint").alias("issue_count"),
            failures.alias("failures"),
            F.when(passed, text[name][0]).otherwise(text[name][1]).alias("summary"),
        )
        for name, (passed, score, count, failures) in checks.items()
    ]
    return facts.select(F.inline(F.array(*rows_out)))


def report(checks: DataFrame) -> DataFrame:
    """One row: status, health score and the summaries of failed checks."""
    lost = F.sum(F.col("weight") * (1 - F.col("score")))
    score = F.greatest(F.lit(0), F.least(F.lit(100), half_even(100 - lost).cast("int")))
    place = lookup("check", {name: i for i, name in enumerate(CHECK_WEIGHTS)})
    failed = F.sort_array(F.collect_list(F.when(~F.col("passed"), F.struct(place.alias("at"), "summary"))))
    rolled = checks.agg(score.alias("health_score"), F.transform(failed, lambda x: x["summary"]).alias("issues"))
    healthy = (F.col("health_score") >= 90) & (F.size("issues") == 0)
    return rolled.select(
        F.when(healthy, "PASS").otherwise("FAIL").alias("status"), healthy.alias("is_healthy"), "health_score", "issues"
    )


def gate(df: DataFrame, min_rows: int, max_null_fraction: float) -> DataFrame:
    """The light gate: too few rows cost 30, too many NULLs in any column cost 40; below 70 fails."""
    worst = F.greatest(*[F.avg(_missing(df, c).cast("int")) for c in df.columns], F.lit(0.0))
    facts = df.agg(F.count("*").alias("actual_records"), F.coalesce(worst, F.lit(0.0)).alias("max_null_percentage"))
    low = F.col("actual_records") < min_rows
    nulls = F.col("max_null_percentage") > max_null_fraction
    score = 100 - F.when(low, 30).otherwise(0) - F.when(nulls, 40).otherwise(0)
    high = F.concat(F.lit("High Nulls ("), percent_text("max_null_percentage"), F.lit("%)"))
    issues = F.array_compact(F.array(F.when(low, "Low volume"), F.when(nulls, high)))
    return facts.select(
        "actual_records",
        half_even("max_null_percentage", 4).alias("max_null_percentage"),
        (~low).alias("volume_passed"),
        (~nulls).alias("nulls_passed"),
        score.alias("health_score"),
        F.when(score < 70, "FAIL").otherwise("PASS").alias("status"),
        (score >= 70).alias("is_healthy"),
        issues.alias("issues"),
    )


def coverage(df: DataFrame, series: list[str], expected_series: int, failures: int = 0) -> DataFrame:
    """How much of the expected series x observed days grid arrived."""
    # one row per series, one per day: both pre-aggregated before they are counted
    per_series = df.groupBy(*series).agg(F.count("*").alias("_n"))
    totals = per_series.agg(F.sum("_n").alias("rows"), F.count("*").alias("observed_series"))
    days = df.groupBy(day("date").alias("d")).agg(F.lit(1).alias("_one")).agg(F.count("d").alias("observed_days"))
    facts = with_one_row(totals, days)
    share = F.coalesce(F.try_divide("rows", F.lit(expected_series) * F.col("observed_days")), F.lit(0.0))
    good = (share >= 0.98) & F.lit(failures == 0)
    percent = half_even(share * 100, 2)
    return facts.select(
        percent.alias("health_score"),
        F.when(good, "PASS").otherwise("FAIL").alias("status"),
        F.lit(expected_series).alias("expected_series"),
        "observed_series",
        "observed_days",
        percent.alias("coverage_pct"),
        F.lit(failures).alias("fetch_failures"),
    )
