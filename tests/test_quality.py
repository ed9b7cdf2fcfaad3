import datetime as dt

import pytest
from pyspark.sql import functions as F

from metrivane.config import Contract, load_contract
from metrivane.operators import assertions, labels, quality

DAYS = 30
AS_OF = dt.date(2024, 2, 2)
CONTRACT = Contract(
    name="t",
    column_order=("date", "kpi_name", "region", "orders", "kpi_value", "is_incident"),
    required=("date", "kpi_name", "region", "orders", "kpi_value", "is_incident"),
    types={"date": "date", "kpi_name": "string", "region": "string", "orders": "integer", "kpi_value": "number",
           "is_incident": "boolean"},
    accepted={"region": ("EMEA", "APAC"), "is_incident": (True, False)},
    non_null=("date", "region", "kpi_value"),
    key=("date", "kpi_name", "region"),
    max_age_days=14,
    min_coverage=0.98,
    min_days=DAYS,
    min_rows=60,
    min_rows_per_day=2,
    ranges={"orders": (0, None), "kpi_value": (0, 10)},
)
SCHEMA = "date string, kpi_name string, region string, orders string, kpi_value string, is_incident string"


def valid(spark, days=DAYS):
    rows = [
        ((dt.date(2024, 1, 1) + dt.timedelta(days=d)).isoformat(), "conversion_rate", region, "3", "0.5", "False")
        for d in range(days)
        for region in ("EMEA", "APAC")
    ]
    return spark.createDataFrame(rows, SCHEMA)


def outcome(df, contract=CONTRACT, as_of=AS_OF):
    checks = quality.run_checks(df, contract, as_of)
    rows = {r.check: r for r in checks.collect()}
    return rows, quality.report(checks).first()


def one_cell(df, column, value):
    hit = (F.col("date") == "2024-01-05") & (F.col("region") == "EMEA")
    return df.withColumn(column, F.when(hit, value).otherwise(F.col(column)))


def test_valid_table_passes(spark):
    rows, report = outcome(valid(spark))
    assert all(r.passed and r.score == 1.0 for r in rows.values()) and len(rows) == 9
    assert (report.status, report.health_score, report.issues) == ("PASS", 100, [])


@pytest.mark.parametrize(
    "column, value, check, count",
    [("kpi_value", None, "nulls", 1), ("region", "Mars", "accepted_values", 1), ("orders", "2.5", "data_types", 1),
     ("orders", "x", "data_types", 1), ("date", "never", "data_types", 1), ("is_incident", "maybe", "data_types", 1),
     ("kpi_value", "11", "numeric_ranges", 1), ("orders", "-1", "numeric_ranges", 1), ("kpi_value", "", "numeric_ranges", 1)],
)
def test_single_faults(spark, column, value, check, count):
    rows, report = outcome(one_cell(valid(spark), column, F.lit(value)))
    assert not rows[check].passed and rows[check].issue_count == count
    assert report.status == "FAIL" and report.health_score < 101


def test_duplicate_counts_every_copy(spark):
    df = valid(spark)
    rows, _ = outcome(df.union(df.limit(1)))
    assert rows["duplicates"].issue_count == 2 and rows["duplicates"].score == pytest.approx(1 - 2 / 61)
    assert quality.duplicate_sample(df.union(df.limit(1)), list(CONTRACT.key)).count() == 1


def test_missing_column_staleness_and_gaps(spark):
    rows, report = outcome(valid(spark).drop("orders"))
    assert not rows["schema"].passed and report.health_score == 80 and "orders" in rows["schema"].summary
    rows, report = outcome(valid(spark), as_of=dt.date(2024, 3, 1))
    assert not rows["freshness"].passed and rows["freshness"].issue_count == 31 and report.health_score == 90
    assert report.status == "FAIL"  # any failed check fails, whatever the score
    rows, _ = outcome(valid(spark).where("date not in ('2024-01-05', '2024-01-06')"))
    assert not rows["completeness"].passed and not rows["volume"].passed
    assert rows["completeness"].score == pytest.approx(28 / 30 / 0.98)
    rows, _ = outcome(valid(spark).where("not (date = '2024-01-05' and region = 'EMEA')"))
    assert rows["volume"].score == 0.5
    rows, _ = outcome(valid(spark).drop("date"))
    assert not rows["freshness"].passed and rows["completeness"].score == 0.0


def test_empty_table_and_empty_contract(spark):
    rows, report = outcome(valid(spark).where("false"))
    assert not rows["freshness"].passed and report.status == "FAIL"
    rows, _ = outcome(valid(spark), Contract())
    assert not rows["duplicates"].passed and rows["data_types"].passed


def test_offending_values_are_sorted_and_cut(spark):
    df = spark.createDataFrame([(f"v{i:02d}",) for i in range(15)] + [("EMEA",), (None,)], "region string")
    out = quality.offending_values(df, Contract(accepted={"region": ("EMEA",)})).orderBy("position").collect()
    assert [r.value for r in out] == [f"v{i:02d}" for i in range(10)]


def test_gate(spark):
    df = spark.createDataFrame([(1.0,)] * 9 + [(None,)], "x double")
    assert tuple(quality.gate(df, 5, 0.2).first())[4:] == (100, "PASS", True, [])
    assert tuple(quality.gate(df, 20, 0.01).first()) == (
        10, 0.1, False, False, 30, "FAIL", False, ["Low volume", "High Nulls (10.0%)"])


def test_coverage(spark):
    df = spark.createDataFrame([("2024-01-01", "a"), ("2024-01-01", "b"), ("2024-01-02", "a")], "date string, s string")
    row = quality.coverage(df, ["s"], 2).first()
    assert (row.coverage_pct, row.status, row.observed_series, row.observed_days) == (75.0, "FAIL", 2, 2)
    assert quality.coverage(df.limit(2), ["s"], 2, failures=1).first().status == "FAIL"


def test_assertions(spark):
    df = spark.createDataFrame([(1, "a", 0.5), (1, "b", 1.5), (None, "a", None)], "k int, v string, x double")
    dim = spark.createDataFrame([(2,)], "k int")
    tests = {
        "null": (assertions.not_null(df, "k"), 1),
        "unique": (assertions.unique(df, "k"), 1),
        "pair": (assertions.unique_combination(df, ["k", "v"]), 0),
        "values": (assertions.accepted_values(df, "v", ["a"]), 1),
        "bounds": (assertions.bounds(df, "x"), 1),
        "related": (assertions.relationship(df, "k", dim, "k"), 1),
    }
    out = {r.assertion: r for r in assertions.run([(n, rows) for n, (rows, _) in tests.items()]).collect()}
    assert {n: r.violations for n, r in out.items()} == {n: c for n, (_, c) in tests.items()}
    assert out["pair"].passed and not out["null"].passed
    table = {r.table: r for r in assertions.integrity({"f": df, "d": dim, "e": dim.limit(0)}, {"f": ["k"]}).collect()}
    assert (table["f"].null_key_rows, table["d"].passed, table["e"].passed) == (1, True, False)


def test_label_windows(spark):
    df = spark.createDataFrame([("2024-01-0%d" % d, k, "x") for d in range(1, 6) for k in ("a", "b")], "date string, kpi_name string, dim string")
    df = df.withColumn("date", F.col("date").cast("date"))
    rules = spark.createDataFrame(
        [("R2", "t2", "second", "2024-01-03", "2024-01-04", "a", None), ("R1", "t1", "first", "2024-01-02", "2024-01-03", "a", "x"),
         ("R3", "t3", "never", "2024-01-01", "2024-01-05", "a", "y")],
        "incident_id string, incident_type string, incident_description string, start_date string, end_date string, kpi_name string, dim string",
    ).withColumns({c: F.col(c).cast("date") for c in ("start_date", "end_date")})
    out = {(r.date.day, r.kpi_name): r for r in labels.label_windows(df, rules, ["kpi_name", "dim"]).collect()}
    assert len(out) == 10
    assert out[3, "a"].incident_id == "R1|R2" and out[3, "a"].incident_description == "first second"
    assert out[2, "a"].incident_type == "t1" and out[4, "a"].incident_type == "t2"
    assert not out[1, "a"].is_incident and out[3, "b"].incident_id == ""


def test_contract_file(tmp_path):
    path = tmp_path / "contract.yaml"
    path.write_text("dataset: {name: d}\nduplicate_key: [a]\nnumeric_ranges: {x: {min: 1}}\ndata_types: {x: number}\n")
    c = load_contract(path)
    assert (c.name, c.key, c.ranges, c.types) == ("d", ("a",), {"x": (1, None)}, {"x": "number"})
    assert load_contract(tmp_path / "absent.yaml") == Contract()


def test_label_windows_against_every_rule(spark):
    """Random rules with wildcards, long and short windows, repeated rules and NULL members, against a plain loop."""
    import datetime as dt
    import random

    rng = random.Random(5)
    first = dt.date(1969, 12, 20)
    day = lambda n: first + dt.timedelta(days=n)
    rules = []
    for i in range(60):
        start = rng.randint(0, 40)
        end = start + rng.choice([0, 1, 6, 30, 4000, -1])
        rules.append((f"I{rng.randint(0, 30):02d}", "t", f"d{i % 7}", day(start), day(end), rng.choice([None, "a", "b"]), rng.choice([None, "x", "y"])))
    rules += rules[:3]
    rows = [(day(n) if n < 70 else None, k, d) for n in range(0, 71, 2) for k in ("a", "b", None) for d in ("x", "z")] * 2
    df = spark.createDataFrame(rows, "date date, kpi_name string, dim string")
    schema = "incident_id string, incident_type string, incident_description string, start_date date, end_date date, kpi_name string, dim string"
    out = labels.label_windows(df, spark.createDataFrame(rules, schema), ["kpi_name", "dim"]).collect()
    assert len(out) == len(rows)
    for r in out:
        fits = sorted(
            (x for x in rules if r.date and x[3] <= r.date <= x[4] and x[5] in (None, r.kpi_name) and x[6] in (None, r.dim)),
            key=lambda x: (x[0], x[1], x[2], x[3], x[4], x[5] or "", x[6] or ""),
        )
        assert (r.is_incident, r.incident_id) == (bool(fits), "|".join(x[0] for x in fits))
        assert r.incident_description == " ".join(x[2] for x in fits)


def test_many_rules_on_one_day(spark):
    rules = spark.range(100_000).selectExpr(
        "concat('I', id) as incident_id", "'t' as incident_type", "'d' as incident_description", "date'2024-01-05' as start_date",
        "date'2024-01-05' as end_date", "concat('k', id) as kpi_name", "cast(null as string) as dim",
    )
    rows = spark.range(20_000).selectExpr("date'2024-01-05' as date", "concat('k', id * 10) as kpi_name", "'x' as dim")
    out = labels.label_windows(rows, rules, ["kpi_name", "dim"])
    assert out.where("is_incident").count() == 10_000
    assert "_rules" not in out.columns and out.count() == 20_000
