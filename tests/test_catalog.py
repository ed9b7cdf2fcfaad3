"""Catalog queries against their SQL on the smallest folder; the comparer runs all of them."""

import os

import pytest

FOLDER = "/root/testdata/sf0.001"
NAMES = [
    "kpi_panel_events", "labelled_panel", "monitoring_table_blocked", "kpi_health_by_day", "zscore_events", "wide_worst",
    "residual_ridge_univariate", "residual_robust_mad", "detector_evaluation", "rca_contributions", "rca_top_causes",
    "incident_records", "incident_selection", "quality_checks", "table_assertions", "dim_members", "fact_incidents",
    "report_executive_rollup", "run_summary",
]

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables absent")


@pytest.fixture(scope="module")
def connection():
    from compare import connect

    return connect(FOLDER)


@pytest.mark.parametrize("name", NAMES)
def test_matches_sql(spark, connection, name):
    from compare import compare

    assert compare(spark, connection, name, FOLDER).startswith("ok")


def test_every_sql_has_a_query():
    from __spark_entry__ import queries
    from oracle import ORACLE

    assert set(ORACLE) <= set(queries())


def test_entry(spark):
    from __spark_entry__ import entry

    assert entry(spark).count() == 150
