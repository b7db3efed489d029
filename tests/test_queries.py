"""Every registered query against its SQL, on whole tables."""

from __future__ import annotations

import os

import pytest

import __spark_entry__ as entry_points
from tests.compare import connect, mismatch

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no benchmark tables")


@pytest.fixture(scope="module")
def duck():
    con = connect(SF_DIR)
    yield con
    con.close()


@pytest.mark.parametrize("name", list(entry_points.REGISTRY))
def test_query_agrees_with_its_sql(spark, duck, name):
    assert mismatch(spark, duck, entry_points.queries()[name], entry_points.oracle_sql()[name], SF_DIR) is None


def test_results_do_not_depend_on_the_session_zone(spark, duck):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        for name in ("fact_orders", "trip_metrics", "clean_telemetry", "epoch_millis", "weekly_warehouse"):
            assert mismatch(spark, duck, entry_points.queries()[name], entry_points.oracle_sql()[name], SF_DIR) is None, name
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_entry(spark):
    assert entry_points.entry(spark).count() > 0
