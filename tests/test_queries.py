"""Every registered query against its SQL, and the shape of its plan."""

import os

import pytest

import __spark_entry__ as entry
from check import compare
from ledgerlake import catalog, oracles

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables here")


def test_every_query_has_sql():
    assert set(catalog.QUERIES) == set(oracles.queries())
    assert set(catalog.QUERIES) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query_agrees_with_sql(spark, name):
    verdict, rows, _ = compare(spark, FOLDER, name, entry.oracle_sql()[name])
    assert verdict == "same"
    assert rows > 0


def test_entry_returns_rows(spark):
    assert entry.entry(spark).limit(1).count() == 1


def plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize(
    "name",
    ["fact_sales", "staging_upsert", "scd2_customer", "sales_daily", "category_analysis",
     "customer_segments", "daily_quality_summary", "revenue_by_date_product"],
)
def test_no_cartesian_or_python_in_plans(spark, name):
    text = plan(entry.queries()[name](spark, FOLDER))
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "Pandas"):
        assert operator not in text


def test_scans_read_only_what_is_needed(spark):
    text = plan(entry.queries()["quality_trend"](spark, FOLDER))
    assert "props" not in text
    scans = [line for line in text.splitlines() if "FileScan" in line]
    products = plan(entry.queries()["sales_by_category"](spark, FOLDER))
    assert scans and "l_discount" not in products and "p_name" not in products


def test_big_dimensions_are_not_broadcast(spark):
    """Without small inputs every join has a shuffled plan: nothing is forced."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for name in ("fact_sales", "product_performance", "customer_segments"):
            frame = entry.queries()[name](spark, FOLDER)
            assert "Broadcast" not in plan(frame)
            assert compare(spark, FOLDER, name, entry.oracle_sql()[name])[0] == "same"
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
