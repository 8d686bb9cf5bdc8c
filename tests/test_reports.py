from datetime import datetime
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from ledgerlake.plans import ingestion, quality, views

RUN = (
    "source_name string, source_type string, records_received bigint, records_stored bigint,"
    " records_rejected bigint, extraction_started_at timestamp, load_completed_at timestamp,"
    " error_message string"
)


@pytest.mark.parametrize(
    ("received", "stored", "rejected", "error", "score", "status"),
    [
        (100, 95, 5, None, "95.00", "partial"),
        (100, 100, 0, None, "100.00", "success"),
        (0, 0, 0, None, "100.00", "success"),
        (100, 50, 0, None, "50.00", "running"),
        (0, 0, 0, "lost", "100.00", "failed"),
        (3, 2, 1, None, "66.67", "partial"),
        (3, 2, 1, "", "66.67", "partial"),
    ],
)
def test_score_and_status(spark, received, stored, rejected, error, score, status):
    start, end = datetime(2024, 1, 1, 0, 0, 0, 900_000), datetime(2024, 1, 1, 0, 0, 2, 100_000)
    row = ("s", "api", received, stored, rejected, start, end, error)
    found = quality.with_run_measures(spark.createDataFrame([row], RUN)).first()
    assert (found["quality_score"], found["status"]) == (D(score), status)
    # Two second boundaries were crossed in 1.2 seconds.
    assert found["duration_seconds"] == 2


def test_runs_are_measured_and_summed_up(spark):
    began = datetime(2024, 1, 1)
    measured = [
        dict(source_name="a", source_type="api", records_received=100, records_stored=95, records_rejected=5),
        dict(source_name="b", source_type="csv", records_received=50, records_stored=50, records_rejected=0),
    ]
    times = ("extraction_started_at", "extraction_completed_at", "load_started_at", "load_completed_at")
    rows = [{**m, **{t: began for t in times}, "error_message": None} for m in measured]
    log = ingestion.run_log(spark, rows, "b1", F.current_timestamp(), "test")
    assert {r["source_name"]: r["status"] for r in log.collect()} == {"a": "partial", "b": "success"}
    total = quality.run_summary(log).filter("is_total").first()
    assert (total["received"], total["stored"], total["quality_score"]) == (150, 145, D("96.67"))
    [detail] = ingestion.ragged_counts(log).collect()
    assert (detail["rejection_reason"], detail["rejection_count"]) == (ingestion.RAGGED, 5)


FACT = (
    "sale_key bigint, product_key bigint, customer_key bigint, quantity int,"
    " total_amount decimal(12,2), cost_amount decimal(12,2)"
)


def test_categories_can_ignore_case(spark):
    products = spark.createDataFrame(
        [(1, "Books", True), (2, "books", True), (3, None, True), (4, "Old", False)],
        "product_key bigint, category string, is_current boolean",
    )
    rows = [(i, i, 1, 1, D("10.00"), None) for i in (1, 2, 3, 4)]
    facts = spark.createDataFrame(rows, FACT)
    exact = views.sales_by_category(facts, products).collect()
    assert {r["category"]: r["orders"] for r in exact} == {"Books": 1, "books": 1, None: 1}
    loose = views.sales_by_category(facts, views.ignoring_case(products)).collect()
    assert sorted(r["orders"] for r in loose) == [1, 2]


def test_unknown_places_and_customers_without_sales(spark):
    customers = spark.createDataFrame(
        [(1, None, None, "New", True), (2, "Unknown", None, "New", True), (3, "West", "USA", "New", False)],
        "customer_key bigint, region string, country string, customer_segment string,"
        " is_current boolean",
    )
    facts = spark.createDataFrame([(1, 1, 1, 2, D("10.00"), D("4.00"))], FACT)
    rows = views.sales_by_region(facts, customers).collect()
    assert [(r["region"], r["country"]) for r in rows] == [("Unknown", "Unknown")] * 2
    assert sorted((r["orders"], r["revenue"]) for r in rows if r["revenue"]) == [(1, D("10.00"))]
    [segment] = views.customer_segments(facts, customers).collect()
    assert (segment["customer_count"], segment["total_orders"]) == (2, 1)


def test_no_facts_at_all(spark):
    empty = spark.createDataFrame([], FACT)
    row = views.sales_kpi_summary(empty).first()
    assert (row["total_orders"], row["total_revenue"], row["avg_order_value"]) == (0, None, None)
