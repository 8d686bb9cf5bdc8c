"""Tables of the store in the session catalog, and the calendar's holidays."""

from datetime import date, timedelta

from pyspark.sql import functions as F

from ledgerlake.functions.calendar import HOLIDAYS, Holiday, dim_date, easter
from ledgerlake.schemas import TABLES
from ledgerlake.sources.store import Warehouse


def facts(spark, *rows):
    frame = spark.createDataFrame(rows, "sale_id string, year int, month int, total_amount double, cost_amount double")
    given = {c.name: F.lit(None).cast(c.dataType) for c in spark.createDataFrame([], TABLES["dw.fact_sales"]).schema}
    return frame.select(*[frame[c] if c in frame.columns else given[c].alias(c) for c in given])


def test_another_session_sees_later_loads(spark, tmp_path):
    store = Warehouse(spark, str(tmp_path), catalog="lake")
    store.publish()
    try:
        other = spark.newSession()

        def seen():
            other.sql("REFRESH TABLE lake_dw.fact_sales")
            rows = other.sql("SELECT sale_id, profit_amount FROM lake_dw.fact_sales_shown").collect()
            return {r["sale_id"]: float(r["profit_amount"]) for r in rows}

        assert seen() == {}
        store.add("dw.fact_sales", facts(spark, ("a", 2024, 1, 5.0, 2.0)))
        assert seen() == {"a": 3.0}
        store.add("dw.fact_sales", facts(spark, ("b", 2024, 2, 5.0, None)))
        assert seen() == {"a": 3.0, "b": 5.0}
        # A month that is emptied leaves the catalog, and one that is replaced shows its new rows.
        store.replace_months("dw.fact_sales", facts(spark, ("c", 2024, 2, 1.0, 1.0)), [(2024, 1), (2024, 2)])
        assert seen() == {"c": 0.0}
        assert [r[0] for r in spark.sql("SHOW PARTITIONS lake_dw.fact_sales").collect()] == ["year=2024/month=2"]
    finally:
        store.unpublish()


def test_snapshots_and_batches_in_the_catalog(spark, tmp_path):
    store = Warehouse(spark, str(tmp_path), catalog="lake")
    waiting = "source_sale_id string, source_system string, skip_reason string"
    loaded = "source_name string, raw_batch string, written bigint, batch_id string, loaded_at timestamp"
    store.replace("staging.waiting_sales", spark.createDataFrame([("a", "csv", "x")], waiting))
    store.publish()
    try:
        def keys():
            return sorted(r[0] for r in spark.sql("SELECT source_sale_id FROM lake_staging.waiting_sales").collect())

        assert keys() == ["a"]
        store.replace("staging.waiting_sales", spark.createDataFrame([("b", "csv", "x"), ("c", "csv", "x")], waiting))
        assert keys() == ["b", "c"]
        row = spark.createDataFrame([("csv_sales", "1", 1, "b1", None)], loaded)
        for batch in ("b1", "b2", "b1"):
            store.append("staging.loaded_batches", row, batch)
        found = spark.sql("SELECT batch, count(*) AS n FROM lake_staging.loaded_batches GROUP BY batch").collect()
        assert {tuple(r) for r in found} == {("b1", 1), ("b2", 1)}
        store.publish()  # again, over what is there
        assert keys() == ["b", "c"]
    finally:
        store.unpublish()
    assert not spark.catalog.databaseExists("lake_dw")


def brute_easter(year):
    """Sunday after the full moon on or after 21 March, by the church's tables."""
    a, b, c = year % 19, year // 100, year % 100
    h = (19 * a + b - b // 4 - (b - (b + 8) // 25 + 1) // 3 + 15) % 30
    w = (32 + 2 * (b % 4) + 2 * (c // 4) - h - c % 4) % 7
    m = (a + 11 * h + 22 * w) // 451
    month, day = divmod(h + w - 7 * m + 114, 31)
    return date(year, month, day + 1)


def test_easter(spark):
    years = spark.range(1583, 2400).select("id", easter(F.col("id")).alias("day"))
    found = {r["id"]: r["day"] for r in years.collect()}
    # Known dates, among them the earliest and the latest possible.
    for text in ("1818-03-22", "1943-04-25", "2000-04-23", "2008-03-23", "2024-03-31", "2025-04-20", "2038-04-25"):
        assert found[int(text[:4])] == date.fromisoformat(text)
    assert found == {year: brute_easter(year) for year in found}
    assert all(day.weekday() == 6 for day in found.values())


def test_holidays(spark):
    days = dim_date(spark, date(2023, 1, 1), date(2025, 12, 31), HOLIDAYS).where("is_holiday").collect()
    found = {r["full_date"] for r in days}
    assert {date(2024, 5, 27), date(2023, 11, 23), date(2025, 1, 20), date(2024, 9, 2), date(2024, 3, 29)} <= found
    assert len(found) == 3 * len(HOLIDAYS)
    last_friday = Holiday("last Friday of October", month=10, weekday=6, nth=-1)
    [day] = dim_date(spark, date(2024, 1, 1), date(2024, 12, 31), [last_friday]).where("is_holiday").collect()
    assert day["full_date"] == date(2024, 10, 25) and day["full_date"] + timedelta(7) > date(2024, 10, 31)
    assert dim_date(spark, date(2024, 1, 1), date(2024, 12, 31)).where("is_holiday").count() == 0


def test_bucketed_facts_are_not_shuffled_by_customer(spark, tmp_path):
    store = Warehouse(spark, str(tmp_path), catalog="lake")
    store.publish()
    try:
        rows = spark.range(400).selectExpr(
            "id % 40 AS customer_key", "CAST(id AS string) AS sale_id", "20240101 AS date_key", "2 AS quantity",
            "CAST(1 AS decimal(12,2)) AS total_amount", "CAST(NULL AS decimal(12,2)) AS cost_amount",
        )
        sold = store.bucket_facts(rows, 4)
        totals = sold.groupBy("customer_key").agg(F.count("*").alias("n"))
        plan = totals._jdf.queryExecution().executedPlan().toString()
        assert "Bucketed: true" in plan and "Exchange" not in plan
        assert {tuple(r) for r in totals.collect()} == {(k, 10) for k in range(40)}
        again = store.bucket_facts(rows.where("customer_key < 5"), 4)
        assert again.count() == 50
    finally:
        store.unpublish()
