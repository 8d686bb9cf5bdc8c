import json
from datetime import date, datetime

from ledgerlake.plans.pipeline import Transformation
from ledgerlake.sources.store import Warehouse
from ledgerlake.streaming import windows
from ledgerlake.streaming.landing import forget_last_commit, stream_feed, stream_to_staging


def landed(root, day, *carts):
    folder = root / "landing" / "api_carts" / day
    folder.mkdir(parents=True)
    text = json.dumps([{"id": i, "userId": 1, "date": "2024-03-10", "products": [{"productId": 9, "quantity": q}]}
                       for i, q in carts])
    (folder / "part.json").write_text(text)


def load(spark, warehouse, root, **options):
    stream_feed(
        spark, warehouse, str(root / "landing"), "api_carts", str(root / "progress"), **options
    ).awaitTermination(120)


def test_every_micro_batch_is_staged_once(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path / "warehouse"))
    for k in range(4):
        landed(tmp_path, f"2024-03-1{k}", (k, 1), (9, k + 1))
    load(spark, warehouse, tmp_path, files_per_batch=1)
    assert len(warehouse.batches("raw.api_carts")) == 4
    assert warehouse.read("raw.api_carts").count() == 8
    day = date(2024, 3, 20)

    def staged(batch, hour):
        job = Transformation(spark, warehouse, batch, day, datetime(2024, 3, 20, hour))
        job.load_sales()
        return job.stats["staging.sales"]["processed"]

    assert staged("b1", 8) == 8
    sales = {r["source_sale_id"]: r["quantity"] for r in warehouse.read("staging.sales").collect()}
    # Of the cart in all four files, the last file's record counts.
    assert sales == {"0-0": 1, "1-0": 1, "2-0": 1, "3-0": 1, "9-0": 4}
    assert staged("b2", 9) == 0
    landed(tmp_path, "2024-03-15", (5, 2))
    load(spark, warehouse, tmp_path)
    load(spark, warehouse, tmp_path)
    assert warehouse.read("raw.api_carts").count() == 9
    assert staged("b3", 10) == 1


def test_malformed_records_are_counted_and_kept(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path / "warehouse"))
    landed(tmp_path, "2024-03-10", (1, 1))
    folder = tmp_path / "landing" / "api_carts" / "2024-03-11"
    folder.mkdir()
    (folder / "part.json").write_text("[{broken")
    load(spark, warehouse, tmp_path)
    assert [r["source_id"] for r in warehouse.read("raw.api_carts").collect()] == ["1"]
    [log] = warehouse.read("quality.ingestion_log").collect()
    assert (log["records_received"], log["records_rejected"], log["status"]) == (2, 1, "partial")
    [kept] = warehouse.read("quality.rejected_records").collect()
    assert "{broken" in kept["record"]


def landed_csv(root, day, *sales):
    folder = root / "landing" / "csv_sales" / day
    folder.mkdir(parents=True)
    head = "sale_id,customer_id,product_id,quantity,unit_price,total_amount,sale_date,payment_method"
    lines = [f"{key},C1,P1,{quantity},2.00,{2 * quantity},2024-03-10,cash" for key, quantity in sales]
    (folder / "part.csv").write_text("\n".join([head, *lines]) + "\n")


def to_staging(spark, warehouse, root, source="csv_sales"):
    stream_to_staging(
        spark, warehouse, str(root / "landing"), source, str(root / "progress"), date(2024, 3, 20)
    ).awaitTermination(120)
    return {r["source_sale_id"]: r for r in warehouse.read("staging.sales").collect()}


def test_csv_feed_reaches_staging(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path / "warehouse"))
    landed_csv(tmp_path, "day1", ("A", 1), ("B", 2), ("bad", 0))
    first = to_staging(spark, warehouse, tmp_path)
    assert {k: r["quantity"] for k, r in first.items()} == {"A": 1, "B": 2}
    landed_csv(tmp_path, "day2", ("B", 5), ("C", 1), ("short\n", 1))
    second = to_staging(spark, warehouse, tmp_path)
    assert {k: r["quantity"] for k, r in second.items()} == {"A": 1, "B": 5, "C": 1}
    assert second["A"]["updated_at"] == first["A"]["updated_at"]
    assert second["B"]["created_at"] == first["B"]["created_at"]
    # Given once more after it was done, the last micro-batch changes nothing.
    log = warehouse.read("quality.transformation_log").count()
    forget_last_commit(spark, str(tmp_path / "progress"))
    assert to_staging(spark, warehouse, tmp_path) == second
    assert warehouse.read("quality.transformation_log").count() == log
    reasons = {r["record_key"]: r["rejection_reasons"] for r in warehouse.read("quality.rejected_records").collect()}
    assert "quantity" in reasons["bad"]


def test_a_batch_that_failed_halfway_is_staged_again(spark, tmp_path, monkeypatch):
    warehouse = Warehouse(spark, str(tmp_path / "warehouse"))
    landed_csv(tmp_path, "day1", ("A", 1))
    with monkeypatch.context() as broken:
        broken.setattr(Transformation, "stage_batch", lambda *_: 1 / 0)
        try:
            to_staging(spark, warehouse, tmp_path)
        except Exception:
            pass
    assert warehouse.read("raw.csv_sales").count() == 1
    assert set(to_staging(spark, warehouse, tmp_path)) == {"A"}
    assert warehouse.read("raw.csv_sales").count() == 1


EVENT = "sale_id long, at timestamp, amount double"


def arrive(spark, root, number, rows):
    given = [(k, datetime.fromisoformat(at) if at else None, amount) for k, at, amount in rows]
    spark.createDataFrame(given, EVENT).write.parquet(f"{root}/landing/{number}")


def take(spark, root, shape):
    stream = shape(spark.readStream.schema(EVENT).parquet(f"{root}/landing/*"))
    windows.append_to(stream, f"{root}/taken", f"{root}/progress").awaitTermination(120)
    return spark.read.parquet(f"{root}/taken")


def once(events):
    return windows.once_each(events, ["sale_id"], "at", "1 day")


ARRIVALS = [
    [(1, "2024-03-01 10:00", 5.0), (1, "2024-03-01 10:00", 5.0), (2, "2024-03-01 11:00", 1.0), (None, "2024-03-01 12:00", 9.0)],
    [(1, "2024-03-01 10:00", 5.0), (3, "2024-03-04 10:00", 2.5), (4, None, 9.0)],
    [(5, "2024-03-02 10:00", 7.0), (6, "2024-03-03 11:00", 3.0), (2, "2024-03-01 11:00", 1.0)],
]


def test_each_sale_once_and_late_ones_by_name(spark, tmp_path):
    for number, rows in enumerate(ARRIVALS):
        arrive(spark, tmp_path, number, rows)
        taken = take(spark, tmp_path, once)
    assert sorted(r["sale_id"] for r in taken.collect()) == [1, 2, 3, 6]
    landed = spark.read.schema(EVENT).parquet(f"{tmp_path}/landing/*")
    late = windows.late_events(landed, taken, ["sale_id"], "at").collect()
    assert sorted((r["sale_id"] or 0, r["reason"]) for r in late) == [
        (0, "missing key or time"), (4, "missing key or time"), (5, "late"),
    ]


def test_days_are_given_when_they_are_closed(spark, tmp_path):
    def days(events):
        return windows.revenue_per_window(once(events), "at", "amount")

    found = []
    for number, rows in enumerate(ARRIVALS):
        arrive(spark, tmp_path, number, rows)
        rows = take(spark, tmp_path, days).collect()
        found.append(sorted((r["window_start"].date(), r["sales"], float(r["revenue"])) for r in rows))
    # Only the first day is over for certain after the second arrival; the third adds nothing to it.
    assert found == [[], [(date(2024, 3, 1), 2, 6.0)], [(date(2024, 3, 1), 2, 6.0)]]
