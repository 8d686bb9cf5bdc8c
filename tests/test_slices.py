"""Steps that are taken slice by slice, and what they leave on disk."""

import os
from collections import Counter
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

import check
from ledgerlake import catalog, oracles, session
from ledgerlake.operators import slices
from ledgerlake.plans import facts
from ledgerlake.plans.pipeline import Transformation
from ledgerlake.schemas import TABLES as TABLE_COLUMNS
from ledgerlake.schemas import split_columns
from ledgerlake.sources.store import Warehouse


@pytest.fixture
def eight_turns(monkeypatch):
    monkeypatch.setattr(slices, "LEAST_BYTES", 1)


@pytest.fixture
def shared(spark, tmp_path, monkeypatch):
    """A folder of its own for intermediate tables."""
    monkeypatch.setattr(session, "shared_dir", lambda spark: str(tmp_path / "shared"))
    return tmp_path / "shared"


def files_in(folder):
    return [os.path.join(at, name) for at, _, names in os.walk(folder) for name in names if name.endswith(".parquet")]


def rows_in(spark, folder):
    found = {os.path.dirname(name) for name in files_in(folder)}
    return {at: spark.read.parquet(at).count() for at in found}


def put(spark, folder, table, rows, schema):
    """One table as one file, as SQL reads it."""
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{folder}/{table}-parts")
    os.rename(files_in(f"{folder}/{table}-parts")[0], f"{folder}/{table}.parquet")


def tables(spark, folder, orders=60, again=()):
    """Orders of four lines, of which the last two have one number; those in `again` come twice."""
    put(spark, folder, "region", [(0, "A")], "r_regionkey int, r_name string")
    put(spark, folder, "nation", [(k, f"N{k}", 0) for k in range(25)], "n_nationkey int, n_name string, n_regionkey int")
    people = [(k, f"Customer#{k:09}", k % 25, 1.0, "AUTOMOBILE") for k in range(1, 15)]
    put(spark, folder, "customer", people, "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string")
    parts = [(k, f"part {k}", "B", "T", k % 20 + 1, 9.5 + k) for k in range(1, 30)]
    put(spark, folder, "part", parts, "p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double")
    day = datetime(1996, 1, 1)
    sold = [(k, k % 14 + 1, "O", 9.0, day, f"{k % 3}-X") for k in range(1, orders)]
    put(spark, folder, "orders", sold, "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp, o_orderpriority string")
    lines = [
        (k, (k * 7 + n) % 29 + 1, 1, min(n, 2), float(n + 1), 10.0 * k + n, 0.0, 0.0, "N", "O", day + timedelta(days=(k * 37 + n) % 1700))
        for k in range(1, orders)
        for n in range(4)
    ]
    lines += [line for line in lines if line[0] in again]
    schema = (
        "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double,"
        " l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp"
    )
    put(spark, folder, "lineitem", lines, schema)
    return str(folder)


TABLES = ("region", "nation", "customer", "part", "orders", "lineitem")


@pytest.fixture
def given(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(check, "TABLES", TABLES)
    return tables(spark, tmp_path / "given", again=range(5, 20))


def test_each_row_has_one_turn_with_all_of_its_key(spark, shared, eight_turns):
    rows = [(k if k % 10 else None, k % 7) for k in range(200)] + [(3, 9)] * 50
    frame = spark.createDataFrame(rows, "k int, v int")
    other = spark.createDataFrame([(k,) for k in [*range(200), None]], "k int")
    dealt = slices.deal(frame, ["k"], "x")
    assert dealt.frame.columns == ["k", "v"] and dealt.frame.count() == len(rows)
    seen, turns = [], []
    for part, mine in dealt.taken():
        assert part.columns == ["k", "v"]
        seen += map(tuple, part.collect())
        turns.append(({r["k"] for r in part.collect()}, {r["k"] for r in mine(other).collect()}))
    assert Counter(seen) == Counter(rows) and len(turns) == slices.SLICES
    for keys, others in turns:
        assert keys <= others
    assert sum(len(others) for _, others in turns) == 201
    assert files_in(shared) == []


def test_nothing_to_deal_still_has_every_turn(spark, shared, eight_turns):
    frame = spark.createDataFrame([], "k int, v int")
    other = spark.createDataFrame([(k,) for k in range(30)], "k int")
    parts = (part.join(mine(other), "k", "right") for part, mine in slices.deal(frame, ["k"], "x").taken())
    kept = slices.stored(parts, "y")
    assert sorted(r["k"] for r in kept.collect()) == list(range(30)) and kept.columns == ["k", "v"]


@pytest.mark.parametrize("size, number", [(0, 1), (16 << 20, 1), (40 << 20, 2), (1 << 40, 8)])
def test_small_tables_are_taken_whole(size, number):
    assert slices.turns(size) == number


@pytest.mark.parametrize("name", ["fact_sales", "fact_merge"])
def test_facts_by_slices_agree_with_sql(spark, given, eight_turns, name):
    verdict, rows, _ = check.compare(spark, given, name, oracles.queries()[name])
    assert verdict == "same" and rows > 0


def test_the_facts_leave_no_earlier_table(spark, given, shared):
    found = catalog.QUERIES["fact_sales"](spark, given)
    left = rows_in(spark, shared)
    skipped = sum(r["skipped"] for r in catalog.QUERIES["fact_skipped"](spark, given).collect())
    assert list(left.values()) == [found.count() + skipped]


def test_appended_facts_leave_only_the_stored_table(spark, given, shared):
    found = catalog.QUERIES["fact_append"](spark, given)
    sales = sum(r["sales"] for r in found.collect())
    assert sum(rows_in(spark, shared).values()) == sales and sales > 0


def test_the_catalogs_facts_leave_only_the_stored_table(spark, given, shared):
    found = catalog.QUERIES["catalog_tables"](spark, given)
    sales = sum(r["sales"] for r in found.collect())
    assert sum(rows_in(spark, shared).values()) == sales and sales > 0


def test_the_whole_run_by_slices_agrees_and_leaves_only_the_warehouse(spark, given, shared, eight_turns, monkeypatch):
    monkeypatch.setattr(slices, "SLICES", 2)
    verdict, rows, _ = check.compare(spark, given, "warehouse_run", oracles.queries()["warehouse_run"])
    assert verdict == "same" and rows > 0
    assert [os.listdir(at) for at in shared.iterdir() if at.name.startswith("run-")] == [["warehouse"]]
    assert not [at for at in shared.iterdir() if at.name.startswith(("scan-", "job-"))]


def test_a_sale_that_moves_to_another_month_leaves_its_old_one(spark):
    schema = "sale_id string, source_system string, month int"
    old = spark.createDataFrame([("a", "csv", 1), ("b", "csv", 1)], schema)
    new = spark.createDataFrame([("a", "csv", 2), ("c", "csv", 1)], schema)
    merged = facts.merge_facts(old, new.where("month = 1"), new)
    assert sorted(map(tuple, merged.collect())) == [("b", "csv", 1), ("c", "csv", 1)]


def test_months_are_merged_in_turns(spark, tmp_path, shared, eight_turns):
    """A sale moves to another month, one is corrected, one is new, and a month is emptied."""
    store = Warehouse(spark, str(tmp_path / "warehouse"))
    schema = "sale_key long, sale_id string, source_system string, year int, month int, quantity int"
    columns = [c.split() for c in split_columns(TABLE_COLUMNS["dw.fact_sales"])]

    def rows(*found):
        frame = spark.createDataFrame(found, schema)
        missing = [F.lit(None).cast(kind).alias(name) for name, kind in columns if name not in frame.columns]
        return frame.select("*", *missing).select(*[name for name, _ in columns])

    store.add("dw.fact_sales", rows((1, "a", "csv", 2024, 1, 1), (2, "b", "csv", 2024, 2, 1), (3, "c", "csv", 2024, 3, 1)))
    job = Transformation(spark, store, "b2", datetime(2024, 4, 1).date())
    arriving = rows((4, "a", "csv", 2024, 2, 5), (5, "c", "csv", 2024, 3, 6), (6, "d", "csv", 2024, 4, 7))
    again = spark.createDataFrame([("a", "csv"), ("c", "csv")], "source_sale_id string, source_system string")
    assert job._merge_months(store.read("dw.fact_sales"), arriving, again) == 4
    found = store.read("dw.fact_sales").select("sale_id", "month", "quantity").collect()
    assert sorted(map(tuple, found)) == [("a", 2, 5), ("b", 2, 1), ("c", 3, 6), ("d", 4, 7)]
    assert files_in(shared) == []
