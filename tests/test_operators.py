import json
import random
import re
from collections import Counter
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from ledgerlake.operators import keys, ranking
from ledgerlake.operators.keys import next_keys
from ledgerlake.operators.ranking import rank_all
from ledgerlake.operators.samples import samples
from ledgerlake.operators.scd2 import changed_if_given, scd2_merge
from ledgerlake.operators.upsert import last_per_key, upsert


def brute_rank(values):
    return [1 + sum(other > v for other in values) for v in values]


def test_ranks_agree_with_brute_force(spark):
    random.seed(3)
    # A third of the rows tie, and values reach from negative to near the end of a long.
    values = [7] * 200 + [random.choice([-5, 0, 1 << 21, 1 << 42, (1 << 62) + 9]) for _ in range(60)]
    values += [random.randrange(-(1 << 40), 1 << 60) for _ in range(340)]
    frame = spark.createDataFrame(list(enumerate(values)), "id int, v bigint")
    expected = dict(enumerate(brute_rank(values)))
    rows = rank_all(frame, {"r": F.col("v"), "s": -F.col("v")}).collect()
    assert len(rows) == len(values)
    assert {row["id"]: row["r"] for row in rows} == expected
    down = brute_rank([-v for v in values])
    assert {row["id"]: row["s"] for row in rows} == dict(enumerate(down))


def test_new_keys_are_unique_and_above_the_old(spark):
    old = spark.createDataFrame([(5,), (900,)], "k bigint")
    new = spark.range(10_000, numPartitions=7).select(next_keys(old, "k").alias("k"))
    keys = [row["k"] for row in new.collect()]
    assert len(set(keys)) == 10_000
    assert min(keys) > 900


def test_first_keys_start_at_one(spark):
    empty = spark.createDataFrame([], "k bigint")
    keys = [r["k"] for r in spark.range(0, 1, 1, 1).select(next_keys(empty, "k").alias("k")).collect()]
    assert keys == [1]


def test_last_record_of_a_hot_key_wins(spark):
    rows = [("hot", i, f"v{i}") for i in range(1000)] + [("cold", 1, None), ("cold", 0, "x")]
    frame = spark.createDataFrame(rows, "k string, line int, value string")
    found = {r["k"]: r["value"] for r in last_per_key(frame, ["k"], ["line"]).collect()}
    assert found == {"hot": "v999", "cold": None}


def test_last_records_keep_null_keys_and_every_column(spark):
    rows = [(None, 1, "a"), (None, 2, "b"), ("x", 1, None), ("y", 3, "c"), ("y", 3, "d"), ("z", 0, "e"), ("z", 0, "e")]
    frame = spark.createDataFrame(rows, "k string, line int, value string")
    found = last_per_key(frame, ["k"], ["line"])
    assert found.columns == ["k", "line", "value"]
    assert sorted(map(tuple, found.collect()), key=str) == sorted(
        [(None, 2, "b"), ("x", 1, None), ("y", 3, "d"), ("z", 0, "e")], key=str
    )
    assert last_per_key(frame.limit(0), ["k"], ["line"]).collect() == []


def test_only_rows_of_repeated_keys_are_sorted(spark):
    frame = spark.range(1000).selectExpr("CAST(id % 990 AS string) AS k", "id AS line", "'v' AS value")
    plan = last_per_key(frame, ["k"], ["line"])._jdf.queryExecution().executedPlan().toString()
    # Sort aggregates stand above the rows that meet a repeated key, and nowhere else.
    places = [m.start() for m in re.finditer("SortAggregate", plan)]
    assert places and plan.index("LeftAnti") < min(places) and max(places) < plan.index("LeftSemi")
    assert "HashAggregate" in plan


STAGED = (
    "k string, value int, is_valid boolean, validation_errors string, created_at timestamp,"
    " updated_at timestamp, batch_id string"
)
EARLY, LATE = datetime(2024, 1, 1), datetime(2024, 2, 1)


def test_upsert_replaces_inserts_and_keeps(spark):
    old = [("a", 1, True, None, EARLY, EARLY, "b1"), ("b", 2, True, None, EARLY, EARLY, "b1")]
    current = spark.createDataFrame(old, STAGED)
    incoming = spark.createDataFrame([("b", None), ("c", 3)], "k string, value int")
    merged = upsert(current, incoming, ["k"], ["value"], F.lit(LATE), F.lit("b2"))
    rows = {r["k"]: r for r in merged.collect()}
    assert {k: r["action"] for k, r in rows.items()} == {"a": "kept", "b": "updated", "c": "inserted"}
    assert rows["a"]["value"] == 1 and rows["a"]["batch_id"] == "b1"
    assert rows["b"]["value"] is None and rows["b"]["created_at"] == EARLY
    assert rows["b"]["updated_at"] == LATE and rows["c"]["created_at"] == LATE


def test_upsert_twice_changes_nothing_more(spark):
    empty = spark.createDataFrame([], STAGED)
    incoming = spark.createDataFrame([("b", 1), ("c", 3)], "k string, value int")
    columns = [c.split()[0] for c in STAGED.split(", ")]
    once = upsert(empty, incoming, ["k"], ["value"], F.lit(EARLY), F.lit("b1")).select(*columns)
    twice = upsert(once, incoming, ["k"], ["value"], F.lit(EARLY), F.lit("b1"))
    assert Counter(twice.select(*columns).collect()) == Counter(once.collect())
    assert {r["action"] for r in twice.collect()} == {"updated"}


DIM = (
    "sk bigint, nk string, price int, title string, effective_from date, effective_to date,"
    " is_current boolean, created_at timestamp, updated_at timestamp"
)


def merge(dim, staged, day):
    return scd2_merge(
        dim, staged, "nk", "sk", changed_if_given("price"), ["title"], F.lit(day), F.lit(LATE)
    )


def test_history_stays_consistent_over_many_merges(spark):
    random.seed(5)
    columns = [c.split()[0] for c in DIM.split(", ")]
    dim = spark.createDataFrame([], DIM)
    known: dict[str, int] = {}
    for day in range(1, 6):
        prices = {f"p{i}": random.choice([10, 20, None]) for i in random.sample(range(12), 8)}
        rows = [(k, p, f"t{day}") for k, p in prices.items()]
        staged = spark.createDataFrame(rows, "nk string, price int, title string")
        merged = merge(dim, staged, date(2024, 1, day))
        actions = Counter(r["action"] for r in merged.collect())
        opened = [k for k, p in prices.items() if k not in known]
        moved = [k for k, p in prices.items() if k in known and p is not None and p != known[k]]
        assert actions["inserted"] == len(opened)
        assert actions["updated"] == actions["closed"] == len(moved)
        assert actions["unchanged"] == len(prices) - len(opened) - len(moved)
        for k in opened + moved:
            known[k] = prices[k]
        dim = spark.createDataFrame(merged.select(*columns).collect(), DIM)
    rows = dim.collect()
    assert len({r["sk"] for r in rows}) == len(rows)
    for key in known:
        versions = sorted((r for r in rows if r["nk"] == key), key=lambda r: r["effective_from"])
        assert [r["is_current"] for r in versions] == [False] * (len(versions) - 1) + [True]
        for before, after in zip(versions, versions[1:]):
            assert before["effective_to"] == after["effective_from"]
        assert versions[-1]["effective_to"] == date(9999, 12, 31)
        assert versions[-1]["price"] == known[key]


def test_a_second_change_on_one_day_leaves_an_empty_version(spark):
    dim = spark.createDataFrame([], DIM)
    columns = dim.columns
    for price in (10, 20, 30):
        staged = spark.createDataFrame([("p", price, "t")], "nk string, price int, title string")
        merged = merge(dim, staged, date(2024, 1, 1)).select(*columns)
        dim = spark.createDataFrame(merged.collect(), DIM)
    rows = dim.collect()
    assert len(rows) == 3 and len({r["sk"] for r in rows}) == 3
    assert sum(r["effective_from"] == r["effective_to"] for r in rows) == 2


def test_samples_are_as_many_as_there_are(spark):
    frame = spark.range(5000).withColumn("g", F.col("id") % 2).withColumn("id", F.col("id") % 1000)
    found = samples(frame, ["g"], F.col("id"), "s", most=7).collect()
    assert {r["g"]: json.loads(r["s"]) for r in found} == {
        0: ["0", "10", "100", "102", "104", "106", "108"],
        1: ["1", "101", "103", "105", "107", "109", "11"],
    }
    few = spark.createDataFrame([(1, "b"), (1, "a"), (1, "b"), (1, None), (2, None)], "g int, v string")
    assert [tuple(r) for r in samples(few, ["g"], F.col("v"), "s").collect()] == [(1, '["a","b"]')]


def test_keys_never_collide_beyond_the_stride(spark, monkeypatch):
    monkeypatch.setattr(keys, "STRIDE", 4)
    none = spark.createDataFrame([], "k long")
    rows = spark.range(40).repartition(4).select(keys.next_keys(none, "k").alias("k"))
    assert len({r["k"] for r in rows.collect()}) == 40
    with pytest.raises(Exception, match="a load may have 4 tasks"):
        spark.range(40, numPartitions=9).select(keys.next_keys(none, "k").alias("k")).collect()


@pytest.mark.parametrize("size", [0, 1, 3, 700])
def test_ranks_with_ties_nulls_and_extremes(spark, size):
    values = [None, 5, 5, -(1 << 62), (1 << 63) - 1, 0, None, -1]
    rows = [(i, values[i % 8] if i % 3 else i % 11) for i in range(size)]
    frame = spark.createDataFrame(rows, "i long, v long")
    ranked = ranking.rank_all(frame, {"r": F.col("v"), "q": -F.col("i")}).collect()
    known = sorted((v for _, v in rows if v is not None), reverse=True)
    expected = {(i, v, known.index(v) + 1 if v is not None else len(known) + 1, i + 1) for i, v in rows}
    assert {tuple(r) for r in ranked} == expected and len(ranked) == size
