"""The registered queries of the training-data operators over whole tables."""

import os

import pytest

import __spark_entry__ as entry
from check import compare
from ledgerlake.llm import registry

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables here")
NATIVE = ["op2_source_mix"]


def test_every_operator_is_registered():
    numbers = {name.split("_")[0] for name in entry.queries()}
    assert {f"op{n}" for n in range(1, 14)} | {"pipeline"} <= numbers
    assert set(registry.ORACLES) <= set(registry.QUERIES)


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query(spark, name):
    verdict, rows, _ = compare(spark, FOLDER, name, entry.oracle_sql().get(name))
    assert verdict == ("same" if name in registry.ORACLES else "rows only")
    table = {"op7": "pages", "op13": "embeddings"}.get(name.split("_")[0], "documents")
    there = spark.read.parquet(f"{FOLDER}/{table}.parquet").count()
    if name.startswith("op4_"):
        assert rows > 0  # a row per leak
    else:
        assert 0 < rows <= there and (rows == there or name == "pipeline")


@pytest.mark.parametrize("name", NATIVE)
def test_native_queries_have_no_python(spark, name):
    text = entry.queries()[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    for operator in ("Python", "Pandas", "Arrow", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert operator not in text
