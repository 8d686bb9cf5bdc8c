import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from ledgerlake import session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    settings = {"spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false"}
    built = session.build("tests", "local[4]", **settings)
    built.sparkContext.setLogLevel("ERROR")
    yield built
    built.stop()


@pytest.fixture(scope="session")
def evaluate(spark):
    """Evaluate one expression of column `v` over a list of values."""

    def run(expression, values, kind="string"):
        rows = [(i, v) for i, v in enumerate(values)]
        frame = spark.createDataFrame(rows, f"i int, v {kind}")
        return [r["x"] for r in frame.select("i", expression.alias("x")).orderBy("i").collect()]

    return run
