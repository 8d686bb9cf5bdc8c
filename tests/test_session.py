import os
import re
import subprocess
import sys
from pathlib import Path
from types import SimpleNamespace

import pytest

from ledgerlake import session


def session_of(master, folder=None):
    conf = SimpleNamespace(get=lambda key, default=None: folder or default)
    return SimpleNamespace(conf=conf, sparkContext=SimpleNamespace(master=master))


def test_the_clusters_folder_is_used():
    assert session.shared_dir(session_of("yarn", "/shared/x/")) == "/shared/x"


@pytest.mark.parametrize("master", ["yarn", "spark://a:7077", "local-cluster[2,1,1024]", "k8s://x"])
def test_a_cluster_without_a_folder_fails_at_once(master):
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.shared_dir(session_of(master))


@pytest.mark.parametrize("master", ["local", "local[4]", "local[*]"])
def test_one_machine_without_a_folder_gets_one_and_keeps_it(master):
    bare = session_of(master)
    assert os.path.isdir(session.shared_dir(bare))
    assert session.shared_dir(bare) == session.shared_dir(bare)


def test_scratch_tables_are_removed(spark):
    with session.scratch(spark) as folder:
        assert session.materialize(spark.range(3), "x", folder).count() == 3
        assert os.listdir(folder.removeprefix("file:"))
    assert not os.path.exists(folder.removeprefix("file:"))


def test_materialized_frames_keep_rows_and_types(spark):
    frame = spark.createDataFrame([(1, ["a"], None)], "a int, b array<string>, c decimal(28,10)")
    kept = session.materialize(frame, "test")
    assert kept.dtypes == frame.dtypes and kept.collect() == frame.collect()
    assert "Parquet" in kept._jdf.queryExecution().toString()


def test_nothing_stays_in_the_shared_folder(tmp_path):
    """Intermediate and result tables are gone when Python ends, also if Spark was stopped before."""
    code = f"""
from pyspark.sql import functions as F
from ledgerlake import session
from ledgerlake.operators.ranking import rank_all
spark = session.build("t", "local[1]", **{{"spark.checkpoint.dir": "{tmp_path}", "spark.ui.enabled": "false"}})
ranked = rank_all(spark.range(9).toDF("v"), {{"r": F.col("v")}})
assert sorted(r["r"] for r in ranked.collect()) == list(range(1, 10))
assert session.materialize(spark.range(3), "x").count() == 3
with session.scratch(spark) as folder:
    session.materialize(spark.range(3), "x", folder)
spark.stop()
"""
    root = Path(__file__).resolve().parents[1]
    subprocess.run([sys.executable, "-c", code], cwd=root, check=True, timeout=300)
    # Spark keeps a folder of its own there.
    left = [p.name for p in tmp_path.iterdir() if re.search("-[0-9a-f]{32}$", p.name)]
    assert left == []
