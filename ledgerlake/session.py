"""Session defaults and durable intermediate results."""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Settings the jobs are written for. A cluster's own values win over these, because
# they are only applied by `build`, never to a session that somebody else made.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot join key even when that costs one more shuffle afterwards.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # The JVM never compiles methods above 8000 bytes of bytecode. Wide cleaning stages
    # exceed that in one generated method and run twice as fast as separate operators.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}

#: The codec of large tables, which take about two thirds of the disk that they take by default.
COMPACT = "zstd"

_own_dir: str | None = None


def build(app: str, master: str | None = None, **settings: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder for intermediate tables: the cluster's `spark.checkpoint.dir`.

    Without one, a session on one machine gets a folder of its own, removed when Python
    ends. On a cluster every executor would write to its own disk there, so that fails.
    """
    global _own_dir
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    if not _own_dir:
        _own_dir = tempfile.mkdtemp(prefix="ledgerlake-")
        atexit.register(shutil.rmtree, _own_dir, ignore_errors=True)
    return _own_dir


def hadoop_path(spark: SparkSession, text: str):
    """A Hadoop path with the file system it is on."""
    path = spark._jvm.org.apache.hadoop.fs.Path(text)
    return path, path.getFileSystem(spark._jsc.hadoopConfiguration())


@contextmanager
def scratch(spark: SparkSession) -> Iterator[str]:
    """A folder for the intermediate tables of one job, removed when the job is done."""
    folder = f"{shared_dir(spark)}/job-{uuid.uuid4().hex}"
    try:
        yield folder
    finally:
        discard(spark, folder)


def temporary(spark: SparkSession, label: str) -> str:
    """A folder for tables that are read after the job that made them; removed when Python ends."""
    folder = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
    atexit.register(_removed, spark, folder)
    return folder


def place_of(spark: SparkSession, label: str, folder: str | None = None) -> str:
    """A new folder for one table: in the job's `folder`, or one that goes when Python ends."""
    return f"{folder}/{label}-{uuid.uuid4().hex}" if folder else temporary(spark, label)


def materialize(
    frame: DataFrame, label: str, folder: str | None = None, codec: str | None = None
) -> DataFrame:
    """Write `frame` once as Parquet in the shared folder and read it back.

    Cuts the lineage like `checkpoint()`, survives lost executors, and keeps column
    pruning for later scans, which a checkpointed RDD does not offer. As later steps read the
    table only, Spark drops the shuffle files of this one when it ends. The table goes with the
    job's `folder`, or when Python ends. `codec` is for large tables, as `COMPACT`.
    """
    spark = frame.sparkSession
    path = place_of(spark, label, folder)
    with shuffles_dropped(spark):
        frame.write.parquet(path, compression=codec)
    return spark.read.schema(frame.schema).parquet(path)


def shuffles_dropped(spark: SparkSession):
    """Within it, the shuffle files of each job go when the job ends, not when Java notices."""
    return setting(spark, "spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")


@contextmanager
def setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def discard(spark: SparkSession, folder: str) -> None:
    """Delete a folder of intermediate tables that no later step reads."""
    path, fs = hadoop_path(spark, folder)
    fs.delete(path, True)


def result_table(frame: DataFrame, label: str) -> DataFrame:
    """The rows of a query, written once, as `materialize` does; removed when Python ends.

    For results that are read after the job that made them, whose own folder is gone by then.
    """
    return materialize(frame, label)


def store_once(frame: DataFrame, label: str, folder: str | None = None) -> DataFrame:
    """Rows that several later steps read, written once: to the job's folder, or as a result table."""
    return materialize(frame, label, folder) if folder else result_table(frame, label)


def _removed(spark: SparkSession, folder: str) -> None:
    try:
        discard(spark, folder)
    except Exception:  # the JVM may be gone before Python is
        shutil.rmtree(folder, ignore_errors=True)
