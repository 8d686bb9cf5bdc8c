"""Landed CSV and JSON feeds to raw tables, and on to staging, as files arrive.

The same ingestion as the batch job, started by new files instead of a schedule: the
stream keeps track of which files were loaded, and every micro-batch is one raw batch with
its log row and the records that could not be read. `stream_feed` ends there, and staging takes
up every raw batch that it has not had yet, however many there are. `stream_to_staging` goes on
to validate the micro-batch and upsert it into the entity's staging table at once; a micro-batch
that was staged before is left alone. Feeds of one entity write one table, so they take turns.
"""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ledgerlake.plans.ingestion import ingest_batch
from ledgerlake.plans.pipeline import Transformation
from ledgerlake.schemas import LANDING
from ledgerlake.session import hadoop_path
from ledgerlake.sources.files import CORRUPT, Extraction
from ledgerlake.sources.raw import CSV_COLUMNS
from ledgerlake.sources.store import Warehouse


def _arriving(
    spark: SparkSession, root: str, source: str, lines: bool, files_per_batch: int | None
) -> DataFrame:
    """The records of files below `root/<source>/` as a stream, with their file and text."""
    reader = (
        spark.readStream.option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
    )
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    path, file_name = f"{root}/{source}/*", F.col("_metadata.file_name").alias("_file_name")
    if source in LANDING:
        reader = reader.schema(f"{LANDING[source]}, {CORRUPT} string").option("multiLine", not lines)
        return reader.json(path).select("*", file_name)
    names = CSV_COLUMNS[source]
    schema = ", ".join(f"{name} string" for name in [*names, CORRUPT])
    values = [F.coalesce(F.col(name), F.lit("")) for name in names]
    reader = reader.schema(schema).option("header", True).option("enforceSchema", False)
    found = reader.option("quote", '"').option("escape", '"').csv(path)
    return found.select("*", file_name, F.concat_ws(",", *values).alias("_raw_line"))


def _load(warehouse: Warehouse, root: str, source: str, records: DataFrame, batch_id: str, began: datetime) -> None:
    """One micro-batch to the raw table, with its log row and the records that could not be read."""
    # In file order, as a file that is one array, or one split of lines, is one task.
    kept = records.withColumn("_line_number", F.monotonically_increasing_id()).persist()
    try:
        broken = kept.where(F.col(CORRUPT).isNotNull())
        good = kept.where(F.col(CORRUPT).isNull()).drop(CORRUPT)
        broken.count()
        extraction = Extraction(
            source, "stream", root, good, broken, started_at=began, completed_at=datetime.now()
        )
        spark = records.sparkSession
        ingest_batch(spark, warehouse, {source: extraction}, batch_id, F.lit(began), "stream")
    finally:
        kept.unpersist()


def _start(arriving: DataFrame, load, checkpoint: str) -> StreamingQuery:
    return (
        arriving.writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def stream_feed(
    spark: SparkSession,
    warehouse: Warehouse,
    root: str,
    source: str,
    checkpoint: str,
    lines: bool = False,
    files_per_batch: int | None = None,
) -> StreamingQuery:
    """Load the files below `root/<source>/` that were not loaded before, then stop.

    A micro-batch that is repeated after a failure has the same number, and so replaces
    the batch it may have written already. `files_per_batch` bounds one micro-batch; the
    rest of the files follow in further ones.
    """

    def load(records: DataFrame, number: int) -> None:
        _load(warehouse, root, source, records, f"{source}-{number:09d}", datetime.now())

    return _start(_arriving(spark, root, source, lines, files_per_batch), load, checkpoint)


def stream_to_staging(
    spark: SparkSession,
    warehouse: Warehouse,
    root: str,
    source: str,
    checkpoint: str,
    as_of: date,
    lines: bool = False,
    files_per_batch: int | None = None,
) -> StreamingQuery:
    """Load the files that were not loaded before into raw and staging tables, then stop.

    The staged batches name the micro-batches that are done. One that fails before it is named
    there is loaded again from its files: its raw batch replaces itself, and the upsert finds
    the same records, so its values come out the same.
    """

    def load(records: DataFrame, number: int) -> None:
        began, batch_id = datetime.now(), f"{source}-{number:09d}"
        job = Transformation(spark, warehouse, batch_id, as_of, began, "stream")
        if job.is_staged(source, batch_id):
            return
        _load(warehouse, root, source, records, batch_id, began)
        job.stage_batch(source, batch_id)
        job.save_steps()

    return _start(_arriving(spark, root, source, lines, files_per_batch), load, checkpoint)


def forget_last_commit(spark: SparkSession, checkpoint: str) -> None:
    """Make a stopped stream repeat its last micro-batch, as if it had failed before the end."""
    folder, fs = hadoop_path(spark, f"{checkpoint}/commits")
    numbers = [s.getPath() for s in fs.listStatus(folder) if s.getPath().getName().isdigit()]
    fs.delete(max(numbers, key=lambda path: int(path.getName())), False)
