"""Sales as a stream of events: each sale once, and revenue per day.

Both hold state only as long as the watermark asks for: a sale's key until no copy of it can
still be taken, a day's totals until the day is closed. Events that come later than that are
left out by Spark; `late_events` finds them afterwards, by name, as what has landed but was never
taken. Results are append-only tables of Spark's file sink, whose log makes each micro-batch
count once however often it is tried.

Events without a key or a time are in neither table, and are among the named ones.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

AMOUNT = "decimal(22,2)"


def _usable(keys: list[str], time: str) -> Column:
    whole = F.col(time).isNotNull()
    for key in keys:
        whole = whole & F.col(key).isNotNull()
    return whole


def once_each(events: DataFrame, keys: list[str], time: str, delay: str) -> DataFrame:
    """The first event of each key; later ones within `delay` of it are copies.

    Events that are older than the newest one seen by more than `delay` are left out, so a copy
    is never taken for a new event: its key is held until the copy would be too late.
    """
    return (
        events.where(_usable(keys, time)).withWatermark(time, delay).dropDuplicatesWithinWatermark(keys)
    )


def revenue_per_window(events: DataFrame, time: str, amount: str, length: str = "1 day") -> DataFrame:
    """Sales and revenue of every window that the watermark has closed.

    `events` carries a watermark. Totals are partial sums per task before they are shuffled by
    window, so a day with a third of all sales is a few rows there.
    """
    return (
        events.groupBy(F.window(time, length).alias("span"))
        .agg(F.count(F.lit(1)).alias("sales"), F.sum(F.col(amount).cast("decimal(12,2)")).cast(AMOUNT).alias("revenue"))
        .select(F.col("span.start").alias("window_start"), F.col("span.end").alias("window_end"), "sales", "revenue")
    )


def append_to(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Take what has arrived since the last time, then stop."""
    return (
        stream.writeStream.format("parquet")
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def late_events(landed: DataFrame, taken: DataFrame, keys: list[str], time: str) -> DataFrame:
    """The landed events that were never taken, once for each key, with the reason.

    Copies are reduced in the map tasks before they meet the taken ones; both sides then hold
    each key once, so a key with many copies cannot skew the join.
    """
    unnamed = landed.where(~_usable(keys, time)).select(*keys, F.lit("missing key or time").alias("reason"))
    named = landed.where(_usable(keys, time)).select(*keys).distinct()
    missed = named.join(taken.select(*keys).distinct(), keys, "left_anti")
    return missed.withColumn("reason", F.lit("late")).unionByName(unnamed)
