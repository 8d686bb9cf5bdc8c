"""Keyed upsert as a pure function of two snapshots."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def last_per_key(frame: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The last row of each key by `order`.

    Keys are counted first, in a hash aggregate of keys alone, and only rows of repeated keys
    are put in order; all others pass as they are, without a sort, and without a shuffle if the
    repeated keys are few enough for Spark to broadcast. The last row is an aggregate rather than
    a window: copies of a hot key are reduced before the shuffle, so no task ever holds all of
    them. Equal rows are interchangeable; order columns that tie are settled by the remaining
    columns. `frame` is read three times, so it should be a stored table.
    """
    counts = frame.groupBy(*[F.col(k).alias(f"_{k}") for k in keys]).agg(F.count(F.lit(1)).alias("_n"))
    repeated = counts.where("_n > 1").drop("_n")
    same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys]
    rest = [c for c in frame.columns if c not in keys]
    ranked = F.struct(*order, *[c for c in rest if c not in order])
    last = (
        frame.join(repeated, same, "left_semi")
        .groupBy(*keys)
        .agg(F.max(ranked).alias("_last"))
        .select(*keys, *[F.col("_last")[c].alias(c) for c in rest])
    )
    return frame.join(repeated, same, "left_anti").select(*keys, *rest).unionByName(last)


def upsert(
    current: DataFrame,
    incoming: DataFrame,
    keys: list[str],
    values: list[str],
    now: Column,
    batch_id: Column,
) -> DataFrame:
    """Replace `values` where the key exists, insert where it does not.

    Both sides hold each key once, so the one full outer join cannot be skewed. The
    `action` column says what happened to each row: kept, updated or inserted.
    """
    old, new = current.alias("old"), incoming.withColumn("_new", F.lit(True)).alias("new")
    joined = old.join(new, keys, "full_outer")
    arrived, known = F.col("_new").isNotNull(), F.col("old.created_at").isNotNull()

    def choose(name: str) -> Column:
        return F.when(arrived, F.col(f"new.{name}")).otherwise(F.col(f"old.{name}")).alias(name)

    return joined.select(
        *keys,
        *[choose(name) for name in values],
        F.coalesce(F.col("old.is_valid"), F.lit(True)).alias("is_valid"),
        F.col("old.validation_errors").alias("validation_errors"),
        F.coalesce(F.col("old.created_at"), now).alias("created_at"),
        F.when(arrived, now).otherwise(F.col("old.updated_at")).alias("updated_at"),
        F.when(arrived, batch_id).otherwise(F.col("old.batch_id")).alias("batch_id"),
        F.when(arrived & known, "updated")
        .when(arrived, "inserted")
        .otherwise("kept")
        .alias("action"),
    )
