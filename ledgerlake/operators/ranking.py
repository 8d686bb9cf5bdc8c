"""RANK() over a whole table without bringing it into one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlake.session import materialize, result_table, scratch


def _ranked_values(frame: DataFrame, names: list[str], folder: str) -> DataFrame:
    """(measure, value, rank) of every distinct value of the measures, NULL last.

    All measures are counted in one pass, with partial counts per value, so ties of any number are
    one row. The counted values are dealt by range, largest first, and stored, which pins the
    partitions. A rank is then one more than the rows of earlier partitions, of which there is a
    sum per partition and measure, and of larger values in the same partition.
    """
    each = F.array(*[F.struct(F.lit(i).alias("measure"), F.col(n).cast("bigint").alias("value")) for i, n in enumerate(names)])
    values = frame.select(F.explode(each).alias("one")).select("one.*")
    counts = values.groupBy("measure", "value").agg(F.count(F.lit(1)).alias("n"))
    dealt = counts.repartitionByRange(F.col("measure"), F.desc_nulls_last("value"))
    stored = materialize(dealt.withColumn("part", F.spark_partition_id()), "ranges", folder)
    sums = stored.groupBy("measure", "part").agg(F.sum("n").alias("_n"))
    earlier = Window.partitionBy("measure").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select("measure", "part", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    within = Window.partitionBy("measure", "part").orderBy(F.desc_nulls_last("value"))
    above = F.coalesce(F.sum("n").over(within.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    ranked = stored.withColumn("_above", above).join(offsets, ["measure", "part"])
    return ranked.select("measure", "value", (F.col("_before") + F.col("_above") + 1).cast("bigint").alias("rank"))


def rank_all(frame: DataFrame, ranks: dict[str, Column]) -> DataFrame:
    """Add RANK() OVER (ORDER BY value DESC NULLS LAST) for each value, which are longs.

    `frame` is stored first, as it is read once for the ranks and once for the result. Ties of any
    number meet their value in a join that splits them.
    """
    keyed = frame.withColumns({f"_{name}": value for name, value in ranks.items()})
    result = stored = result_table(keyed, "ranked")
    with scratch(frame.sparkSession) as folder:
        values = result_table(_ranked_values(stored, [f"_{name}" for name in ranks], folder), "ranks")
    for i, name in enumerate(ranks):
        mine = values.where(F.col("measure") == i).select(F.col("value").alias("_value"), F.col("rank").alias(name))
        result = result.join(mine, result[f"_{name}"].eqNullSafe(mine["_value"])).drop(f"_{name}", "_value")
    return result
