"""Tables dealt into slices by key, for steps that are taken slice by slice.

A step that shuffles whole rows several times has the table on disk as many times over. Taken by
slices, one after the other, it has the shuffle files of one slice at a time, and a slice is gone
when its result is written. Rows of one key lie in one slice, so a step that only brings rows of
one key together gives the same rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.session import COMPACT, discard, hadoop_path, place_of, setting, shuffles_dropped

SLICES = 8
#: Slices are taken together up to this size, so that small tables are taken whole.
LEAST_BYTES = 16 << 20
_SLICE = "ll_slice"

Mine = Callable[[DataFrame], DataFrame]


def slice_of(keys: list[str]) -> Column:
    """The number of a row's slice; NULL is a key like others."""
    return F.pmod(F.xxhash64(*keys), F.lit(SLICES)).cast("int")


def turns(size: int) -> int:
    """In how many turns a table of so many bytes is taken."""
    return max(1, min(SLICES, size // LEAST_BYTES))


def bytes_of(spark, folder: str) -> int:
    path, fs = hadoop_path(spark, folder)
    return fs.getContentSummary(path).getLength() if fs.exists(path) else 0


@dataclass(frozen=True)
class Dealt:
    """A stored table in a folder per slice."""

    frame: DataFrame
    keys: list[str]
    folder: str

    def taken(self) -> Iterator[tuple[DataFrame, Mine]]:
        """The rows of some slices, and what restricts another table with the same keys to them.

        All slices get their turn, also those without rows. The rows are gone when the next ones
        are asked for, so each turn's result has to be written before.
        """
        spark, schema = self.frame.sparkSession, self.frame.schema
        number = turns(bytes_of(spark, self.folder))
        for turn in range(number):
            slices = list(range(turn, SLICES, number))
            paths = [f"{self.folder}/{_SLICE}={i}" for i in slices]
            there = [path for path in paths if bytes_of(spark, path)]
            rows = spark.read.schema(schema).parquet(*there) if there else spark.createDataFrame([], schema)
            yield rows, lambda other: other.where(slice_of(self.keys).isin(slices)) if number > 1 else other
            for path in there:
                discard(spark, path)
        discard(spark, self.folder)


def deal(frame: DataFrame, keys: list[str], label: str, folder: str | None = None) -> Dealt:
    """Write `frame` in slices by `keys`, without a shuffle: every task writes to all of them."""
    spark = frame.sparkSession
    path = place_of(spark, label, folder)
    # As many files are open at once as there are slices, so rows need not be sorted by slice.
    with shuffles_dropped(spark), setting(spark, "spark.sql.maxConcurrentOutputFileWriters", str(SLICES)):
        frame.withColumn(_SLICE, slice_of(keys)).write.partitionBy(_SLICE).parquet(path, compression=COMPACT)
    return Dealt(spark.read.schema(frame.schema).parquet(path).drop(_SLICE), keys, path)


def stored(parts: Iterable[DataFrame], label: str, folder: str | None = None) -> DataFrame:
    """The rows of all parts as one table. Each part is written before the next is asked for."""
    path = None
    for part in parts:
        spark, schema = part.sparkSession, part.schema
        path = path or place_of(spark, label, folder)
        with shuffles_dropped(spark):
            part.write.mode("append").parquet(path, compression=COMPACT)
    return spark.read.schema(schema).parquet(path)
