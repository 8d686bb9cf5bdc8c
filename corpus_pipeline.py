"""A training corpus from raw documents, in five stages.

Each stage takes what its predecessor kept, as written Parquet, and its decisions take effect
there: documents of low quality go, lines of repeated windows are cut, one document of each
group of similar ones stays, documents with benchmark items go, and the rest are mixed to
target weights. All but the last stage return the columns of documents; the last returns the
blocks of the mix, with cuts and repeats, numbered in their order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ledgerlake.llm import decontam, linedup, mixing, ngramjoin, quality
from ledgerlake.llm.common import read
from ledgerlake.session import materialize


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.accepted(docs, read(spark, sf_dir, "labels"))


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return linedup.remaining(docs)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return ngramjoin.one_of_each(docs, words=5, percent=80)


def benchmark_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontam.clean(docs, read(spark, sf_dir, "benchmark"))


def mix_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed_blocks(docs)


STAGES = [
    ("quality classifier", quality_stage),
    ("line dedup", line_stage),
    ("n-gram Jaccard join", near_stage),
    ("benchmark decontamination", benchmark_stage),
    ("mixing sources", mix_stage),
]

#: A fitted classifier and edit distances are not for SQL; the tests hold brute force against it.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
