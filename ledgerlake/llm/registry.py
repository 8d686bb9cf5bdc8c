"""The queries of this subpackage and their SQL."""

from __future__ import annotations

import functools
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from ledgerlake.llm import (
    bytededup,
    decontam,
    fingerprints,
    htmltext,
    licenses,
    linedup,
    mixing,
    ngramjoin,
    quality,
    simhash,
    tokenalign,
    tokencounts,
    vectorcodes,
)

ROOT = str(Path(__file__).resolve().parents[2])


def _findable(query: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    """Lets Python workers find this package where the driver did, if it is not installed."""

    @functools.wraps(query)
    def run(spark: SparkSession, folder: str) -> DataFrame:
        spark.sparkContext.environment.setdefault("PYTHONPATH", ROOT)
        return query(spark, folder)

    return run


QUERIES = {
    name: _findable(query)
    for name, query in {
        "op1_fingerprints": fingerprints.op1_fingerprints,
        "op2_source_mix": mixing.op2_source_mix,
        "op3_ngram_jaccard": ngramjoin.op3_ngram_jaccard,
        "op4_qgram_decontamination": decontam.op4_qgram_decontamination,
        "op5_line_windows": linedup.op5_line_windows,
        "op6_suffix_dedup": bytededup.op6_suffix_dedup,
        "op7_html_text": htmltext.op7_html_text,
        "op8_token_counts": tokencounts.op8_token_counts,
        "op9_license_scan": licenses.op9_license_scan,
        "op10_quality": quality.op10_quality,
        "op11_simhash_classes": simhash.op11_simhash_classes,
        "op12_token_alignment": tokenalign.op12_token_alignment,
        "op13_vector_codes": vectorcodes.op13_vector_codes,
        "pipeline": corpus_pipeline.run,
    }.items()
}

ORACLES = {
    "op2_source_mix": mixing.ORACLE,
    "op3_ngram_jaccard": ngramjoin.ORACLE,
    "op5_line_windows": linedup.ORACLE,
    "op13_vector_codes": vectorcodes.ORACLE,
}
