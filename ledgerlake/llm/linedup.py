"""Line dedup by overlapping windows of three consecutive lines.

Every run of three lines is a window. A window found at more than one place keeps its first
place, in the order of document id, text digest and line; the lines covered by its later
places are removed, whichever windows cover them. The first place of every line that goes is
kept, as each line stays at the first place of its window or of an earlier one.

Defined results: null and empty texts and texts of fewer than three lines have no windows and
stay as they are; rows with the same id and text are one document to the search, so they lose
the same lines and are no copies of each other; a null id comes first; an empty table gives no
rows; extra columns are kept and never read.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlake.llm.common import named, read, text_digest

WINDOW_LINES = 3


@F.pandas_udf(T.ArrayType(T.BinaryType()))
def window_digests(texts: pd.Series) -> pd.Series:
    """128-bit digests of every window of a text's lines, in order."""
    import xxhash

    out = []
    for text in texts:
        lines = [xxhash.xxh3_128_digest(x) for x in text.encode("utf-8", "surrogatepass").split(b"\n")]
        windows = zip(*(lines[k:] for k in range(WINDOW_LINES)))
        out.append([xxhash.xxh3_128_digest(b"".join(w)) for w in windows])
    return pd.Series(out)


def covered(starts: list[int], lines: int) -> np.ndarray:
    """Which of so many lines lie in a window that begins at one of `starts`."""
    change = np.zeros(lines + WINDOW_LINES + 1, np.int32)
    np.add.at(change, starts, 1)
    np.add.at(change, np.asarray(starts) + WINDOW_LINES, -1)
    return np.cumsum(change)[:lines] > 0


@F.pandas_udf(T.StructType().add("text", T.StringType()).add("removed", T.IntegerType()))
def without_lines(texts: pd.Series, starts: pd.Series) -> pd.DataFrame:
    kept, removed = [], []
    for text, at in zip(texts, starts):
        if at is None or not len(at):
            kept.append(text)
            removed.append(0)
            continue
        lines = text.split("\n")
        gone = covered(list(at), len(lines))
        kept.append("\n".join(x for x, g in zip(lines, gone) if not g))
        removed.append(int(gone.sum()))
    return pd.DataFrame({"text": kept, "removed": pd.Series(removed, dtype="int32")})


def later_windows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document that has later places of windows: _ll_id, _ll_digest, _ll_starts.

    Windows are combined in the map tasks before they are shuffled, so a passage that many
    documents share is a few rows per task; the places meet the repeated windows in a join,
    whose hot keys Spark splits.
    """
    text = named(docs, text_col)
    places = (
        docs.select(named(docs, id_col).alias("_ll_id"), text_digest(text).alias("_ll_digest"), text.alias("_ll_text"))
        .where(F.size(F.split("_ll_text", "\n", WINDOW_LINES)) >= WINDOW_LINES)
        .select("_ll_id", "_ll_digest", F.posexplode(window_digests("_ll_text")).alias("line", "window"))
        .select("window", F.struct("_ll_id", "_ll_digest", "line").alias("place"))
    )
    repeated = (
        places.groupBy("window")
        .agg(F.min("place").alias("first"), F.max("place").alias("last"))
        .where("first != last")
        .select("window", "first")
    )
    return (
        places.join(repeated, "window")
        .where("place != first")
        .groupBy("place._ll_id", "place._ll_digest")
        .agg(F.collect_set("place.line").alias("_ll_starts"))
    )


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`docs` with later windows cut from the text, and the number of lines removed.

    The columns of `docs` come first, then `_ll_removed` and `_ll_emptied` (lines went and
    nothing but white space is left).
    """
    found = later_windows(docs, id_col, text_col)
    left = docs.withColumns(
        {"_ll_doc_id": named(docs, id_col), "_ll_doc_digest": text_digest(named(docs, text_col))}
    )
    both = left.join(
        found,
        left["_ll_doc_id"].eqNullSafe(found["_ll_id"]) & (left["_ll_doc_digest"] == found["_ll_digest"]),
        "left",
    ).withColumn("_ll_cut", without_lines(named(left, text_col), "_ll_starts"))
    removed = F.col("_ll_cut.removed")
    return both.select(
        *[F.col("_ll_cut.text").alias(c) if c == text_col else named(both, c) for c in docs.columns],
        removed.alias("_ll_removed"),
        ((removed > 0) & F.col("_ll_cut.text").rlike(r"^\s*$")).alias("_ll_emptied"),
    )


def remaining(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents without repeated windows; those that lost all their text are left out."""
    cut = dedup_lines(docs, id_col, text_col).where("NOT _ll_emptied")
    return cut.select(*[named(cut, c) for c in docs.columns])


def sha256(text: Column) -> Column:
    return F.sha2(F.coalesce(text, F.lit("")).cast("binary"), 256)


def op5_line_windows(spark: SparkSession, folder: str) -> DataFrame:
    cut = dedup_lines(read(spark, folder, "documents").select("doc_id", "text"))
    return cut.select(
        "doc_id",
        F.col("_ll_removed").alias("n_removed"),
        F.coalesce(F.length("text"), F.lit(0)).alias("n_kept_chars"),
        sha256(F.col("text")).alias("kept_sha256"),
        F.col("_ll_emptied").alias("emptied"),
    )


ORACLE = r"""
WITH lines AS (
  SELECT doc_id, coalesce(md5(text), '') AS digest, string_split(text, chr(10)) AS line
  FROM documents
), windows AS (
  SELECT DISTINCT doc_id, digest, unnest(range(1, len(line) - 1)) AS pos, line
  FROM lines WHERE len(line) >= 3
), named AS (
  SELECT doc_id, digest, pos, line[pos] || chr(10) || line[pos + 1] || chr(10) || line[pos + 2] AS content
  FROM windows
), ordered AS (
  SELECT *, row_number() OVER (PARTITION BY content ORDER BY doc_id NULLS FIRST, digest, pos) AS turn
  FROM named
), later AS (
  SELECT doc_id, digest, list(pos) AS starts FROM ordered WHERE turn > 1 GROUP BY doc_id, digest
), cut AS (
  SELECT l.doc_id, len(l.line) AS n, l.line,
         CASE WHEN s.starts IS NULL THEN l.line ELSE
           [l.line[i] FOR i IN range(1, len(l.line) + 1)
            IF NOT (list_contains(s.starts, i) OR list_contains(s.starts, i - 1)
                    OR list_contains(s.starts, i - 2))] END AS kept
  FROM lines l LEFT JOIN later s ON l.doc_id IS NOT DISTINCT FROM s.doc_id AND l.digest = s.digest
)
SELECT doc_id,
       coalesce(len(line) - len(kept), 0)::INT AS n_removed,
       length(coalesce(array_to_string(kept, chr(10)), ''))::INT AS n_kept_chars,
       sha256(coalesce(array_to_string(kept, chr(10)), '')) AS kept_sha256,
       coalesce(len(line) > len(kept) AND regexp_full_match(array_to_string(kept, chr(10)), '\s*'), false)
         AS emptied
FROM cut
"""
