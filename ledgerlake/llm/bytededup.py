"""Suffix-array dedup: removes bytes of strings of a given length that occur twice.

Every window of `length` bytes has an anchor, the gram of least hash in it (the leftmost).
Equal windows have equal anchors at equal places, so windows need only be compared with
those of the same anchor. Consecutive windows with one anchor are a run. Runs whose anchor
occurs nowhere else hold no repeat. Runs of the same bytes repeat as a whole, and one of each
such class is enough; the classes that share an anchor but differ are cut out of their texts
and brought together in shards by anchor. A shard is one byte string, its runs set apart by a
byte that UTF-8 never has; its suffix array is built by induced sorting, and the permuted
common prefixes tell which windows begin a string that begins elsewhere too. An anchor with
more than `most` differing runs is split further, by window: its windows are grouped by 128
bits of hash, in partial counts, instead of meeting in one shard.

Defined results: a null text counts as empty; texts shorter than `length` lose nothing;
repeated rows are documents of their own, so their long texts go in both; extra columns are
ignored; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlake.llm.common import named, read, text_digest
from ledgerlake.llm.suffixes import repeated
from ledgerlake.session import materialize

LENGTH = 400
#: The part of a window that its anchor takes up: long anchors are rarely shared by chance.
ANCHOR = 200
MOST_RUNS = 4096
SHARD_BYTES = 1 << 21
_PIECE_BITS = 20
_APART = b"\xff"
_MIX = np.uint64(0x9E3779B97F4A7C15)


def grams(raw: np.ndarray, length: int) -> np.ndarray:
    """A hash of the gram at every place, by doubling the length of what is hashed."""
    out, width = (raw.astype(np.uint64) + np.uint64(1)) * _MIX, 1
    while width < length:
        step = min(width, length - width)
        out = (out[:-step] ^ (out[:-step] >> np.uint64(29))) * _MIX + out[step:]
        width += step
    return (out ^ (out >> np.uint64(32))) * _MIX


def anchored_runs(raw: bytes, length: int, anchor: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The first and last window of every run, and the hash of its anchor."""
    windows = len(raw) - length + 1
    firsts, lasts, anchors = [], [], []
    size = 1 << _PIECE_BITS
    for start in range(0, max(windows, 0), size):
        count = min(size, windows - start)
        hashes = grams(np.frombuffer(raw, np.uint8, count + length - 1, start), anchor)
        # High bits of the hash above the place: of equal grams the leftmost is the least.
        bits = np.uint64(_PIECE_BITS + 1)
        least = (hashes >> bits << bits) + np.arange(len(hashes), dtype=np.uint64)
        run, width = length - anchor + 1, 1
        while width < run:
            step = min(width, run - width)
            least = np.minimum(least[:-step], least[step:])
            width += step
        place = (least & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
        first = np.concatenate([[0], np.flatnonzero(place[1:] != place[:-1]) + 1])
        firsts.append(first + start)
        lasts.append(np.concatenate([first[1:], [count]]) - 1 + start)
        anchors.append(hashes[place[first]].view(np.int64))
    if not firsts:
        return np.array([], np.int64), np.array([], np.int64), np.array([], np.int64)
    return np.concatenate(firsts), np.concatenate(lasts), np.concatenate(anchors)


def _runs(docs: DataFrame, id_col: str, text_col: str, length: int, anchor: int) -> DataFrame:
    """Per row: row, id, digest, and its runs (lo, hi, a: anchor, f: hash of all its bytes)."""
    rows = docs.select(
        F.monotonically_increasing_id().alias("row"),
        text_digest(named(docs, text_col)).alias("digest"),
        named(docs, text_col).alias("text"),
        named(docs, id_col).alias("id"),
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        for batch in batches:
            columns, ends = [[], [], [], []], [0]
            for text in batch["text"]:
                raw = (text.as_py() or "").encode("utf-8", "surrogatepass")
                lo, hi, a = anchored_runs(raw, length, anchor)
                f = [
                    xxhash.xxh3_64_intdigest(raw[i : j + length])
                    for i, j in zip(lo.tolist(), hi.tolist())
                ]
                for column, part in zip(columns, (lo, hi, a, np.array(f, np.uint64).view(np.int64))):
                    column.append(part)
                ends.append(ends[-1] + len(lo))
            values = [np.concatenate(c) for c in columns]
            runs = pa.StructArray.from_arrays(
                [pa.array(values[0], pa.int32()), pa.array(values[1], pa.int32()), pa.array(values[2]), pa.array(values[3])],
                ["lo", "hi", "a", "f"],
            )
            listed = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), runs)
            yield pa.RecordBatch.from_arrays(
                [batch["row"], batch["digest"], listed, batch["id"]], ["row", "digest", "runs", "id"]
            )

    kinds = "row long, digest binary, runs array<struct<lo: int, hi: int, a: long, f: long>>"
    return rows.mapInArrow(run, f"{kinds}, id {rows.schema['id'].dataType.simpleString()}")


_CUT = T.ArrayType(
    T.StructType().add("a", T.LongType()).add("n", T.LongType()).add("m", T.LongType())
    .add("row", T.LongType()).add("lo", T.IntegerType()).add("hi", T.IntegerType()).add("raw", T.BinaryType())
)


def _cut_out(docs: DataFrame, id_col: str, text_col: str, asked: DataFrame, length: int) -> DataFrame:
    """The asked runs (a, n, m, row, lo, hi) with their bytes."""

    @F.pandas_udf(_CUT)
    def cut(texts: pd.Series, runs: pd.Series) -> pd.Series:
        out = []
        for text, some in zip(texts, runs):
            raw = text.encode("utf-8", "surrogatepass")
            out.append([{**r, "raw": raw[r["lo"] : r["hi"] + length]} for r in some])
        return pd.Series(out)

    wanted = asked.groupBy("id", "digest").agg(
        F.collect_list(F.struct("a", "n", "m", "row", "lo", "hi")).alias("runs")
    )
    texts = docs.select(
        named(docs, id_col).alias("text_id"),
        text_digest(named(docs, text_col)).alias("text_digest"),
        named(docs, text_col).alias("text"),
    )
    met = texts.join(
        wanted, texts["text_id"].eqNullSafe(wanted["id"]) & (texts["text_digest"] == wanted["digest"])
    )
    return met.select(F.explode(cut("text", "runs")).alias("run")).select("run.*")


def _sharded(pieces: DataFrame, length: int) -> DataFrame:
    """(row, low, high): the bytes of repeated windows, from the suffix arrays of shards."""

    def covers(runs: list[tuple]) -> Iterator[tuple[int, int, int]]:
        text = np.frombuffer(_APART.join(r[4] for r in runs), np.uint8)
        again = repeated(text, length)
        start = 0
        for row, lo, hi, n, raw in runs:
            if n == 1:
                found = np.flatnonzero(again[start : start + hi - lo + 1])
                if len(found):
                    splits = np.flatnonzero(np.diff(found) > 1)
                    lows = found[np.concatenate([[0], splits + 1])]
                    highs = found[np.concatenate([splits, [len(found) - 1]])]
                    for low, high in zip(lows.tolist(), highs.tolist()):
                        yield row, lo + low, lo + high + length
            start += len(raw) + 1

    def shard(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, last = [], 0, None

        def done():
            found = list(zip(*covers(held))) or [[], [], []]
            kinds = (pa.int64(), pa.int32(), pa.int32())
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(found, kinds)], ["row", "low", "high"])

        for batch in batches:
            for a, row, lo, hi, n, raw in zip(*(batch[c].to_pylist() for c in ("a", "row", "lo", "hi", "n", "raw"))):
                if last == (a, row, lo):
                    continue  # from a repeated row
                if size >= SHARD_BYTES and last[0] != a:
                    yield done()
                    held, size = [], 0
                held.append((row, lo, hi, n, raw))
                size += len(raw)
                last = (a, row, lo)
        if held:
            yield done()

    dealt = pieces.repartition("a").sortWithinPartitions("a", "row", "lo")
    return dealt.mapInArrow(shard, "row long, low int, high int")


def _by_window(pieces: DataFrame, length: int) -> DataFrame:
    """(row, low, high) of repeated windows, for anchors with very many differing runs."""

    @F.pandas_udf(T.ArrayType(T.BinaryType()))
    def windows(raws: pd.Series) -> pd.Series:
        import xxhash

        return pd.Series(
            [[xxhash.xxh3_128_digest(r[k : k + length]) for k in range(len(r) - length + 1)] for r in raws]
        )

    single = pieces.select("row", "lo", "n", F.posexplode(windows("raw")).alias("k", "window"))
    single = single.select("window", "row", (F.col("lo") + F.col("k")).alias("low"), "n").distinct()
    often = single.groupBy("window").agg(F.count("*").alias("times")).where("times > 1")
    return single.where("n = 1").join(often, "window", "left_semi").select("row", "low", (F.col("low") + length).alias("high"))


def repeated_spans(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    length: int = LENGTH,
    anchor: int = ANCHOR,
    most: int = MOST_RUNS,
) -> DataFrame:
    """id, digest and spans (low, high; they may touch) of the documents with repeated strings."""
    marked = materialize(_runs(docs, id_col, text_col, length, anchor), "byte-runs")
    runs = marked.select("row", F.inline("runs"))
    classes = runs.groupBy("a", "f").agg(
        F.count("*").alias("n"), F.first("row").alias("row"), F.first("lo").alias("lo"), F.first("hi").alias("hi")
    )
    anchors = classes.groupBy("a").agg(
        F.count("*").alias("m"), F.sum("n").alias("places"), F.min("n").alias("least")
    )
    # Spark sees one subplan in both uses of `classes`.
    tagged = materialize(classes.join(anchors.where("places > 1"), "a"), "byte-classes")
    whole = runs.join(tagged.where("n > 1").select("a", "f"), ["a", "f"], "left_semi").select(
        "row", F.col("lo").alias("low"), (F.col("hi") + length).alias("high")
    )
    asked = tagged.where("m > 1 AND least = 1").join(marked.select("row", "id", "digest"), "row")
    pieces = materialize(_cut_out(docs, id_col, text_col, asked, length), "byte-pieces")
    partly = _sharded(pieces.where(F.col("m") <= most), length).unionByName(
        _by_window(pieces.where(F.col("m") > most), length)
    )
    spans = (
        whole.unionByName(partly)
        .groupBy("row")
        .agg(F.collect_list(F.struct("low", "high")).alias("spans"))
        .join(marked.select("row", "id", "digest"), "row")
    )
    # Repeated rows have the same spans.
    return spans.groupBy("id", "digest").agg(F.first("spans").alias("spans"))


_RESULT = (
    T.StructType().add("n_bytes", T.LongType()).add("kept", T.BinaryType())
    .add("spans", T.ArrayType(T.StructType().add("low", T.LongType()).add("high", T.LongType())))
)


@F.pandas_udf(_RESULT)
def _without(texts: pd.Series, spans: pd.Series) -> pd.DataFrame:
    sizes, kept, merged = [], [], []
    for text, some in zip(texts, spans):
        raw = (text or "").encode("utf-8", "surrogatepass")
        joined: list[list[int]] = []
        for low, high in sorted((s["low"], s["high"]) for s in (some if some is not None else ())):
            if joined and low <= joined[-1][1]:
                joined[-1][1] = max(high, joined[-1][1])
            else:
                joined.append([low, high])
        edges = [0, *(x for span in joined for x in span), len(raw)]
        sizes.append(len(raw))
        kept.append(b"".join(raw[a:b] for a, b in zip(edges[::2], edges[1::2])))
        merged.append([{"low": a, "high": b} for a, b in joined])
    return pd.DataFrame({"n_bytes": sizes, "kept": kept, "spans": merged})


def dedup_bytes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """id, n_bytes, kept (the remaining bytes) and spans (the removed runs) of every row."""
    found = repeated_spans(docs, id_col, text_col, **options).withColumnRenamed("id", "span_id")
    texts = docs.select(
        named(docs, id_col).alias("id"),
        text_digest(named(docs, text_col)).alias("text_digest"),
        named(docs, text_col).alias("text"),
    )
    both = texts.join(
        found, texts["id"].eqNullSafe(found["span_id"]) & (texts["text_digest"] == found["digest"]), "left"
    )
    return both.select("id", _without("text", "spans").alias("r")).select("id", "r.*")


def op6_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    kept = dedup_bytes(read(spark, folder, "documents"))
    return kept.select(
        F.col("id").alias("doc_id"),
        "n_bytes",
        F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["high"] - s["low"]).alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )
