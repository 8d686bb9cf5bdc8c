"""Document fingerprints: digests of improbable features.

A text's bytes are read through a window of 64 bytes. The entropy of a window, in a thousand
steps, says how common it is: the rarer its entropy in the whole corpus, the lower its rank.
In every run of 64 windows the one of lowest rank (the first of them) gains a point; windows
with 16 points or more, whose entropy is not extreme, are the features. Each feature's SHA-1
sets five bits in a Bloom filter of 2048 bits; after 160 features the next filter is chained
on. Two fingerprints are compared filter by filter: the bits in common, above what chance
gives and relative to the most there could be, the best match of each filter of the shorter
chain, averaged.

Short texts have few features or none. Those of fewer than 1024 bytes, and any text without
features, have a filter of their words' digests besides. Two texts that both have words are
compared by these if one of them has fewer than eight features; all others by features. Only
a text without any feature has nothing in common with a long one.

Defined results: a null text counts as empty; an empty text has an empty fingerprint, which is
like another empty one (1) and unlike any other (0); equal texts have equal fingerprints; rows
are followed by the next in the order of id and text digest, null ids first, the last by the
first, and a single row by itself; repeated rows follow each other; extra columns are ignored;
an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlake.llm.common import named, read

WINDOW = 64
LEVELS = 1000
LOWEST, HIGHEST = 100, 990
POINTS = 16
FILTER_BITS = 2048
FILTER_FEATURES = 160
HASHES = 5
#: Texts of fewer bytes have a filter of words too, which counts if there are few features.
SHORT, FEW = 1024, 8
HEADER = 6
PIECE_BYTES = 1 << 17

#: Documents of neighbouring ids are dealt out in groups of about so many.
GROUP_ROWS = 1 << 14

_COUNTS = np.arange(WINDOW + 1)
_TERMS = np.zeros(WINDOW + 1)
_TERMS[1:] = _COUNTS[1:] * np.log2(_COUNTS[1:])
# Whole numbers, so that sums along a text are exact and equal bytes give equal results.
_TERMS = np.round(_TERMS * (1 << 20)).astype(np.int64)
_FULL = int(_TERMS[WINDOW])


def entropies(raw: np.ndarray) -> np.ndarray:
    """The entropy of every window, from 0 to LEVELS, by what each step adds and drops."""
    size = len(raw)
    if size < WINDOW:
        return np.array([], np.int16)
    # How often a byte stands in the window's length before it, and after it.
    before, after = np.zeros(size, np.int8), np.zeros(size, np.int8)
    for step in range(1, WINDOW):
        same = (raw[step:] == raw[:-step]).view(np.int8)
        before[step:] += same
        after[:-step] += same
    added = _TERMS[before + 1] - _TERMS[before]
    dropped = _TERMS[after + 1] - _TERMS[after]
    total = np.cumsum(added)[WINDOW - 1 :]
    total[1:] -= np.cumsum(dropped)[: size - WINDOW]
    return ((_FULL - total) * LEVELS // _FULL).astype(np.int16)


def levels_of(raws: list[bytes]) -> list[np.ndarray]:
    """The window entropies of several texts, worked out in one go."""
    levels = entropies(np.frombuffer(b"".join(raws), np.uint8))
    ends = np.cumsum([len(r) for r in raws])
    return [levels[end - len(r) : max(end - WINDOW + 1, end - len(r))] for r, end in zip(raws, ends)]


def features(levels: np.ndarray, ranks: np.ndarray) -> np.ndarray:
    """The places of the improbable windows of a text, given its windows' entropies."""
    if not len(levels):
        return np.array([], np.int64)
    run = min(WINDOW, len(levels))
    kind, bits = (np.int32, 21) if len(levels) < 1 << 21 else (np.int64, 48)
    key = (ranks[levels].astype(kind) << bits) + np.arange(len(levels), dtype=kind)
    least, width = key, 1
    while width < run:
        step = min(width, run - width)
        least = np.minimum(least[:-step], least[step:])
        width += step
    starts = np.concatenate([[0], np.flatnonzero(least[1:] != least[:-1]) + 1])
    points = np.diff(np.concatenate([starts, [len(least)]]))
    place = (least[starts] & ((1 << bits) - 1))[points >= min(POINTS, run)].astype(np.int64)
    return place[(levels[place] >= LOWEST) & (levels[place] <= HIGHEST)]


def _filters(items: list[bytes]) -> list[bytes]:
    digests = list(dict.fromkeys(hashlib.sha1(x).digest() for x in items))
    bits = np.frombuffer(b"".join(digests), np.uint32).reshape(-1, HASHES) % FILTER_BITS
    chain: list[bytes] = []
    for k in range(0, len(bits), FILTER_FEATURES):
        filled = np.zeros(FILTER_BITS, np.uint8)
        filled[bits[k : k + FILTER_FEATURES].ravel()] = 1
        chain.append(np.packbits(filled).tobytes())
    return chain


def _chained(raw: bytes, places: list[int]) -> bytes:
    """A mark (1: features, 2: words, 3: both), how many features there are up to FEW, the number
    of word filters, and the filters."""
    if not raw:
        return b""
    chain = _filters([raw[p : p + WINDOW] for p in places])
    words = _filters(raw.split() or [raw]) if len(raw) < SHORT or not chain else []
    mark = bool(chain) + 2 * bool(words)
    return bytes([mark, min(len(places), FEW)]) + len(words).to_bytes(4, "big") + b"".join(words + chain)


def digests(raws: list[bytes], ranks: np.ndarray) -> list[tuple[bytes, np.ndarray]]:
    """Fingerprint and feature places of every text."""
    out = []
    for raw, levels in zip(raws, levels_of(raws)):
        places = features(levels, ranks)
        out.append((_chained(raw, places), places))
    return out


def digest(raw: bytes, ranks: np.ndarray) -> bytes:
    return digests([raw], ranks)[0][0]


def redone(
    raws: list[bytes], same: list[int], old: list[np.ndarray], ranks: np.ndarray
) -> list[bytes]:
    """Fingerprints of texts of which the first so many bytes, and features there, are known.

    A feature depends on the runs that it stands in, so on 63 bytes before it and 126 after.
    """
    reach = 2 * (WINDOW - 1)
    starts = [n - reach - WINDOW if n >= 8 * WINDOW else 0 for n in same]
    out = []
    for raw, n, start, places, levels in zip(
        raws, same, starts, old, levels_of([r[s:] for r, s in zip(raws, starts)])
    ):
        found = features(levels, ranks) + start
        if start:
            found = np.concatenate([places[places < n - reach], found[found >= n - reach]])
        out.append(_chained(raw, found))
    return out


def _numbers(chain: bytes, low: int, high: int) -> list[tuple[int, int]]:
    size = FILTER_BITS // 8
    values = (int.from_bytes(chain[HEADER + k * size : HEADER + (k + 1) * size]) for k in range(low, high))
    return [(v, v.bit_count()) for v in values]


def likeness(a: bytes, b: bytes) -> float:
    """From 0 to 1; the same for (a, b) and (b, a)."""
    if a == b:
        return 1.0
    if not a or not b or not a[0] & b[0]:
        return 0.0
    both, sides = a[0] & b[0], []
    by_words = both == 2 or both == 3 and min(a[1], b[1]) < FEW
    for chain in (a, b):
        words, filters = int.from_bytes(chain[2:HEADER]), (len(chain) - HEADER) * 8 // FILTER_BITS
        sides.append(_numbers(chain, 0, words) if by_words else _numbers(chain, words, filters))
    one, two = sorted(sides, key=lambda side: (len(side), side))
    total = 0.0
    for x, nx in one:
        best = 0.0
        for y, ny in two:
            most, chance = min(nx, ny), nx * ny / FILTER_BITS
            cut = chance + 0.3 * (most - chance)
            best = max(best, ((x & y).bit_count() - cut) / max(most - cut, 1e-9))
        total += min(1.0, best)
    return total / len(one)


def _pieces(batch: pa.RecordBatch, column: str) -> Iterator[tuple[int, list[bytes]]]:
    """The texts of a batch as bytes, in runs that fit a processor's cache, with their start."""
    held, size, start = [], 0, 0
    for k, text in enumerate(batch[column]):
        held.append((text.as_py() or "").encode("utf-8", "surrogatepass"))
        size += len(held[-1])
        if size >= PIECE_BYTES:
            yield start, held
            held, size, start = [], 0, k + 1
    if held:
        yield start, held


def corpus_ranks(texts: DataFrame, text_col: str) -> np.ndarray:
    """Ranks of the entropy levels by how rare they are in all texts, the rarest first.

    Every task sends one row per level it met.
    """
    rows = texts.select(named(texts, text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(LEVELS + 1, np.int64)
        for batch in batches:
            for _, raws in _pieces(batch, "text"):
                for levels in levels_of(raws):
                    counts += np.bincount(levels, minlength=LEVELS + 1)
        met = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(met), pa.array(counts[met])], ["level", "n"])

    counts = np.zeros(LEVELS + 1, np.int64)
    for level, n in rows.mapInArrow(run, "level long, n long").groupBy("level").agg(F.sum("n")).collect():
        counts[level] = n
    ranks = np.empty(LEVELS + 1, np.int64)
    ranks[np.lexsort((np.arange(LEVELS + 1), counts))] = np.arange(LEVELS + 1)
    return ranks


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id and fingerprint (binary) of every row."""
    ranks = corpus_ranks(docs, text_col)

    @F.pandas_udf(T.BinaryType())
    def printed(texts: pd.Series) -> pd.Series:
        return pd.Series([digest((t or "").encode("utf-8", "surrogatepass"), ranks) for t in texts], dtype="object")

    return docs.select(named(docs, id_col).alias("id"), printed(named(docs, text_col)).alias("fingerprint"))


def _grouped(docs: DataFrame, id_col: str, text_col: str, group_rows: int) -> tuple[DataFrame, int]:
    """Rows (id, text, group, trails): neighbours by id share a group, and the first id of each
    group also trails the group before it (the first of all, the last group).

    Only the least id of each group comes to the driver.
    """
    spark = docs.sparkSession
    rows = docs.select(named(docs, id_col).cast("long").alias("id"), named(docs, text_col).alias("text"))
    ids = rows.select("id").distinct()
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), ids.count() // group_rows + 1)
    firsts = (
        ids.repartitionByRange(parts, F.col("id").asc_nulls_first())
        .groupBy(F.spark_partition_id().alias("part"))
        .agg(F.min(F.coalesce("id", F.lit(-(1 << 63)))).alias("first"))
        .collect()
    )
    cuts = np.sort(np.array([r["first"] for r in firsts], np.int64))
    last = max(len(cuts) - 1, 0)

    @F.pandas_udf(T.ArrayType(T.LongType()))
    def groups(some: pd.Series) -> pd.Series:
        values = some.astype("Int64").fillna(-(1 << 63)).to_numpy(np.int64)
        at = np.searchsorted(cuts, values, side="right") - 1
        # A trailing copy is told by a negative number.
        before = np.where(at > 0, at - 1, last)
        return pd.Series([[g, -1 - b] if cuts[g] == v else [g] for g, b, v in zip(at, before, values)])

    spread = rows.select("id", "text", F.explode(groups("id")).alias("g"))
    return spread.select(
        "id", "text", F.when(F.col("g") < 0, -1 - F.col("g")).otherwise(F.col("g")).alias("group"),
        (F.col("g") < 0).alias("trails"),
    ), len(cuts)


def with_next(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", group_rows: int = GROUP_ROWS
) -> DataFrame:
    """Every row with the fingerprints of its text, of its edited text, and their likeness.

    Columns: id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited,
    near_next. The texts are shuffled once, into sorted groups that are read as a stream with
    one row in hand, whatever their size. The edited text is that with its last quarter of
    characters replaced by as many first ones of the next row's text.
    """
    ranks = corpus_ranks(docs, text_col)
    rows, _ = _grouped(docs, id_col, text_col, group_rows)
    dealt = rows.repartition("group").sortWithinPartitions("group", "trails", F.col("id").asc_nulls_first(), F.md5("text"))
    schema = (
        "id long, n_chars long, edited_sha256 string, fingerprint binary, edited_fingerprint binary,"
        " near_edited double, near_next double"
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [field.split()[0] for field in schema.split(", ")]
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.binary(), pa.binary(), pa.float64(), pa.float64()]
        held = None  # the last row, its successor is still to come
        for batch in batches:
            ids, groups, trails = (batch[c].to_pylist() for c in ("id", "group", "trails"))
            for start, raws in _pieces(batch, "text"):
                pairs = []
                for k, (raw, (own, places)) in enumerate(zip(raws, digests(raws, ranks)), start):
                    row = (ids[k], raw, own, places, groups[k])
                    if held and held[4] == groups[k]:
                        pairs.append((held, row))
                    held = None if trails[k] else row
                if pairs:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, kind) for c, kind in zip(zip(*_compared(pairs, ranks)), kinds)], names
                    )

    return dealt.mapInArrow(run, schema)


def _compared(pairs: list[tuple[tuple, tuple]], ranks: np.ndarray) -> Iterator[tuple]:
    """The result of each row and the next one, (id, bytes, fingerprint, places, ...) each."""
    sizes, changed, same = [], [], []
    for (_, raw, *_), (_, following, *_) in pairs:
        text, other = (x.decode("utf-8", "surrogatepass") for x in (raw, following))
        gone = len(text) // 4
        new = other[:gone].encode("utf-8", "surrogatepass")
        kept = len(raw) - len(text[len(text) - gone :].encode("utf-8", "surrogatepass"))
        sizes.append(len(text))
        changed.append(raw[:kept] + new)
        same.append(kept)
    others = redone(changed, same, [held[3] for held, _ in pairs], ranks)
    for (held, row), size, new, other in zip(pairs, sizes, changed, others):
        yield (
            held[0], size, hashlib.sha256(new).hexdigest(), held[2], other,
            likeness(held[2], other), likeness(held[2], row[2]),
        )


def op1_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    found = with_next(read(spark, folder, "documents"))
    return found.select(
        F.col("id").alias("doc_id"), "n_chars", "edited_sha256", F.lower(F.hex("fingerprint")).alias("fingerprint"),
        F.lower(F.hex("edited_fingerprint")).alias("edited_fingerprint"), "near_edited", "near_next",
    )
