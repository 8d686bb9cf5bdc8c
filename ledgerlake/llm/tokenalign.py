"""Alignment of two tokenizers over the same bytes, by sparse products of incidence matrices.

Tokens of a byte-level BPE (A) and of a sentence-piece model (B) cover the same bytes. A's
token-byte incidence times the transpose of B's gives the overlap links: which tokens share
bytes, and how many. Where neighbouring A tokens have no B token in common, both tokenizations
end, so the links cut the bytes into groups. The incidence of A's ids with groups times that of
B's gives the shared-group links of every pair of ids, with their number. Matrices are rows of
compressed indices in numpy, and products go row by row, as Gustavson's do: the rows of the
right side that a row names are put one after another and equal columns are added up. Many
short documents make up one matrix, since no group crosses documents, and products are made in
blocks of rows, so that long ones stay in bounds.

How many documents hold a pair is counted over the corpus. A task deals its documents into
parts of some millions of tokens, and keeps a part's distinct pairs once, so that not every
document's pairs have to be shuffled. Parts send their pairs to be added up, and get the
counts back, joined by pair and dealt by part; no table of all pairs is ever in one place.

Defined results: null and empty texts, and those whose A or B tokens do not join to the bytes of
space+text, have no tokens, hence zeros and an empty digest; strings of special tokens are
plain text; repeated rows are documents of their own; a null id is passed on; an empty table
gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from dataclasses import dataclass
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.llm.common import named, read
from ledgerlake.session import materialize, result_table, scratch

#: Public vocabularies.
BYTE_BPE = "/opt/tokenizers/byte_bpe_50k.json"
PIECE_BPE = "/opt/tokenizers/piece_bpe_32k.model"
# The pattern by which the byte-level pre-tokenizer cuts texts, a fixed value.
PATTERN = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
)
# Bytes of one matrix, products of one block, and tokens of one part, each but for one document.
MATRIX_BYTES, BLOCK_PRODUCTS, PART_TOKENS = 1 << 19, 1 << 20, 1 << 20
# Ids are below this.
IDS = 1 << 16


# ------------------------------------------------------------------ sparse matrices


@dataclass
class Csr:
    """A sparse matrix by rows: row r has columns idx[ptr[r]:ptr[r + 1]], ascending, with values."""

    ptr: np.ndarray
    idx: np.ndarray
    val: np.ndarray
    cols: int


def incidence(rows: np.ndarray, columns: np.ndarray, n_rows: int, n_cols: int) -> Csr:
    """How often each (row, column) occurs."""
    keys, counts = np.unique(rows.astype(np.int64) * n_cols + columns, return_counts=True)
    ptr = np.searchsorted(keys, np.arange(n_rows + 1, dtype=np.int64) * n_cols)
    return Csr(ptr, keys % n_cols, counts.astype(np.int64), n_cols)


def product(a: Csr, b: Csr, block: int = BLOCK_PRODUCTS) -> Csr:
    """a·b by rows: each entry of a row of `a` names a row of `b`, whose entries it scales."""
    n_rows = len(a.ptr) - 1
    sizes = np.diff(b.ptr)[a.idx]
    before = np.concatenate([[0], np.cumsum(sizes)])[a.ptr]
    row_of = np.repeat(np.arange(n_rows), np.diff(a.ptr))
    keys, values, low = [], [], 0
    while low < n_rows:
        high = max(low + 1, int(np.searchsorted(before, before[low] + block, "right")) - 1)
        entries = np.arange(a.ptr[low], a.ptr[high])
        each = sizes[entries]
        entry = np.repeat(entries, each)
        place = np.arange(len(entry)) - np.repeat(np.cumsum(each) - each, each)
        source = b.ptr[a.idx[entry]] + place
        key = row_of[entry] * b.cols + b.idx[source]
        value = a.val[entry] * b.val[source]
        if len(key):
            if (key[1:] < key[:-1]).any():
                order = np.argsort(key, kind="stable")
                key, value = key[order], value[order]
            first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
            keys.append(key[first])
            values.append(np.add.reduceat(value, first))
        low = high
    key = np.concatenate(keys) if keys else np.zeros(0, np.int64)
    value = np.concatenate(values) if values else np.zeros(0, np.int64)
    ptr = np.searchsorted(key, np.arange(n_rows + 1, dtype=np.int64) * b.cols)
    return Csr(ptr, key % b.cols, value, b.cols)


# ----------------------------------------------------------------------- tokenizers


class ByteTokenizer:
    """The byte-level BPE of a vocabulary file, with the bytes of its tokens."""

    def __init__(self, content: bytes):
        import tiktoken

        model = json.loads(content)
        special = {token["id"] for token in model["added_tokens"]}
        letter_bytes = byte_letters()
        ranks = {
            bytes(letter_bytes[c] for c in token): number
            for token, number in model["model"]["vocab"].items()
            if number not in special
        }
        self.encoding = tiktoken.Encoding("byte-bpe", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.token_bytes = [b""] * (max(ranks.values()) + 1)
        for token, number in ranks.items():
            self.token_bytes[number] = token

    def encode(self, texts: list[str]) -> list[list[int]]:
        return [self.encoding.encode_ordinary(" " + text) for text in texts]


class PieceTokenizer:
    """The sentence-piece model of a file, which puts a space before the text itself."""

    def __init__(self, content: bytes):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_proto=content)
        self.token_bytes = [
            bytes([int(self.model.id_to_piece(i)[3:5], 16)])
            if self.model.is_byte(i)
            else self.model.id_to_piece(i).replace("▁", " ").encode()
            for i in range(self.model.vocab_size())
        ]

    def encode(self, texts: list[str]) -> list[list[int]]:
        return self.model.encode(texts, num_threads=1)


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in byte-level vocabularies: printable bytes are their
    own letters, the others are numbered from 256 up."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(256 + k): b for k, b in enumerate(others)}


# ------------------------------------------------------------------------ alignment


@dataclass
class Aligned:
    """Some documents' tokens, one after another, and what links them.

    `a_ptr` and `b_ptr` cut the tokens by document. `overlap` has a row for each A token, a column
    for each B token, and the bytes they share. `a_group` and `b_group` number the groups, and
    `group_ptr` cuts those by document. `pairs` has a row for each (document, A id) in
    `pair_rows`, a column for each B id, and how many links they have.
    """

    a: np.ndarray
    b: np.ndarray
    a_ptr: np.ndarray
    b_ptr: np.ndarray
    overlap: Csr
    a_group: np.ndarray
    b_group: np.ndarray
    group_ptr: np.ndarray
    pair_rows: np.ndarray
    pairs: Csr


class Aligner:
    def __init__(self, byte_bpe: bytes, piece_bpe: bytes):
        self.one, self.two = ByteTokenizer(byte_bpe), PieceTokenizer(piece_bpe)
        self.one_sizes = np.array([len(t) for t in self.one.token_bytes], np.int64)
        self.two_sizes = np.array([len(t) for t in self.two.token_bytes], np.int64)

    def tokens(self, texts: list[str | None]) -> tuple[list[list[int]], list[list[int]]]:
        """Tokens of both, none where they do not join to the bytes of space+text."""
        given = [text or "" for text in texts]
        a, b = self.one.encode(given), self.two.encode(given)
        one, two = self.one.token_bytes, self.two.token_bytes
        for k, text in enumerate(given):
            whole = b" " + text.encode("utf-8", "surrogatepass")
            same = text and b"".join([one[i] for i in a[k]]) == whole == b"".join([two[i] for i in b[k]])
            if not same:
                a[k], b[k] = [], []
        return a, b

    def align(self, texts: list[str | None]) -> Aligned:
        a_lists, b_lists = self.tokens(texts)
        a_ptr = np.concatenate([[0], np.cumsum([len(t) for t in a_lists], dtype=np.int64)])
        b_ptr = np.concatenate([[0], np.cumsum([len(t) for t in b_lists], dtype=np.int64)])
        a = np.fromiter((i for t in a_lists for i in t), np.int64, a_ptr[-1])
        b = np.fromiter((i for t in b_lists for i in t), np.int64, b_ptr[-1])
        sizes, others = self.one_sizes[a], self.two_sizes[b]
        n_bytes = int(sizes.sum())
        ones = np.ones(n_bytes, np.int64)
        bytes_of_a = Csr(np.concatenate([[0], np.cumsum(sizes)]), np.arange(n_bytes), ones, n_bytes)
        b_of_byte = Csr(np.arange(n_bytes + 1), np.repeat(np.arange(len(b)), others), ones, len(b))
        overlap = product(bytes_of_a, b_of_byte)
        # A token starts a group if it shares no B token with the one before.
        firsts, lasts = overlap.idx[overlap.ptr[:-1]], overlap.idx[overlap.ptr[1:] - 1]
        starts = np.concatenate([np.ones(min(len(a), 1), bool), firsts[1:] > lasts[:-1]])
        a_group = np.cumsum(starts) - 1
        b_group = np.zeros(len(b), np.int64)
        b_group[overlap.idx] = np.repeat(a_group, np.diff(overlap.ptr))
        n_groups = int(a_group[-1]) + 1 if len(a) else 0
        group_ptr = np.concatenate([[0], np.cumsum(starts)])[a_ptr]
        # Ids of A by document times groups, and groups times ids of B.
        doc = np.repeat(np.arange(len(texts)), np.diff(a_ptr))
        pair_rows, row = np.unique(doc * IDS + a, return_inverse=True)
        pairs = product(incidence(row, a_group, len(pair_rows), max(n_groups, 1)), incidence(b_group, b, n_groups, IDS))
        return Aligned(a, b, a_ptr, b_ptr, overlap, a_group, b_group, group_ptr, pair_rows, pairs)


class Groups:
    """Writes groups as text: ids of A, a bar, ids of B, and a semicolon between groups."""

    def __init__(self, ids: int = IDS):
        self.table = [f"{i}{end}" for end in (",", "|", ";", "") for i in range(ids)]
        self.ids = ids

    def texts(self, found: Aligned) -> list[str]:
        last_a = np.concatenate([found.a_group[1:] != found.a_group[:-1], np.ones(min(len(found.a), 1), bool)])
        last_b = np.concatenate([found.b_group[1:] != found.b_group[:-1], np.ones(min(len(found.b), 1), bool)])
        # In the order of groups, those of A first.
        n_groups = int(found.group_ptr[-1])
        a_before = np.concatenate([[0], np.cumsum(np.bincount(found.a_group, minlength=n_groups))])
        b_before = np.concatenate([[0], np.cumsum(np.bincount(found.b_group, minlength=n_groups))])
        codes = np.zeros(len(found.a) + len(found.b), np.int64)
        codes[np.arange(len(found.a)) + b_before[found.a_group]] = found.a + self.ids * last_a
        ends = np.where(last_b, 2, 0)
        filled = found.b_ptr[1:][np.diff(found.b_ptr) > 0]
        ends[filled - 1] = 3
        codes[np.arange(len(found.b)) + a_before[found.b_group + 1]] = found.b + self.ids * ends
        parts, cuts, table = codes.tolist(), (found.a_ptr + found.b_ptr).tolist(), self.table
        return ["".join([table[c] for c in parts[low:high]]) for low, high in zip(cuts, cuts[1:])]


def _blocks(texts: pa.Array) -> Iterator[tuple[int, int, list[str | None]]]:
    """Ranges of texts that make up one matrix, and these texts."""
    low, size = 0, 0
    for k, length in enumerate(pc.binary_length(texts).fill_null(0).to_pylist()):
        size += length + 1
        if size >= MATRIX_BYTES:
            yield low, k + 1, texts[low : k + 1].to_pylist()
            low, size = k + 1, 0
    if low < len(texts):
        yield low, len(texts), texts[low:].to_pylist()


def _vocabularies(spark: SparkSession, byte_bpe: str, piece_bpe: str):
    """The two files, a few MB each, sent along with the tasks."""
    return spark.sparkContext.broadcast((Path(byte_bpe).read_bytes(), Path(piece_bpe).read_bytes()))


def links(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    byte_bpe: str = BYTE_BPE, piece_bpe: str = PIECE_BPE,
) -> DataFrame:
    """Per row: id, the tokens of both, their groups within the document, and the overlap links.

    `overlaps` has (a, b, bytes), where a and b number the document's tokens from 0.
    """
    rows = docs.select(named(docs, id_col).alias("id"), named(docs, text_col).alias("text"))
    files = _vocabularies(docs.sparkSession, byte_bpe, piece_bpe)
    fields = pa.struct([("a", pa.int64()), ("b", pa.int64()), ("bytes", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = Aligner(*files.value)
        for batch in batches:
            for low, high, texts in _blocks(batch["text"]):
                found = aligner.align(texts)
                over = found.overlap
                left = np.repeat(np.arange(len(found.a)), np.diff(over.ptr))
                ids_a, ids_b, groups_a, groups_b, overlaps = [], [], [], [], []
                for k in range(high - low):
                    sa, sb = slice(*found.a_ptr[k : k + 2]), slice(*found.b_ptr[k : k + 2])
                    so = slice(over.ptr[sa.start], over.ptr[sa.stop])
                    ids_a.append(found.a[sa])
                    ids_b.append(found.b[sb])
                    groups_a.append(found.a_group[sa] - found.group_ptr[k])
                    groups_b.append(found.b_group[sb] - found.group_ptr[k])
                    shared = zip((left[so] - sa.start).tolist(), (over.idx[so] - sb.start).tolist(), over.val[so].tolist())
                    overlaps.append([{"a": a, "b": b, "bytes": n} for a, b, n in shared])
                longs = [pa.array(x, pa.list_(pa.int64())) for x in (ids_a, ids_b, groups_a, groups_b)]
                yield pa.RecordBatch.from_arrays(
                    [batch["id"][low:high], *longs, pa.array(overlaps, pa.list_(fields))],
                    ["id", "a", "b", "a_group", "b_group", "overlaps"],
                )

    kind = rows.schema["id"].dataType.simpleString()
    longs = ", ".join(f"{c} array<long>" for c in ("a", "b", "a_group", "b_group"))
    return rows.mapInArrow(run, f"id {kind}, {longs}, overlaps array<struct<a: long, b: long, bytes: long>>")


# ------------------------------------------------------------------- corpus counts


def _packed(values: list[np.ndarray], kind: type) -> bytes:
    import zstandard

    whole = np.concatenate(values) if values else np.zeros(0)
    return zstandard.compress(whole.astype(kind).tobytes())


def _opened(content: bytes, kind: type) -> np.ndarray:
    import zstandard

    return np.frombuffer(zstandard.decompress(content), kind)


#: A part's documents, their distinct pairs (`cut` of each) as places among the part's own.
PART = (
    "part long, n_a array<long>, n_b array<long>, n_groups array<long>, n_links array<long>,"
    " groups_sha256 array<string>, cut array<long>, places binary, times binary, pairs array<int>, docs array<int>"
)


class _Part:
    """Documents of one part as they come."""

    def __init__(self):
        self.ids, self.counts, self.digests = [], [], []
        self.keys, self.times, self.cut, self.tokens = [], [], [0], 0

    def add(self, ids: list, found: Aligned, digests: list[str]) -> None:
        keys = (found.pair_rows[np.repeat(np.arange(len(found.pair_rows)), np.diff(found.pairs.ptr))] % IDS) * IDS + found.pairs.idx
        ends = found.pairs.ptr[np.searchsorted(found.pair_rows, np.arange(len(ids) + 1) * IDS)]
        sums = np.concatenate([[0], np.cumsum(found.pairs.val)])[ends]
        self.ids += ids
        self.digests += digests
        self.counts.append(np.stack([np.diff(found.a_ptr), np.diff(found.b_ptr), np.diff(found.group_ptr), np.diff(sums)]))
        self.keys.append(keys.astype(np.uint32))
        self.times.append(found.pairs.val)
        self.cut += (ends[1:] + self.cut[-1]).tolist()
        self.tokens += len(found.a)

    def row(self, number: int, id_type: pa.DataType) -> pa.RecordBatch:
        keys = np.concatenate(self.keys)
        pairs, places, docs = np.unique(keys, return_inverse=True, return_counts=True)
        steps = np.diff(places, prepend=0)
        counts = np.concatenate(self.counts, axis=1)
        whole = [
            pa.array([number], pa.int64()),
            *[pa.array([c], pa.list_(pa.int64())) for c in counts],
            pa.array([self.digests], pa.list_(pa.string())),
            pa.array([self.cut], pa.list_(pa.int64())),
            pa.array([_packed([steps], np.int32)], pa.binary()),
            pa.array([_packed(self.times, np.int64)], pa.binary()),
            pa.array([pairs.view(np.int32)], pa.list_(pa.int32())),
            pa.array([docs], pa.list_(pa.int32())),
            pa.array([self.ids], pa.list_(id_type)),
        ]
        return pa.RecordBatch.from_arrays(whole, [*[f.split()[0] for f in PART.split(", ")], "ids"])


def _parts(docs: DataFrame, id_col: str, text_col: str, byte_bpe: str, piece_bpe: str) -> DataFrame:
    """One row per part, see `PART`, with the `ids` of its documents."""
    rows = docs.select(named(docs, id_col).alias("id"), named(docs, text_col).alias("text"))
    files = _vocabularies(docs.sparkSession, byte_bpe, piece_bpe)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        aligner, writer = Aligner(*files.value), Groups()
        number, part, id_type = TaskContext.get().partitionId() << 32, _Part(), None
        for batch in batches:
            id_type = batch.schema.field("id").type
            ids = batch["id"].to_pylist()
            for low, high, texts in _blocks(batch["text"]):
                found = aligner.align(texts)
                digests = [hashlib.sha256(t.encode()).hexdigest() if t else "" for t in writer.texts(found)]
                part.add(ids[low:high], found, digests)
                if part.tokens >= PART_TOKENS:
                    yield part.row(number, id_type)
                    number, part = number + 1, _Part()
        if part.ids:
            yield part.row(number, id_type)

    return rows.mapInArrow(run, f"{PART}, ids array<{rows.schema['id'].dataType.simpleString()}>")


def _counted(parts: pa.Table, counts: pa.Table) -> pa.Table:
    """The documents of one part, with the corpus counts of its pairs."""
    row = {name: parts[name][0] for name in parts.column_names}
    place = counts["place"].to_numpy()
    of_pair, best = np.zeros(len(place), np.int64), np.zeros(len(place), bool)
    of_pair[place] = counts["n"].to_numpy()
    best[place] = counts["best"].to_numpy(zero_copy_only=False)
    places = np.cumsum(_opened(row["places"].as_py(), np.int32).astype(np.int64))
    times = _opened(row["times"].as_py(), np.int64)
    cut = np.array(row["cut"].as_py(), np.int64)
    sums = [np.concatenate([[0], np.cumsum(x)])[cut] for x in (times * best[places], times * of_pair[places])]
    names = ("n_a", "n_b", "n_groups", "n_links")
    return pa.table(
        {"id": row["ids"].values, **{n: row[n].values for n in names}, "n_best": np.diff(sums[0]),
         "count_sum": np.diff(sums[1]), "groups_sha256": row["groups_sha256"].values}
    )


def aligned_documents(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    byte_bpe: str = BYTE_BPE, piece_bpe: str = PIECE_BPE,
) -> DataFrame:
    """Per row: id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256.

    `count_sum` adds, over all links of tokens that share a group, in how many documents the two
    ids are linked; `n_best` is how many links have the highest such number of their A id.
    """
    with scratch(docs.sparkSession) as folder:
        parts = materialize(_parts(docs, id_col, text_col, byte_bpe, piece_bpe), "parts", folder)
        held = parts.select("part", F.posexplode(F.arrays_zip("pairs", "docs")).alias("place", "held")).select(
            "part", "place", "held.pairs", "held.docs"
        )
        held = held.repartition("pairs")
        totals = held.groupBy("pairs").agg(F.sum("docs").alias("n"))
        totals = materialize(totals, "pair-counts", folder).withColumn("a", F.shiftrightunsigned("pairs", 16))
        highest = totals.groupBy("a").agg(F.max("n").alias("most"))
        flagged = totals.join(highest, "a").select("pairs", "n", (F.col("n") == F.col("most")).alias("best"))
        counts = held.join(flagged, "pairs").select(F.col("part").alias("of_part"), "place", "n", "best")
        kind = parts.schema["ids"].dataType.elementType.simpleString()
        longs = ", ".join(f"{c} long" for c in ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum"))
        found = (
            parts.drop("pairs", "docs").groupBy("part").cogroup(counts.groupBy("of_part"))
            .applyInArrow(_counted, f"id {kind}, {longs}, groups_sha256 string")
        )
        return result_table(found, "aligned")


def op12_token_alignment(spark: SparkSession, folder: str) -> DataFrame:
    return aligned_documents(read(spark, folder, "documents")).withColumnRenamed("id", "doc_id")
