"""Codes of vectors: product quantisation with norm-of-sum bounds.

Components become integers, a vector is cut into equal parts, and each part position has a
codebook that rounds of assigning and averaging move. Most parts keep their entry from one
round to the next. To see that without looking at all entries, a part carries a bound: its
exact distance to the second nearest entry in the round that last looked at all of them, and
that round's stamp. All codebooks of earlier rounds are retained, as they are small. In a later
round no other entry can be nearer than the bound less the longest way that one of them is now
from where it was in the stamped round. That is the norm of the sum of its moves, which is
never more than the sum of their norms, by which bounds are commonly lowered. Parts whose own
entry is nearer than that keep it; all others are compared with every entry again, exactly.

Distances are integers and exact: in doubles while they are below 2^53, else in 64 bits.

A round is one pass over the state, which it writes anew: the sums of a task come out as rows
beside it, at most one for each part and entry, and are added up by Spark.

Defined results: rows whose vector is null, or holds a null or a component that is not finite,
are dropped; a null id comes after all others, equal ids go by their vectors; rows of equal ids
are rows of their own; with fewer vectors than entries every vector is an entry; vectors of
another length than the first one have no code and no error, and add nothing; an empty table
gives no rows; extra columns are ignored. A length that parts do not divide, and components so
large that a squared distance would not fit in 63 bits, are errors by name.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.llm.common import named, read
from ledgerlake.session import hadoop_path, materialize, result_table, scratch

PARTS, ENTRIES, ROUNDS, SCALE = 8, 16, 6, 4096
# Rounding of square roots is far below this share.
SLACK = 1e-9
STATE = "v array<int>, entry binary, stamp binary, bound binary"
SUMS = "part int, place int, n long, sums array<long>"


@dataclass
class Coding:
    """`codes` (id, label, code, error), the final entries by part, and how many parts each
    pass compared with all entries."""

    codes: DataFrame
    codebooks: np.ndarray
    compared: list[int] = field(default_factory=list)


def scaled(vectors: np.ndarray, scale: int) -> np.ndarray:
    """Integers of the components, rounded down."""
    whole = np.floor(vectors.astype(np.float64) * scale)
    if whole.size and np.abs(whole).max() >= 2**31:
        raise ValueError("a vector's component is too large to be coded")
    return whole.astype(np.int64)


def exact_type(width: int, *arrays: np.ndarray) -> type:
    """The type in which squared distances of `width` components are exact."""
    top = max((int(np.abs(a).max()) for a in arrays if a.size), default=0)
    most = max(width, 1) * 4 * top * top
    if most >= 2**63:
        raise ValueError("a vector's component is too large to be coded")
    return np.float64 if most < 2**53 else np.int64


def two_nearest(parts: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of each row of `parts` its nearest entry, the lower one of equals, and the squared
    distance to the second nearest (infinite if there is none)."""
    kind = exact_type(book.shape[1], parts, book)
    x, c = parts.astype(kind), book.astype(kind)
    far = (x * x).sum(1)[:, None] - 2 * (x @ c.T) + (c * c).sum(1)[None]
    nearest = far.argmin(1)
    if len(book) < 2:
        return nearest, np.full(len(parts), np.inf)
    far = far.astype(np.float64)
    far[np.arange(len(parts)), nearest] = np.inf
    return nearest, far.min(1)


def displacements(history: list[np.ndarray]) -> np.ndarray:
    """By stamp, part and entry: how far any other entry of the part is from where it was."""
    now = history[-1].astype(np.float64)
    out = []
    for then in history:
        moved = np.sqrt(((now - then) ** 2).sum(2))
        others = np.zeros_like(moved)
        for entry in range(moved.shape[1]):
            rest = np.delete(moved, entry, axis=1)
            others[:, entry] = rest.max(1) if rest.shape[1] else 0.0
        out.append(others)
    return np.array(out)


def assign(
    v: np.ndarray, entry: np.ndarray, stamp: np.ndarray, bound: np.ndarray,
    history: list[np.ndarray], moved: np.ndarray,
) -> tuple[np.ndarray, int]:
    """Assigns every part to its nearest entry of the last codebooks, in place.

    Returns the squared distances to the assigned entries, and how many parts were compared
    with all entries.
    """
    now, book = len(history) - 1, history[-1]
    position = np.arange(v.shape[1])
    kind = exact_type(v.shape[2], v, book)

    def distance() -> np.ndarray:
        return ((v.astype(kind) - book[position, entry].astype(kind)) ** 2).sum(2)

    if now:
        limit = (bound * (1 - SLACK) - moved[stamp, position, entry] * (1 + SLACK))
        open_parts = ~(np.sqrt(distance().astype(np.float64)) * (1 + SLACK) < limit)
    else:
        open_parts = np.ones(entry.shape, bool)
    for part in position:
        rows = np.flatnonzero(open_parts[:, part])
        if len(rows):
            entry[rows, part], second = two_nearest(v[rows, part], book[part])
            bound[rows, part] = np.sqrt(second)
            stamp[rows, part] = now
    return distance().astype(np.int64), int(open_parts.sum())


def _lists(values: np.ndarray, kind: pa.DataType) -> pa.Array:
    n, width = values.shape
    return pa.ListArray.from_arrays(np.arange(n + 1, dtype=np.int32) * width, pa.array(values.ravel(), kind))


def _bytes(values: np.ndarray) -> pa.Array:
    return pa.array([row.tobytes() for row in values], pa.binary())


def _matrix(column: pa.Array, kind: type, width: int) -> np.ndarray:
    if pa.types.is_list(column.type):
        flat = column.flatten().to_numpy(zero_copy_only=False)
    else:
        flat = np.frombuffer(b"".join(column.to_pylist()), kind)
    return flat.reshape(len(column), width).astype(kind)


def _unpacked(batch: pa.RecordBatch, dims: int, parts: int, scale: int):
    """v, entry, stamp and bound of a batch of state rows, or of vectors at first."""
    n = batch.num_rows
    if "entry" in batch.schema.names:
        v = _matrix(batch["v"], np.int64, dims)
        entry, stamp, bound = (
            _matrix(batch[name], kind, parts)
            for name, kind in (("entry", np.uint8), ("stamp", np.uint8), ("bound", np.float64))
        )
    else:
        v = scaled(batch["v"].flatten().to_numpy(zero_copy_only=False).reshape(n, dims), scale)
        entry, stamp = np.zeros((n, parts), np.uint8), np.zeros((n, parts), np.uint8)
        bound = np.zeros((n, parts))
    return v.reshape(n, parts, dims // parts if parts else 0), entry, stamp, bound


def _round(state: DataFrame, history: list[np.ndarray], dims: int, scale: int) -> DataFrame:
    """The state after assigning to the last codebooks, and rows of sums beside it."""
    parts, entries, width = history[-1].shape
    moved = displacements(history)
    kept = state.select("id", "label", *[c for c in ("v", "entry", "stamp", "bound") if c in state.columns])
    kinds = {c: kept.schema[c].dataType.simpleString() for c in ("id", "label")}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, counts = np.zeros((parts, entries, width), object), np.zeros((parts, entries), np.int64)
        compared, types = 0, None
        for batch in batches:
            if not batch.num_rows:
                continue
            types = [batch.schema.field(c).type for c in ("id", "label")]
            v, entry, stamp, bound = _unpacked(batch, dims, parts, scale)
            _, looked = assign(v, entry, stamp, bound, history, moved)
            compared += looked
            for part in range(parts):
                counts[part] += np.bincount(entry[:, part], minlength=entries)
                for place in np.unique(entry[:, part]):
                    # Below 2^31 each, so a batch of them fits in 64 bits.
                    sums[part, place] += v[entry[:, part] == place, part].sum(0)
            n = batch.num_rows
            nothing = [pa.nulls(n, k) for k in (pa.int32(), pa.int32(), pa.int64(), pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(
                [batch["id"], batch["label"], _lists(v.reshape(n, dims), pa.int32()),
                 _bytes(entry), _bytes(stamp), _bytes(bound), *nothing],
                ["id", "label", "v", "entry", "stamp", "bound", "part", "place", "n", "sums"],
            )
        if types is None:
            return
        used = [(part, place) for part in range(parts) for place in range(entries) if counts[part, place]]
        rows = [(part, place, int(counts[part, place]), [int(s) for s in sums[part, place]]) for part, place in used]
        rows.append((-1, 0, compared, []))
        whole = [pa.array(c, k) for c, k in zip(zip(*rows), (pa.int32(), pa.int32(), pa.int64(), pa.list_(pa.int64())))]
        empty = [pa.nulls(len(rows), k) for k in (*types, pa.list_(pa.int32()), *[pa.binary()] * 3)]
        yield pa.RecordBatch.from_arrays(
            [*empty, *whole], ["id", "label", "v", "entry", "stamp", "bound", "part", "place", "n", "sums"]
        )

    return kept.mapInArrow(run, f"id {kinds['id']}, label {kinds['label']}, {STATE}, {SUMS}")


def _moved_codebooks(written: DataFrame, book: np.ndarray) -> tuple[np.ndarray, int]:
    """The averages of the parts, rounded down; unused entries stay. One row an entry comes here."""
    width = book.shape[2]
    totals = [F.sum(F.get("sums", F.lit(i)).cast("decimal(38,0)")).alias(f"s{i}") for i in range(width)]
    rows = written.where("part IS NOT NULL").groupBy("part", "place").agg(F.sum("n").alias("n"), *totals).collect()
    out, compared = book.copy(), 0
    for row in rows:
        if row["part"] < 0:
            compared = row["n"]
        else:
            out[row["part"], row["place"]] = [int(row[f"s{i}"]) // row["n"] for i in range(width)]
    return out, compared


def _coded(state: DataFrame, history: list[np.ndarray], dims: int, scale: int) -> DataFrame:
    parts = history[-1].shape[0]
    moved = displacements(history)
    kinds = {c: state.schema[c].dataType.simpleString() for c in ("id", "label")}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            v, entry, stamp, bound = _unpacked(batch, dims, parts, scale)
            far, _ = assign(v, entry, stamp, bound, history, moved)
            yield pa.RecordBatch.from_arrays(
                [batch["id"], batch["label"], pa.array([row.tobytes().hex() for row in entry], pa.string()),
                 pa.array(far.sum(1), pa.int64())],
                ["id", "label", "code", "error"],
            )

    return state.mapInArrow(run, f"id {kinds['id']}, label {kinds['label']}, code string, error long")


def coded_vectors(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    parts: int = PARTS,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
    scale: int = SCALE,
) -> Coding:
    """Codes of all vectors, two hex digits a part, and their squared errors.

    `entries` is 256 at most and `rounds` 255, so that each fits in a byte of the state.
    """
    spark = vectors.sparkSession
    if not (0 < parts and 0 < entries <= 256 and 0 <= rounds <= 255):
        raise ValueError("parts, entries or rounds out of range")
    picked = vectors.select(
        named(vectors, id_col).alias("id"), named(vectors, label_col).alias("label"),
        named(vectors, vector_col).cast("array<double>").alias("v"),
    )
    finite = "v IS NOT NULL AND forall(v, x -> x IS NOT NULL AND abs(x) < double('infinity'))"
    kept = picked.where(finite)
    first = kept.orderBy(F.asc_nulls_last("id"), "v").select("v").limit(1).collect()
    dims = len(first[0]["v"]) if first else 0
    if dims % parts:
        raise ValueError(f"vectors of {dims} components cannot be cut into {parts} equal parts")
    sized = kept.where(F.size("v") == dims)
    # As many vectors as a codebook has entries.
    start = sized.orderBy(F.asc_nulls_last("id"), "v").select("v").limit(entries).collect()
    chosen = scaled(np.array([row["v"] for row in start], np.float64).reshape(len(start), dims), scale)
    book = chosen.reshape(len(start), parts, dims // parts).transpose(1, 0, 2)
    history, compared = [book], []
    with scratch(spark) as folder:
        state = sized
        for number in range(rounds if start else 0):
            written = materialize(_round(state, history, dims, scale), f"round-{number}", folder)
            book, looked = _moved_codebooks(written, history[-1])
            history.append(book)
            compared.append(looked)
            state = written.where("part IS NULL")
            _drop_older(spark, folder, number)
        codes = _coded(state, history, dims, scale) if start else sized.selectExpr(
            "id", "label", "'' AS code", "0L AS error")
        rest = kept.where(F.size("v") != dims).selectExpr(
            "id", "label", "CAST(NULL AS string) AS code", "CAST(NULL AS bigint) AS error"
        )
        codes = result_table(codes.unionByName(rest), "codes")
    return Coding(codes, history[-1], compared)


def _drop_older(spark: SparkSession, folder: str, number: int) -> None:
    """Deletes the state of the round before, which no later step reads."""
    path, fs = hadoop_path(spark, f"{folder}/round-{number - 1}-*")
    for found in fs.globStatus(path) or []:
        fs.delete(found.getPath(), True)


def codebook_digest(codebooks: np.ndarray) -> str:
    text = ",".join(str(int(x)) for x in codebooks.ravel())
    return hashlib.sha256(text.encode()).hexdigest()


def op13_vector_codes(spark: SparkSession, folder: str) -> DataFrame:
    coding = coded_vectors(read(spark, folder, "embeddings"))
    codes = coding.codes
    totals = codes.groupBy(F.col("label").alias("of")).agg(F.sum("error").alias("label_error"))
    return codes.join(totals, codes["label"].eqNullSafe(totals["of"])).select(
        F.col("id").alias("vec_id"), "code", "error", "label_error",
        F.lit(codebook_digest(coding.codebooks)).alias("codebooks_sha256"),
    )


def _oracle() -> str:
    far = "list_sum(list_transform(list_zip(x, c), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT"
    steps = [f"""kept AS MATERIALIZED (
  SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor(CAST(x AS DOUBLE) * {SCALE}) AS BIGINT)) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), parts AS MATERIALIZED (
  SELECT vec_id, label, p, v[p * (len(v) // {PARTS}) + 1 : (p + 1) * (len(v) // {PARTS})] AS x
  FROM kept, range({PARTS}) AS t(p)
), firsts AS (
  SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS e FROM kept ORDER BY vec_id LIMIT {ENTRIES}
), book0 AS MATERIALIZED (
  SELECT p, e, x AS c FROM firsts JOIN parts USING (vec_id)
)"""]  # fmt: skip
    for k in range(ROUNDS + 1):
        steps.append(f"""near{k} AS MATERIALIZED (
  SELECT vec_id, any_value(label) AS label, p, any_value(x) AS x, min({far} * {ENTRIES} + e) AS best
  FROM parts JOIN book{k} USING (p) GROUP BY vec_id, p
)""")
        if k < ROUNDS:
            steps.append(f"""sums{k} AS (
  SELECT p, best % {ENTRIES} AS e, i, sum(x[i])::BIGINT AS s, count(*) AS n
  FROM near{k}, range(1, (SELECT min(len(x)) + 1 FROM parts)) AS t(i) GROUP BY ALL
), means{k} AS (
  SELECT p, e, list((s - ((s % n) + n) % n) // n ORDER BY i) AS c FROM sums{k} GROUP BY p, e
), book{k + 1} AS MATERIALIZED (
  SELECT p, e, coalesce(m.c, b.c) AS c FROM book{k} b LEFT JOIN means{k} m USING (p, e)
)""")
    return "WITH " + ", ".join(steps) + f""", codes AS (
  SELECT vec_id, any_value(label) AS label, sum(best // {ENTRIES})::BIGINT AS error,
         string_agg(printf('%02x', best % {ENTRIES}), '' ORDER BY p) AS code
  FROM near{ROUNDS} GROUP BY vec_id
), digest AS (
  SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY p, e)) AS codebooks_sha256 FROM book{ROUNDS}
)
SELECT vec_id, code, error, sum(error) OVER (PARTITION BY label)::BIGINT AS label_error, codebooks_sha256
FROM codes, digest"""  # fmt: skip


ORACLE = _oracle()
