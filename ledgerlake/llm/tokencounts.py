"""Token counts by a separator scan of flat token files.

A flat file is one run of token ids, every document followed by the end-of-document id, with
no index of where documents begin. Files are read in blocks that know nothing of documents.
In each block a vectorised search finds the separators; what lies before the first and after
the last one is stitched to the neighbouring blocks by a prefix scan over a few numbers per
block: tokens and separators so far, and the last separator before the block. The scan goes
in two steps, over chunks of blocks and within chunks, so that one huge file is not one task.

Defined results: null and empty texts have no tokens, only their separator; tokens after the
last separator of a file are a document that is not terminated; files without tokens hold no
documents; repeated rows are documents of their own; extra columns are ignored; an empty
table gives no rows.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerlake.llm.common import named, read
from ledgerlake.session import materialize

#: A public vocabulary of byte-level BPE ranks, and the pattern of its library that cuts texts.
VOCABULARY = "/opt/tokenizers/byte_bpe_multi_50k.tiktoken"
PATTERN = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
)
#: Ids are two bytes wide; the vocabulary leaves this one free.
END_OF_DOCUMENT = 50256
TOKEN = np.dtype("<u2")
BLOCK_TOKENS = 1 << 16
CHUNK_BLOCKS = 4096
BLOCKS = "file string, block long, payload binary"
#: The largest file that Spark reads as one value.
LARGEST = (1 << 31) - (1 << 20)


def load_encoding(vocabulary: str = VOCABULARY, pattern: str = PATTERN):
    return encoding_of(Path(vocabulary).read_bytes(), pattern)


def encoding_of(content: bytes, pattern: str = PATTERN):
    """The encoding of a vocabulary file's content."""
    import tiktoken

    pairs = (line.split() for line in content.splitlines() if line)
    ranks = {base64.b64decode(token): int(rank) for token, rank in pairs}
    return tiktoken.Encoding("bpe", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def write_flat(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    vocabulary: str = VOCABULARY,
    pattern: str = PATTERN,
    block_tokens: int = BLOCK_TOKENS,
) -> DataFrame:
    """Flat files of all documents, one per task, stored in blocks: file, block, payload, ids.

    `ids` names the documents that end in a block; the scan never reads it.
    """
    rows = docs.select(named(docs, id_col).alias("id"), named(docs, text_col).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    # About a megabyte; the tasks need no file of their own.
    content = docs.sparkSession.sparkContext.broadcast(Path(vocabulary).read_bytes())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encoding = encoding_of(content.value, pattern)
        file, block = f"part-{TaskContext.get().partitionId():06d}", 0
        held, size, ids, id_type = [], 0, [], None

        def stored(tokens):
            arrays = [pa.array([file]), pa.array([block], pa.int64()), pa.array([tokens.tobytes()], pa.binary()),
                      pa.array([ids], pa.list_(id_type))]
            return pa.RecordBatch.from_arrays(arrays, ["file", "block", "payload", "ids"])

        for batch in batches:
            id_type = batch.schema.field("id").type
            for doc_id, text in zip(batch["id"].to_pylist(), batch["text"]):
                tokens = encoding.encode_ordinary(text.as_py() or "")
                tokens.append(END_OF_DOCUMENT)
                left = np.array(tokens, TOKEN)
                while len(left):
                    part, left = left[: block_tokens - size], left[block_tokens - size :]
                    held.append(part)
                    size += len(part)
                    if not len(left):
                        ids.append(doc_id)
                    if size == block_tokens:
                        yield stored(np.concatenate(held))
                        held, size, ids, block = [], 0, [], block + 1
        if size:
            yield stored(np.concatenate(held))

    return materialize(
        rows.mapInArrow(run, f"file string, block long, payload binary, ids array<{kind}>"), "flat-tokens"
    )


def read_flat(spark: SparkSession, path: str, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """Blocks (file, block, payload) of flat files of two-byte ids; an odd last byte is no token.

    Spark reads files of up to LARGEST bytes as one value each. Larger ones are read as records of a
    fixed length, split among tasks; the length is the largest one that fills the file.
    """
    files = spark.read.format("binaryFile").load(path)
    step = block_tokens * TOKEN.itemsize

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, content in zip(batch["path"].to_pylist(), batch["content"]):
                view = memoryview(content.as_buffer())
                view = view[: len(view) - len(view) % TOKEN.itemsize]
                for block, low in enumerate(range(0, len(view), step)):
                    arrays = [pa.array([file]), pa.array([block], pa.int64()), pa.array([view[low : low + step].tobytes()], pa.binary())]
                    yield pa.RecordBatch.from_arrays(arrays, ["file", "block", "payload"])

    whole = files.where(F.col("length") <= LARGEST).select("path", "content")
    found = whole.mapInArrow(run, BLOCKS)
    # Only files of gigabytes are named here.
    for row in files.where(F.col("length") > LARGEST).select("path", "length").collect():
        found = found.unionByName(_records(spark, row["path"], row["length"], step))
    return found


def _records(spark: SparkSession, file: str, size: int, most: int) -> DataFrame:
    """The blocks of a large file, as records of the largest length up to `most` that fills it."""
    if size % TOKEN.itemsize:
        raise ValueError(f"{file} is not made of ids of {TOKEN.itemsize} bytes")
    width = next(w for w in range(most - most % TOKEN.itemsize, 0, -TOKEN.itemsize) if size % w == 0)
    records = spark.sparkContext.binaryRecords(file, width).zipWithIndex()
    return spark.createDataFrame(records.map(lambda r: (file, r[1], bytearray(r[0]))), BLOCKS)


def scan_blocks(blocks: DataFrame, separator: int = END_OF_DOCUMENT) -> DataFrame:
    """Per block: its tokens, and the places just after its separators."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, places = [], []
            for payload in batch["payload"]:
                tokens = np.frombuffer(payload.as_buffer(), TOKEN) if payload.is_valid else np.array([], TOKEN)
                sizes.append(len(tokens))
                places.append(np.flatnonzero(tokens == separator) + 1)
            yield pa.RecordBatch.from_arrays(
                [batch["file"], batch["block"], pa.array(sizes, pa.int64()), pa.array(places, pa.list_(pa.int64()))],
                ["file", "block", "tokens", "ends"],
            )

    return blocks.select("file", "block", "payload").mapInArrow(
        run, "file string, block long, tokens long, ends array<long>"
    )


def _before(frame: DataFrame, name: str, value: Column, total) -> DataFrame:
    """`name`: the sum or maximum of `value` over all earlier blocks of the file."""
    with_value = frame.withColumn("_value", value)
    chunks = with_value.groupBy("file", "chunk").agg(total("_value").alias("_chunk"))
    earlier = Window.partitionBy("file").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    chunks = chunks.select("file", "chunk", total("_chunk").over(earlier).alias("_earlier"))
    inside = Window.partitionBy("file", "chunk").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    joined = with_value.withColumn("_inside", total("_value").over(inside)).join(chunks, ["file", "chunk"])
    if total is F.sum:
        both = F.coalesce("_earlier", F.lit(0)) + F.coalesce("_inside", F.lit(0))
    else:
        both = F.greatest("_earlier", "_inside")
    return joined.withColumn(name, both).drop("_value", "_inside", "_earlier")


def documents(blocks: DataFrame, separator: int = END_OF_DOCUMENT) -> DataFrame:
    """One row per document of the files: file, block, place, ordinal, start, n_tokens, terminated.

    `ordinal` counts the documents of a file and `start` its tokens; `block` is where the
    document ends, as the `place`-th one there.
    """
    facts = materialize(scan_blocks(blocks, separator), "token-blocks")
    facts = facts.withColumn("chunk", F.expr(f"block div {CHUNK_BLOCKS}"))
    facts = _before(facts, "offset", F.col("tokens"), F.sum)
    facts = _before(facts, "ordinal", F.size("ends").cast("long"), F.sum)
    last_end = F.when(F.size("ends") > 0, F.col("offset") + F.element_at("ends", -1))
    facts = _before(facts, "begun", last_end, F.max).withColumn("begun", F.coalesce("begun", F.lit(0)))
    ended = facts.select("file", "block", "offset", "ordinal", "begun", "ends", F.posexplode("ends").alias("place", "end"))
    start = F.when(F.col("place") == 0, F.col("begun")).otherwise(
        F.col("offset") + F.expr("try_element_at(ends, place)")
    )
    closed = ended.select(
        "file", "block", F.col("place").cast("long").alias("place"), (F.col("ordinal") + F.col("place")).alias("ordinal"),
        start.alias("start"), (F.col("offset") + F.col("end") - 1 - start).alias("n_tokens"), F.lit(True).alias("terminated"),
    )
    files = facts.groupBy("file").agg(
        F.max("block").alias("block"),
        F.max(F.col("offset") + F.col("tokens")).alias("tokens"),
        F.max(F.coalesce(last_end, F.lit(0))).alias("start"),
        F.sum(F.size("ends")).alias("ordinal"),
    )
    rest = files.where("tokens > start").select(
        "file", "block", F.lit(-1).cast("long").alias("place"), "ordinal", "start",
        (F.col("tokens") - F.col("start")).alias("n_tokens"), F.lit(False).alias("terminated"),
    )
    return closed.unionByName(rest)


def op8_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    flat = write_flat(read(spark, folder, "documents"))
    names = flat.select("file", "block", F.posexplode("ids").alias("place", "doc_id"))
    found = documents(flat)
    return found.join(names, ["file", "block", "place"]).select("doc_id", "n_tokens", "file", "ordinal", "start")
