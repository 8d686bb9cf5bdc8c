"""SimHash near-duplicates by meet-in-the-middle ball hashing.

A text's shingles vote on the 64 bits of its fingerprint. Two fingerprints that differ in at
most r bits, r even, have one in the middle that differs from each of them in at most r / 2. So
every distinct fingerprint emits all its variants within half the radius, itself among them
(65 for a radius of 2), and those of one variant meet. All that meet differ in at most r bits,
by way of the variant, and they are no more than the variant has neighbours, whatever the
data. It is therefore enough to link each with the smallest of them: a component is the same
as with all pairs. Links are made distinct and verified on the fingerprints themselves.

Rows meet only by fingerprint: equal ones are one node from the start, with the smallest id
among their rows, found by partial sums in the map tasks. Texts are never shuffled.

Defined results: null texts, empty ones and those of white space have the fingerprint zero,
which is linked like any other; a text of fewer words than a shingle votes with all its words as
one; rows of equal texts are linked, repeated rows too; a null id is passed on and never names
a class that has other ids; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.llm.common import named, read
from ledgerlake.llm.components import components
from ledgerlake.session import materialize, result_table, scratch

BITS = 64
SEED = 42
RADIUS = 2
# Hashes that vote at once, which bounds the memory of very long texts.
VOTES_AT_ONCE = 1 << 16


def shingle_hashes(text: str | None, words: int) -> Iterator[np.ndarray]:
    """XXH64 of a text's shingles, repeats included, in blocks."""
    import xxhash

    tokens = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if 0 < len(tokens) < words:
        tokens, words = [b" ".join(tokens)], 1
    count = len(tokens) - words + 1
    for low in range(0, count, VOTES_AT_ONCE):
        block = tokens[low : min(low + VOTES_AT_ONCE, count) + words - 1]
        joined = map(b" ".join, zip(*(block[k:] for k in range(words))))
        yield np.fromiter(map(xxhash.xxh64_intdigest, joined, repeat(SEED)), np.uint64)


def fingerprint(text: str | None, words: int = 3) -> int:
    """The bits that are set in more than half of the hashes."""
    votes, count = np.zeros(BITS, np.int64), 0
    for hashes in shingle_hashes(text, words):
        count += len(hashes)
        for byte in range(BITS // 8):
            column = (hashes >> np.uint64(8 * byte)).astype(np.uint8)
            # How often each value of the byte occurs decides its eight bits.
            votes[8 * byte : 8 * byte + 8] += np.bincount(column, minlength=256) @ BIT_OF_BYTE
    set_bits = np.flatnonzero(2 * votes > count)
    return sum(1 << int(bit) for bit in set_bits)


BIT_OF_BYTE = (np.arange(256)[:, None] >> np.arange(8)) & 1


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 3) -> DataFrame:
    """(id, fingerprint) per row; the fingerprint's 64 bits as a long."""
    rows = docs.select(named(docs, id_col).alias("id"), named(docs, text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([fingerprint(text.as_py(), words) for text in batch["text"]], np.uint64)
            yield pa.RecordBatch.from_arrays([batch["id"], pa.array(found.view(np.int64))], ["id", "fingerprint"])

    return rows.mapInArrow(run, f"id {rows.schema['id'].dataType.simpleString()}, fingerprint long")


def ball(value: Column, half: int) -> Column:
    """All variants of a 64-bit value that differ from it in at most `half` bits."""
    masks = [sum(1 << b for b in bits) for n in range(half + 1) for bits in combinations(range(BITS), n)]
    signed = np.array(masks, np.uint64).view(np.int64).tolist()
    return F.transform(F.array(*[F.lit(m) for m in signed]), lambda mask: value.bitwiseXOR(mask))


def ball_links(nodes: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Links (a, b), a < b, that connect all distinct values of `fingerprint` within `radius` bits.

    Values that are within the radius of each other have a path of such links.
    """
    if radius % 2 or not 0 <= radius <= 4:
        raise ValueError("the radius is 0, 2 or 4 bits")
    if not radius:
        return nodes.select(F.col("fingerprint").alias("a"), F.col("fingerprint").alias("b")).limit(0)
    values = nodes.select("fingerprint").distinct()
    emitted = values.select("fingerprint", F.explode(ball(F.col("fingerprint"), radius // 2)).alias("variant"))
    # No more than a variant has neighbours: 65 at half a radius of one bit, 2,081 of two.
    met = emitted.groupBy("variant").agg(F.collect_list("fingerprint").alias("all")).where("size(all) > 1")
    stars = met.select(F.array_min("all").alias("a"), F.explode("all").alias("b")).where("a != b").distinct()
    return stars.where(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= radius)


def near_classes(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 3, radius: int = RADIUS
) -> DataFrame:
    """One row per row of `docs`: id, fingerprint, class_id, n_class.

    `class_id` is the smallest id that links reach, `n_class` the number of rows they reach.
    """
    with scratch(docs.sparkSession) as folder:
        marked = materialize(fingerprints(docs, id_col, text_col, words), "fingerprints", folder)
        nodes = marked.groupBy("fingerprint").agg(F.min("id").alias("least"), F.count("*").alias("n"))
        nodes = materialize(nodes, "nodes", folder)
        links = materialize(ball_links(nodes, radius), "ball-links", folder)
        roots = components(links, folder)
        rooted = nodes.join(roots, nodes["fingerprint"] == roots["node"], "left").select(
            "fingerprint", "least", "n", F.coalesce("root", "fingerprint").alias("root")
        )
        classes = rooted.groupBy("root").agg(F.min("least").alias("class_id"), F.sum("n").alias("n_class"))
        of_node = rooted.select("fingerprint", "root").join(classes, "root").drop("root")
        return result_table(marked.join(of_node, "fingerprint"), "near-classes").select(
            "id", "fingerprint", "class_id", "n_class"
        )


def op11_simhash_classes(spark: SparkSession, folder: str) -> DataFrame:
    return near_classes(read(spark, folder, "documents")).select(
        F.col("id").alias("doc_id"),
        F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"),
        F.col("class_id").alias("component_id"),
        "n_class",
    )
