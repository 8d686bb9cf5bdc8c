"""N-gram Jaccard join on parity sketches.

A text's set of shingles is hashed into a sketch of many bits, in which every shingle flips
one bit; bits that differ between two sketches are no more than the shingles that differ
between the sets. Sets of one size band may differ in at most d shingles if they are to be
similar enough. Their sketches are cut into more than d lanes, so similar sets agree in at
least (lanes - d) lanes: sets that share a lane are candidates. A short folded sketch goes along
with the lanes; the whole sketch of a band has a few bits for each shingle that may differ, so it
tells sets of any size apart, and drops nearly all wrong pairs before the sets themselves move
and decide.

Lanes with no bit, or one bit, set agree by chance. They are left out for sets that have fewer
than (lanes - d) of them: two similar sets then agree in another lane as well, or else both
have that many, and both use them. So no similar pair is lost.

Texts that share a passage agree in lanes that hold nothing else. Of its (lanes - d - 1) lanes to
spare, what light ones leave, a set drops those that most sets share. Lanes are dropped in one
order for all sets, light ones first, so of the (lanes - d) or more lanes in which two similar sets
agree, both keep the last.

Groups of many near copies share lanes in large numbers. Equal sets are one node from the
start. Every node is first compared with one other, the one in its lanes that most nodes share
lanes with, and joins its component if they are similar. Only lanes that then hold several
components go on. While they have too many pairs, one node of every lane, then 2, 4, ..., are
compared with the rest; when few pairs are left, all those between different components are.
Pairs that are already in one component are never listed, and of a lane of more than a few nodes
no pairs are: its sets are copies of one text with edits, many of them just too far from it.
They are told apart by what they differ in from the lane's hub, the weightiest node around. With E
what a set differs in from the hub, two sets differ in |E| + |F| - 2 |E and F| shingles. If both
are similar to the hub they are one component; if not, E and F must share more than about half
of either. So a set drops that many of E, those that most sets of the hub share, and what edits
of its own are left meets nothing.

Defined results: null texts, empty ones and those of white space have no shingles and are
linked with nothing; a text of fewer words than a shingle has one shingle, all its words; rows
with equal sets are linked, repeated rows too; a null id is passed on and never names a class
that has other ids; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlake.llm.common import WORD, named, read, text_digest
from ledgerlake.llm.components import components
from ledgerlake.session import discard, materialize, result_table, scratch

BAND_RATIO = 1.5
LANE_BITS = 16
# Words of the folded sketch that goes along with the lanes.
FOLD_WORDS = 4
# Bits of a band's whole sketch for each shingle that may differ. With four, sets pass that differ
# in up to 1.4 times as many (2 ln 2); unrelated ones differ in about nine times as many.
SKETCH_BITS = 4
# Lanes above the shingles that may differ, in hundredths of these: what a set has to spare.
SPARE_PERCENT = 20
# Low bits of a lane's key that hold its band.
BAND_BITS = 7
# Compare all remaining pairs once they are at most so many per lane entry of the start.
PAIRS_PER_ENTRY = 256
# Of a lane with more nodes the pairs are not listed, but found by the differences from its hub.
LANE_NODES = 8


def _mixed(x: np.ndarray) -> np.ndarray:
    """A bijection on 64 bits (the finaliser of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(text: str | None, words: int) -> np.ndarray:
    """The sorted distinct 64-bit hashes of a text's shingles."""
    import xxhash

    tokens = (text or "").encode("utf-8", "surrogatepass").lower().split()
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, tokens), np.uint64, len(tokens))
    if not len(hashes):
        return hashes
    width = min(words, len(hashes))
    count = len(hashes) - width + 1
    out = np.full(count, width, np.uint64)
    for k in range(width):
        out = _mixed(out * np.uint64(0x9E3779B97F4A7C15) + hashes[k : k + count])
    return np.unique(out)


def band_of(size: int) -> int:
    return int(math.log(size + 0.5) / math.log(BAND_RATIO))


@lru_cache
def band_top(band: int) -> int:
    """The largest size in a band."""
    top = int(BAND_RATIO ** (band + 1))
    while band_of(top) > band:
        top -= 1
    while band_of(top + 1) == band:
        top += 1
    return top


@lru_cache
def band_plan(band: int, percent: int) -> tuple[int, int, int]:
    """How many shingles may differ, the number of lanes, and the bits of a light lane."""
    top = band_top(band)
    differ = (100 - percent) * 2 * top // (100 + percent)
    if differ == 0:
        return 0, 0, 0
    bottom = max(1.0, top / BAND_RATIO)
    for light in (1, 0):
        for lanes in range(differ + 2 + differ * SPARE_PERCENT // 100, 2 * differ + 4):
            load = bottom / lanes
            share = math.exp(-load) * (1 + load * light)
            if share * lanes + 1.5 * math.sqrt(share * lanes) <= lanes - differ - 1:
                return differ, lanes, light
    return differ, differ + 2, -1


def lanes_of(values: np.ndarray, percent: int) -> tuple[np.ndarray, list[int]]:
    """The keys under which a set of shingles is found, for its band and larger ones it reaches.

    With them, for each of these bands, how many of its keys the set can drop and still be found.
    """
    size, out, spares = len(values), [], []
    if not size:
        return np.array([], np.uint64), []
    for band in range(band_of(size), band_of(size * 100 // percent) + 1):
        differ, lanes, light = band_plan(band, percent)
        if not lanes:
            spares.append(0)
            continue
        places, counts = np.unique(
            values % np.uint64(lanes << LANE_BITS), return_counts=True
        )
        odd = places[counts % 2 == 1]
        lane = (odd >> np.uint64(LANE_BITS)).astype(np.int64)
        bits = np.bincount(lane, minlength=lanes)
        digest = np.zeros(lanes, np.uint64)
        np.bitwise_xor.at(digest, lane, _mixed(odd + np.uint64(0x632BE59BD9B4E019)))
        named_lane = np.arange(lanes, dtype=np.uint64) + np.uint64(band << 40)
        keys = _mixed(digest ^ _mixed(named_lane + np.uint64(0xD6E8FEB86659FD93)))
        keys = keys >> np.uint64(BAND_BITS) << np.uint64(BAND_BITS) | np.uint64(band)
        heavy = bits > light
        used = int(heavy.sum())
        out.append(keys if used <= differ else keys[heavy])
        spares.append(max(0, used - differ - 1))
    return np.concatenate(out) if out else np.array([], np.uint64), spares


def lane_keys(values: np.ndarray, percent: int) -> np.ndarray:
    return lanes_of(values, percent)[0]


def folded(values: np.ndarray, words: int = FOLD_WORDS) -> np.ndarray:
    """The sketch folded to a few words: still no more bits differ than shingles do."""
    size = 64 * words
    counts = np.bincount((_mixed(values) % np.uint64(size)).astype(np.int64), minlength=size)
    return np.packbits((counts % 2).astype(np.uint8)).view(np.int64)


def band_sketches(values: np.ndarray, percent: int) -> list[bytes]:
    """The whole sketches of a set, for its band and larger ones it reaches."""
    out = []
    for band in range(band_of(len(values)), band_of(len(values) * 100 // percent) + 1):
        differ = band_plan(band, percent)[0]
        out.append(folded(values, max(1, -(-SKETCH_BITS * differ // 64))).tobytes())
    return out


def sketches(docs: DataFrame, id_col: str, text_col: str, words: int, percent: int) -> DataFrame:
    """Per row: row, id, digest, n, the set's 128-bit hash, its sketches and lane keys."""
    fields = (
        "row long, digest binary, n long, set_hash binary, fold array<long>, lanes array<long>,"
        " spares array<int>, band int, bands array<binary>"
    )
    rows = docs.select(
        F.monotonically_increasing_id().alias("row"),
        text_digest(named(docs, text_col)).alias("digest"),
        named(docs, text_col).alias("text"),
        named(docs, id_col).alias("id"),
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        for batch in batches:
            sizes, hashes, folds, lanes, spares, band, bands = [], [], [], [], [], [], []
            for text in batch["text"]:
                values = shingles(text.as_py(), words)
                sizes.append(len(values))
                hashes.append(xxhash.xxh3_128_digest(values.tobytes()))
                folds.append(folded(values))
                keys, spare = lanes_of(values, percent)
                lanes.append(keys.view(np.int64))
                spares.append(spare)
                band.append(band_of(len(values)))
                bands.append(band_sketches(values, percent))
            yield pa.RecordBatch.from_arrays(
                [batch["row"], batch["digest"], pa.array(sizes, pa.int64()), pa.array(hashes, pa.binary()),
                 *[pa.array(x, pa.list_(pa.int64())) for x in (folds, lanes)],
                 pa.array(spares, pa.list_(pa.int32())), pa.array(band, pa.int32()), pa.array(bands, pa.list_(pa.binary())), batch["id"]],
                ["row", "digest", "n", "set_hash", "fold", "lanes", "spares", "band", "bands", "id"],
            )

    return rows.mapInArrow(run, f"{fields}, id {rows.schema['id'].dataType.simpleString()}")


@dataclass(frozen=True)
class Texts:
    """Where the sets of nodes come from."""

    docs: DataFrame
    id_col: str
    text_col: str
    words: int

    def sets(self, wanted: DataFrame) -> DataFrame:
        """(node, values) of the wanted nodes (node, id, digest), from one text of each."""
        words = self.words
        texts = self.docs.select(
            named(self.docs, self.id_col).alias("text_id"),
            text_digest(named(self.docs, self.text_col)).alias("text_digest"),
            named(self.docs, self.text_col).alias("text"),
        )
        met = texts.join(
            wanted, texts["text_id"].eqNullSafe(wanted["id"]) & (texts["text_digest"] == wanted["digest"])
        )

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                values = [shingles(text.as_py(), words).view(np.int64) for text in batch["text"]]
                yield pa.RecordBatch.from_arrays(
                    [batch["node"], pa.array(values, pa.list_(pa.int64()))], ["node", "values"]
                )

        one = met.dropDuplicates(["node"]).select("node", "text")
        return one.mapInArrow(run, "node long, values array<long>")


@F.pandas_udf(T.LongType())
def _differing(a: pd.Series, b: pd.Series) -> pd.Series:
    """In how many bits two sketches differ."""
    pairs = ((np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)) for x, y in zip(a, b))
    return pd.Series([int(np.bitwise_count(x ^ y).sum()) for x, y in pairs], dtype="int64")


@F.pandas_udf(T.LongType())
def _shared(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series(
        [len(np.intersect1d(x, y, assume_unique=True)) for x, y in zip(a, b)], dtype="int64"
    )


def _similar(shared: Column, a: Column, b: Column, percent: int) -> Column:
    return shared * 100 >= (a + b - shared) * percent


def _hopeful(percent: int) -> str:
    """Pairs that sizes and folded sketches allow to be similar."""
    bits = " + ".join(f"bit_count(a.fold[{i}] ^ b.fold[{i}])" for i in range(FOLD_WORDS))
    return (
        f"least(a.n, b.n) * 100 >= greatest(a.n, b.n) * {percent}"
        f" AND ({bits}) * {100 + percent} <= (a.n + b.n) * {100 - percent}"
    )


def _sets_of(nodes: DataFrame, known: DataFrame, texts: Texts, label: str, folder: str) -> DataFrame:
    wanted = known.select("node", "id", "digest").join(nodes.distinct(), "node", "left_semi")
    return materialize(texts.sets(wanted), label, folder)


def _verified(
    pairs: DataFrame, known: DataFrame, texts: Texts, percent: int, folder: str
) -> DataFrame:
    """The pairs (a, b, na, nb) whose sets are similar.

    The sketches of the larger set's band, which the smaller one reaches as well, leave few pairs.
    Only the sets of their nodes are made, once for each node.
    """
    first = known.selectExpr("node AS a", "band AS band_a", "bands AS of_a")
    second = known.selectExpr("node AS b", "band AS band_b", "bands AS of_b")
    met = pairs.join(first, "a").join(second, "b")
    band = F.greatest("band_a", "band_b")
    bits = _differing(F.get("of_a", band - F.col("band_a")), F.get("of_b", band - F.col("band_b")))
    near = met.where(bits * (100 + percent) <= (F.col("na") + F.col("nb")) * (100 - percent))
    near = materialize(near.select("a", "b", "na", "nb"), "near-pairs", folder)
    nodes = near.select(F.col("a").alias("node")).union(near.select("b"))
    sets = _sets_of(nodes, known, texts, "near-sets", folder)
    one = sets.select(F.col("node").alias("a"), F.col("values").alias("va"))
    two = sets.select(F.col("node").alias("b"), F.col("values").alias("vb"))
    both = near.join(one, "a").join(two, "b")
    return both.where(_similar(_shared("va", "vb"), F.col("na"), F.col("nb"), percent)).select("a", "b")


def _hubs(links: DataFrame, weights: DataFrame) -> DataFrame:
    """(node, root) where the root is the weightiest linked node, if weightier than the node.

    One step of joining: nodes of one root are connected, though not all that are have one.
    """
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    near = both.join(weights.select(F.col("node").alias("b"), "weight"), "b")
    best = near.groupBy("a").agg(F.max(F.struct("weight", "b")).alias("best"))
    own = best.join(weights.select(F.col("node").alias("a"), "weight"), "a")
    larger = F.col("best") > F.struct("weight", F.col("a").alias("b"))
    return own.where(larger).select(F.col("a").alias("node"), F.col("best.b").alias("root"))


def _first_pairs(live: DataFrame, known: DataFrame, percent: int) -> DataFrame:
    """Every node with the weightiest node that shares a lane with it: one pair a node."""
    weighed = live.join(known.select("node", "weight"), "node")
    tops = weighed.groupBy("key").agg(F.max(F.struct("weight", "node")).alias("top"))
    best = (
        live.join(tops, "key")
        .where("node != top.node")
        .groupBy("node")
        .agg(F.max("top").alias("top"))
        .select("node", F.col("top.node").alias("other"))
    )
    one = known.select(F.col("node"), F.struct("n", "fold").alias("a"))
    two = known.select(F.col("node").alias("other"), F.struct("n", "fold").alias("b"))
    met = best.join(one, "node").join(two, "other").where(_hopeful(percent))
    return met.selectExpr("least(node, other) AS a1", "greatest(node, other) AS b1",
                          "if(node < other, a.n, b.n) AS na", "if(node < other, b.n, a.n) AS nb").select(
        F.col("a1").alias("a"), F.col("b1").alias("b"), "na", "nb").distinct()


def _differences(near: DataFrame, sets: DataFrame) -> DataFrame:
    """(node, root, hub, n, hub_n, size, parts): the `size` shingles in which node and hub differ."""
    one = sets.select("node", F.col("values").alias("own"))
    two = sets.select(F.col("node").alias("hub"), F.col("values").alias("of_hub"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts, n, hub_n = [], [], []
            for own, of_hub in zip(batch["own"], batch["of_hub"]):
                own, of_hub = own.values.to_numpy(), of_hub.values.to_numpy()
                parts.append(np.setxor1d(own, of_hub, assume_unique=True))
                n.append(len(own))
                hub_n.append(len(of_hub))
            yield pa.RecordBatch.from_arrays(
                [batch["node"], batch["root"], batch["hub"], pa.array(n, pa.int64()), pa.array(hub_n, pa.int64()),
                 pa.array(map(len, parts), pa.int64()), pa.array(parts, pa.list_(pa.int64()))],
                ["node", "root", "hub", "n", "hub_n", "size", "parts"],
            )

    met = near.join(one, "node").join(two, "hub").select("node", "root", "hub", "own", "of_hub")
    return met.mapInArrow(
        run, "node long, root long, hub long, n long, hub_n long, size long, parts array<long>"
    )


def _hub_pairs(
    live: DataFrame, known: DataFrame, texts: Texts, percent: int, folder: str
) -> tuple[DataFrame, DataFrame]:
    """Of lanes (key, node, root): links (a, b) with their hubs, and pairs (a, b, na, nb) to verify.

    Similar pairs of different roots that share a lane are among the pairs, or both linked with
    its hub, the weightiest node of any lane of its nodes: nearly all copies of one text get one hub
    in all their lanes, its original if it is there. With D the shingles that a set may differ in from one of any size, E and F share
    half of |E| + (hub's size - own size) * (100 - percent) / (100 + percent) or more if the other
    set is not linked with the hub, |E| - D in any case, and |E| - D / 2 if |F| is not less than |E|.
    A set's parts are dropped, the most shared first, as long as so many are left out.
    """
    s, r = 100 + percent, 100 - percent
    tops = live.join(known.select("node", "weight"), "node").groupBy("key").agg(
        F.max(F.struct("weight", "node")).alias("top")
    )
    mains = live.join(tops, "key").groupBy("node").agg(F.max("top").alias("main"))
    hubs = live.join(mains, "node").groupBy("key").agg(F.max("main").alias("main")).selectExpr("key", "main.node AS hub")
    near = live.join(hubs, "key").where("node != hub").select("node", "root", "hub")
    near = materialize(near.distinct(), "hub-nodes", folder)
    nodes = near.select("node").union(near.select("hub"))
    sets = _sets_of(nodes, known, texts, "hub-sets", folder)
    found = materialize(_differences(near, sets), "hub-parts", folder)
    links = found.where(f"size * {s} <= (n + hub_n) * {r}").selectExpr("hub AS a", "node AS b")

    top = f"(n + n * 100 DIV {percent})"
    marked = found.selectExpr(
        "node", "root", "hub", "n", "size", "parts", f"size * {s} <= (n + hub_n) * {r} AS linked",
        f"(size * {s} + (hub_n - n) * {r}) DIV {2 * s} + 1 AS half",
        f"greatest(1, (size * {s} - {top} * {r} + {s - 1}) DIV {s}) AS loose",
        f"(2 * size * {s} - {top} * {r} + {2 * s - 1}) DIV {2 * s} AS smaller",
    ).selectExpr(
        "*", "if(linked, half, greatest(half, smaller)) AS first_from", "if(linked, half, loose) AS second_from"
    )
    parts = found.select("hub", "node", F.explode("parts").alias("part"))
    often = parts.groupBy("hub", "part").agg(F.count("*").alias("m")).where("m > 1")
    most = Window.partitionBy("node", "hub").orderBy(F.desc("m"), "part")
    ranked = parts.join(often, ["hub", "part"]).withColumn("place", F.row_number().over(most))
    kept = ranked.join(marked.drop("parts", "n"), ["node", "hub"]).where("place >= least(first_from, second_from)")
    kept = kept.selectExpr("hub", "part", "node", "root", "size", "linked", "place >= first_from AS first",
                           "place >= second_from AS second", "place >= half AS tight")
    kept = materialize(kept.join(known.select("node", "n", "fold"), "node"), "hub-entries", folder)
    pairs = (
        kept.where("first").alias("a")
        .join(kept.where("second AND NOT linked").alias("b"), F.expr(
            "a.hub = b.hub AND a.part = b.part AND a.root != b.root AND (a.linked OR"
            f" (b.tight AND struct(a.size, a.node) < struct(b.size, b.node))) AND {_hopeful(percent)}"))
        .selectExpr("least(a.node, b.node) AS a", "greatest(a.node, b.node) AS b",
                    "if(a.node < b.node, a.n, b.n) AS na", "if(a.node < b.node, b.n, a.n) AS nb")
    )
    return links, pairs


def _lane_entries(marked: DataFrame, folder: str) -> DataFrame:
    """(key, node, m) for the lanes that several sets share, `m` of them, less those a set can spare.

    Only one row of every set has its lanes listed, so copies add nothing. Keys are counted with
    partial sums before the few that are shared meet their nodes. A window holds the lanes of one
    set in one band.
    """
    firsts = marked.groupBy("set_hash").agg(F.min("row").alias("node")).select("node")
    nodes = marked.select("row", "lanes").join(firsts, F.col("row") == F.col("node"), "left_semi")
    posts = nodes.select(F.col("row").alias("node"), F.explode(F.array_distinct("lanes")).alias("key"))
    often = posts.groupBy("key").agg(F.count("*").alias("m")).where("m > 1")
    often = materialize(often, "lane-keys", folder)
    spares = marked.select(F.col("row").alias("node"), "band", "spares")
    shared = posts.join(often, "key").join(spares, "node")
    shared = shared.withColumn("key_band", F.col("key").bitwiseAND((1 << BAND_BITS) - 1))
    most = Window.partitionBy("node", "key_band").orderBy(F.desc("m"), "key")
    ranked = shared.withColumn("place", F.row_number().over(most))
    spare = F.get("spares", (F.col("key_band") - F.col("band")).cast("int"))
    return materialize(ranked.where(F.col("place") > spare).select("key", "node", "m"), "lane-entries", folder)


def linked_sets(marked: DataFrame, texts: Texts, percent: int, folder: str) -> DataFrame:
    """(node, root) for nodes that are linked to a smaller one; a node is the first row of a set.

    `marked` is read for the lanes and their nodes first; see `jaccard_classes` for its end.
    """
    spark = texts.docs.sparkSession
    entries = _lane_entries(marked, folder)
    facts = marked.select("row", "id", "digest", "n", "fold", "band", "bands")
    known = materialize(
        entries.groupBy("node").agg(F.sum("m").alias("weight")).join(facts, F.col("node") == F.col("row")).drop("row"),
        "lane-nodes", folder,
    )
    discard(spark, f"{folder}/marked")
    sketch, weights = known.select("node", "n", "fold"), known.select("node", "weight")
    live = entries.select("key", "node")

    def verified(pairs: DataFrame, earlier: DataFrame | None, step: str) -> DataFrame:
        pairs = materialize(pairs, "lane-pairs", step)
        found = _verified(pairs, known, texts, percent, step)
        return materialize(earlier.unionByName(found) if earlier else found, "lane-links", folder)

    step = f"{folder}/step-0"
    links = verified(_first_pairs(live, known, percent), None, step)
    discard(spark, step)
    roots = components(links, f"{folder}/first-roots")
    leaders_each, most = 1, None
    while True:
        before, step = step, f"{folder}/step-{leaders_each}"
        # Lanes that hold several components, and their pairs of nodes of different ones.
        rooted = live.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
        parts = rooted.groupBy("key", "root").agg(F.count("*").cast("double").alias("c"))
        lanes = parts.groupBy("key").agg(F.sum("c").alias("m"), F.sum(F.col("c") ** 2).alias("same"))
        open_lanes = lanes.where("m * m > same").selectExpr("key", "m", "(m * m - same) / (2 * m) AS share")
        live = materialize(rooted.join(open_lanes, "key"), "lane-live", step)
        discard(spark, before)
        size, pairs_left = live.agg(F.count("*"), F.sum("share")).first()
        if not size:
            return components(links, folder)
        most = most or PAIRS_PER_ENTRY * size
        last = pairs_left <= most
        left = live.select("key", "node", "root", "m").join(sketch, "node")
        if last:
            left = others = left.where(F.col("m") <= LANE_NODES)
        else:
            salted = left.join(weights, "node").withColumn(
                "salt", F.pmod(F.xxhash64("node"), F.lit(leaders_each))
            )
            chosen = salted.groupBy("key", "salt").agg(
                F.max(F.struct("weight", "node", "root", "n", "fold")).alias("top")
            )
            others = chosen.select("key", "top.node", "top.root", "top.n", "top.fold")
        pairs = (
            left.alias("a")
            .join(others.alias("b"), F.expr(f"a.key = b.key AND a.root != b.root AND {_hopeful(percent)}"
                                            + (" AND a.node < b.node" if last else "")))
            .selectExpr("least(a.node, b.node) AS a", "greatest(a.node, b.node) AS b",
                        "if(a.node < b.node, a.n, b.n) AS na", "if(a.node < b.node, b.n, a.n) AS nb")
            .distinct()
        )
        if last:
            large = live.where(F.col("m") > LANE_NODES)
            with_hubs, more = _hub_pairs(large, known, texts, percent, step)
            links = verified(pairs.unionByName(more).distinct(), links.unionByName(with_hubs), step)
            return components(links, folder)
        links = verified(pairs, links, step)
        roots = materialize(_hubs(links, weights), "lane-hubs", step)
        live = live.select("key", "node").join(others.select("key", "node"), ["key", "node"], "left_anti")
        leaders_each *= 2


def jaccard_classes(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    words: int = 5,
    percent: int = 80,
) -> DataFrame:
    """One row per row of `docs`: row, id, digest, n_shingles, class, class_id, n_sets.

    `class` numbers the rows that links connect (rows without shingles are alone), `class_id`
    is the smallest id in it, `first` whether the row is the first of its class by id, digest
    and row.
    """
    with scratch(docs.sparkSession) as folder:
        sketched = materialize(sketches(docs, id_col, text_col, words, percent), "sketches", f"{folder}/marked")
        marked = materialize(sketched.select("row", "id", "digest", "n", "set_hash"), "rows", folder)
        texts = Texts(docs, id_col, text_col, words)
        # The sketches and lanes are dropped once the shared lanes and their nodes are known.
        roots = linked_sets(sketched.where("n > 0"), texts, percent, folder)
        filled = marked.where("n > 0")
        firsts = filled.groupBy("set_hash").agg(F.min("row").alias("node"), F.count("*").alias("copies"))
        sets = firsts.join(roots, "node", "left").select(
            "set_hash", "copies", F.coalesce("root", "node").alias("class")
        )
        rows = (
            marked.select("row", "id", "digest", "n", F.when(F.col("n") > 0, F.col("set_hash")).alias("set_hash"))
            .join(sets, "set_hash", "left")
            .withColumn("class", F.coalesce("class", "row"))
        )
        classes = rows.groupBy("class").agg(
            F.min("id").alias("class_id"), F.min(F.struct("id", "digest", "row")).alias("least")
        )
        found = rows.join(classes, "class").select(
            "row", "id", "digest", F.col("n").alias("n_shingles"), "class", "class_id",
            F.coalesce("copies", F.lit(1).cast("long")).alias("n_copies"), (F.col("row") == F.col("least.row")).alias("first"),
        )
        return result_table(found, "classes")


def one_of_each(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5, percent: int = 80
) -> DataFrame:
    """The documents, less all but the first of every class of similar ones.

    Rows that agree in id and text are one class if they have words, so one of them is kept;
    they are reduced to one in the map tasks before they meet the classes. Rows without words
    are linked with nothing and all stay.
    """
    classes = jaccard_classes(docs, id_col, text_col, words, percent)
    kept = classes.where("first AND n_shingles > 0").select(
        F.col("id").alias("_ll_kept_id"), F.col("digest").alias("_ll_kept_digest")
    )
    has_words = F.coalesce(named(docs, text_col).rlike(WORD), F.lit(False))
    keyed = docs.where(has_words).withColumns(
        {"_ll_id": named(docs, id_col), "_ll_digest": text_digest(named(docs, text_col))}
    )
    one = keyed.dropDuplicates(["_ll_id", "_ll_digest"])
    left = one.join(
        kept,
        one["_ll_id"].eqNullSafe(kept["_ll_kept_id"]) & (one["_ll_digest"] == kept["_ll_kept_digest"]),
        "left_semi",
    )
    return left.select(*[named(left, c) for c in docs.columns]).unionByName(docs.where(~has_words))


def op3_ngram_jaccard(spark: SparkSession, folder: str) -> DataFrame:
    classes = jaccard_classes(read(spark, folder, "documents"), words=3, percent=90)
    return classes.select(
        F.col("id").alias("doc_id"), "n_shingles", F.coalesce("class_id", "id").alias("component_id"), "n_copies"
    )


ORACLE = r"""
WITH RECURSIVE tokens AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS w
  FROM documents
), grams AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
    ELSE list_distinct([w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] FOR i IN range(1, len(w) - 1)])
    END AS g
  FROM tokens
), sized AS (
  SELECT doc_id, len(g) AS n, list_sort(g) AS g FROM grams
), sets AS (
  SELECT min(doc_id) AS node, g, n, count(*) AS copies FROM sized WHERE n > 0 GROUP BY g, n
), words AS (
  SELECT node, n, unnest(g) AS gram FROM sets
), links AS (
  SELECT a.node AS a, b.node AS b
  FROM words a JOIN words b ON a.gram = b.gram AND a.node < b.node
   AND least(a.n, b.n) * 100 >= greatest(a.n, b.n) * 90
  GROUP BY a.node, b.node, a.n, b.n
  HAVING 100 * count(*) >= 90 * (a.n + b.n - count(*))
), both_ways AS (
  SELECT a, b FROM links UNION ALL SELECT b, a FROM links
), reach(a, b) AS (
  SELECT node, node FROM sets
  UNION
  SELECT r.a, l.b FROM reach r JOIN both_ways l ON r.b = l.a
), classes AS (
  SELECT a AS node, min(b) AS class_id FROM reach GROUP BY a
)
SELECT s.doc_id, s.n::BIGINT AS n_shingles, coalesce(c.class_id, s.doc_id) AS component_id,
       coalesce(t.copies, 1)::BIGINT AS n_copies
FROM sized s LEFT JOIN sets t ON s.g = t.g AND s.n > 0 LEFT JOIN classes c ON c.node = t.node
"""
