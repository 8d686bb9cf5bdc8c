"""Mixing sources to target weights by a low-discrepancy schedule.

The words of each source form a stream: its documents in the order of a digest of their ids,
again from the start when the stream is used up. The stream is cut into blocks of equal
numbers of words. A golden-ratio sequence of points, mapped through the cumulative targets of
the sources, says which source gives the next block; the rank of a slot among the slots of its
source says which block. A source's last block is cut where its target is met, and slots that
the sequence has not reached by its end follow after it, so that targets hold to the word.
The mix itself is its blocks in the order of their slots; `mixed_blocks` writes their text.

Defined results: a null text has size 0 and a document of size 0 gives no words; a null source
is a source of its own, the last one; repeated rows are documents of their own, which share out
the words of their stream positions; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerlake.llm.common import WORD, named, read, text_digest
from ledgerlake.session import materialize

# Weights of sources, in turn, the size of the mix, and the most a source repeats.
WEIGHTS = (3, 1, 2)
SHARE_PERCENT = 150
MOST_PASSES = 2

BLOCK_WORDS = 1024
GOLDEN = 0.6180339887498949
# That times 2^20, less its whole part: keeps precision for large slot numbers.
GOLDEN_HIGH = 0.607787409740351
RANK_CHUNK = 1 << 16


# A word with the white space after it, the first one also with that before it.
SPACED_WORD = rf"(?:^[\x20\x09-\x0D]+)?{WORD}[\x20\x09-\x0D]*"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def source_targets(
    sizes: DataFrame,
    weights: Sequence[int] = WEIGHTS,
    share_percent: int = SHARE_PERCENT,
    most_passes: int = MOST_PASSES,
) -> DataFrame:
    """One row per source of (source, size): its number, size, target and quota of words.

    The targets are the levels of water poured into vessels as wide as the weights and as
    high as the caps allow. Only here do all sources meet in one task, one short row each.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    numbered = per.withColumn("sid", F.row_number().over(by_name))
    turn = (F.col("sid") - 1) % len(weights)
    wide = numbered.withColumns(
        {
            "weight": F.element_at(F.array(*[F.lit(w) for w in weights]), turn + 1),
            "cap": F.col("source_size") * most_passes,
        }
    )
    fullest = Window.orderBy(F.col("cap") / F.col("weight"), "sid")
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    before = F.coalesce(F.sum("cap").over(fullest.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    onward = F.sum("weight").over(fullest.rowsBetween(0, Window.unboundedFollowing))
    total = F.sum("source_size").over(everything)
    level = (total * share_percent - before * 100) / (onward * 100)
    poured = wide.withColumn("level", level).withColumn("level", F.max("level").over(everything))
    target = F.least(F.col("cap").cast("double"), F.col("weight") * F.col("level"))
    return poured.withColumn("target", target).select(
        "sid", "source", "source_size", "target", F.floor("target").cast("bigint").alias("quota")
    )


def schedule(spark: SparkSession, sources: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """The slots of the mix: slot number, source number, and rank among the source's slots.

    `sources` is read several times and should be a stored table. Points meet sources by an
    equal join on grid cells, so that any number of sources will do; ranks are found per
    chunk of slots and shifted by the counts of earlier chunks, so that no window holds all
    slots of a source.
    """
    sources = sources.withColumn("slots", F.ceil(F.col("quota") / block_words).cast("bigint"))
    facts = sources.agg(F.sum("slots").alias("slots"), F.count("*").alias("sources")).first()
    slots, grid = facts["slots"] or 0, 4 * facts["sources"] + 1
    upto = F.sum("quota").over(Window.orderBy("sid"))
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    total = F.sum("quota").over(everything)
    ranges = (
        sources.select(
            "sid", "slots", F.try_divide(upto - F.col("quota"), total).alias("low"), F.try_divide(upto, total).alias("high")
        )
        .where("high > low")
        .withColumn("cell", F.explode(F.expr(f"sequence(bigint(low * {grid}), bigint(high * {grid}))")))
    )
    turn = F.col("slot") % (1 << 20) * F.lit(GOLDEN)
    turns = F.expr(f"slot div {1 << 20}") * F.lit(GOLDEN_HIGH)
    points = spark.range(slots).withColumnRenamed("id", "slot").withColumn(
        "point", ((turn - F.floor(turn)) + (turns - F.floor(turns))) % 1.0
    )
    points = points.withColumn("cell", F.floor(F.col("point") * grid).cast("bigint"))
    drawn = points.join(ranges, "cell").where("point >= low AND point < high").select("slot", "sid", "slots")
    drawn = drawn.withColumn("chunk", F.expr(f"slot div {RANK_CHUNK}"))
    counts = drawn.groupBy("sid", "chunk").agg(F.count("*").alias("n"))
    earlier = counts.withColumn(
        "earlier", F.sum("n").over(Window.partitionBy("sid").orderBy("chunk")) - F.col("n")
    ).select("sid", "chunk", "earlier")
    within = F.row_number().over(Window.partitionBy("sid", "chunk").orderBy("slot")) - 1
    ranked = (
        drawn.withColumn("within", within)
        .join(earlier, ["sid", "chunk"])
        .select("slot", "sid", (F.col("earlier") + F.col("within")).alias("rank"), "slots")
        .where("rank < slots")
        .select("slot", "sid", "rank")
    )
    reached = counts.groupBy("sid").agg(F.sum("n").alias("reached"))
    late = (
        sources.where("slots > 0")
        .join(reached, "sid", "left")
        .withColumn("reached", F.coalesce("reached", F.lit(0)))
        .where("reached < slots")
        .select("sid", F.explode(F.expr("sequence(reached, slots - 1)")).alias("rank"))
        .select((F.lit(slots) + F.col("rank") * facts["sources"] + F.col("sid") - 1).alias("slot"), "sid", "rank")
    )
    return ranked.unionByName(late)


def _pieces(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: Sequence[int] = WEIGHTS,
    share_percent: int = SHARE_PERCENT,
    most_passes: int = MOST_PASSES,
    block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """The pieces of documents that the blocks of the mix hold, a row each.

    A row of `docs` is known by `row`; one that no block takes from has a single row without a
    slot. `piece` holds the rank of its block, the pass through the source, the first word in
    the document, the number of words, and the place in the block.
    """
    spark = docs.sparkSession
    key = named(docs, id_col)
    sized = materialize(
        docs.select(
            key.alias("key_id"),
            text_digest(named(docs, text_col)).alias("key_digest"),
            named(docs, source_col).alias("source"),
            word_count(named(docs, text_col)).alias("size"),
            # Rows without an id are put in order by their text, so that they are not all in one place.
            F.coalesce(F.md5(key.cast("string")), F.md5(named(docs, text_col)), F.lit("")).alias("place"),
        ),
        "mix-sizes",
    )
    sources = materialize(source_targets(sized, weights, share_percent, most_passes), "mix-sources")
    slots = schedule(spark, sources, block_words)

    # Positions in the streams: sums within short digest ranges, shifted by earlier ranges. Repeated
    # rows are one until they have their place, and then follow each other.
    same = sized.groupBy(*sized.columns).agg(F.count("*").alias("copies"))
    rows = same.withColumn("all", F.col("size") * F.col("copies")).withColumn("part", F.substring("place", 1, 4)).join(
        sources.withColumnRenamed("source", "name"), F.col("source").eqNullSafe(F.col("name"))
    )
    # In two steps, so that no window holds more than 256 rows whatever a source has.
    parts = rows.groupBy("sid", "part").agg(F.sum("all").alias("words"))
    parts = parts.withColumn("lead", F.substring("part", 1, 2))
    leads = parts.groupBy("sid", "lead").agg(F.sum("words").alias("all_words"))
    upto_lead = F.sum("all_words").over(Window.partitionBy("sid").orderBy("lead"))
    leads = leads.select("sid", "lead", (upto_lead - F.col("all_words")).alias("before"))
    upto_part = F.sum("words").over(Window.partitionBy("sid", "lead").orderBy("part"))
    offsets = (
        parts.withColumn("inside", upto_part - F.col("words"))
        .join(leads, ["sid", "lead"])
        .select("sid", "part", (F.col("before") + F.col("inside")).alias("offset"))
    )
    order = Window.partitionBy("sid", "part").orderBy("place", "key_id", "key_digest", "size")
    running = order.rowsBetween(Window.unboundedPreceding, 0)
    placed = (
        rows.withColumns({"n": F.row_number().over(order), "upto": F.sum("all").over(running)})
        .join(offsets, ["sid", "part"])
        .withColumn("copy", F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1)))
        .withColumn("start", F.col("offset") + F.col("upto") - F.col("all") + F.col("copy") * F.col("size"))
    )
    passes = F.array(*[
        F.struct(
            F.lit(p).alias("pass"),
            (F.col("start") + F.col("source_size") * p).alias("first"),
            (F.col("start") + F.col("source_size") * p).alias("low"),
            F.least(F.col("start") + F.col("source_size") * p + F.col("size"), F.col("quota")).alias("high"),
        )
        for p in range(most_passes)
    ])
    reach = f"""flatten(transform(filter(passes, x -> x.high > x.low), x -> transform(
        sequence(x.low div {block_words}, (x.high - 1) div {block_words}),
        r -> struct(r as rank, x.pass as pass,
                    greatest(x.low, r * {block_words}L) - x.first as start,
                    least(x.high, (r + 1) * {block_words}L)
                    - greatest(x.low, r * {block_words}L) as words,
                    greatest(x.low - r * {block_words}L, 0L) as place))))"""
    carried = ["key_id", "key_digest", "size", "source", "source_size", "target"]
    row = F.struct("sid", "part", "n", "copy").alias("row")
    pieces = (
        placed.withColumn("passes", passes)
        .select(row, "sid", *carried, F.explode_outer(F.expr(reach)).alias("piece"))
        .withColumn("rank", F.col("piece.rank"))
    )
    # Only what a slot asks for is in the mix.
    scheduled = pieces.join(slots, ["sid", "rank"], "left")
    return scheduled.withColumn("piece", F.when(F.col("slot").isNotNull(), F.col("piece")))


def mix(docs: DataFrame, **options) -> DataFrame:
    """One row per row of `docs`: key_id, key_digest, size, source_size, target, taken, n_slots.

    `taken` counts the words that the scheduled blocks take from the document, repeats
    included; `n_slots` is the number of blocks that do so.
    """
    carried = ["key_id", "key_digest", "size", "source_size", "target"]
    return (
        _pieces(docs, **options)
        .groupBy("row")
        .agg(
            *[F.first(c).alias(c) for c in carried],
            F.coalesce(F.sum("piece.words"), F.lit(0)).alias("taken"),
            F.count("slot").alias("n_slots"),
        )
        .select(*carried, "taken", "n_slots")
    )


def mixed_blocks(docs: DataFrame, **options) -> DataFrame:
    """The mix: slot, source, rank, n_words, text and pieces of every block.

    In the order of `slot` the texts are the corpus, with its cuts and repeats. `pieces` says
    what a text is made of, in order: doc_id, pass through the source, first word in the
    document, number of words. Pieces keep their white space; one that ends without any is
    followed by a line break where another comes after it. Texts are shuffled twice: to their
    pieces and, cut, to their blocks.
    """
    id_col, text_col = options.get("id_col", "doc_id"), options.get("text_col", "text")
    piece = F.struct("slot", "source", "rank", "piece")
    per_row = (
        _pieces(docs, **options)
        .where("slot IS NOT NULL")
        .groupBy("row")
        .agg(*[F.first(c).alias(c) for c in ("key_id", "key_digest")], F.collect_list(piece).alias("_ll_pieces"))
        .drop("row")
    )
    # One text for each id and digest, whatever rows repeat it; their pieces join it row by row.
    key = F.coalesce(F.concat(F.lit("="), F.col("doc_id").cast("string")), F.lit(""))
    texts = docs.select(named(docs, id_col).alias("doc_id"), named(docs, text_col).alias("text"))
    texts = texts.select(key.alias("key"), text_digest(F.col("text")).alias("key_digest"), "doc_id", "text")
    texts = texts.dropDuplicates(["key", "key_digest"])
    per_row = per_row.withColumn("key", F.coalesce(F.concat(F.lit("="), F.col("key_id").cast("string")), F.lit("")))
    whole = per_row.join(texts, ["key", "key_digest"])
    # The words are the variable of a lambda, as they would be found anew for every piece else.
    cut = F.transform(
        F.array(F.regexp_extract_all("text", F.lit(SPACED_WORD), F.lit(0))),
        lambda spaced: F.transform(
            "_ll_pieces",
            lambda p: F.struct(
                p["slot"].alias("slot"),
                p["source"].alias("source"),
                p["rank"].alias("rank"),
                p["piece"]["place"].alias("place"),
                F.array_join(
                    F.slice(spaced, (p["piece"]["start"] + 1).cast("int"), p["piece"]["words"].cast("int")), ""
                ).alias("text"),
                p["piece"]["pass"].alias("pass"),
                p["piece"]["start"].alias("start"),
                p["piece"]["words"].alias("words"),
            ),
        ),
    )
    parts = whole.select("doc_id", F.explode(cut[0]).alias("p")).select("doc_id", "p.*")
    blocks = parts.groupBy("slot").agg(
        F.first("source").alias("source"),
        F.first("rank").alias("rank"),
        F.sum("words").alias("n_words"),
        F.array_sort(F.collect_list(F.struct("place", "doc_id", "pass", "start", "words", "text"))).alias("parts"),
    )
    spaced = F.transform(
        "parts",
        lambda p, k: F.when(
            (k < F.size("parts") - 1) & ~F.substring(p["text"], -1, 1).rlike(r"[\x20\x09-\x0D]"),
            F.concat(p["text"], F.lit("\n")),
        ).otherwise(p["text"]),
    )
    made_of = F.transform(
        "parts", lambda p: F.struct(p["doc_id"].alias("doc_id"), *[p[c].alias(c) for c in ("pass", "start", "words")])
    )
    return blocks.select("slot", "source", "rank", "n_words", F.array_join(spaced, "").alias("text"), made_of.alias("pieces"))


def op2_source_mix(spark: SparkSession, folder: str) -> DataFrame:
    mixed = mix(read(spark, folder, "documents"))
    return mixed.select(
        F.col("key_id").alias("doc_id"), "size", "source_size", "target", "taken", "n_slots"
    )


ORACLE = r"""
WITH sized AS (
  SELECT doc_id, source, text,
         coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         coalesce(md5(doc_id::VARCHAR), md5(text), '') AS place
  FROM documents
), per AS (
  SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source
), numbered AS (
  SELECT *, row_number() OVER (ORDER BY source NULLS LAST) AS sid FROM per
), wide AS (
  SELECT *, [3, 1, 2][((sid - 1) % 3 + 1)::INT] AS weight, 2 * source_size AS cap FROM numbered
), levels AS (
  SELECT *,
    (sum(source_size) OVER () * 150
     - 100 * coalesce(sum(cap) OVER (ORDER BY cap / weight, sid
                                     ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE
    / (100 * sum(weight) OVER (ORDER BY cap / weight, sid
                               ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::DOUBLE AS level
  FROM wide
), targets AS (
  SELECT sid, source, source_size,
         least(cap::DOUBLE, weight::DOUBLE * max(level) OVER ()) AS target
  FROM levels
), placed AS (
  SELECT s.doc_id, s.size, t.sid, t.source_size, t.target, floor(t.target)::BIGINT AS quota,
         (sum(s.size) OVER (PARTITION BY t.sid ORDER BY s.place, s.doc_id, md5(s.text), s.size
                            ROWS UNBOUNDED PRECEDING) - s.size)::BIGINT AS start
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source
), ends AS (
  SELECT *, least(start + size, quota) AS high1,
         start + source_size AS low2, least(start + source_size + size, quota) AS high2
  FROM placed
)
SELECT doc_id, size, source_size, target,
       (greatest(high1 - start, 0) + greatest(high2 - low2, 0))::BIGINT AS taken,
       (CASE WHEN high1 > start THEN (high1 - 1) // 1024 - start // 1024 + 1 ELSE 0 END
        + CASE WHEN high2 > low2 THEN (high2 - 1) // 1024 - low2 // 1024 + 1 ELSE 0 END)::BIGINT
         AS n_slots
FROM ends
"""
