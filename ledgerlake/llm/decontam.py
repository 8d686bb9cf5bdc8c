"""Benchmark decontamination by the q-gram lemma.

Texts are compared in lower case with runs of white space as one space. A benchmark item of m
characters counts as leaked where a document holds it with at most floor(m * edits / 100)
edits. By the q-gram lemma such a place shares at least m + 1 - q - q * budget q-grams with
the item, and all of them lie on neighbouring diagonals (place in the document less place in
the item), no further apart than twice the budget. Shared q-grams are counted per item in
bands of diagonals that overlap by half, so that every such place falls whole into one band;
bands with enough of them are verified by banded alignment (equality, where there is no edit),
which also gives the span. Every place counts that overlaps no better one of the same item.

Parts of an item count as well: chains of stretches of at least q equal characters, one after
the other in both texts, that cover at least `part_chars` characters of the item, with at most
`edits` percent of them edited between the stretches. By the lemma, a part has a window of
`part_chars` characters with one edit above its budget at most, so q-grams of one band of
diagonals stand closely there; texts and items without such a window are passed over. A part is as long as its first stretch allows, and overlaps no place of
the whole item and no longer part.

The benchmark is a stated query set. It goes through the tasks in blocks of at most
`block_chars` characters, whatever its size: the documents are never shuffled.

Defined results: null and empty texts hold nothing; items of no more than q characters, or
for which the lemma leaves no q-gram to share, are looked up whole, with no edits; empty and
null items are left out, equal items are all reported, and so is every place of an item; repeated rows are reported each;
extra columns are ignored; an empty table on either side gives no leaks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlake.llm.common import named, read

GRAM = 8
EDIT_PERCENT = 5
PART_CHARS = 50
BLOCK_CHARS = 2_000_000
_MIX = np.uint64(0x9E3779B97F4A7C15)
_FILTER_BITS = 20
# More edits than any text has, for cells outside the band.
FAR = 1 << 40


def normal(text: str | None) -> str:
    return " ".join((text or "").lower().split())


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)


def grams(codes: np.ndarray, q: int) -> np.ndarray:
    """A hash of the q-gram at every place, by doubling the length of what is hashed."""
    if len(codes) < q:
        return np.array([], np.uint64)
    out, length = (codes + np.uint64(1)) * _MIX, 1
    while length < q:
        step = min(length, q - length)
        out = (out[:-step] ^ (out[:-step] >> np.uint64(29))) * _MIX + out[step:]
        length += step
    return (out ^ (out >> np.uint64(32))) * _MIX


def budget(length: int, q: int, percent: int) -> int:
    """The edits allowed; none where the lemma would ask for no shared q-gram."""
    edits = length * percent // 100
    while edits and length + 1 - q - q * edits < 1:
        edits -= 1
    return edits


def align(
    item: np.ndarray, region: np.ndarray, limit: int, low: int, high: int
) -> tuple[int, int, int] | None:
    """(edits, start, end) of the best place of `item` in `region`, or None above `limit`.

    Only cells on the diagonals (place in the region less place in the item) from `low` to `high`
    are filled. Sellers' recurrence over the rows of the item, on the band's cells of a row at
    once; ties go to the earliest end, then the latest start.
    """
    size = high - low + 1
    cell = np.arange(size)
    place = low + cell
    inside = (place >= 0) & (place <= len(region))
    cost, start = np.where(inside, 0, FAR), place.copy()
    padded = np.append(region, np.zeros(1, region.dtype))
    for code in item:
        place = place + 1
        # A step along the diagonal stays in its cell, a step down comes from the next one.
        read = np.clip(place - 1, 0, len(region))
        diagonal = np.where(place >= 1, cost + (padded[read] != code), FAR)
        down = np.append(cost[1:], FAR) + 1
        row = np.minimum(diagonal, down)
        origin = np.where(diagonal <= down, start, np.append(start[1:], 0))
        row = np.where((place >= 0) & (place <= len(region)), row, FAR)
        # Steps to the right: the least of (row - cell) so far, with where it came from.
        level = (row - cell) * (size + 1) + (size - cell)
        came = size - np.minimum.accumulate(level) % (size + 1)
        cost, start = np.minimum(row[came] + cell - came, FAR), origin[came]
        cost = np.where(place <= len(region), cost, FAR)
        if cost.min() > limit:
            return None
    best = int(cost.argmin())
    if cost[best] > limit:
        return None
    return int(cost[best]), int(start[best]), int(place[best])


def distance(one: np.ndarray, two: np.ndarray) -> int:
    """The edits between two short texts."""
    if not len(one) or not len(two):
        return len(one) + len(two)
    place = np.arange(len(two) + 1)
    cost = place
    for i, code in enumerate(one, 1):
        best = np.minimum(cost[:-1] + (two != code), cost[1:] + 1)
        cost = np.minimum.accumulate(np.concatenate([[i], best]) - place) + place
    return int(cost[-1])


def dense(place: np.ndarray, count: int, width: int) -> np.ndarray:
    """For each place whether it begins a run of so many places in so many characters."""
    if len(place) < count:
        return np.array([], bool)
    return place[max(count, 1) - 1 :] - place[: len(place) - max(count, 1) + 1] < width


def apart(found: list[tuple]) -> list[tuple]:
    """Of (rank, start, end, ...) in the order of rank and start, those that overlap no earlier one."""
    kept: list[tuple] = []
    for x in sorted(found):
        if not any(x[1] < y[2] and y[1] < x[2] for y in kept):
            kept.append(x)
    return kept


class Items:
    """A block of benchmark items with the index of their q-grams.

    Without `part` only whole items are looked for.
    """

    def __init__(self, rows: list[tuple[int, str]], q: int, percent: int, part: int | None = None):
        self.q, self.percent, self.part, self.ids = q, percent, part, [i for i, _ in rows]
        if part is not None:
            part_edits = budget(part, q, percent)
            # Edits may lie close: some window of a part has one more than its own budget at most.
            self.part_least = max(1, part + 1 - q - q * (part_edits + 1))
            self.part_step, self.part_width = part_edits + 1, part + 2 * (part_edits + 1)
        self.codes = [_codes(t) for _, t in rows]
        self.edits = [budget(len(c), q, percent) for c in self.codes]
        self.least = np.array([len(c) + 1 - q - q * e for c, e in zip(self.codes, self.edits)])
        self.short = [k for k, c in enumerate(self.codes) if len(c) <= q]
        self.texts = [t for _, t in rows]
        each = [grams(c, q) for c in self.codes]
        keys = np.concatenate(each) if each else np.array([], np.uint64)
        owner = np.repeat(np.arange(len(each)), [len(g) for g in each])
        at = np.concatenate([np.arange(len(g)) for g in each]) if each else owner
        order = np.argsort(keys, kind="stable")
        self.keys, self.owner, self.at = keys[order], owner[order], at[order]
        long = [k for k in range(len(each)) if len(each[k])]
        # Any leak has so many shared places at least, in so many characters at most.
        self.fewest = int(min((self.least[k] for k in long), default=0))
        self.widest = max((len(self.codes[k]) + self.edits[k] for k in long), default=0)
        self.present = np.zeros(1 << _FILTER_BITS, bool)
        self.present[(keys >> np.uint64(64 - _FILTER_BITS)).astype(np.int64)] = True

    def hits(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(item, diagonal, place) of every q-gram that the text shares with an item."""
        found = grams(codes, self.q)
        place = np.flatnonzero(self.present[(found >> np.uint64(64 - _FILTER_BITS)).astype(np.int64)])
        if not dense(place, self.fewest, self.widest).any() and not (
            self.part is not None and dense(place, self.part_least, self.part_width).any()
        ):
            place = place[:0]
        low = np.searchsorted(self.keys, found[place], "left")
        many = np.searchsorted(self.keys, found[place], "right") - low
        place, low, many = place[many > 0], low[many > 0], many[many > 0]
        entry = np.repeat(low - np.cumsum(many) + many, many) + np.arange(many.sum())
        spread = np.repeat(place, many)
        return self.owner[entry], spread - self.at[entry], spread

    def leaks(self, text: str | None) -> list[tuple[int, int, int, int]]:
        """(item id, edits, start, end) of every place of every leaked item."""
        return [found[:4] for found in self.places(text)]

    def places(self, text: str | None) -> list[tuple[int, int, int, int, int, int]]:
        """(item id, edits, start, end, start and end in the item) of every place."""
        plain = normal(text)
        out = []
        for k in self.short:
            item = self.texts[k]
            at = plain.find(item)
            while at >= 0:
                out.append((self.ids[k], 0, at, at + len(item), 0, len(item)))
                at = plain.find(item, at + len(item))
        codes = _codes(plain)
        item, diagonal, place = self.hits(codes)
        if not len(item):
            return sorted(out)
        # Too few hits in all rule an item out before anything is sorted.
        counts = np.bincount(item, minlength=len(self.ids))
        enough = counts >= np.maximum(self.least, 1)
        crowded = self._crowded(counts, item, diagonal, place)
        keep = (enough | crowded)[item]
        item, diagonal, place = item[keep], diagonal[keep], place[keep]
        for k in np.unique(item):
            length = len(self.codes[k])
            if length <= self.q:
                continue
            mine, whole = np.flatnonzero(item == k), []
            if enough[k]:
                whole = self._whole(k, plain, codes, diagonal[mine])
            out += [(self.ids[k], edits, start, end, 0, length) for edits, start, end in whole]
            if crowded[k]:
                for _, start, end, edits, first, last in self._parts(k, codes, diagonal[mine], place[mine], whole):
                    out.append((self.ids[k], edits, start, end, first, last))
        return sorted(out)

    def _crowded(self, counts: np.ndarray, item: np.ndarray, diagonal: np.ndarray, place: np.ndarray) -> np.ndarray:
        """The items of which a window of the text may hold a part: enough hits in a band."""
        found = np.zeros(len(self.ids), bool)
        if self.part is None:
            return found
        long = np.array([len(c) > self.part for c in self.codes])
        keep = (long & (counts >= self.part_least))[item]
        item, diagonal, place = item[keep], diagonal[keep], place[keep]
        band = np.floor_divide(diagonal, self.part_step)
        item, place = np.tile(item, 3), np.tile(place, 3)
        band = np.concatenate([band, band - 1, band - 2])
        order = np.lexsort((place, band, item))
        item, band, place = item[order], band[order], place[order]
        ahead = self.part_least - 1
        if len(item) > ahead:
            last = len(item) - ahead
            same = (item[ahead:] == item[:last]) & (band[ahead:] == band[:last])
            found[item[:last][same & (place[ahead:] - place[:last] < self.part_width)]] = True
        return found

    def _whole(self, k: int, plain: str, codes: np.ndarray, diagonal: np.ndarray) -> list[tuple[int, int, int]]:
        """(edits, start, end) of the places of a whole item."""
        edits, length = self.edits[k], len(self.codes[k])
        step = max(edits, 1)
        band = np.floor_divide(diagonal, step)
        # Band b holds the diagonals of steps b, b + 1 and b + 2, whichever one is first.
        both = np.concatenate([band, band - 1, band - 2])
        bands, counts = np.unique(both, return_counts=True)
        found = set()
        for b in bands[counts >= self.least[k]]:
            low = max(0, int(b) * step - edits)
            high = min(len(codes), (int(b) + 3) * step + length + edits)
            at = plain.find(self.texts[k], low, high)
            if at >= 0:
                while at >= 0:
                    found.add((0, at, at + length))
                    at = plain.find(self.texts[k], at + length, high)
            # A place in this region keeps within its edits of the band's diagonals, twice at most.
            elif near := align(
                self.codes[k], codes[low:high], edits,
                int(b) * step - 2 * edits - low, (int(b) + 3) * step + 2 * edits - low,
            ):
                found.add((near[0], low + near[1], low + near[2]))
        return apart(list(found))

    def _parts(
        self, k: int, codes: np.ndarray, diagonal: np.ndarray, place: np.ndarray, whole: list[tuple[int, int, int]]
    ) -> list[tuple]:
        """(-length, start, end, edits, start and end in the item) of the parts of an item elsewhere."""
        q, item, limit = self.q, self.codes[k], len(self.codes[k]) * self.percent // 100
        free = np.ones(len(place), bool)
        for _, start, end in whole:
            free &= (place + q <= start) | (place >= end)
        diagonal, place = diagonal[free], place[free]
        if len(place) < self.part_least:
            return []
        # Stretches of equal characters: (start, end, diagonal), by start.
        order = np.lexsort((place, diagonal))
        diagonal, place = diagonal[order], place[order]
        first = np.flatnonzero(np.r_[True, (np.diff(diagonal) != 0) | (np.diff(place) != 1)])
        last = np.r_[first[1:], len(place)] - 1
        runs = sorted(zip(place[first].tolist(), (place[last] + q).tolist(), diagonal[first].tolist()))
        starts = np.array([r[0] for r in runs])
        gap = q * (limit + 1) + limit
        following: dict[int, list[tuple[int, int]]] = {}

        def after(j: int) -> list[tuple[int, int]]:
            """(run, edits before it) of the runs that can follow a run."""
            if j not in following:
                following[j] = []
                _, end, d = runs[j]
                for n in range(j + 1, int(np.searchsorted(starts, end + gap, "right"))):
                    start, stop, other = runs[n]
                    over = max(0, end - start, (end - d) - (start - other))
                    if abs(d - other) <= limit and start + over < stop and stop > end:
                        there, here = item[end - d : start + over - other], codes[end : start + over]
                        if (edits := distance(there, here)) <= limit:
                            following[j].append((n, edits))
            return following[j]

        found = []
        for i, (start, _, d) in enumerate(runs):
            cost, best = {i: 0}, None
            for j in range(i, len(runs)):
                if j not in cost:
                    if j > max(cost):
                        break
                    continue
                end, length = runs[j][1], runs[j][1] - runs[j][2] - (start - d)
                if length >= self.part and cost[j] * 100 <= self.percent * length:
                    best = min(best or (0,), (-length, start, end, cost[j], start - d, end - runs[j][2]))
                for n, edits in after(j):
                    if (total := cost[j] + edits) <= limit and total < cost.get(n, limit + 1):
                        cost[n] = total
            if best:
                found.append(best)
        return apart(found)


def blocks(
    benchmark: DataFrame, id_col: str, text_col: str, chars: int
) -> Iterator[list[tuple[int, str]]]:
    """The items in blocks of at most so many characters (or one item), fetched one at a time."""
    block, size = [], 0
    items = benchmark.select(named(benchmark, id_col).alias("id"), named(benchmark, text_col).alias("text"))
    for row in items.orderBy("id", "text").toLocalIterator():
        text = normal(row["text"])
        if not text or row["id"] is None:
            continue
        if block and size + len(text) > chars:
            yield block
            block, size = [], 0
        block.append((row["id"], text))
        size += len(text)
    if block:
        yield block


LEAKS = T.ArrayType(
    T.StructType().add("item", T.LongType()).add("edits", T.IntegerType())
    .add("start", T.IntegerType()).add("end", T.IntegerType())
    .add("item_start", T.IntegerType()).add("item_end", T.IntegerType())
)


def _found(text: Column, block: list[tuple[int, str]], q: int, percent: int, part: int | None) -> Column:
    """The leaks of one block's items in each text."""
    sent = SparkSession.getActiveSession().sparkContext.broadcast(block)

    @F.pandas_udf(LEAKS)
    def found(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        items = Items(sent.value, q, percent, part)
        names = ("item", "edits", "start", "end", "item_start", "item_end")
        for texts in parts:
            yield pd.Series([[dict(zip(names, leak)) for leak in items.places(t)] for t in texts])

    return found(text)


def leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    q: int = GRAM,
    edit_percent: int = EDIT_PERCENT,
    block_chars: int = BLOCK_CHARS,
    part_chars: int | None = PART_CHARS,
) -> DataFrame:
    """`id` and `leaks` for every row: an array of (item, edits, start, end, item_start, item_end).

    Spans count characters of the normal forms of the text and of the item.
    """
    text = named(docs, text_col)
    found = [
        _found(text, block, q, edit_percent, part_chars)
        for block in blocks(benchmark, item_col, item_text_col, block_chars)
    ]
    all_found = F.concat(*found) if found else F.expr("array()").cast(LEAKS)
    return docs.select(named(docs, id_col).alias("id"), all_found.alias("leaks"))


def clean(
    docs: DataFrame,
    benchmark: DataFrame,
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    q: int = GRAM,
    edit_percent: int = EDIT_PERCENT,
    block_chars: int = BLOCK_CHARS,
    part_chars: int | None = PART_CHARS,
) -> DataFrame:
    """The documents in which no benchmark item or long part of one leaks, with their own columns."""
    for block in blocks(benchmark, item_col, item_text_col, block_chars):
        docs = docs.where(F.size(_found(named(docs, text_col), block, q, edit_percent, part_chars)) == 0)
    return docs


def op4_qgram_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    """Every leak: the document, the item, the edits, and the spans in the normal forms of both."""
    found = leaks(read(spark, folder, "documents"), read(spark, folder, "benchmark"))
    each = found.select(F.col("id").alias("doc_id"), F.explode("leaks").alias("leak"))
    return each.select(
        "doc_id",
        F.col("leak.item").alias("item_id"),
        F.col("leak.edits").alias("edits"),
        F.col("leak.start").alias("start_char"),
        F.col("leak.end").alias("end_char"),
        F.col("leak.item_start").alias("item_start_char"),
        F.col("leak.item_end").alias("item_end_char"),
    )
