"""License scans: fuzzy search for short notices beside exact phrases.

Words are runs of letters, digits and characters beyond ASCII, in lower case for A-Z. Base
phrases count wherever their words stand one after the other. Notices are looked for in the
text with its words joined by single spaces: a notice of m characters may have up to
floor(m * errors / 100) edits. It is cut into one piece more than that, so one piece at least
is left whole in any such place (pigeonhole); exact search for the pieces gives the candidate
regions, and bounded-error matching of the regex library decides and reports the span.

The score of a document is the likeness of its best match: 1 for a base phrase, else one less
edits over length of the best notice, else 0.

Defined results: null and empty texts have no words and no labels; repeated rows are scanned
each; extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import cached_property

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.llm.common import named, read

# Base phrases and their labels.
PHRASES = (
    ("gnu general public license", "gpl"),
    ("apache license", "apache"),
    ("cc by", "cc-by"),
    ("mit license", "mit"),
)
# Our own notices and the labels that they add.
NOTICES = (
    ("licensed under the apache license version 2 0", "apache-2.0"),
    ("released under the mit license", "mit-notice"),
    ("permission is hereby granted free of charge to any person obtaining a copy", "mit-notice"),
    ("licensed under the gnu general public license version 3", "gpl-3.0"),
    ("licensed under the gnu general public license version 2", "gpl-2.0"),
    ("gnu lesser general public license", "lgpl"),
    ("gnu affero general public license", "agpl"),
    ("licensed under cc by nc 4 0", "cc-by-nc-4.0"),
    ("licensed under cc by sa 4 0", "cc-by-sa-4.0"),
    ("licensed under cc by 4 0", "cc-by-4.0"),
    ("creative commons attribution noncommercial", "cc-by-nc"),
    ("creative commons attribution sharealike", "cc-by-sa"),
    ("mozilla public license version 2 0", "mpl-2.0"),
    ("redistribution and use in source and binary forms", "bsd"),
    ("this is free and unencumbered software released into the public domain", "unlicense"),
    ("dedicated to the public domain under cc0", "cc0"),
)
ERROR_PERCENT = 10
# Anything in ASCII that is no part of a word becomes a space; the rest of a word is kept.
_WORDS = bytes(
    c if c > 127 or chr(c).isalnum() else 32 for c in bytes(range(256)).lower()
)


@dataclass(frozen=True)
class Notice:
    text: str
    label: str
    errors: int

    @cached_property
    def pieces(self) -> list[tuple[int, bytes]]:
        """(offset, piece) of a cut into errors + 1 pieces of about equal length."""
        count, size = self.errors + 1, len(self.text)
        cuts = [size * k // count for k in range(count + 1)]
        return [(low, self.text[low:high].encode()) for low, high in zip(cuts, cuts[1:])]


def notice(text: str, label: str, percent: int = ERROR_PERCENT) -> Notice:
    return Notice(text, label, len(text) * percent // 100)


#: How many matches a window of a long region has room for.
WINDOW_MATCHES = 16


def apart(spans: list[tuple]) -> list[tuple]:
    """Of spans (..., start at 3, end at 4, ...) in order, those that overlap no earlier one."""
    starts: list[int] = []
    by_start: dict[int, tuple] = {}
    kept = []
    for span in spans:
        at = bisect_left(starts, span[4])
        # All kept spans are apart, so only the last one that starts before this one's end can overlap.
        if at and by_start[starts[at - 1]][4] > span[3]:
            continue
        starts.insert(at, span[3])
        by_start[span[3]] = span
        kept.append(span)
    return kept


class Scanner:
    """Base phrases and notices, ready to search one text after the other."""

    def __init__(self, phrases: Sequence[tuple[str, str]], notices: Sequence[Notice]):
        import ahocorasick
        import regex

        self.phrases = [(f" {p} ".encode(), label) for p, label in phrases]
        self.notices = notices
        self.patterns = [
            regex.compile(
                b"(?be)(?:" + regex.escape(n.text.encode(), literal_spaces=True) + b"){e<=%d}" % n.errors
            )
            for n in notices
        ]
        self.seeds = ahocorasick.Automaton()
        by_piece: dict[str, list[tuple[int, int]]] = {}
        for k, n in enumerate(notices):
            for offset, piece in n.pieces:
                by_piece.setdefault(piece.decode("latin-1"), []).append((k, offset))
        for piece, users in by_piece.items():
            self.seeds.add_word(piece, (len(piece), users))
        self.seeds.make_automaton()

    def regions(self, words: bytes) -> dict[int, list[tuple[int, int]]]:
        """Per notice, merged regions around the exact places of its pieces."""
        found: dict[int, list[tuple[int, int]]] = {}
        for last, (length, users) in self.seeds.iter(words.decode("latin-1")):
            for k, offset in users:
                n = self.notices[k]
                low = max(0, last + 1 - length - offset - n.errors)
                high = low + len(n.text) + 2 * n.errors + 1
                mine = found.setdefault(k, [])
                if mine and low <= mine[-1][1]:
                    mine[-1] = (min(low, mine[-1][0]), max(high, mine[-1][1]))
                else:
                    mine.append((low, high))
        return found

    def windows(self, n: Notice, regions: list[tuple[int, int]]) -> Iterator[tuple[int, int]]:
        """The regions, long ones in windows that overlap by the longest match, so that the search
        for the best match never goes over a long text again and again."""
        overlap = len(n.text) + n.errors
        for low, high in regions:
            while high - low > WINDOW_MATCHES * overlap:
                yield low, low + WINDOW_MATCHES * overlap
                low += (WINDOW_MATCHES - 1) * overlap
            yield low, high

    def scan(self, text: str | None) -> dict:
        """Counts and places of base phrases, and spans of notices in the joined words."""
        words = b" ".join((text or "").encode("utf-8", "surrogatepass").translate(_WORDS).split())
        padded = b" " + words + b" "
        starts, base = [], set()
        for phrase, label in self.phrases:
            at, passed, word = padded.find(phrase), 0, 0
            while at >= 0:
                word += padded.count(b" ", passed, at)
                starts.append(word)
                base.add(label)
                at, passed = padded.find(phrase, at + 1), at
        spans = []
        for k, regions in self.regions(words).items():
            n = self.notices[k]
            for low, high in self.windows(n, regions):
                # The best match first, then what lies on either side of it.
                open_parts = [(low, min(high, len(words)))]
                while open_parts:
                    at, end = open_parts.pop()
                    if end - at < len(n.text) - n.errors:
                        continue
                    if match := self.patterns[k].search(words, at, end):
                        edits = sum(match.fuzzy_counts)
                        spans.append((edits / len(n.text), -len(n.text), n.label, match.start(), match.end(), edits))
                        open_parts += [(at, match.start()), (match.end(), end)]
        # A place belongs to the notice that fits it best.
        kept = apart(sorted(set(spans)))
        best = max((1 - span[0] for span in kept), default=0.0)
        labels = base | {span[2] for span in kept}
        return {
            "n_words": words.count(b" ") + 1 if words else 0,
            "n_base": len(starts),
            "first_word": min(starts, default=None),
            "last_word": max(starts, default=None),
            "base_labels": ",".join(sorted(base)),
            "labels": ",".join(sorted(labels)),
            "score": 1.0 if base else best,
            "spans": [dict(zip(("label", "start", "end", "edits"), s)) for s in sorted(span[2:] for span in kept)],
        }


SCHEMA = (
    "n_words long, n_base long, first_word long, last_word long, base_labels string, labels string,"
    " score double, spans array<struct<label: string, start: long, end: long, edits: long>>"
)


def scan(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    phrases: Sequence[tuple[str, str]] = PHRASES,
    notices: Sequence[Notice] | None = None,
) -> DataFrame:
    """One row per row of `docs`: id, the columns of SCHEMA. One pass, no shuffle.

    Spans are byte places in the words joined by single spaces.
    """
    notices = [notice(*n) for n in NOTICES] if notices is None else notices
    rows = docs.select(named(docs, text_col).alias("text"), named(docs, id_col).alias("id"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(phrases, notices)
        span = pa.struct([("label", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("edits", pa.int64())])
        kinds = {
            "n_words": pa.int64(), "n_base": pa.int64(), "first_word": pa.int64(), "last_word": pa.int64(),
            "base_labels": pa.string(), "labels": pa.string(), "score": pa.float64(), "spans": pa.list_(span),
        }
        for batch in batches:
            found = [scanner.scan(text.as_py()) for text in batch["text"]]
            columns = [pa.array([f[name] for f in found], kind) for name, kind in kinds.items()]
            yield pa.RecordBatch.from_arrays([*columns, batch["id"]], [*kinds, "id"])

    return rows.mapInArrow(run, f"{SCHEMA}, id {rows.schema['id'].dataType.simpleString()}")


def op9_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    found = scan(read(spark, folder, "documents"))
    return found.select(
        F.col("id").alias("doc_id"), "n_words", "n_base", "first_word", "last_word", "base_labels",
        "labels", "score", F.size("spans").alias("n_spans"),
    )
