"""Quality classifier: a generalised additive model with pairwise interactions.

A document is described by a few numbers taken from its whole text. Each number is cut into
bins; cyclic boosting adds shallow trees, one feature at a time, to that feature's table of
bin scores, and then trees over two features to tables of the strongest pairs. A score is the
logistic of the sum of the table entries that a document's bins point to.

Defined results: null and empty texts have all features 0 and get the score of such a text; a
null label teaches nothing; repeated rows are scored alike; extra columns are ignored; with no
usable label every document scores 0.5, and with one kind of label only, near that label.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlake.llm.common import named, read

# The most labelled rows that a model is fitted on; chosen by a digest of their ids.
SAMPLE_ROWS = 20_000
THRESHOLD = 0.3

FEATURES = (
    "log_bytes", "upper", "digits", "white", "newlines", "marks", "symbols", "non_ascii",
    "entropy", "word_length", "distinct_words", "top_word", "repeated_neighbours",
    "repeated_lines", "line_length", "marked_words",
)
_BYTES = np.arange(256)
_UPPER = (_BYTES >= 65) & (_BYTES <= 90)
_LOWER = (_BYTES >= 97) & (_BYTES <= 122)
_DIGIT = (_BYTES >= 48) & (_BYTES <= 57)
_WHITE = (_BYTES == 32) | ((_BYTES >= 9) & (_BYTES <= 13))
_MARK = np.isin(_BYTES, list(b".,;:?!'\"()-"))
_SYMBOL = (_BYTES > 32) & (_BYTES < 127) & ~(_UPPER | _LOWER | _DIGIT | _MARK)


def describe(text: str | None) -> np.ndarray:
    """The features of one whole text, in the order of FEATURES."""
    out = np.zeros(len(FEATURES), np.float32)
    raw = (text or "").encode("utf-8", "surrogatepass")
    if not raw:
        return out
    counts = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    size, letters = len(raw), counts[_UPPER | _LOWER].sum()
    shares = counts[counts > 0] / size
    words = raw.split()
    out[:9] = (
        np.log1p(size),
        counts[_UPPER].sum() / max(letters, 1),
        counts[_DIGIT].sum() / size,
        counts[_WHITE].sum() / size,
        counts[10] / size,
        counts[_MARK].sum() / size,
        counts[_SYMBOL].sum() / size,
        counts[128:].sum() / size,
        -(shares * np.log2(shares)).sum(),
    )
    if words:
        often = Counter(words)
        lines = [x for x in raw.split(b"\n") if x.strip()]
        out[9:] = (
            sum(map(len, words)) / len(words),
            len(often) / len(words),
            max(often.values()) / len(words),
            sum(a == b for a, b in zip(words, words[1:])) / len(words),
            1 - len(set(lines)) / max(len(lines), 1),
            np.log1p(size / max(len(lines), 1)),
            sum(not (65 <= w[-1] <= 90 or 97 <= w[-1] <= 122 or w[-1] > 127) for w in words) / len(words),
        )
    return out


@dataclass(frozen=True)
class Model:
    """Bin edges per feature, a table of scores per feature, and tables of pairs on coarse bins."""

    base: float
    edges: list[np.ndarray]
    tables: list[np.ndarray]
    coarse: list[np.ndarray]
    pairs: list[tuple[int, int, np.ndarray]]

    def score(self, features: np.ndarray) -> np.ndarray:
        total = np.full(len(features), self.base)
        rough = {}
        for f, (edges, table) in enumerate(zip(self.edges, self.tables)):
            total += table[np.searchsorted(edges, features[:, f], side="right")]
        for f in {i for a, b, _ in self.pairs for i in (a, b)}:
            rough[f] = np.searchsorted(self.coarse[f], features[:, f], side="right")
        for a, b, table in self.pairs:
            total += table[rough[a], rough[b]]
        return 1 / (1 + np.exp(-total))


def _edges(values: np.ndarray, bins: int) -> np.ndarray:
    return np.unique(np.quantile(values, np.linspace(0, 1, bins + 1)[1:-1]))


def _tree(grad: np.ndarray, weight: np.ndarray, leaves: int, least: float) -> np.ndarray:
    """Newton steps of a tree with a few leaves over ordered bins."""
    grad_to = np.concatenate([[0.0], np.cumsum(grad)])
    weight_to = np.concatenate([[0.0], np.cumsum(weight)])

    def gain(low, high):
        return (grad_to[high] - grad_to[low]) ** 2 / (weight_to[high] - weight_to[low] + 1.0)

    parts = [(0, len(grad))]
    while len(parts) < leaves:
        best = (1e-9, None, None)
        for at, (low, high) in enumerate(parts):
            cuts = np.arange(low + 1, high)
            ok = (weight_to[cuts] - weight_to[low] >= least) & (weight_to[high] - weight_to[cuts] >= least)
            if not ok.any():
                continue
            gains = np.where(ok, gain(low, cuts) + gain(cuts, high) - gain(low, high), -1.0)
            if gains.max() > best[0]:
                best = (gains.max(), at, cuts[gains.argmax()])
        if best[1] is None:
            break
        low, high = parts[best[1]]
        parts[best[1] : best[1] + 1] = [(low, best[2]), (best[2], high)]
    step = np.zeros(len(grad))
    for low, high in parts:
        step[low:high] = (grad_to[high] - grad_to[low]) / (weight_to[high] - weight_to[low] + 1.0)
    return step


def _square(grad: np.ndarray, weight: np.ndarray) -> tuple[float, np.ndarray]:
    """The best tree with one cut on either of two features: its gain and steps."""
    g = grad.cumsum(0).cumsum(1)
    w = weight.cumsum(0).cumsum(1)
    if min(g.shape) < 2:
        return 0.0, np.zeros_like(grad)
    gl, wl = g[:-1, -1:], w[:-1, -1:]
    gt, wt = g[-1:, :-1], w[-1:, :-1]
    quarters = [
        (g[:-1, :-1], w[:-1, :-1]),
        (gl - g[:-1, :-1], wl - w[:-1, :-1]),
        (gt - g[:-1, :-1], wt - w[:-1, :-1]),
        (g[-1, -1] - gl - gt + g[:-1, :-1], w[-1, -1] - wl - wt + w[:-1, :-1]),
    ]
    gains = sum(a**2 / (b + 1.0) for a, b in quarters)
    i, j = np.unravel_index(gains.argmax(), gains.shape)
    steps = [a[i, j] / (b[i, j] + 1.0) for a, b in quarters]
    step = np.empty_like(grad)
    step[: i + 1, : j + 1], step[: i + 1, j + 1 :] = steps[0], steps[1]
    step[i + 1 :, : j + 1], step[i + 1 :, j + 1 :] = steps[2], steps[3]
    return float(gains[i, j]), step


def fit(
    features: np.ndarray,
    labels: np.ndarray,
    bins: int = 64,
    coarse_bins: int = 12,
    rounds: int = 150,
    pair_rounds: int = 60,
    n_pairs: int = 8,
    rate: float = 0.15,
    leaves: int = 4,
    least: float = 4.0,
) -> Model:
    """Cyclic boosting of one feature after the other, then of the strongest pairs."""
    count = features.shape[1]
    if not len(labels):
        none = [np.array([])] * count
        return Model(0.0, none, [np.zeros(1)] * count, none, [])
    share = (labels.sum() + 0.5) / (len(labels) + 1)
    base = float(np.log(share / (1 - share)))
    edges = [_edges(features[:, f], bins) for f in range(count)]
    at = [np.searchsorted(edges[f], features[:, f], side="right") for f in range(count)]
    tables = [np.zeros(len(e) + 1) for e in edges]
    total = np.full(len(labels), base)

    def slope():
        p = 1 / (1 + np.exp(-total))
        return labels - p, p * (1 - p)

    for _ in range(rounds):
        for f in range(count):
            n, (grad, weight) = len(tables[f]), slope()
            step = rate * _tree(
                np.bincount(at[f], grad, n), np.bincount(at[f], weight, n), leaves, least
            )
            tables[f] += step
            total += step[at[f]]

    coarse = [_edges(features[:, f], coarse_bins) for f in range(count)]
    rough = [np.searchsorted(coarse[f], features[:, f], side="right") for f in range(count)]

    def square(a, b):
        shape = (len(coarse[a]) + 1, len(coarse[b]) + 1)
        cell, (grad, weight) = rough[a] * shape[1] + rough[b], slope()
        size = shape[0] * shape[1]
        sums = (np.bincount(cell, x, size).reshape(shape) for x in (grad, weight))
        return cell, *_square(*sums)

    strength = sorted(((square(a, b)[1], a, b) for a in range(count) for b in range(a)), reverse=True)
    chosen = [(a, b) for gain, a, b in strength[:n_pairs] if gain > 0]
    pairs = [(a, b, np.zeros((len(coarse[a]) + 1, len(coarse[b]) + 1))) for a, b in chosen]
    for _ in range(pair_rounds):
        for a, b, table in pairs:
            cell, _, step = square(a, b)
            table += rate * step
            total += rate * step.ravel()[cell]
    return Model(base, edges, tables, coarse, pairs)


def is_held_out(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 5 == 0


def train(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    sample_rows: int = SAMPLE_ROWS,
) -> Model:
    """Fit on at most `sample_rows` labelled ids of the learning folds, by a digest of the id.

    The sampled labels are few enough, by that bound, to be sent to every task, so the texts
    need no shuffle; only one feature vector for each of them comes to the driver. Of an id that
    stands in several rows the least vector counts, so rows of a hot id are reduced in the map
    tasks. An id with two labels is learnt with both.
    """
    known = labels.select(
        named(labels, id_col).alias("_ll_label_id"), named(labels, label_col).cast("int").alias("_ll_label")
    ).where("_ll_label_id IS NOT NULL AND _ll_label IS NOT NULL")
    sample = (
        known.where(~is_held_out(F.col("_ll_label_id")))
        .distinct()
        .orderBy(F.xxhash64("_ll_label_id"), "_ll_label_id", "_ll_label")
        .limit(sample_rows)
    )
    rows = (
        docs.select(named(docs, id_col).alias("_ll_id"), named(docs, text_col).alias("_ll_text"))
        .join(F.broadcast(sample), F.col("_ll_id") == F.col("_ll_label_id"))
        .select("_ll_id", "_ll_label", features_of("_ll_text").alias("x"))
        .groupBy("_ll_id", "_ll_label")
        .agg(F.min("x").alias("x"))
        .collect()
    )
    rows.sort(key=lambda r: (r["_ll_id"], r["_ll_label"]))
    x = np.array([r["x"] for r in rows], np.float32).reshape(-1, len(FEATURES))
    return fit(x, np.array([float(r["_ll_label"]) for r in rows]))


@F.pandas_udf(T.ArrayType(T.FloatType()))
def features_of(texts: pd.Series) -> pd.Series:
    return pd.Series([describe(t) for t in texts])


def score(model: Model, text: Column) -> Column:
    """The probability of label 1 of a text."""

    @F.pandas_udf(T.DoubleType())
    def scored(texts: pd.Series) -> pd.Series:
        if not len(texts):
            return pd.Series([], dtype="float64")
        return pd.Series(model.score(np.stack([describe(t) for t in texts])))

    return scored(text)


def accepted(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    threshold: float = THRESHOLD,
) -> DataFrame:
    """The documents that score at least `threshold`, with their own columns."""
    model = train(docs, labels, id_col, text_col)
    return docs.where(score(model, named(docs, text_col)) >= threshold)


def op10_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs = read(spark, folder, "documents")
    model = train(docs, read(spark, folder, "labels"))
    scored = docs.select(
        "doc_id", is_held_out(F.col("doc_id")).alias("held_out"), score(model, F.col("text")).alias("score")
    )
    return scored.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
