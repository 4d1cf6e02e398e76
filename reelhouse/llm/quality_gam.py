"""Quality classifier: generalised additive model with pairwise interactions.

Every feature of a text has a lookup table over bins, and so have a few pairs of
features. The tables are learned by boosting: in turn, each feature gets a
shallow tree fitted to what the sum of all tables still misses, and the tree is
added to its table at a small rate. Pairs are ranked by how much a coarse
two-way table would still gain. A score is a sum of table entries.

Training takes a bounded sample of labelled documents to the driver; scoring is
one pass over the texts, without a shuffle.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelhouse.llm.text import fold, short_batches

#: At most so many labelled documents are learned from (the smallest by hash of the id).
SAMPLE = 20_000
#: A document with this score or more is of good quality.
THRESHOLD = 0.3
BINS, PAIR_BINS, PAIRS = 32, 12, 8
ROUNDS, PAIR_ROUNDS, RATE = 150, 60, 0.1
_SLICE = 1000

_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_SYMBOL = re.compile(r"[#*$%&<>@^~{}\[\]\\=+]")
_DIGIT = re.compile(r"[0-9]")
_CLEAN = re.compile(r"[^\W\d_]+[.,;:!?]?")

FEATURES = (
    "words", "word_length", "symbols", "bars", "exclamations", "digits", "upper", "distinct",
    "most_common", "same_as_last", "repeated_lines", "clean_words", "sentence_ends", "line_length",
)


def features(text: str | None) -> tuple[float, ...]:
    """Numbers that describe a text; all defined for empty and null texts."""
    text = text or ""
    words = _WORD.findall(text)
    n = len(words)
    if not n:
        return (0.0,) * len(FEATURES)
    chars = sum(map(len, words))
    counts = Counter(words)
    lines = [x for x in text.split("\n") if _WORD.search(x)]
    return (
        np.log1p(n),
        chars / n,
        len(_SYMBOL.findall(text)) / chars,
        text.count("|") / n,
        text.count("!") / n,
        len(_DIGIT.findall(text)) / chars,
        sum(1 for w in words if len(w) > 1 and w.isupper()) / n,
        len(counts) / n,
        max(counts.values()) / n,
        sum(map(str.__eq__, words, words[1:])) / n,
        1 - len(set(lines)) / len(lines),
        sum(1 for w in words if _CLEAN.fullmatch(w)) / n,
        text.count(".") / n,
        np.log1p(n / len(lines)),
    )


class Model(NamedTuple):
    edges: list[np.ndarray]
    base: float
    tables: list[np.ndarray]
    pairs: list[tuple[int, int]]
    pair_edges: list[np.ndarray]
    pair_tables: list[np.ndarray]

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of good quality of each row of features."""
        total = np.full(len(x), self.base)
        for column, (edges, table) in enumerate(zip(self.edges, self.tables, strict=True)):
            total += table[np.searchsorted(edges, x[:, column], "right")]
        for (a, b), table in zip(self.pairs, self.pair_tables, strict=True):
            total += table[
                np.searchsorted(self.pair_edges[a], x[:, a], "right"),
                np.searchsorted(self.pair_edges[b], x[:, b], "right"),
            ]
        return 1 / (1 + np.exp(-np.clip(total, -30, 30)))


def _edges(values: np.ndarray, bins: int) -> np.ndarray:
    return np.unique(np.quantile(values, np.linspace(0, 1, bins + 1)[1:-1]))


def _split(g: np.ndarray, h: np.ndarray) -> tuple[float, int]:
    """Best cut of ordered bins with gradients ``g`` and weights ``h``."""
    if len(g) < 2:
        return 0.0, 0
    gl, hl = g.cumsum()[:-1], h.cumsum()[:-1]
    gr, hr = g.sum() - gl, h.sum() - hl
    gain = gl**2 / (hl + 1) + gr**2 / (hr + 1) - g.sum() ** 2 / (h.sum() + 1)
    at = int(gain.argmax())
    return float(gain[at]), at + 1


def _tree(g: np.ndarray, h: np.ndarray, depth: int = 2) -> np.ndarray:
    """Leaf value of every bin after splitting the bins at most ``depth`` times in a row."""
    gain, at = _split(g, h)
    if depth == 0 or gain <= 1e-9:
        return np.full(len(g), g.sum() / (h.sum() + 1))
    return np.concatenate([_tree(g[:at], h[:at], depth - 1), _tree(g[at:], h[at:], depth - 1)])


def _tree_2d(g: np.ndarray, h: np.ndarray, depth: int = 3) -> np.ndarray:
    """The same over a table, cutting along whichever side gains more."""
    (by_row, row), (by_column, column) = _split(g.sum(1), h.sum(1)), _split(g.sum(0), h.sum(0))
    if depth == 0 or max(by_row, by_column) <= 1e-9:
        return np.full(g.shape, g.sum() / (h.sum() + 1))
    if by_row >= by_column:
        return np.vstack([_tree_2d(g[:row], h[:row], depth - 1), _tree_2d(g[row:], h[row:], depth - 1)])
    return np.hstack(
        [_tree_2d(g[:, :column], h[:, :column], depth - 1), _tree_2d(g[:, column:], h[:, column:], depth - 1)]
    )


def fit(x: np.ndarray, y: np.ndarray) -> Model:
    """Learns from feature rows and 0/1 labels; with one label only, its share is the score."""
    share = (y.sum() + 0.5) / (len(y) + 1)
    base = float(np.log(share / (1 - share)))
    width = x.shape[1]
    edges = [_edges(x[:, k], BINS) if len(x) else np.zeros(0) for k in range(width)]
    pair_edges = [_edges(x[:, k], PAIR_BINS) if len(x) else np.zeros(0) for k in range(width)]
    tables = [np.zeros(len(e) + 1) for e in edges]
    if len(np.unique(y)) < 2:
        return Model(edges, base, tables, [], pair_edges, [])
    spot = [np.searchsorted(e, x[:, k], "right") for k, e in enumerate(edges)]
    total = np.full(len(x), base)

    def slopes() -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-np.clip(total, -30, 30)))
        return y - p, p * (1 - p)

    for _ in range(ROUNDS):
        for k in range(width):
            g, h = slopes()
            n = len(tables[k])
            step = RATE * _tree(np.bincount(spot[k], g, n), np.bincount(spot[k], h, n))
            tables[k] += step
            total += step[spot[k]]
    coarse = [np.searchsorted(e, x[:, k], "right") for k, e in enumerate(pair_edges)]
    shape = lambda a, b: (len(pair_edges[a]) + 1, len(pair_edges[b]) + 1)

    def grid(a: int, b: int) -> tuple[np.ndarray, np.ndarray]:
        g, h = slopes()
        rows, columns = shape(a, b)
        cell = coarse[a] * columns + coarse[b]
        return (
            np.bincount(cell, g, rows * columns).reshape(rows, columns),
            np.bincount(cell, h, rows * columns).reshape(rows, columns),
        )

    gains = []
    for a in range(width):
        for b in range(a + 1, width):
            g, h = grid(a, b)
            gains.append((float((g**2 / (h + 1)).sum()), a, b))
    pairs = [(a, b) for _, a, b in sorted(gains, reverse=True)[:PAIRS]]
    pair_tables = [np.zeros(shape(a, b)) for a, b in pairs]
    for _ in range(PAIR_ROUNDS):
        for k, (a, b) in enumerate(pairs):
            step = RATE * _tree_2d(*grid(a, b))
            pair_tables[k] += step
            total += step[coarse[a], coarse[b]]
    return Model(edges, base, tables, pairs, pair_edges, pair_tables)


def _matrix(texts: pd.Series) -> np.ndarray:
    return np.array([features(t) for t in texts], float).reshape(-1, len(FEATURES))


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """Learns from labelled documents outside the held-out fifth.

    ``labels`` has doc_id and quality (0 or 1); rows with nulls are passed over, and
    so are ids without a document. ``sample`` bounds the ids, so they are broadcast.
    """
    short_batches(docs.sparkSession)
    chosen = (
        labels.where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull() & (fold(F.col("doc_id"), 5) != 0))
        .select(F.col("doc_id").alias("_id"), F.col("quality").cast("double").alias("y"))
        .orderBy(F.xxhash64("_id"), "_id", "y")
        .limit(sample)
    )
    columns = [f"f{k}" for k in range(len(FEATURES))]

    def described(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = pd.DataFrame(_matrix(frame["text"]), columns=columns)
            yield out.assign(y=frame["y"].to_numpy(), id=frame["doc_id"].astype(str).to_numpy())

    rows = (
        docs.select("doc_id", "text")
        .join(F.broadcast(chosen), F.col("doc_id") == F.col("_id"))
        .select("doc_id", "text", "y")
        .mapInPandas(described, ", ".join(f"{c} double" for c in [*columns, "y"]) + ", id string")
        .toPandas()
        .sort_values(["id", "y", *columns])
    )
    return fit(rows[columns].to_numpy(float), rows["y"].to_numpy(float))


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with ``score``; null and empty texts are scored like any other."""

    short_batches(docs.sparkSession)

    @F.pandas_udf("double")
    def score(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for series in texts:
            parts = [
                model.score(_matrix(series.iloc[at : at + _SLICE])) for at in range(0, len(series), _SLICE)
            ]
            yield pd.Series(np.concatenate(parts) if parts else np.zeros(0))

    return docs.withColumn("score", score("text"))


def good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents whose score reaches the threshold; same columns."""
    kept = scored(docs.withColumnRenamed("score", "_score") if "score" in docs.columns else docs, train(docs, labels))
    return kept.where(F.col("score") >= THRESHOLD).drop("score").toDF(*docs.columns)
