"""Benchmark decontamination: suffix arrays over the training texts.

Each task takes its documents in shards of about ``SHARD`` bytes and sorts the
word positions of a shard by the words that follow, by rank doubling. Every test
suffix, cut to a window of ten words (a shorter item is one window), is then
binary-searched in that array: the positions between its bounds are all places
where the window occurs. Neighbouring windows of one item that occur at
neighbouring places are parts of one verbatim match, which is how the longest
matches and their places are told.

A match has only words that the test set has. So only runs of such words, of the
length of the shortest window at least, enter the arrays; nothing else can match.

The test set goes to the tasks in blocks of bounded size, one pass over the
documents each; a document is narrow (no shuffle at all), and its result does not
depend on how documents are dealt to tasks or shards.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reelhouse.llm import terms
from reelhouse.llm.text import short_batches

#: Words of a window.
WINDOW = 10
#: Bytes of text in one suffix array.
SHARD = 8 << 20
#: Windows of one piece of a long item; pieces overlap by what a window needs.
PIECE = 50_000

_SPANS = T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))
_PA_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))


@dataclass
class Suffixes:
    """Distinct windows of a block of items, and where in the items each lies."""

    known: dict[bytes, int]
    words: np.ndarray  # windows x longest window, 0 beyond the end
    length: np.ndarray
    items: list[str | None]
    first: np.ndarray  # places of window q: first[q] up to first[q + 1]
    item: np.ndarray
    offset: np.ndarray

    @staticmethod
    def of(pieces: list[tuple[str | None, int, int, bytes]], window: int) -> Suffixes:
        """``pieces``: item, hash of its whole text, position of the piece, its words."""
        known: dict[bytes, int] = {}
        names: dict[tuple[str | None, int], int] = {}
        places: dict[tuple[int, ...], list[tuple[int, int]]] = {}
        for name, key, at, text in pieces:
            ids = [known.setdefault(word, len(known) + 1) for word in text.split()]
            item = names.setdefault((name, key), len(names))
            for start in range(max(1, len(ids) - window + 1)):
                places.setdefault(tuple(ids[start : start + window]), []).append((item, at + start))
        words = np.zeros((len(places), window), np.int64)
        length = np.zeros(len(places), np.int64)
        for q, ids in enumerate(places):
            words[q, : len(ids)] = ids
            length[q] = len(ids)
        first = np.cumsum([0, *map(len, places.values())])
        flat = np.array([p for found in places.values() for p in found], np.int64).reshape(-1, 2)
        return Suffixes(known, words, length, [name for name, _ in names], first, flat[:, 0], flat[:, 1])


def suffix_array(words: np.ndarray, depth: int) -> np.ndarray:
    """Positions of ``words`` in the order of the ``depth`` words that start there."""
    rank, have = words, 1
    while have < depth:
        step = min(have, depth - have)
        later = np.zeros_like(rank)
        later[: len(rank) - step] = rank[step:]
        key = rank * (int(rank.max(initial=0)) + 1) + later
        rank = np.unique(key, return_inverse=True)[1]
        have += step
    return np.argsort(rank, kind="stable")


def bounds(
    text: np.ndarray, order: np.ndarray, words: np.ndarray, length: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Binary search of every window: the part of the suffix array that starts with it.

    ``text`` goes on with zeros for the length of a window.
    """

    def bound(low: np.ndarray, after_equal: bool) -> np.ndarray:
        high = np.full(len(words), len(order))
        open_ = np.flatnonzero(low < high)
        while len(open_):
            middle = (low[open_] + high[open_]) >> 1
            at = order[middle]
            order_of = np.zeros(len(open_), np.int64)
            for k in range(words.shape[1]):
                same = np.flatnonzero((order_of == 0) & (k < length[open_]))
                if not len(same):
                    break
                order_of[same] = text[at[same] + k] - words[open_[same], k]
            right = order_of <= 0 if after_equal else order_of < 0
            low[open_[right]] = middle[right] + 1
            high[open_[~right]] = middle[~right]
            open_ = open_[low[open_] < high[open_]]
        return low

    first = bound(np.zeros(len(words), np.int64), False)
    return first, bound(first.copy(), True)


def _runs(ids: np.ndarray, starts: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Known words in runs of ``least`` or more within one text, each run followed by 0,
    and the position each comes from."""
    known = ids > 0
    fresh = known.copy()
    fresh[1:] &= ~known[:-1]
    inside = starts[:-1][starts[:-1] < len(ids)]
    fresh[inside] = known[inside]
    run = fresh.cumsum() - 1
    long_run = np.bincount(run[known], minlength=1) >= least
    at = np.flatnonzero(known)
    at = at[long_run[run[at]]]
    slot = np.arange(len(at)) + (fresh[at].cumsum() - 1 if len(at) else 0)
    size = int(slot[-1]) + 2 if len(at) else 0
    text, place = np.zeros(size, np.int64), np.full(size, -1)
    text[slot], place[slot] = ids[at], at
    return text, place


def occurrences(ids: np.ndarray, starts: np.ndarray, suffixes: Suffixes) -> tuple[np.ndarray, np.ndarray]:
    """(position, window) of every occurrence of a window in the texts of a shard."""
    none = np.zeros(0, np.int64)
    if not len(suffixes.words):
        return none, none
    text, place = _runs(ids, starts, int(suffixes.length.min()))
    if not len(text):
        return none, none
    there = np.zeros(len(suffixes.known) + 1, bool)
    there[text] = True
    there[0] = True
    asked = np.flatnonzero(there[suffixes.words].all(axis=1))
    depth = suffixes.words.shape[1]
    order = suffix_array(text, depth)
    text = np.concatenate([text, np.zeros(depth, np.int64)])
    low, high = bounds(text, order, suffixes.words[asked], suffixes.length[asked])
    n = high - low
    window = np.repeat(asked, n)
    within = np.arange(int(n.sum())) - np.repeat(n.cumsum() - n, n)
    return place[order[np.repeat(low, n) + within]], window


def _spans(at: np.ndarray, length: np.ndarray, starts: np.ndarray) -> list[list[dict[str, int]]]:
    """Covered stretches of each text, positions within the text."""
    size = int(starts[-1])
    change = np.bincount(at, minlength=size + 1) - np.bincount(at + length, minlength=size + 1)
    # a stretch never goes on in the next text, but may end where that one begins
    covered = np.concatenate([[False], change.cumsum()[:-1] > 0, [False]])
    breaks = np.zeros(size + 1, bool)
    breaks[starts] = True
    begins = np.flatnonzero(covered[1:] & (~covered[:-1] | breaks))
    ends = np.flatnonzero(covered[:-1] & (~covered[1:] | breaks))
    found: list[list[dict[str, int]]] = [[] for _ in range(len(starts) - 1)]
    owner = np.searchsorted(starts, begins, "right") - 1
    for doc, a, b in zip(owner.tolist(), begins.tolist(), ends.tolist(), strict=True):
        found[doc].append({"start": a - int(starts[doc]), "end": b - int(starts[doc])})
    return found


def _merged(one: list[dict[str, int]], two: list[dict[str, int]]) -> list[dict[str, int]]:
    if not one or not two:
        return one or two
    out: list[dict[str, int]] = []
    for span in sorted(one + two, key=lambda s: s["start"]):
        if out and span["start"] <= out[-1]["end"]:
            out[-1] = {"start": out[-1]["start"], "end": max(out[-1]["end"], span["end"])}
        else:
            out.append(span)
    return out


def _test_blocks(items: DataFrame, item_col: str, text_col: str, window: int, block: int) -> Iterator[Suffixes]:
    """Windows of all items in blocks; a long item is cut into overlapping pieces first."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[tuple] = []
            for name, key, raw in zip(*(column.to_pylist() for column in batch.columns), strict=True):
                words = terms.split(raw)
                last = max(1, len(words) - window + 1) if words else 0
                for at in range(0, last, PIECE):
                    rows.append((name, key, at, b" ".join(words[at : at + PIECE + window - 1])))
            columns = list(zip(*rows, strict=True)) or [(), (), (), ()]
            types = (pa.string(), pa.int64(), pa.int64(), pa.binary())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=["item", "key", "at", "words"]
            )

    text = F.col(text_col)
    plain = items.select(F.col(item_col).cast("string").alias("item"), F.xxhash64(text).alias("key"), text.cast("binary").alias("raw"))
    pieces = plain.mapInArrow(cut, "item string, key long, at long, words binary").distinct()
    found = False
    for rows in terms.blocks(pieces, "words", block):
        found = True
        yield Suffixes.of([(r["item"], r["key"], r["at"], bytes(r["words"])) for r in rows], window)
    if not found:
        yield Suffixes.of([], window)


def _read(shard: pa.RecordBatch, column: int, known: dict[bytes, int]) -> tuple[np.ndarray, np.ndarray]:
    return terms.numbered([terms.split(raw) for raw in shard.column(column).to_pylist()], known)


def hits(
    docs: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    window: int = WINDOW,
    block: int = terms.BLOCK,
    shard: int = SHARD,
) -> DataFrame:
    """One row per row of ``docs``: id, n_words, spans of words inside test windows, items.

    ``spans`` are word positions from 0, ends exclusive, in order and apart; ``items``
    the ids, as text, of the items that have an occurring window, in order, each once.
    Null and empty texts have no words and no hits, neither have such items; an item
    without id hits words but is not listed. Repeated rows and ids are each judged
    alike. Further columns of both tables play no part. An empty test set hits
    nothing; empty ``docs`` give an empty result.
    """
    short_batches(docs.sparkSession)
    spark = docs.sparkSession
    schema = T.StructType(
        [
            T.StructField("id", docs.schema[id_col].dataType),
            T.StructField("raw", T.BinaryType()),
            T.StructField("n_words", T.LongType()),
            T.StructField("spans", _SPANS),
            T.StructField("items", T.ArrayType(T.StringType())),
        ]
    )
    found = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("binary").alias("raw"))
    for suffixes in _test_blocks(items, item_col, text_col, window, block):
        sent = spark.sparkContext.broadcast(suffixes)

        def search(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            test = sent.value
            for part in terms.shards(batches, 1, shard):
                ids, starts = _read(part, 1, test.known)
                at, which = occurrences(ids, starts, test)
                spans = _spans(at, test.length[which], starts)
                named: list[set[str]] = [set() for _ in spans]
                doc = np.searchsorted(starts, at, "right") - 1
                for key in np.unique(doc * len(test.words) + which).tolist():
                    row, q = divmod(key, len(test.words))
                    named[row].update(
                        name for k in test.item[test.first[q] : test.first[q + 1]] if (name := test.items[k]) is not None
                    )
                if part.num_columns > 2:
                    spans = [_merged(a, b) for a, b in zip(part.column(3).to_pylist(), spans, strict=True)]
                    named = [b.union(a) for a, b in zip(part.column(4).to_pylist(), named, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        part.column(1),
                        pa.array(np.diff(starts), pa.int64()),
                        pa.array(spans, _PA_SPANS),
                        pa.array([sorted(x, key=lambda s: s.encode()) for x in named], pa.list_(pa.string())),
                    ],
                    names=schema.names,
                )

        found = found.mapInArrow(search, schema)
    return found.select(F.col("id").alias(id_col), "n_words", "spans", "items")


def matches(
    docs: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    window: int = WINDOW,
    block: int = terms.BLOCK,
    shard: int = SHARD,
) -> DataFrame:
    """The longest verbatim matches: id, item, doc_start, item_start, length, in words.

    A match of ``window`` words or more (or of a whole shorter item) that neither end
    can be made longer. Items longer than ``PIECE`` windows may give a match in two
    parts. Odd rows are treated as in ``hits``; an item without id is listed as null.
    """
    short_batches(docs.sparkSession)
    spark = docs.sparkSession
    schema = T.StructType(
        [T.StructField("id", docs.schema[id_col].dataType), T.StructField("item", T.StringType())]
        + [T.StructField(name, T.LongType()) for name in ("doc_start", "item_start", "length")]
    )
    plain = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("binary").alias("raw"))
    found = None
    for suffixes in _test_blocks(items, item_col, text_col, window, block):
        sent = spark.sparkContext.broadcast(suffixes)

        def search(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            test = sent.value
            for part in terms.shards(batches, 1, shard):
                ids, starts = _read(part, 1, test.known)
                at, which = occurrences(ids, starts, test)
                n = (test.first[1:] - test.first[:-1])[which]
                place = np.repeat(test.first[which], n) + np.arange(int(n.sum())) - np.repeat(n.cumsum() - n, n)
                at, size = np.repeat(at, n), np.repeat(test.length[which], n)
                item, offset = test.item[place], test.offset[place]
                order = np.lexsort((at, at - offset, item))
                at, size, item, offset = at[order], size[order], item[order], offset[order]
                doc = np.searchsorted(starts, at, "right") - 1
                new = np.ones(len(at), bool)
                new[1:] = (np.diff(at) != 1) | (np.diff(offset) != 1) | (np.diff(item) != 0) | (np.diff(doc) != 0)
                top = np.flatnonzero(new)
                end = np.append(top[1:], len(at))[: len(top)] - 1
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0).take(pa.array(doc[top])),
                        pa.array([test.items[k] for k in item[top]], pa.string()),
                        pa.array(at[top] - starts[doc[top]]),
                        pa.array(offset[top]),
                        pa.array(at[end] + size[end] - at[top]),
                    ],
                    names=schema.names,
                )

        new = plain.mapInArrow(search, schema)
        found = new if found is None else found.unionByName(new)
    return found.withColumnsRenamed({"id": id_col, "item": item_col})


def without_hits(docs: DataFrame, items: DataFrame, text_col: str = "text", item_col: str = "item_id") -> DataFrame:
    """``docs`` without the documents that hold a test window; columns as they are."""
    short_batches(docs.sparkSession)
    spark = docs.sparkSession
    column = docs.columns.index(text_col)
    kept = docs
    for suffixes in _test_blocks(items, item_col, text_col, WINDOW, terms.BLOCK):
        sent = spark.sparkContext.broadcast(suffixes)

        def clean(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            test = sent.value
            for part in terms.shards(batches, column, SHARD):
                raw = [text.encode("utf-8", "surrogatepass") if text else None for text in part.column(column).to_pylist()]
                ids, starts = terms.numbered([terms.split(text) for text in raw], test.known)
                at, _ = occurrences(ids, starts, test)
                keep = np.ones(part.num_rows, bool)
                keep[np.searchsorted(starts, at, "right") - 1] = False
                yield part.filter(pa.array(keep))

        kept = kept.mapInArrow(clean, docs.schema)
    return kept
