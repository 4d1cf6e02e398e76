"""Packing token sequences: cutting stock by column generation.

Documents become token ids and are cut into full sequences and one remainder.
Short lengths count as they are, longer ones are rounded up to units of ``length /
CLASSES``, so the corpus is a histogram of bounded size. On that histogram
the driver solves the cutting-stock linear program: a simplex basis of patterns
(how many pieces of each length share a sequence), with a knapsack dynamic
program pricing new patterns. Usage of each pattern is rounded down; what is left
is filled by first fit on the histogram. Pieces are ranked within their length
and the ranks are dealt to the patterns.

Ranks count within (length, salt): a length that a third of all pieces share is
ranked by many tasks, and the counts of the salts, a bounded table, turn local
ranks into global ones. Texts are tokenized once; only narrow rows are shuffled.
"""

from __future__ import annotations

import os
import re
import struct
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reelhouse.llm.text import short_batches, stored

LENGTH = 2048
END_ID = 1
#: Lengths are told apart in so many steps; bounds the linear program. Lengths of up to
#: ``EXACT`` steps are each a class of their own.
CLASSES = 256
EXACT = 4
SALTS = 256
#: Words whose ids a Python worker remembers.
REMEMBERED = 300_000
_SLICE = 500
_TOGETHER = 1 << 20
_BETWEEN = re.compile(r"[^ \t\n\r]+")
_APART = re.compile(r"[a-zªµºß-öø-ÿ]+|[^ \t\n\ra-zªµºß-öø-ÿ]+")
_BOUND = re.compile(r"[^ \t\n\r']*'[^ \t\n\r]*|[a-zªµºß-öø-ÿ]+|[^ \t\n\r'a-zªµºß-öø-ÿ]+")

_LETTERS = re.compile(r"[a-zªµºß-öø-ÿ]+")
#: New words that are encoded as one text.
_JOINED = 256

_tokenizers: dict[str, tuple] = {}


def _tokenizer(path: str | None):
    """The tokenizer and the ids of words met lately and before, once per Python worker."""
    if path not in _tokenizers:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        if path is None:
            import public_tokenizers

            file = public_tokenizers.path("word_bpe_49k.json")
        else:
            file = path
        model = Tokenizer.from_file(file)
        _tokenizers[path] = (model, {}, {}, _word_ends(model))
    return _tokenizers[path]


def _word_ends(model) -> np.ndarray | None:
    """Which ids end a word, where the tokenizer marks that."""
    suffix = getattr(model.model, "end_of_word_suffix", None)
    if not suffix:
        return None
    ends = np.zeros(model.get_vocab_size(), bool)
    vocab = model.get_vocab(with_added_tokens=False)
    ends[[number for token, number in vocab.items() if token.endswith(suffix)]] = True
    return ends


def _coded(model, ends: np.ndarray | None, words: list[str]) -> Iterator[tuple[str, bytes]]:
    """Each word with its ids. A call costs more than a word, so words of letters are
    encoded many in a text, whose ids are cut where a word ends."""
    apart = words
    if ends is not None:
        apart, plain = [], []
        for word in words:
            (plain if _LETTERS.fullmatch(word) else apart).append(word)
        groups = [plain[at : at + _JOINED] for at in range(0, len(plain), _JOINED)]
        texts = [" ".join(group) for group in groups]
        for group, coded in zip(groups, model.encode_batch_fast(texts, add_special_tokens=False), strict=True):
            ids = np.array(coded.ids, "<u4")
            cuts = [0, *(4 * np.flatnonzero(ends[ids]) + 4).tolist()]
            if len(cuts) != len(group) + 1:
                apart += group
                continue
            raw = ids.tobytes()
            yield from zip(group, (raw[a:b] for a, b in zip(cuts, cuts[1:], strict=False)), strict=True)
    for word, coded in zip(apart, model.encode_batch_fast(apart, add_special_tokens=False), strict=True):
        ids = coded.ids
        yield word, struct.pack(f"<{len(ids)}I", *ids)


def _stretches(text: str) -> list[str]:
    """Parts of a text that the tokenizer never joins: their ids follow each other.

    It lower-cases, and separates letters from signs, so texts in Latin letters give
    letters and signs apart, in lower case; other texts give stretches between spaces.
    An apostrophe binds its word; marks of special tokens keep their case.
    """
    if "<|" not in text:
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            pass
        else:
            return (_BOUND if "'" in text else _APART).findall(text.lower())
    return _BETWEEN.findall(text)


def encode(texts: list[str | None], tokenizer: str | None = None) -> list[bytes]:
    """Token ids of each text as little-endian 32-bit numbers.

    Each stretch is looked up, and encoded when it was not met before, once for texts
    of about ``_TOGETHER`` characters.
    """
    model, known, before, ends = _tokenizer(tokenizer)
    out: list[bytes] = []
    held: list[list[str]] = []
    full = 0

    def look_up() -> None:
        if len(known) > REMEMBERED:
            before.clear()
            before.update(known)
            known.clear()
        new = set().union(*held).difference(known)
        again = new.intersection(before)
        known.update((word, before[word]) for word in again)
        known.update(_coded(model, ends, list(new - again)))
        out.extend(b"".join(map(known.__getitem__, words)) for words in held)

    for text in texts:
        held.append(_stretches(text or ""))
        full += len(text or "")
        if full > _TOGETHER:
            look_up()
            held, full = [], 0
    look_up()
    return out


def pieces(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    length: int = LENGTH,
    end_id: int = END_ID,
    tokenizer: str | None = None,
) -> DataFrame:
    """Every document cut at multiples of ``length`` tokens.

    Columns: the id, start, length, ids (little-endian 32-bit), doc_tokens. A null
    text is empty and gives one piece that holds ``end_id`` alone. Repeated rows are
    cut each.
    """
    short_batches(docs.sparkSession)
    kind = docs.schema[id_col].dataType
    schema = T.StructType(
        [T.StructField("doc_id", kind), *(T.StructField(n, t) for n, t in (
            ("start", T.LongType()), ("length", T.LongType()), ("ids", T.BinaryType()), ("doc_tokens", T.LongType())
        ))]
    )
    end = np.array([end_id], "<u4").tobytes()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, _SLICE):
                batch = whole.slice(at, _SLICE)
                rows, starts, parts, totals = [], [], [], []
                for row, ids in enumerate(encode(batch.column(1).to_pylist(), tokenizer)):
                    ids += end
                    for start in range(0, len(ids), 4 * length):
                        rows.append(row)
                        starts.append(start // 4)
                        parts.append(ids[start : start + 4 * length])
                        totals.append(len(ids) // 4)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(pa.array(rows, pa.int64())),
                        pa.array(starts, pa.int64()),
                        pa.array([len(x) // 4 for x in parts], pa.int64()),
                        pa.array(parts, pa.binary()),
                        pa.array(totals, pa.int64()),
                    ],
                    names=schema.names,
                )

    cut_up = docs.select(F.col(id_col), F.col(text_col)).mapInArrow(cut, schema)
    return cut_up if id_col == "doc_id" else cut_up.withColumnRenamed("doc_id", id_col)


# -- the linear program on the histogram


def _best_pattern(value: np.ndarray, size: np.ndarray, room: int) -> tuple[float, np.ndarray]:
    """The pattern of most value that fits: unbounded knapsack by dynamic programming."""
    best = np.zeros(room + 1)
    took = np.full(room + 1, -1)
    order = np.argsort(size, kind="stable")
    value, size = value[order], size[order]
    fits = np.searchsorted(size, np.arange(room + 1), "right")
    for space in range(1, room + 1):
        best[space] = best[space - 1]
        if n := fits[space]:
            gain = best[space - size[:n]] + value[:n]
            top = int(gain.argmax())
            if gain[top] > best[space] + 1e-12:
                best[space], took[space] = gain[top], top
    pattern, space = np.zeros(len(size), np.int64), room
    while space > 0:
        if took[space] < 0:
            space -= 1
        else:
            pattern[order[took[space]]] += 1
            space -= size[took[space]]
    return float(best[room]), pattern


def _first_fit(size: np.ndarray, left: np.ndarray, room: int) -> list[tuple[np.ndarray, int]]:
    """Plan that fills each sequence with the longest pieces that still fit."""
    plan, left = [], left.copy()
    while left.any():
        pattern, space = np.zeros(len(size), np.int64), room
        for k in range(len(size) - 1, -1, -1):
            pattern[k] = min(left[k], space // size[k])
            space -= pattern[k] * size[k]
        used = pattern > 0
        times = int((left[used] // pattern[used]).min())
        plan.append((pattern, times))
        left -= times * pattern
    return plan


def _inverse(square: np.ndarray) -> np.ndarray:
    """By elimination on numpy rows: the threads of a LAPACK library can wait for each
    other for ever in a process that has started a Spark session."""
    m = len(square)
    both = np.hstack([square, np.eye(m)])
    for k in range(m):
        top = k + int(np.abs(both[k:, k]).argmax())
        if top != k:
            both[[k, top]] = both[[top, k]]
        both[k] /= both[k, k]
        others = both[:, k].copy()
        others[k] = 0.0
        both -= others[:, None] * both[k]
    return both[:, m:].copy()


def solve(
    size: np.ndarray, demand: np.ndarray, room: int, gap: float = 1e-3, calm: float = 0.8
) -> tuple[np.ndarray, np.ndarray]:
    """Patterns (columns) and how often each is used, fractional, at least cost.

    The basis starts with patterns of one length each; those of first fit enter
    next, then what the knapsack finds. It is asked at prices drawn towards those
    with the best bound so far (``calm``), which keeps them from swinging. Prices
    worth p sequences, whose best pattern is worth v, prove that no plan takes
    fewer than p / v; the search ends within ``gap`` of that.
    """
    m = len(size)
    basis = np.diag(room // size).astype(float)
    inverse = np.diag(1.0 / (room // size))
    usage = inverse @ demand
    pivots = 0

    def enter(pattern: np.ndarray) -> None:
        nonlocal inverse, usage, pivots
        way = inverse @ pattern
        ratio = np.full(m, np.inf)
        np.divide(usage, way, out=ratio, where=way > 1e-9)
        out = int(ratio.argmin())
        step = max(ratio[out], 0.0)
        usage = usage - step * way
        usage[out] = step
        basis[:, out] = pattern
        pivots += 1
        if pivots % 64:
            row = inverse[out] / way[out]
            inverse = inverse - np.outer(way, row)
            inverse[out] = row
        else:
            inverse = _inverse(basis)
            usage = np.maximum(inverse @ demand, 0)

    pool = [pattern for pattern, _ in _first_fit(size, demand.astype(np.int64), room)]
    for pattern in pool:
        if inverse.sum(axis=0) @ pattern > 1 + 1e-6:
            enter(pattern)
    best, centre = 0.0, inverse.sum(axis=0)
    weight = calm
    for _ in range(40 * m):
        price = inverse.sum(axis=0)
        asked = weight * centre + (1 - weight) * price
        value, pattern = _best_pattern(asked, size, room)
        bound = asked @ demand / max(value, 1e-12)
        if bound > best:
            best, centre = bound, asked / max(value, 1e-12)
        if usage.sum() <= best * (1 + gap):
            break
        if price @ pattern > 1 + 1e-7:
            enter(pattern)
            weight = calm
        elif weight:
            weight = 0.0 if weight < 0.1 else weight / 2
        else:
            break
    return basis.round().astype(np.int64), usage


def patterns_for(
    counts: np.ndarray, sizes: np.ndarray | None = None, room: int | None = None
) -> list[tuple[np.ndarray, int]]:
    """Whole-number plan for a histogram: ``counts[k]`` pieces of ``sizes[k]`` (or k).

    Gives (pieces of each length, number of sequences) pairs that use every piece.
    """
    sizes = np.arange(len(counts)) if sizes is None else sizes
    room = len(counts) - 1 if room is None else room
    there = np.flatnonzero(counts)
    if not len(there):
        return []
    size, demand = sizes[there], counts[there].astype(np.int64)
    basis, usage = solve(size, demand.astype(float), room)
    plan, left = [], demand.copy()
    for column in np.argsort(-usage, kind="stable"):
        pattern = basis[:, column]
        used = pattern > 0
        times = min(int(usage[column] + 1e-6), int((left[used] // pattern[used]).min()))
        if times > 0:
            plan.append((pattern, times))
            left -= times * pattern
    plan += _first_fit(size, left, room)
    wide = []
    for pattern, times in plan:
        row = np.zeros(len(counts), np.int64)
        row[there] = pattern
        wide.append((row, times))
    return wide


def _classes(length: int) -> tuple[int, int, np.ndarray]:
    """Unit, longest exact length, and the size each class of lengths counts as."""
    unit = -(-length // CLASSES)
    exact = min(length, EXACT * unit)
    above = -(-(length - exact) // unit)
    sizes = np.concatenate([np.arange(exact + 1), exact + unit * np.arange(1, above + 1)])
    return unit, exact, np.minimum(sizes, length)


def _deal(plan: list[tuple[np.ndarray, int]], classes: int) -> dict[str, np.ndarray]:
    """Which ranks of each length class go to which sequences, as sorted ranges."""
    taken, first = np.zeros(classes + 1, np.int64), 0
    ranges = []
    for pattern, times in plan:
        for k in np.flatnonzero(pattern):
            ranges.append((int(k), int(taken[k]), first, int(pattern[k])))
            taken[k] += times * pattern[k]
        first += times
    ranges.sort()
    columns = np.array(ranges, np.int64).reshape(-1, 4).T
    return {"key": (columns[0] << 44) + columns[1], "rank": columns[1], "first": columns[2], "each": columns[3]}


# -- on the cluster


def pack(
    cut: DataFrame,
    id_col: str = "doc_id",
    length: int = LENGTH,
    carry: dict[str, Column] | None = None,
) -> DataFrame:
    """Place of every piece: ``sequence_id`` and ``offset`` beside the piece's columns.

    ``cut`` is what ``pieces`` gives; of ids, ``carry`` names what the result holds
    (by default the ids themselves), so that it alone is stored and moved.
    """
    unit, exact, sizes = _classes(length)
    carry = {"ids": F.col("ids")} if carry is None else carry
    table = stored(
        cut.select(
            F.monotonically_increasing_id().alias("_piece"),
            id_col,
            "start",
            "length",
            *[column.alias(name) for name, column in carry.items()],
            "doc_tokens",
        ),
        "pieces",
    )
    slim = table.select(
        "_piece",
        "length",
        F.when(F.col("length") <= exact, F.col("length"))
        .otherwise(exact + F.ceil((F.col("length") - exact) / unit))
        .cast("int")
        .alias("_class"),
        F.pmod(F.xxhash64("_piece"), F.lit(SALTS)).cast("int").alias("_salt"),
    )
    # a row per class and salt at most
    found = slim.groupBy("_class", "_salt").count().toPandas()
    counts = np.zeros((len(sizes), SALTS), np.int64)
    counts[found["_class"].to_numpy(int), found["_salt"].to_numpy(int)] = found["count"]
    before = counts.cumsum(axis=1) - counts
    dealt = _deal(patterns_for(counts.sum(axis=1), sizes, length), len(counts) - 1)

    @F.pandas_udf("long")
    def sequence(kind: pd.Series, salt: pd.Series, local: pd.Series) -> pd.Series:
        kind, rank = kind.to_numpy(np.int64), before[kind, salt] + local.to_numpy(np.int64) - 1
        at = np.searchsorted(dealt["key"], (kind << 44) + rank, "right") - 1
        return pd.Series(dealt["first"][at] + (rank - dealt["rank"][at]) // dealt["each"][at])

    local = F.row_number().over(Window.partitionBy("_class", "_salt").orderBy("_piece"))
    placed = slim.withColumn("_local", local).withColumn("sequence_id", sequence("_class", "_salt", "_local"))
    filled = Window.partitionBy("sequence_id").orderBy("_class", "_piece")
    offset = F.sum("length").over(filled.rowsBetween(Window.unboundedPreceding, 0)) - F.col("length")
    places = placed.select("_piece", "sequence_id", offset.alias("offset"))
    return table.join(places, "_piece").drop("_piece")


def sequences(packed: DataFrame) -> DataFrame:
    """The packed sequences: sequence_id and the ids of its pieces in order."""
    parts = F.transform(F.sort_array(F.collect_list(F.struct("offset", "ids"))), lambda x: x["ids"])
    joined = F.aggregate(parts, F.lit(b""), lambda whole, part: F.concat(whole, part))
    return packed.groupBy("sequence_id").agg(joined.alias("ids"))
