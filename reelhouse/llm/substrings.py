"""Repeated passages: windows found by doubling their length.

A window of ``window`` words that two documents share begins as a shared window of
half the length, so halves are judged first and only repeated ones are extended:

* Half length. Halves are counted before anything else of a run is moved; only runs
  whose half two documents hold go on. Each full window stands for its half window of smallest hash. Equal
  full windows choose equal halves, so it is enough to judge the chosen ones, one
  position in about thirteen. Neighbouring full windows that chose the same half
  are one run.
* Double length, whole runs. Runs with a repeated half are compared by a hash of
  all their full windows: copies fall together, and every run of a document
  behind the first one is repeated as a whole.
* Double length, single windows. Of runs that differ, the first holder of each
  compares its windows one by one. No candidate is left after that.

Judging a length is an aggregation with map-side totals, then a join; a passage
that a third of all documents hold is pre-aggregated, and AQE splits its join.
Texts travel once, to the documents that have candidates.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reelhouse.llm import shingles
from reelhouse.llm.text import Scratch, short_batches, stored

WINDOW = 50
_SLICE = 500
_LAST = (1 << 63) - 1


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """Smallest of each ``width`` neighbours, by doubling the width covered."""
    done = 1
    while done < width:
        step = min(done, width - done)
        values = np.minimum(values[: len(values) - step], values[step:])
        done += step
    return values


def _both(words: list[bytes], window: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all half windows, and of the full windows they extend to."""
    half = shingles.windows(shingles.word_hashes(words), window // 2)
    return half, shingles.extended(half, window - window // 2)


def runs(words: list[bytes], window: int) -> tuple[np.ndarray, ...]:
    """Half-window hash, hash of the full windows, first window and length of each run."""
    half, full = _both(words, window)
    if not len(full):
        empty = np.zeros(0, np.int64)
        return empty, empty, empty, empty
    chosen = _least(half, window - window // 2 + 1)
    begin = np.flatnonzero(np.concatenate([[True], chosen[1:] != chosen[:-1]]))
    length = np.diff(begin, append=len(full))
    place = np.arange(len(full)) - np.repeat(begin, length)
    content = np.add.reduceat(full * (shingles.mixed(place.astype(np.uint64)) | np.uint64(1)), begin)
    return chosen[begin].view(np.int64), content.view(np.int64), begin, length


def _described(docs: DataFrame, id_col: str, text_col: str, window: int) -> DataFrame:
    """One row per row of ``docs``: id, text hash, n_words, hash of its words, its runs."""
    short_batches(docs.sparkSession)
    kind = docs.schema[id_col].dataType
    hashes, places = T.ArrayType(T.LongType()), T.ArrayType(T.IntegerType())
    schema = T.StructType(
        [T.StructField("id", kind), T.StructField("text_key", T.LongType()), T.StructField("n_words", T.LongType()),
         T.StructField("sha", T.BinaryType()), T.StructField("half", hashes), T.StructField("content", hashes),
         T.StructField("begin", places), T.StructField("length", places)]
    )

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, _SLICE):
                batch = whole.slice(at, _SLICE)
                counts, shas, found = [], [], ([], [], [], [])
                for text in batch.column(2).to_pylist():
                    words = shingles.split(text)
                    counts.append(len(words))
                    shas.append(hashlib.sha256(b" ".join(words)).digest())
                    for into, values in zip(found, runs(words, window), strict=True):
                        into.append(values)
                ends = np.cumsum([0, *map(len, found[0])]).astype(np.int32)
                lists = [
                    pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(values).astype(kind)))
                    for values, kind in zip(found, (np.int64, np.int64, np.int32, np.int32), strict=True)
                ]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), batch.column(1), pa.array(counts, pa.int64()), pa.array(shas), *lists],
                    names=schema.names,
                )

    text = F.col(text_col)
    plain = docs.select(F.col(id_col).alias("id"), F.xxhash64(text).alias("text_key"), text.alias("text"))
    found = plain.mapInArrow(describe, schema)
    return stored(found.withColumn("row", F.monotonically_increasing_id()), "passage-rows")


def _full_windows(candidates: DataFrame, window: int) -> DataFrame:
    """(row, doc, window hash) of the single windows to compare, each once per document."""

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, _SLICE):
                batch = whole.slice(at, _SLICE)
                rows, docs, texts, spans = (c.to_pylist() for c in batch.columns)
                parts = []
                for text, marked in zip(texts, spans, strict=True):
                    full = _both(shingles.split(text), window)[1]
                    part = [full[s["begin"] : s["begin"] + s["length"]] for s in marked if not s["whole"]]
                    parts.append(np.unique(np.concatenate(part)) if part else full[:0])
                sizes = [len(x) for x in parts]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.repeat(np.array(rows, np.int64), sizes)),
                        pa.array(np.repeat(np.array(docs, np.int64), sizes)),
                        pa.array(np.concatenate([x.view(np.int64) for x in parts])),
                    ],
                    names=["row", "doc", "hash"],
                )

    picked = candidates.where(F.exists("spans", lambda s: ~s["whole"])).select("row", "doc", "text", "spans")
    return picked.mapInArrow(hashed, "row long, doc long, hash long")


def _cut(candidates: DataFrame, window: int, texts: bool) -> DataFrame:
    """Number and spans of the removed words of every candidate row, and the sha of the
    kept words or, with ``texts``, the kept text."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, _SLICE):
                batch = whole.slice(at, _SLICE)
                rows, whole_texts, spans, hits = (c.to_pylist() for c in batch.columns)
                counts, kept, removed = [], [], []
                for text, marked, hit in zip(whole_texts, spans, hits, strict=True):
                    words = shingles.split(text)
                    full = _both(words, window)[1]
                    repeated = np.zeros(len(full), bool)
                    for s in marked:
                        part = slice(s["begin"], s["begin"] + s["length"])
                        if s["whole"]:
                            repeated[part] = True
                        elif hit:
                            repeated[part] = np.isin(full[part].view(np.int64), np.array(hit, np.int64))
                    edge = np.zeros(len(words) + 1, np.int64)
                    starts = np.flatnonzero(repeated)
                    np.add.at(edge, starts, 1)
                    np.add.at(edge, starts + window, -1)
                    gone = edge[:-1].cumsum() > 0
                    turns = np.flatnonzero(np.diff(gone.astype(np.int8), prepend=0, append=0))
                    removed.append([{"begin": int(b), "end": int(e)} for b, e in turns.reshape(-1, 2)])
                    counts.append(int(gone.sum()))
                    left = b" ".join([w for w, out in zip(words, gone.tolist(), strict=True) if not out])
                    kept.append(left if texts else hashlib.sha256(left).digest())
                span = pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(rows, pa.int64()), pa.array(counts, pa.int64()), pa.array(removed, span), pa.array(kept, pa.binary())],
                    names=["row", "n_removed", "removed", "kept"],
                )

    return candidates.select("row", "text", "spans", "hits").mapInArrow(
        cut, "row long, n_removed long, removed array<struct<begin: long, end: long>>, kept binary"
    )


def repeated(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    window: int = WINDOW,
    texts: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """All rows (row, id, text hash, n_words, sha of all words), and those with repeated words.

    The second has row, n_removed, removed spans of words and ``kept``, the sha of the
    kept words or, with ``texts``, the kept text; rows not in it keep everything. A window is repeated when a document of a smaller id holds
    it too. A null id is larger than any id; rows that share an id do not count against
    each other. Null texts have no words; shorter texts than a window lose nothing.
    """
    rows = _described(docs, id_col, text_col, window)
    keep = Scratch()
    doc = F.coalesce(F.col("id").cast("long"), F.lit(_LAST)).alias("doc")
    # halves alone first: the rest of a run follows where two documents hold its half
    halves = (
        rows.select(doc, F.explode("half").alias("half"))
        .groupBy("half").agg(F.min("doc").alias("lo"), F.max("doc").alias("hi")).where("lo < hi")
    )
    halves = keep.stored(halves.select("half"), "passage-halves")
    listed = F.explode(F.arrays_zip("half", "content", "begin", "length")).alias("run")
    held = rows.select("row", doc, listed).select("row", "doc", "run.*")
    held = keep.stored(held.join(halves, "half", "left_semi"), "passage-runs")
    whole = held.groupBy("half", "content").agg(F.min("doc").alias("first"), F.max("doc").alias("last"))
    kinds = whole.groupBy("half").agg(F.count("content").alias("kinds")).where("kinds > 1")
    differs = F.col("kinds").isNotNull()
    candidates = whole.join(kinds, "half", "left").where(differs | (F.col("first") < F.col("last"))).select(
        "half", "content", "first", differs.alias("differs")
    )
    behind = F.col("doc") > F.col("first")
    spans = (
        held.join(candidates, ["half", "content"]).where(behind | F.col("differs"))
        .groupBy("row").agg(F.collect_list(F.struct("begin", "length", behind.alias("whole"))).alias("spans"))
    )
    marked = rows.select("row", "id", doc, "text_key").join(spans, "row")
    text = F.col(text_col)
    source = docs.select(F.col(id_col).alias("_id"), F.xxhash64(text).alias("_key"), text.alias("text"))
    same = source["_id"].eqNullSafe(marked["id"]) & (source["_key"] == marked["text_key"])
    # rows that repeat id and text are found several times over, with the same content
    table = stored(source.join(marked, same).select("row", "doc", "text", "spans"), "passage-candidates")
    keep.drop()

    single = _full_windows(table, window)
    first = single.groupBy("hash").agg(F.min("doc").alias("first"), F.max("doc").alias("last")).where("first < last")
    hits = single.join(first, "hash").where("doc > first").groupBy("row").agg(F.collect_set("hash").alias("hits"))
    # texts whose runs are judged as wholes need no windows and do not travel again
    partly = F.exists("spans", lambda s: ~s["whole"])
    by_window = table.where(partly).join(hits, "row", "left")
    whole_only = table.where(~partly).withColumn("hits", F.array().cast("array<long>"))
    found = _cut(by_window.unionByName(whole_only), window, texts)
    return rows, found.dropDuplicates(["row"])


def removals(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """One row per row of ``docs``: id, n_words, n_removed, kept_sha256, removed spans."""
    rows, found = repeated(docs, id_col, text_col, window)
    kept = found.select("row", "n_removed", "removed", "kept")
    return rows.select("row", "id", "n_words", "sha").join(kept, "row", "left").select(
        F.col("id").alias(id_col),
        "n_words",
        F.coalesce("n_removed", F.lit(0).cast("long")).alias("n_removed"),
        F.lower(F.hex(F.coalesce("kept", "sha"))).alias("kept_sha256"),
        F.coalesce("removed", F.array().cast("array<struct<begin: long, end: long>>")).alias("removed"),
    )


def without_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """``docs`` without repeated words; same columns. Texts that lose none stay as they
    are, the kept words of the others are joined by one space."""
    rows, found = repeated(docs, id_col, text_col, window, texts=True)
    # rows that share id and text lose the same words
    cut = found.join(rows.select("row", "id", "text_key"), "row").select(
        F.col("id").alias("_id"), F.col("text_key").alias("_key"), F.col("kept").cast("string").alias("_kept")
    ).dropDuplicates(["_id", "_key"])
    marked = docs.withColumn("_own", F.xxhash64(F.col(text_col)))
    joined = marked.join(cut, marked[id_col].eqNullSafe(cut["_id"]) & (marked["_own"] == cut["_key"]), "left")
    text = F.coalesce("_kept", marked[text_col])
    return joined.select(*[text.alias(c) if c == text_col else marked[c] for c in docs.columns])
