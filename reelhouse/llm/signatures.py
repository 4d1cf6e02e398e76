"""Ranked lexical search over bit-sliced Bloom signatures.

**Index.** A document enters its Bloom filter with every term, and once more per
term for each step of ``STEPS`` its frequency reaches. Documents of one filter size
(four sizes up the number of entries, so a long text has a long filter) are laid
side by side: slice b of a group holds bit b of each of its documents. The index
knows no query and is about a tenth of the text.

**Bounds.** For a term the AND of its slices tells the documents that may hold it,
step by step how often at most; with the document's own length that bounds what
the term adds to its score, and the weighted sum of the slices bounds the score. A
Bloom filter never forgets an entry, so the bound is never too low.

**Exact scores.** The ``PROBES`` highest bounds of every item are scored on full
texts; the tenth best of those is a score that ten documents are known to reach.
Every document whose bound reaches it is then scored on its full text, the others
are proven to be behind. Nothing is capped: if bounds exclude nothing, all are
scored.

Queries go to the tasks in blocks of bounded size. Tasks keep their best ``PROBES``
per item before anything is shuffled. Documents to score are found by id and a
hash of the text, so repeated rows are scored each.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reelhouse.llm import shingles, terms
from reelhouse.llm.text import stored

#: Documents an item gets.
TOP = 10
#: Documents per item whose exact scores set the limit.
PROBES = 40
#: Frequencies a filter tells apart; beyond the last, a term fills the text at most.
STEPS = (1, 2, 3, 4, 6, 8, 12, 16, 24, 32, 64, 128, 256, 1024, 4096)
#: Bits of a filter per entry, rounded up to a power of two, and slices per entry.
BITS, HASHES = 10, 4
#: Most documents and most bits of one group of slices.
GROUP, GROUP_BITS = 512, 1 << 21
#: Bytes of text that are split into terms at once, and of query text in a block.
SHARD = 4 << 20
BLOCK = 1 << 20
#: Most cells, terms x documents, that bounds are worked out for at once.
_CELLS = 4 << 20

_MOST = np.array([0, *(after - 1 for after in STEPS[1:]), 1 << 40], np.int64)


def _entries(words: np.ndarray, step: int) -> np.ndarray:
    if step == 0:
        return words
    return shingles.mixed(words + np.uint64(step * 0x9E3779B97F4A7C15 % (1 << 64)))


def _slices(entries: np.ndarray, bits: int) -> np.ndarray:
    """The slices of each entry: entries x HASHES."""
    second = shingles.mixed(entries) | np.uint64(1)
    turns = np.arange(HASHES, dtype=np.uint64)
    return ((entries[:, None] + second[:, None] * turns) & np.uint64(bits - 1)).astype(np.int64)


def index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The signatures, one row per group of documents: bits, ids, keys, lengths, slices.

    ``lengths`` count terms with repeats. Texts without terms are left out, as no
    query finds them.
    """
    # a row of slices may hold 256 KB
    docs.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 64)
    kind = docs.schema[id_col].dataType
    schema = T.StructType(
        [
            T.StructField("bits", T.LongType()),
            T.StructField("ids", T.ArrayType(kind)),
            T.StructField("keys", T.ArrayType(T.LongType())),
            T.StructField("lengths", T.ArrayType(T.LongType())),
            T.StructField("slices", T.BinaryType()),
        ]
    )

    def group(bits: int, members: list[tuple]) -> tuple:
        width = -(-len(members) // 8)
        rows = np.zeros((bits, width), np.uint8)
        for at, (_, _, _, entries) in enumerate(members):
            rows[np.unique(_slices(entries, bits)), at >> 3] |= np.uint8(128 >> (at & 7))
        ids, keys, lengths, _ = zip(*members, strict=True)
        return bits, ids, keys, lengths, rows.tobytes()

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_: dict[int, list[tuple]] = {}
        id_type = pa.int64()
        held = 0

        def written(found: list[tuple]) -> pa.RecordBatch:
            types = (pa.int64(), pa.list_(id_type), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary())
            columns = zip(*found, strict=True)
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=schema.names
            )

        for part in terms.shards(batches, 2, SHARD):
            id_type = part.schema.field(0).type
            full = []
            for name, key, raw in zip(*(column.to_pylist() for column in part.columns), strict=True):
                words = terms.split(raw)
                if not words:
                    continue
                found, times = np.unique(shingles.word_hashes(words), return_counts=True)
                entries = np.concatenate([_entries(found[times >= least], k) for k, least in enumerate(STEPS)])
                bits = max(64, 1 << (BITS * len(entries) - 1).bit_length())
                members = open_.setdefault(bits, [])
                members.append((name, key, len(words), entries))
                held += len(entries)
                if len(members) >= max(8, min(GROUP, GROUP_BITS // bits)):
                    held -= sum(len(m[3]) for m in members)
                    full.append(group(bits, open_.pop(bits)))
            if held > 1 << 22:  # entries of unfinished groups: 32 MB
                full += [group(bits, members) for bits, members in open_.items()]
                open_, held = {}, 0
            if full:
                yield written(full)
        if open_:
            yield written([group(bits, members) for bits, members in open_.items()])

    plain = docs.select(
        F.col(id_col).alias("id"), F.xxhash64(text_col).alias("key"), F.col(text_col).cast("binary").alias("raw")
    )
    return plain.mapInArrow(build, schema)


@dataclass
class Queries:
    """A block of items: their terms, how often each asks for one, and the weights."""

    known: dict[bytes, int]  # from 1
    hashes: np.ndarray
    first: np.ndarray  # terms of item i: first[i] up to first[i + 1]
    term: np.ndarray  # from 0
    times: np.ndarray
    weight: np.ndarray
    n_docs: int
    n_terms: int

    @staticmethod
    def of(texts: list[bytes]) -> Queries:
        known: dict[bytes, int] = {}
        asked = [Counter(terms.split(text)) for text in texts]
        flat = [(known.setdefault(word, len(known) + 1) - 1, n) for item in asked for word, n in item.items()]
        pairs = np.array(flat, np.int64).reshape(-1, 2)
        first = np.cumsum([0, *map(len, asked)])
        hashes = shingles.word_hashes(list(known)) if known else np.zeros(0, np.uint64)
        return Queries(known, hashes, first, pairs[:, 0], pairs[:, 1], np.zeros(len(known), np.int64), 0, 0)

    def scale(self, lengths: np.ndarray) -> np.ndarray:
        return 25 + (75 * lengths * self.n_docs) // self.n_terms

    def sums(self, added: np.ndarray, items: np.ndarray | None = None) -> np.ndarray:
        """Of what each term adds (terms, or terms x documents), the sum for each item."""
        if items is None:
            first, place = self.first, slice(None)
        else:
            n = self.first[items + 1] - self.first[items]
            first = np.concatenate([[0], n.cumsum()])
            place = np.repeat(self.first[items] - first[:-1], n) + np.arange(int(first[-1]))
        out = np.zeros((len(first) - 1, *added.shape[1:]), np.int64)
        term, times = self.term[place], self.times[place]
        for i in range(len(out)):
            a, b = first[i], first[i + 1]
            out[i] = times[a:b] @ added[term[a:b]]
        return out


def _impact(times: np.ndarray, scale: np.ndarray) -> np.ndarray:
    return (1_000_000_000 * times) // (1000 * times + 8 * scale)


def _document_frequencies(docs: DataFrame, queries: Queries, text_col: str) -> np.ndarray:
    """Documents that hold each term of the block: partial counts by task, then a sum of
    one row per term, whose number the block bounds."""
    sent = docs.sparkSession.sparkContext.broadcast(queries.known)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = sent.value
        total = np.zeros(len(known) + 1, np.int64)
        for part in terms.shards(batches, 0, SHARD):
            words = [terms.split(raw) for raw in part.column(0).to_pylist()]
            ids, starts = terms.numbered(words, known)
            doc = np.repeat(np.arange(len(words)), np.diff(starts))
            pairs = np.unique(doc[ids > 0] * len(total) + ids[ids > 0])
            total += np.bincount(pairs % len(total), minlength=len(total))
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["term", "df"])

    found = docs.select(F.col(text_col).cast("binary")).mapInArrow(count, "term long, df long")
    out = np.zeros(len(queries.known) + 1, np.int64)
    for row in found.groupBy("term").agg(F.sum("df").alias("df")).collect():
        out[row["term"]] = row["df"]
    return out[1:]


def _upper(row: dict, queries: Queries) -> np.ndarray:
    """Bound of the score of every item for every document of a group: items x documents."""
    slices = np.frombuffer(row["slices"], np.uint8).reshape(row["bits"], -1)
    lengths = np.array(row["lengths"], np.int64)
    wide = max(1, _CELLS // len(queries.hashes) // 8)
    parts = [
        _upper_part(slices[:, at : at + wide], lengths[8 * at : 8 * (at + wide)], queries)
        for at in range(0, slices.shape[1], wide)
    ]
    return np.hstack(parts)


def _upper_part(slices: np.ndarray, lengths: np.ndarray, queries: Queries) -> np.ndarray:
    level = np.zeros((len(queries.hashes), len(lengths)), np.uint8)
    alive, so_far = np.arange(len(queries.hashes)), None
    for step in range(len(STEPS)):
        places = _slices(_entries(queries.hashes[alive], step), len(slices))
        there = slices[places[:, 0]]
        for k in range(1, HASHES):
            there = there & slices[places[:, k]]
        so_far = there if so_far is None else so_far & there
        some = so_far.any(axis=1)
        alive, so_far = alive[some], so_far[some]
        if not len(alive):
            break
        level[alive] += np.unpackbits(so_far, axis=1, count=len(lengths))
    impact = _impact(np.minimum(_MOST[:, None], lengths), queries.scale(lengths))
    added = np.take_along_axis(impact, level.astype(np.int64), axis=0) * queries.weight[:, None]
    return queries.sums(added)


def _bounded(signatures: DataFrame, queries: Queries, kind: T.DataType, least: np.ndarray | None) -> DataFrame:
    """(item, bound, id, key): the highest bounds of each item in a task, or, with
    ``least``, the documents whose bound reaches it as (id, key, items)."""
    sent = signatures.sparkSession.sparkContext.broadcast((queries, least))
    id_field = [T.StructField("id", kind), T.StructField("key", T.LongType())]
    if least is None:
        schema = T.StructType([T.StructField("item", T.LongType()), T.StructField("bound", T.LongType()), *id_field])
    else:
        schema = T.StructType([*id_field, T.StructField("items", T.ArrayType(T.LongType()))])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[dict, pa.Array]]:
        for batch in batches:
            for at in range(batch.num_rows):
                row = {name: batch.column(name)[at] for name in ("bits", "keys", "lengths", "slices")}
                yield {k: v.as_py() for k, v in row.items()}, batch.column("ids")[at].values

    def highest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked, _ = sent.value
        n = len(asked.first) - 1
        best = np.zeros((n, 0), np.int64)
        ids: list[pa.Array] = []
        keys: list[int] = []
        which = np.zeros((n, 0), np.int64)
        for row, names in rows(batches):
            upper = _upper(row, asked)
            best = np.hstack([best, upper])
            which = np.hstack([which, np.broadcast_to(np.arange(len(names)) + len(keys), upper.shape)])
            ids.append(names)
            keys += row["keys"]
            if best.shape[1] > PROBES:
                top = np.argpartition(-best, PROBES - 1, axis=1)[:, :PROBES]
                best, which = np.take_along_axis(best, top, 1), np.take_along_axis(which, top, 1)
            if len(keys) > 64 * GROUP:  # keep only the members that are still listed
                used, place = np.unique(which, return_inverse=True)
                ids = [pa.chunked_array(ids).combine_chunks().take(pa.array(used))]
                keys = [keys[k] for k in used]
                which = place.reshape(which.shape)
        if keys:
            item, column = np.nonzero(best > 0)
            member = which[item, column]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(item),
                    pa.array(best[item, column]),
                    pa.chunked_array(ids).combine_chunks().take(pa.array(member)),
                    pa.array([keys[k] for k in member], pa.int64()),
                ],
                names=schema.names,
            )

    def reaching(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked, limit = sent.value
        for row, names in rows(batches):
            reached = (_upper(row, asked) >= np.maximum(limit, 1)[:, None]).T
            member = np.flatnonzero(reached.any(axis=1))
            if len(member):
                yield pa.RecordBatch.from_arrays(
                    [
                        names.take(pa.array(member)),
                        pa.array([row["keys"][k] for k in member], pa.int64()),
                        pa.array([np.flatnonzero(reached[k]) for k in member], pa.list_(pa.int64())),
                    ],
                    names=schema.names,
                )

    return signatures.mapInArrow(highest if least is None else reaching, schema)


def _scored(docs: DataFrame, wanted: DataFrame, queries: Queries, id_col: str, text_col: str) -> DataFrame:
    """(item, id, score > 0) of the documents of ``wanted`` (id, key, items), on full texts."""
    sent = docs.sparkSession.sparkContext.broadcast(queries)
    kind = docs.schema[id_col].dataType
    schema = T.StructType(
        [T.StructField("item", T.LongType()), T.StructField("id", kind), T.StructField("score", T.LongType())]
    )

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked = sent.value
        for part in terms.shards(batches, 1, SHARD):
            words = [terms.split(raw) for raw in part.column(1).to_pylist()]
            ids, starts = terms.numbered(words, asked.known)
            scale = asked.scale(np.diff(starts))
            rows, items, scores = [], [], []
            for row, chosen in enumerate(part.column(2).to_pylist()):
                times = np.bincount(ids[starts[row] : starts[row + 1]], minlength=len(asked.known) + 1)[1:]
                chosen = np.array(chosen, np.int64)
                found = asked.sums(asked.weight * _impact(times, scale[row]), chosen)
                keep = found > 0
                rows.append(np.full(int(keep.sum()), row))
                items.append(chosen[keep])
                scores.append(found[keep])
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.concatenate(items)),
                    part.column(0).take(pa.array(np.concatenate(rows))),
                    pa.array(np.concatenate(scores)),
                ],
                names=schema.names,
            )

    source = docs.select(
        F.col(id_col).alias("_id"), F.xxhash64(text_col).alias("_key"), F.col(text_col).cast("binary").alias("raw")
    )
    same = source["_id"].eqNullSafe(wanted["id"]) & (source["_key"] == wanted["key"])
    texts = source.join(wanted, same).select("id", "raw", "items")
    return texts.mapInArrow(score, schema)


def _ranked(scores: DataFrame, by: str, top: int, ties: str = "id") -> DataFrame:
    order = Window.partitionBy("item").orderBy(F.col(by).desc(), F.col(ties).asc_nulls_last())
    return scores.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)


def _search_block(
    docs: DataFrame, signatures: DataFrame, queries: Queries, id_col: str, text_col: str, top: int
) -> DataFrame:
    """(item, rank, id, score) of the items of a block."""
    df = _document_frequencies(docs, queries, text_col)
    n = queries.n_docs
    queries.weight = np.array([math.floor(1000 * math.log((2 * n + 2) / (2 * d + 1))) for d in df.tolist()], np.int64)
    kind = docs.schema[id_col].dataType

    probes = _ranked(_bounded(signatures, queries, kind, None), "bound", PROBES, "key")
    chosen = probes.groupBy("id", "key").agg(F.collect_set("item").alias("items"))
    tried = _ranked(_scored(docs, stored(chosen, "search-probes"), queries, id_col, text_col), "score", top)
    least = np.zeros(len(queries.first) - 1, np.int64)
    # one row per item of the block
    for row in tried.groupBy("item").agg(F.count("score").alias("n"), F.min("score").alias("least")).collect():
        if row["n"] == top:
            least[row["item"]] = row["least"]
    # rows of equal id and text have equal bounds; one of them is enough to find all
    wanted = _bounded(signatures, queries, kind, least).dropDuplicates(["id", "key"])
    return _ranked(_scored(docs, stored(wanted, "search-candidates"), queries, id_col, text_col), "score", top)


def ranked(
    docs: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    top: int = TOP,
    block: int = BLOCK,
) -> DataFrame:
    """The ``top`` documents of every item: item, rank, id, score.

    Scores are above 0; equal ones are ranked by id, null last. Null and empty texts
    are never found and find nothing. Rows of ``docs`` that repeat an id, or are equal,
    are documents of their own; equal rows of ``items`` count once, rows that share an
    id but not the text are ranked each. Further columns of both tables play no part;
    with an empty table on either side the result is empty.
    """
    spark = docs.sparkSession
    signatures = stored(index(docs, id_col, text_col), "signatures")
    totals = signatures.select(
        F.sum(F.size("lengths")), F.sum(F.aggregate("lengths", F.lit(0).cast("long"), lambda a, x: a + x))
    ).first()
    plain = items.select(F.col(item_col).alias("name"), F.col(text_col).cast("binary").alias("raw")).distinct()
    named = T.StructType([T.StructField("item", T.LongType()), T.StructField(item_col, items.schema[item_col].dataType)])
    found = []
    for rows in terms.blocks(plain, "raw", block):
        queries = Queries.of([bytes(row["raw"] or b"") for row in rows])
        queries.n_docs, queries.n_terms = (int(total or 0) for total in totals)
        if len(queries.hashes) and queries.n_docs:
            best = _search_block(docs, signatures, queries, id_col, text_col, top)
            names = spark.createDataFrame([(k, row["name"]) for k, row in enumerate(rows)], named)
            found.append(best.join(names, "item").select(item_col, "rank", F.col("id").alias(id_col), "score"))
    if not found:
        empty = T.StructType([
            named[1], T.StructField("rank", T.IntegerType()),
            T.StructField(id_col, docs.schema[id_col].dataType), T.StructField("score", T.LongType()),
        ])
        return spark.createDataFrame([], empty)
    return reduce(DataFrame.unionByName, found)
