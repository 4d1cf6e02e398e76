"""Lower-case runs of letters and digits, as bytes, and a query set in bounded blocks.

For tasks that read whole texts. Every byte from 0x80 on belongs to a term, so all
characters outside ASCII do; of ASCII only digits and letters, A-Z in lower case.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelhouse.llm.text import stored

#: Bytes of query text that are sent to the tasks at once.
BLOCK = 16 << 20
_BUCKETS = 4096


def _table() -> bytes:
    kept = bytearray(b" " * 256)
    for byte in [*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]:
        kept[byte] = byte
    for byte in range(0x41, 0x5B):
        kept[byte] = byte + 0x20
    return bytes(kept)


_KEPT = _table()


def split(raw: bytes | None) -> list[bytes]:
    """Terms of a UTF-8 text in order; null has none."""
    return raw.translate(_KEPT).split() if raw else []


def numbered(words: list[list[bytes]], known: dict[bytes, int]) -> tuple[np.ndarray, np.ndarray]:
    """Number of every word of all texts, 0 for those not in ``known``, and where each text starts."""
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    starts = np.concatenate([[0], sizes.cumsum()])
    flat = itertools.chain.from_iterable(words)
    return np.fromiter(map(known.get, flat, itertools.repeat(0)), np.int64, int(starts[-1])), starts


def shards(batches: Iterator[pa.RecordBatch], column: int, size: int) -> Iterator[pa.RecordBatch]:
    """The rows of a task again, in parts with about ``size`` bytes in ``column``; a longer
    text is a part with few others."""
    held: list[pa.RecordBatch] = []
    full = 0
    for batch in batches:
        ends = np.asarray(pc.fill_null(pc.binary_length(batch.column(column)), 0), np.int64).cumsum()
        at = 0
        while at < batch.num_rows:
            before = ends[at - 1] if at else 0
            upto = max(at + 1, int(np.searchsorted(ends, before + size - full, "right")))
            held.append(batch.slice(at, upto - at))
            full += int(ends[upto - 1] - before)
            at = upto
            if full >= size or at < batch.num_rows:
                yield _joined(held)
                held, full = [], 0
    if held:
        yield _joined(held)


def _joined(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
    return parts[0] if len(parts) == 1 else pa.Table.from_batches(parts).combine_chunks().to_batches()[0]


def blocks(rows: DataFrame, text: str, block: int = BLOCK) -> list[list]:
    """``rows`` in groups with about ``block`` bytes in the column ``text``, collected one
    group at a time as the caller goes through them.

    Rows are dealt to 4,096 buckets by hash; what is collected at once is so many
    buckets as hold ``block`` bytes together, or one. A row counts 128 bytes more than
    its text.
    """
    table = stored(
        rows.withColumn("_bucket", F.pmod(F.xxhash64(*rows.columns), F.lit(_BUCKETS)).cast("int")), "query-set"
    )
    sizes = table.groupBy("_bucket").agg(F.sum(F.coalesce(F.octet_length(text), F.lit(0)) + 128).alias("bytes")).orderBy("_bucket").collect()
    groups: list[list[int]] = []
    full = 0
    for bucket, size in sizes:
        if not groups or full + size > block:
            groups.append([])
            full = 0
        groups[-1].append(bucket)
        full += size
    for group in groups:
        yield table.where(F.col("_bucket").isin(group)).drop("_bucket").collect()
