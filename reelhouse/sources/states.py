"""Tables kept as parts that runs share.

Each run has a small folder ``snapshot=<run time>`` that lists, part by part, the
folders its rows lie in. A run writes the parts it changes to a folder of its own,
``rows=<run>``, and refers to all others where an earlier run left them, so what it
writes follows what has changed and not the size of the table. Parts are partition
folders: hash buckets of a key, or the open and the closed versions of a history.
"""

from __future__ import annotations

import json
from collections.abc import Collection
from dataclasses import dataclass, field
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reelhouse import schemas
from reelhouse.sources import snapshots, storage

MANIFEST = "_state.json"
BUCKET = "bucket"
PART = "_part"
#: Bytes of stored rows that make a part of a bucket, and the most parts a bucket has.
PART_BYTES, MOST_PARTS = 2 << 20, 64


def parts_for(size: int, buckets: int) -> int:
    """Parts of a bucket, of so many that hold ``size`` bytes."""
    return max(1, min(MOST_PARTS, size // max(1, buckets) // PART_BYTES))


@dataclass(frozen=True)
class State:
    """``parts``: folders of every part, below the table; ``notes``: what the writer added."""

    parts: dict[str, list[str]] = field(default_factory=dict)
    notes: dict = field(default_factory=dict)

    @property
    def buckets(self) -> int:
        return self.notes.get("buckets", 0)


def bucket_of(key: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def in_buckets(rows: DataFrame, key: str, buckets: int, parts: int) -> DataFrame:
    """Rows of a bucket together, of a large one in so many ``parts`` by its key; what
    needs the rows of one key (``PART`` and ``BUCKET`` among its keys) and the write by
    bucket then take them as they lie. A key's rows all go to one task. Twice as many
    partitions as parts leave few tasks with several, so that sorts stay in memory."""
    part = F.pmod(F.xxhash64(key, F.lit("part")), F.lit(parts)).cast("int")
    return rows.withColumn(PART, part).repartition(2 * buckets * parts, BUCKET, PART)


def bucket_name(bucket: int) -> str:
    return f"{BUCKET}={bucket}"


def load(spark: SparkSession, root: str, table: str, run_ts: datetime) -> State | None:
    """The state a run left, None if it keeps its rows in its own folder."""
    return at(spark, snapshots.folder(root, table, run_ts))


def at(spark: SparkSession, folder: str) -> State | None:
    text = storage.read_text(spark, storage.join(folder, MANIFEST))
    if text is None:
        return None
    found = json.loads(text)
    return State(found["parts"], found["notes"])


def scan(
    spark: SparkSession,
    root: str,
    table: str,
    state: State,
    schema: T.StructType,
    only: Collection[str] | None = None,
) -> DataFrame:
    """Rows of a state, of the parts in ``only`` where it is given."""
    path = storage.join(root, table)
    folders = [
        storage.join(path, folder)
        for part, places in state.parts.items()
        if only is None or part in only
        for folder in places
    ]
    if not folders:
        return spark.createDataFrame([], schema)
    found = spark.read.schema(schema).option("basePath", path).parquet(*folders)
    return found.select(schemas.columns(schema))
