"""Tables kept as one folder per run, ``snapshot=<run time>``.

A table that is computed from its own earlier content cannot be overwritten
while a lazy plan still reads it. Each run writes its own folder instead, from
the newest one of an earlier run. A failed run leaves the earlier state in
place, and a repeated run starts from where its first attempt started.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from reelhouse import schemas
from reelhouse.sources import storage

_PREFIX = "snapshot="
_FORMAT = "%Y%m%dT%H%M%S"


def name(run_ts: datetime) -> str:
    return f"{_PREFIX}{run_ts:{_FORMAT}}"


def run_times(spark: SparkSession, root: str, table: str) -> list[datetime]:
    """Of all snapshots, complete or not, newest first."""
    found = storage.child_folders(spark, storage.join(root, table))
    keys = [n.removeprefix(_PREFIX) for n in found if n.startswith(_PREFIX)]
    return sorted((datetime.strptime(key, _FORMAT) for key in keys), reverse=True)


def newest(
    spark: SparkSession, root: str, table: str, before: datetime | None = None
) -> datetime | None:
    """Run time of the newest complete snapshot, of a run earlier than ``before``."""
    for run_ts in run_times(spark, root, table):
        if (before is None or run_ts < before) and storage.is_complete(
            spark, folder(root, table, run_ts)
        ):
            return run_ts
    return None


def folder(root: str, table: str, run_ts: datetime) -> str:
    return storage.join(root, table, name(run_ts))


def read(
    spark: SparkSession,
    root: str,
    table: str,
    schema: T.StructType,
    before: datetime | None = None,
) -> DataFrame | None:
    run_ts = newest(spark, root, table, before)
    if run_ts is None:
        return None
    path = folder(root, table, run_ts)
    return spark.read.schema(schema).parquet(path).select(schemas.columns(schema))
