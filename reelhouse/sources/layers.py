"""Layer tables by folder, with declared schemas."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from reelhouse import schemas, settings
from reelhouse.operators import marts
from reelhouse.sources import snapshots, states, storage

_MEASURED = "gold_video_engagement"
_KIND = {spec.table: spec.kind for spec in settings.SOURCES}


def schema_of(table: str) -> T.StructType:
    for layer in (schemas.SILVER, schemas.GOLD, schemas.WAREHOUSE):
        if table in layer:
            return layer[table]
    return schemas.bronze(_KIND[table])


def stream_table(table: str) -> str:
    """Where the stream keeps its rows of a bronze table."""
    return f"{table}_stream"


def is_snapshotted(table: str) -> bool:
    return any(table in layer for layer in (schemas.SILVER, schemas.GOLD, schemas.WAREHOUSE))


def location(spark: SparkSession, root: str, table: str) -> str | None:
    """The folder of the table's current state: its newest complete snapshot, which may
    list shared parts (``states``), or the table's own folder when it has never been
    kept as snapshots."""
    if is_snapshotted(table) and snapshots.run_times(spark, root, table):
        run_ts = snapshots.newest(spark, root, table)
        return None if run_ts is None else snapshots.folder(root, table, run_ts)
    path = storage.join(root, table)
    return path if storage.exists(spark, path) else None


def read_table(
    spark: SparkSession, root: str, table: str, schema: T.StructType | None = None
) -> DataFrame | None:
    """All partitions of a table, of its newest state when it is kept as snapshots;
    None when it does not exist.

    Lazy: filters on partition columns the caller adds prune folders, and only
    the columns used later are read.
    """
    declared = schema or schema_of(table)
    path = location(spark, root, table)
    if path is None:
        return None
    state = states.at(spark, path) if is_snapshotted(table) else None
    if state is not None and table == _MEASURED:
        # its state holds what does not depend on the day, and the day of its run
        stored = T.StructType([f for f in declared.fields if f.name not in marts.DAILY])
        rows = states.scan(spark, root, table, state, stored)
        return marts.measured(rows, date.fromisoformat(state.notes["as_of"]))
    if state is not None:
        return states.scan(spark, root, table, state, declared)
    return spark.read.schema(declared).parquet(path).select(schemas.columns(declared))


def read_or_empty(spark: SparkSession, root: str, table: str) -> DataFrame:
    found = read_table(spark, root, table)
    return found if found is not None else spark.createDataFrame([], schema_of(table))
