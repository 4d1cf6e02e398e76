"""Writing snapshots; ``reelhouse.sources.snapshots`` says what they are."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession

from reelhouse.sinks import tables
from reelhouse.sources import snapshots, storage

KEEP = 3


def write(
    df: DataFrame | Sequence[DataFrame],
    root: str,
    table: str,
    run_ts: datetime,
    partitions: Sequence[str] = (),
    together: bool = True,
) -> str:
    """Write the snapshot of a run, replacing that of its earlier attempt.

    ``df`` may read snapshots of earlier runs, not of this one. One run at a time
    may write a table. Several frames, and ``together=False`` for rows that lie together
    already, as for ``tables.overwrite``.
    """
    return tables.overwrite(
        df, storage.join(root, table), snapshots.name(run_ts), partitions, together
    )


def prune(
    spark: SparkSession, root: str, table: str, run_ts: datetime, keep: int = KEEP
) -> list[str]:
    """Delete the snapshots older than those of the newest ``keep`` days.

    Never that of the run itself, nor newer ones: a backfill writes an old day.

    Days that have a complete snapshot are counted, not snapshots: a run starts
    from the state of an earlier day, which has to survive however often it is
    repeated. The kept ones also serve readers that opened one before the run.
    """
    if keep < 2:
        raise ValueError("keep at least the day of the run and the one before it")
    days, removed = set(), []
    for taken in snapshots.run_times(spark, root, table):
        path = snapshots.folder(root, table, taken)
        if len(days) >= keep and taken.date() not in days and taken < run_ts:
            storage.delete(spark, path)
            removed.append(path)
        elif storage.is_complete(spark, path):
            days.add(taken.date())
    return removed
