"""Parquet tables of the layers.

Rows are brought together by partition value with Spark's REBALANCE before a
partitioned write: a small partition becomes one file instead of one per task,
and one that holds most of the data is split over many tasks.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame

from reelhouse.operators.columns import empty_like
from reelhouse.sinks import commits
from reelhouse.sources import storage

BY_DATE = ("ingestion_date",)


def existing_partitions(df: DataFrame, wanted: Sequence[str]) -> list[str]:
    return [name for name in wanted if name in df.columns]


def by_partition(df: DataFrame, partitions: Sequence[str]) -> DataFrame:
    """Rows of one partition value together, in tasks of an even size."""
    return df.hint("rebalance", *partitions) if partitions else df


def _write(
    df: DataFrame, path: str, mode: str, partitions: Sequence[str], **options: str
) -> str:
    columns = existing_partitions(df, partitions)
    writer = df.write.mode(mode).options(compression=storage.COMPRESSION, **options)
    if columns:
        writer = writer.partitionBy(*columns)
    writer.parquet(path)
    return path


def append(df: DataFrame, root: str, table: str, partitions: Sequence[str] = BY_DATE) -> str:
    """Add rows; nothing that is there changes. Running it twice adds them twice.

    A run's rows share one ingestion date, so the tasks that scanned them write
    them as they are; rows of many dates should go through ``by_partition`` first.
    The files are entered in the table's commit log, so that incremental readers
    take them up.
    """
    path = _write(df, storage.join(root, table), "append", partitions)
    commits.record(df.sparkSession, path, len(existing_partitions(df, partitions)))
    return path


def replace_partitions(
    df: DataFrame, root: str, table: str, partitions: Sequence[str] = BY_DATE, day: str | None = None
) -> str:
    """Replace the partitions ``df`` has rows for and leave all others: an append
    that may be repeated. Logged as ``append`` is; ``day`` is when rows of partitions
    that do not tell were ingested."""
    path = _write(
        df, storage.join(root, table), "overwrite", partitions, partitionOverwriteMode="dynamic"
    )
    commits.record(df.sparkSession, path, len(existing_partitions(df, partitions)), day=day)
    return path


#: Bytes of stored rows that one round of a write moves, and the most rounds of a write.
ROUND_BYTES, MOST_ROUNDS = 4 << 20, 4
#: Whether a folder is marked as complete when its write ends.
_MARKS = "mapreduce.fileoutputcommitter.marksuccessfuljobs"


def rounds_for(size: int) -> int:
    """Rounds in which so many stored bytes are shuffled: each round's shuffle is gone before
    the next, so no more than one lies on disk beside the tables."""
    return max(1, min(MOST_ROUNDS, size // ROUND_BYTES))


def marks(last: bool) -> dict[str, str]:
    """Options of one write of several into a folder, which is complete with the last."""
    return {} if last else {_MARKS: "false"}


def overwrite(
    df: DataFrame | Sequence[DataFrame],
    root: str,
    table: str,
    partitions: Sequence[str] = BY_DATE,
    together: bool = True,
) -> str:
    """Replace the whole table. ``df`` must not read from it. ``together`` brings the
    rows of a partition together first, which shuffles all of them. Several frames are
    written one after the other; the table is complete with the last."""
    path = storage.join(root, table)
    frames = [df] if isinstance(df, DataFrame) else list(df)
    for n, one in enumerate(frames, 1):
        rows = by_partition(one, existing_partitions(one, partitions)) if together else one
        _write(
            rows, path, "overwrite" if n == 1 else "append", partitions,
            partitionOverwriteMode="static", **marks(n == len(frames)),
        )
    return path


def overwrite_gold(
    df: DataFrame, root: str, table: str, partitions: Sequence[str] | None = None
) -> str:
    """``overwrite`` with the caller's partition columns, those the frame has."""
    return overwrite(df, root, table, BY_DATE if partitions is None else partitions)


def overwrite_dimension(df: DataFrame, root: str, table: str) -> str:
    return overwrite(df, root, table, ())


def overwrite_fact(df: DataFrame, root: str, table: str = "fact_video_performance") -> str:
    return overwrite(df, root, table, ("year", "month"))


def partition_folder(root: str, table: str, column: str, value: date) -> str:
    return storage.join(root, table, f"{column}={value}")


def replace_partition(
    df: DataFrame, root: str, table: str, value: date, column: str = "ingestion_date"
) -> str:
    """Make ``df`` the content of one partition, also when it has no rows, and log it."""
    path = _replace(df, root, table, value, column)
    commits.record(df.sparkSession, path, only=[f"{column}={value}"], replaced=True)
    return path


def _replace(df: DataFrame, root: str, table: str, value: date, column: str) -> str:
    _write(df.drop(column), partition_folder(root, table, column, value), "overwrite", ())
    return storage.join(root, table)


def quarantine(
    df: DataFrame,
    root: str,
    table: str,
    run_date: date,
    any_rows: bool = True,
    part: str | None = None,
) -> str | None:
    """Keep the rejected rows of one run; repeating the run replaces them.

    Runs of one day replace each other, unless each names its own ``part`` of the day.

    Nothing is written, and ``df`` is not evaluated, when the caller knows that
    there are none; rows an earlier attempt of the run left are removed then.
    """
    column = "quarantine_date"
    if part is not None:
        root, table = partition_folder(root, table, column, run_date), f"part={part}"
        if any_rows or storage.exists(df.sparkSession, storage.join(root, table)):
            kept = df if any_rows else empty_like(df)
            _write(kept, storage.join(root, table), "overwrite", ())
        return storage.join(root, table)
    if not any_rows:
        folder = partition_folder(root, table, column, run_date)
        if not storage.exists(df.sparkSession, folder):
            return None
        df = empty_like(df)
    return _replace(df, root, table, run_date, column)
