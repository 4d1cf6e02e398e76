"""High-water marks: the last time seen of every source, and reads beyond it.

State is a table ``(source_type, source_key, last_ts)``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelhouse.settings import DEFAULT_MARK


def rows_since_marks(
    rows: DataFrame,
    marks: DataFrame,
    source_type: str,
    key: str,
    published: str,
    default_mark: str = DEFAULT_MARK,
) -> DataFrame:
    """Rows at or after the mark of their source; sources without one use the default.

    The mark itself is included: a second row may carry the same time, and the
    repeats this brings are removed by the later deduplication. Rows without a
    readable time are included too; the later checks decide about them.
    """
    mine = marks.where(F.col("source_type") == source_type).select(
        F.col("source_key").alias("_mark_key"), F.col("last_ts").alias("_mark")
    )
    joined = rows.join(mine, F.col(key).cast("string") == F.col("_mark_key"), "left")
    mark = F.coalesce(F.col("_mark"), F.lit(default_mark).cast("timestamp"))
    since = F.coalesce(F.col(published) >= mark, F.lit(True))
    return joined.where(since).drop("_mark_key", "_mark")


def marks_from(
    landed: DataFrame, source_type: str, key: str, at: str | Column
) -> DataFrame:
    """The marks a landing produces: the last time seen of each source that
    landed something. Sources that landed nothing get none and so keep theirs."""
    when = F.col(at) if isinstance(at, str) else at
    return (
        landed.where(F.col(key).isNotNull())
        .groupBy(F.col(key).cast("string").alias("source_key"))
        .agg(F.max(when).alias("last_ts"))
        .select(F.lit(source_type).alias("source_type"), "source_key", "last_ts")
    )


def advance(marks: DataFrame, *landed: DataFrame) -> DataFrame:
    """Old and new marks merged; a mark never moves back."""
    both = marks
    for new in landed:
        both = both.unionByName(new)
    return both.groupBy("source_type", "source_key").agg(F.max("last_ts").alias("last_ts"))
