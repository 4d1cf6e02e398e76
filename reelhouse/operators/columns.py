"""Projections that depend on which columns a frame has."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def select_existing(df: DataFrame, wanted: Iterable[str]) -> DataFrame:
    """The wanted columns the frame has, in the wanted order."""
    return df.select([name for name in wanted if name in df.columns])


def union_common(frames: list[DataFrame]) -> DataFrame:
    """Union by name on the columns all frames have, in the order of the first."""
    shared = frames[0].columns
    for frame in frames[1:]:
        shared = [name for name in shared if name in frame.columns]
    out = frames[0].select(shared)
    for frame in frames[1:]:
        out = out.unionByName(frame.select(shared))
    return out


def empty_like(df: DataFrame, **extra: str) -> DataFrame:
    """No rows, the columns of ``df`` and any ``extra`` ones given as name=type."""
    added = {name: F.lit(None).cast(kind) for name, kind in extra.items()}
    return df.withColumns(added).where(F.lit(False)) if added else df.where(F.lit(False))


def conform_channels(df: DataFrame) -> DataFrame:
    """Give a channel mart the columns channel history is kept for.

    Used when there is no channel statistics table: subscribers are unknown and
    counted as 0, and the mart's number of videos stands in for the video count.
    """
    if "channel_title" in df.columns and "channel_name" not in df.columns:
        df = df.withColumnRenamed("channel_title", "channel_name")
    zero = F.lit(0).cast("bigint")
    fill = {
        "country": F.lit(None).cast("string"),
        "subscriber_count": zero,
        "total_views": zero,
        "video_count": F.col("total_videos") if "total_videos" in df.columns else zero,
    }
    return df.withColumns({k: v for k, v in fill.items() if k not in df.columns})
