"""Nested bronze items to flat, typed silver rows.

Each flattener is a single projection over a declared schema, so only the
nested fields it names are read from Parquet. ``unparsed`` lists the columns
whose text was present but unreadable; the quality checks take it up and drop it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelhouse import settings
from reelhouse.functions import parse

UNPARSED = "unparsed"
_INGESTION = ("ingestion_date", "ingestion_timestamp", "source")


def _project(df: DataFrame, kept: dict[str, Column], typed: dict[str, tuple[Column, Column]],
             order: tuple[str, ...], keep_unparsed: bool) -> DataFrame:
    made = dict(kept)
    for name, (_, value) in typed.items():
        made[name] = value
    out = [made[name].alias(name) for name in order]
    out += [F.col(name) for name in _INGESTION]
    if keep_unparsed:
        failed = [
            F.when(parse.unreadable(text, value), F.lit(name))
            for name, (text, value) in typed.items()
        ]
        out.append(F.array_compact(F.array(*failed)).alias(UNPARSED))
    return df.select(*out)


def _count(field: str) -> tuple[Column, Column]:
    return F.col(field), parse.to_count(F.col(field))


def _time(field: str) -> tuple[Column, Column]:
    return F.col(field), parse.to_utc(F.col(field))


def video_stats(df: DataFrame, keep_unparsed: bool = False) -> DataFrame:
    return _project(
        df,
        kept={
            "video_id": F.col("id"),
            "title": F.col("snippet.title"),
            "channel_id": F.col("snippet.channelId"),
            "channel_title": F.col("snippet.channelTitle"),
            "category_id": F.col("snippet.categoryId"),
            "description": F.col("snippet.description"),
            "duration": F.col("contentDetails.duration"),
            "tag_count": F.coalesce(F.array_size("snippet.tags"), F.lit(0)),
            "thumbnail_url": F.col("snippet.thumbnails.high.url"),
        },
        typed={
            "published_at": _time("snippet.publishedAt"),
            "views": _count("statistics.viewCount"),
            "likes": _count("statistics.likeCount"),
            "comment_count": _count("statistics.commentCount"),
            "favorite_count": _count("statistics.favoriteCount"),
        },
        order=(
            "video_id", "title", "channel_id", "channel_title", "category_id",
            "published_at", "description", "duration", "tag_count", "views", "likes",
            "comment_count", "favorite_count", "thumbnail_url",
        ),
        keep_unparsed=keep_unparsed,
    )


def channel_stats(df: DataFrame, keep_unparsed: bool = False) -> DataFrame:
    return _project(
        df,
        kept={
            "channel_id": F.col("id"),
            "channel_name": F.col("snippet.title"),
            "description": F.col("snippet.description"),
            "country": F.col("snippet.country"),
        },
        typed={
            "published_at": _time("snippet.publishedAt"),
            "subscriber_count": _count("statistics.subscriberCount"),
            "total_views": _count("statistics.viewCount"),
            "video_count": _count("statistics.videoCount"),
        },
        order=(
            "channel_id", "channel_name", "description", "country", "published_at",
            "subscriber_count", "total_views", "video_count",
        ),
        keep_unparsed=keep_unparsed,
    )


def categories(df: DataFrame, keep_unparsed: bool = False) -> DataFrame:
    return _project(
        df,
        kept={
            "category_id": F.col("id"),
            "category_name": F.col("snippet.title"),
            "assignable": F.col("snippet.assignable"),
        },
        typed={},
        order=("category_id", "category_name", "assignable"),
        keep_unparsed=False,
    )


def search_videos(df: DataFrame, keep_unparsed: bool = False) -> DataFrame:
    """Search results, whose ``id`` is a struct and which may carry a keyword."""
    return _project(
        df,
        kept={
            "video_id": F.col("id.videoId"),
            "title": F.col("snippet.title"),
            "channel_id": F.col("snippet.channelId"),
            "channel_title": F.col("snippet.channelTitle"),
            "description": F.col("snippet.description"),
            "thumbnail_url": F.col("snippet.thumbnails.high.url"),
            "source_keyword": F.coalesce(
                F.col("_source_keyword"), F.lit(settings.UNKNOWN_KEYWORD)
            ),
        },
        typed={"published_at": _time("snippet.publishedAt")},
        order=(
            "video_id", "title", "channel_id", "channel_title", "published_at",
            "description", "thumbnail_url", "source_keyword",
        ),
        keep_unparsed=keep_unparsed,
    )
