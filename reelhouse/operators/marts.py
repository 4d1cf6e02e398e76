"""Gold marts: one row per video, per channel and per category."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelhouse import schemas
from reelhouse.functions import metrics
from reelhouse.operators import columns, dedup


def combine_videos(
    stats: DataFrame,
    trending: DataFrame | None,
    dealt: Callable[[DataFrame], DataFrame] | None = None,
    by: Sequence[str] = (),
) -> DataFrame:
    """Statistics and trending rows, each unique per video, as one such set.

    The later ingestion wins; on a tie the statistics row does. ``dealt`` may bring the
    rows of both together by the columns ``by`` it adds, which depend on the video alone.
    """
    if trending is None:
        return stats
    rank = "_source_rank"
    both = columns.union_common(
        [stats.withColumn(rank, F.lit(0)), trending.withColumn(rank, F.lit(1))]
    )
    both = dealt(both) if dealt else both
    return dedup.keep_latest(both, [*by, "video_id"], ties=[F.col(rank)]).drop(rank)


def category_names(categories: DataFrame) -> DataFrame:
    """Id and name only, one row per id, so that joining it cannot add rows."""
    latest = dedup.keep_latest(categories, "category_id")
    return latest.select("category_id", "category_name")


def with_category(videos: DataFrame, categories: DataFrame | None) -> DataFrame:
    """Left join of the names: videos of an unknown category stay, without a name."""
    if categories is None:
        return videos
    return videos.join(category_names(categories), "category_id", "left")


def with_metrics(videos: DataFrame, as_of: date | None = None) -> DataFrame:
    return (
        videos.withColumns(
            {
                "engagement_rate": metrics.engagement_rate(),
                "like_ratio": metrics.like_ratio(),
                "days_since_published": metrics.days_since(as_of=as_of),
            }
        ).withColumn("view_velocity", metrics.view_velocity())
    )


def with_year_month(videos: DataFrame, column: str = "published_at") -> DataFrame:
    return videos.withColumns({"year": F.year(column), "month": F.month(column)})


def video_engagement(
    stats: DataFrame,
    trending: DataFrame | None = None,
    categories: DataFrame | None = None,
    as_of: date | None = None,
) -> DataFrame:
    """The video mart: combined sources, metrics, category name, year and month."""
    return engagement_of(combine_videos(stats, trending), categories, as_of)


def engagement_of(
    videos: DataFrame, categories: DataFrame | None, as_of: date | None = None, also: Sequence[str] = ()
) -> DataFrame:
    """The video mart of combined sources, with columns of theirs that it does not have."""
    videos = with_year_month(with_category(with_metrics(videos, as_of), categories))
    return columns.select_existing(
        videos, [*schemas.columns(schemas.GOLD["gold_video_engagement"]), *also]
    )


#: Columns of the video mart that depend on the day it is looked at.
DAILY = ("days_since_published", "view_velocity")


def measured(mart: DataFrame, as_of: date | None) -> DataFrame:
    """The stored video mart with the columns that depend on a day."""
    dated = mart.withColumn("days_since_published", metrics.days_since(as_of=as_of))
    dated = dated.withColumn("view_velocity", metrics.view_velocity())
    return dated.select(schemas.columns(schemas.GOLD["gold_video_engagement"]))


def _video_totals() -> list:
    return [
        F.count("video_id").alias("total_videos"),
        F.sum("views").alias("total_views"),
        F.sum("likes").alias("total_likes"),
        F.sum("comment_count").alias("total_comments"),
        F.count("views").alias("seen_videos"),
        F.max("views").alias("max_views"),
        F.min("views").alias("min_views"),
        F.sum("engagement_rate").alias("engagement_sum"),
        F.count("engagement_rate").alias("engagement_rows"),
    ]


_SUMS = (
    "total_videos", "total_views", "total_likes", "total_comments",
    "seen_videos", "engagement_sum", "engagement_rows",
)


def _joined_totals() -> list:
    """Totals of totals."""
    return [
        *[F.sum(name).alias(name) for name in _SUMS],
        F.max("max_views").alias("max_views"),
        F.min("min_views").alias("min_views"),
    ]


def channel_totals(stats: DataFrame, *also: str) -> DataFrame:
    """Totals per channel and title, and per value of further columns: a part of what
    ``channel_performance`` needs, which parts of ``stats`` can have each.

    Titles are text and cannot sit in a hash aggregate's buffer, so they are keys here,
    and picking one is left to a second step over about one row per channel.
    """
    seen = stats.withColumns(
        {
            "engagement_rate": metrics.engagement_rate(),
            "seen_at": F.unix_timestamp(F.try_to_timestamp(F.col("ingestion_timestamp"))),
        }
    )
    return seen.groupBy(*also, "channel_id", "channel_title").agg(
        *_video_totals(), F.max("seen_at").alias("seen_at")
    )


def channels_of(totals: DataFrame, run_date: date) -> DataFrame:
    """The channel mart of ``channel_totals``: each under its most recently seen title."""
    return totals.groupBy("channel_id").agg(
        F.max_by("channel_title", F.struct("seen_at", "channel_title")).alias("channel_title"),
        *_joined_totals(),
    ).select(
        "channel_id",
        "channel_title",
        "total_videos",
        "total_views",
        "total_likes",
        "total_comments",
        metrics.steady_round(F.try_divide("total_views", "seen_videos"), 0).alias("avg_views"),
        "max_views",
        "min_views",
        metrics.steady_round(F.try_divide("engagement_sum", "engagement_rows"), 4).alias(
            "avg_engagement_rate"
        ),
        F.lit(run_date).alias("ingestion_date"),
    )


def channel_performance(stats: DataFrame, run_date: date) -> DataFrame:
    """Totals per channel under its most recently seen title."""
    return channels_of(channel_totals(stats), run_date)


def category_totals(stats: DataFrame, *also: str) -> DataFrame:
    """Totals per category id, and per value of further columns, without names.

    A category may hold any share of the videos, and this way only one row per
    category meets the join with its name.
    """
    rated = stats.withColumn("engagement_rate", metrics.engagement_rate())
    return rated.groupBy(*also, "category_id").agg(*_video_totals())


def categories_of(totals: DataFrame, categories: DataFrame, run_date: date) -> DataFrame:
    """The category mart of ``category_totals``."""
    whole = totals.groupBy("category_id").agg(*_joined_totals())
    return with_category(whole, categories).select(
        "category_id",
        "category_name",
        "total_videos",
        "total_views",
        "total_likes",
        metrics.steady_round(F.try_divide("total_views", "seen_videos"), 0).alias("avg_views"),
        "max_views",
        metrics.steady_round(F.try_divide("engagement_sum", "engagement_rows"), 4).alias(
            "avg_engagement_rate"
        ),
        F.lit(run_date).alias("ingestion_date"),
    )


def category_performance(stats: DataFrame, categories: DataFrame, run_date: date) -> DataFrame:
    """Totals per category; videos of unknown categories keep a group without a name."""
    return categories_of(category_totals(stats), categories, run_date)
