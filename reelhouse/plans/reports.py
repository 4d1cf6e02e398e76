"""Analytic reports over the star schema.

Two shapes keep them cheap on a large fact:

* Group reports total the fact by the foreign key first and join the dimension
  to those totals, so a key that holds a third of the fact is reduced in the
  scanning tasks and the join sees one row per key.
* Top lists find their rows with narrow columns and fetch the descriptive ones
  only for the few that remain. ``dim_video`` is as long as the fact, so its
  titles would otherwise all be shuffled to keep twenty.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reelhouse.functions.labels import day_type, tag_bucket
from reelhouse.functions.metrics import steady_round
from reelhouse.sources import layers


@dataclass(frozen=True)
class Star:
    """The warehouse tables a report reads.

    ``unique_videos`` says that fact and ``dim_video`` come from one state of the
    video mart, as the warehouse job writes them: each video is once in both, with
    the same tags. Distinct videos are then counted as rows in the scanning tasks,
    top lists need no look whether a video is known, and tags are read from the
    fact; otherwise the ids of the whole fact are shuffled for each of these.
    """

    fact: DataFrame
    dim_video: DataFrame
    dim_category: DataFrame
    dim_date: DataFrame
    dim_channel: DataFrame | None = None
    unique_videos: bool = False

    def video_count(self) -> Column:
        count = F.count if self.unique_videos else F.count_distinct
        return count("video_id").alias("total_videos")

    @classmethod
    def from_warehouse(cls, spark: SparkSession, root: str) -> Star:
        """The tables the warehouse job wrote under ``root``."""
        names = ("dim_video", "dim_category", "dim_date", "dim_channel")
        return cls(
            fact=layers.read_or_empty(spark, root, "fact_video_performance"),
            **{name: layers.read_or_empty(spark, root, name) for name in names},
            unique_videos=True,
        )

    @classmethod
    def from_views(cls, spark: SparkSession) -> Star:
        """The tables as registered by ``catalog.register_views``."""
        channel = "dim_channel"
        return cls(
            fact=spark.table("fact_video_performance"),
            dim_video=spark.table("dim_video"),
            dim_category=spark.table("dim_category"),
            dim_date=spark.table("dim_date"),
            dim_channel=spark.table(channel) if spark.catalog.tableExists(channel) else None,
        )


#: Top lists up to this length are broadcast to fetch their titles.
MOST_BROADCAST = 10_000

# --- top lists ---------------------------------------------------------------


def _top_videos(star: Star, keep: Column, by: str, rows: int) -> DataFrame:
    """The best fact rows with their category name and video description.

    Facts whose category or video is not in the dimensions drop out before the
    limit is taken. Ties in the ranking go to the lower ``video_id``.
    """
    ranking = [F.col(by).desc(), F.col("video_id")]
    named = star.fact.where(keep).join(
        star.dim_category.select("category_id", "category_name"), "category_id"
    )
    if star.unique_videos:
        known = named
    else:
        known = named.join(star.dim_video.select("video_id"), "video_id", "left_semi")
    best = known.orderBy(*ranking).limit(rows)
    # At most as many rows as the result itself.
    few = F.broadcast(best) if rows <= MOST_BROADCAST else best
    described = few.join(
        star.dim_video.select("video_id", "title", "channel_title", "published_at"), "video_id"
    )
    # With a limit the sort is a merge of small heaps; without one Spark would
    # scan ``dim_video`` once more to sample sort ranges.
    return described.orderBy(*ranking).limit(rows)


def _rounded(name: str, digits: int, alias: str | None = None) -> Column:
    return F.round(name, digits).alias(alias or name)


def _published() -> Column:
    return F.col("published_at").cast("string").alias("published_at")


def top_trending_videos(star: Star, rows: int = 20) -> DataFrame:
    best = _top_videos(star, F.col("views").isNotNull(), "views", rows)
    return best.select(
        "title", "channel_title", "category_name", "views", "likes", "comment_count",
        _rounded("engagement_rate", 4), _rounded("view_velocity", 2, "views_per_day"),
        _published(),
    )


def most_engaging_videos(star: Star, min_views: int = 10000, rows: int = 20) -> DataFrame:
    best = _top_videos(star, F.col("views") > min_views, "engagement_rate", rows)
    return best.select(
        "title", "channel_title", "category_name", "views", "likes", "comment_count",
        _rounded("engagement_rate", 4), _rounded("like_ratio", 4, "like_ratio_pct"),
    )


def fastest_growing_videos(star: Star, rows: int = 20) -> DataFrame:
    best = _top_videos(star, F.col("view_velocity").isNotNull(), "view_velocity", rows)
    return best.select(
        "title", "channel_title", "category_name", "views",
        _rounded("view_velocity", 2, "views_per_day"), _published(),
        _rounded("engagement_rate", 4),
    )


# --- group reports -----------------------------------------------------------

_MEASURES = ("views", "likes", "engagement_rate")


def _partial_totals(fact: DataFrame, *keys: str) -> DataFrame:
    """Sums and counts per key that can be added up further."""
    measures = [F.count("video_id").alias("videos"), F.max("views").alias("views_max")]
    for name in _MEASURES:
        measures += [F.sum(name).alias(f"{name}_sum"), F.count(name).alias(f"{name}_rows")]
    return fact.groupBy(*keys).agg(*measures)


def _total(name: str) -> Column:
    return F.sum(f"{name}_sum")


def _average(name: str, digits: int) -> Column:
    mean = F.try_divide(F.sum(f"{name}_sum"), F.sum(f"{name}_rows"))
    return steady_round(mean, digits)


def _by_category(star: Star) -> tuple[DataFrame, Column]:
    totals = _partial_totals(star.fact.where(F.col("views").isNotNull()), "category_id")
    names = star.dim_category.select("category_id", "category_name")
    return totals.join(names, "category_id"), F.sum("videos").alias("total_videos")


def top_performing_categories(star: Star) -> DataFrame:
    named, videos = _by_category(star)
    return (
        named.groupBy("category_name")
        .agg(
            videos,
            _total("views").alias("total_views"),
            _total("likes").alias("total_likes"),
            _average("views", 0).alias("avg_views_per_video"),
            _average("engagement_rate", 4).alias("avg_engagement_rate"),
            F.max("views_max").alias("max_views"),
        )
        .orderBy(F.desc("total_views"), "category_name")
    )


def category_top(star: Star, rows: int = 10) -> DataFrame:
    named, videos = _by_category(star)
    return (
        named.groupBy("category_name")
        .agg(
            videos,
            _total("views").alias("total_views"),
            _average("engagement_rate", 4).alias("avg_engagement"),
        )
        .orderBy(F.desc("total_views"), "category_name")
        .limit(rows)
    )


def channel_performance(star: Star) -> DataFrame:
    return (
        star.fact.groupBy("channel_id")
        .agg(
            star.video_count(),
            F.sum("views").alias("total_views"),
            F.sum("likes").alias("total_likes"),
            steady_round(F.avg("views"), 0).alias("avg_views"),
            steady_round(F.avg("engagement_rate"), 4).alias("avg_engagement"),
            F.max("views").alias("best_video_views"),
        )
        .orderBy(F.desc("total_views"), "channel_id")
    )


def _by_date(star: Star, *columns: str) -> DataFrame:
    return _partial_totals(star.fact, "date_id").join(
        star.dim_date.select("date_id", *columns), "date_id"
    )


def monthly_trend_analysis(star: Star) -> DataFrame:
    calendar = ("year", "month", "month_name", "quarter")
    return (
        _by_date(star, *calendar)
        .groupBy(*calendar)
        .agg(
            F.sum("videos").alias("videos_published"),
            _total("views").alias("total_views"),
            _total("likes").alias("total_likes"),
            _average("engagement_rate", 4).alias("avg_engagement"),
        )
        .orderBy(F.desc("year"), F.desc("month"))
    )


def monthly_series(star: Star) -> DataFrame:
    """The monthly trend in calendar order, as it is charted."""
    calendar = ("year", "month", "month_name")
    return (
        _by_date(star, *calendar)
        .groupBy(*calendar)
        .agg(
            F.sum("videos").alias("video_count"),
            _total("views").alias("total_views"),
            _average("engagement_rate", 4).alias("avg_engagement"),
        )
        .orderBy("year", "month")
    )


def weekend_vs_weekday(star: Star) -> DataFrame:
    return (
        _by_date(star, "is_weekend")
        .groupBy("is_weekend")
        .agg(
            F.sum("videos").alias("total_videos"),
            _average("views", 0).alias("avg_views"),
            _average("likes", 0).alias("avg_likes"),
            _average("engagement_rate", 4).alias("avg_engagement"),
        )
        .select(
            day_type(F.col("is_weekend")).alias("day_type"),
            "total_videos", "avg_views", "avg_likes", "avg_engagement",
        )
        .orderBy(F.desc("avg_views"))
    )


def weekend_split(star: Star) -> DataFrame:
    return weekend_vs_weekday(star).drop("avg_likes")


def tag_count_vs_views(star: Star) -> DataFrame:
    """Views by number of tags: those of ``dim_video``, which the fact of the same mart
    state carries as well."""
    group = tag_bucket(F.col("tag_count")).alias("tag_group")
    if star.unique_videos:
        tagged = star.fact.select("video_id", "views", "engagement_rate", group)
    else:
        tagged = star.fact.select("video_id", "views", "engagement_rate").join(
            star.dim_video.select("video_id", group), "video_id"
        )
    return (
        tagged.groupBy("tag_group")
        .agg(
            F.count("video_id").alias("video_count"),
            steady_round(F.avg("views"), 0).alias("avg_views"),
            steady_round(F.avg("engagement_rate"), 4).alias("avg_engagement"),
        )
        .orderBy(F.desc("avg_views"))
    )


def summary(star: Star) -> DataFrame:
    return star.fact.where(F.col("views").isNotNull()).agg(
        star.video_count(),
        F.sum("views").alias("total_views"),
        F.sum("likes").alias("total_likes"),
        steady_round(F.avg("engagement_rate"), 4).alias("avg_engagement"),
    )


REPORTS = {
    "channel_performance": channel_performance,
    "fastest_growing_videos": fastest_growing_videos,
    "monthly_trend_analysis": monthly_trend_analysis,
    "most_engaging_videos": most_engaging_videos,
    "tag_count_vs_views": tag_count_vs_views,
    "top_performing_categories": top_performing_categories,
    "top_trending_videos": top_trending_videos,
    "weekend_vs_weekday": weekend_vs_weekday,
}
