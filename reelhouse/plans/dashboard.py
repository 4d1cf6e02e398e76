"""The frames a dashboard shows: reports plus their display columns.

All are limited or aggregated, so each is small enough to hand to a chart
(``.toPandas()``) whatever the size of the fact.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelhouse.functions import labels
from reelhouse.plans import reports
from reelhouse.plans.reports import Star


def top_videos(star: Star) -> DataFrame:
    return reports.top_trending_videos(star).drop("published_at").withColumns(
        {
            "title_short": labels.shortened(F.col("title"), 40),
            "views_M": labels.in_units(F.col("views"), 1_000_000, 2),
        }
    )


def velocity(star: Star) -> DataFrame:
    return reports.fastest_growing_videos(star, rows=15).drop("published_at").withColumns(
        {
            "title_short": labels.shortened(F.col("title"), 35),
            "views_per_day_K": labels.in_units(F.col("views_per_day"), 1_000, 1),
        }
    )


def monthly(star: Star) -> DataFrame:
    return reports.monthly_series(star).withColumn(
        "period", labels.period(F.col("month_name"), F.col("year"))
    )


def kpi_texts(star: Star) -> DataFrame:
    return reports.summary(star).select(
        labels.grouped_integer(F.col("total_videos")).alias("total_videos"),
        labels.millions_text(F.col("total_views")).alias("total_views"),
        labels.millions_text(F.col("total_likes")).alias("total_likes"),
        labels.percent_text(F.col("avg_engagement")).alias("avg_engagement"),
    )


def frames(star: Star) -> dict[str, DataFrame]:
    return {
        "top_videos": top_videos(star),
        "categories": reports.category_top(star),
        "monthly": monthly(star),
        "velocity": velocity(star),
        "weekend": reports.weekend_split(star),
        "summary": reports.summary(star),
    }
