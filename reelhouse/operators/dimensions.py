"""The star schema: video, category and date dimensions and the fact."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelhouse import schemas
from reelhouse.operators import columns, dedup

_VIDEO = schemas.columns(schemas.WAREHOUSE["dim_video"])
_FACT = schemas.columns(schemas.WAREHOUSE["fact_video_performance"])


def date_id(day: Column) -> Column:
    return F.date_format(day, "yyyyMMdd")


def _one_per_video(gold: DataFrame, deduplicate: bool) -> DataFrame:
    if deduplicate:
        return dedup.unique_key(gold, "video_id")
    return gold.where(F.col("video_id").isNotNull())


def dim_video(gold: DataFrame, deduplicate: bool = True) -> DataFrame:
    """``deduplicate=False`` saves a shuffle of the table when it is known unique."""
    return columns.select_existing(_one_per_video(gold, deduplicate), _VIDEO)


def dim_category(categories: DataFrame) -> DataFrame:
    return dedup.unique_key(categories, "category_id").select(
        "category_id", "category_name", "assignable"
    )


def distinct_dates(gold: DataFrame) -> DataFrame:
    days = gold.select(F.to_date("published_at").alias("full_date"))
    return days.where(F.col("full_date").isNotNull()).distinct()


def dim_date(gold: DataFrame) -> DataFrame:
    day = F.col("full_date")
    return distinct_dates(gold).select(
        date_id(day).alias("date_id"),
        day,
        F.year(day).alias("year"),
        F.month(day).alias("month"),
        F.date_format(day, "MMMM").alias("month_name"),
        F.quarter(day).alias("quarter"),
        F.date_format(day, "EEEE").alias("day_of_week"),
        F.dayofweek(day).isin(1, 7).alias("is_weekend"),
    )


def fact_video_performance(gold: DataFrame, deduplicate: bool = True) -> DataFrame:
    dated = _one_per_video(gold, deduplicate).withColumn(
        "date_id", date_id(F.to_date("published_at"))
    )
    return columns.select_existing(dated, _FACT)
