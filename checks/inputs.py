"""Catalogue-shaped frames derived from the test tables.

A video is an order, its channel the customer, its category the customer's
nation; ``oracles.py`` states the same definitions in SQL.
"""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

AS_OF = date(2001, 9, 1)
RUN_TS = datetime(2001, 9, 1, 1, 0, 0)
# Channel history is loaded from the orders before this day and then merged with
# those from it on.
HISTORY_DAY = date(1998, 4, 15)
FIRST_RUN = date(2025, 1, 1)
SECOND_RUN = date(2025, 6, 1)
START_MARK = "1990-01-01T00:00:00Z"
PAGE_ROWS = 50


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _text(name: str) -> Column:
    return F.col(name).cast("string")


def order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        table(spark, sf_dir, "lineitem")
        .groupBy(F.col("l_orderkey").alias("o_orderkey"))
        .agg(
            F.sum("l_quantity").alias("quantity"),
            F.count("*").alias("line_count"),
            F.count_if(F.col("l_returnflag") == "R").alias("returned"),
        )
    )


def videos(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One flat video per order, before any audit columns."""
    orders = table(spark, sf_dir, "orders")
    customers = table(spark, sf_dir, "customer").withColumnRenamed("c_custkey", "o_custkey")
    # every twelfth video is of a category that no listing names
    unlisted = F.when(F.col("o_orderkey") % 12 == 0, 900).otherwise(0)
    joined = (
        orders.join(order_lines(spark, sf_dir), "o_orderkey", "left")
        .join(customers, "o_custkey")
        .withColumn("category", (F.col("c_nationkey") + unlisted).cast("bigint"))
    )
    return joined.select(
        _text("o_orderkey").alias("video_id"),
        F.concat("o_orderpriority", F.lit(" #"), _text("o_orderkey")).alias("title"),
        _text("o_custkey").alias("channel_id"),
        F.col("c_name").alias("channel_title"),
        _text("category").alias("category_id"),
        F.col("o_orderdate").cast("timestamp").alias("published_at"),
        F.concat(F.lit("status "), "o_orderstatus").alias("description"),
        F.concat(F.lit("PT"), _text("line_count"), F.lit("M")).alias("duration"),
        F.coalesce(F.floor(F.col("quantity") / 10), F.lit(0)).cast("int").alias("tag_count"),
        F.floor("o_totalprice").cast("bigint").alias("views"),
        F.floor("quantity").cast("bigint").alias("likes"),
        F.col("line_count").alias("comment_count"),
        F.col("returned").alias("favorite_count"),
        F.concat(F.lit("https://img.example/"), _text("o_orderkey")).alias("thumbnail_url"),
    )


def video_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``silver_video_stats`` of every order, ingested on its own day."""
    stamped = videos(spark, sf_dir).withColumns(
        {
            "ingestion_date": F.to_date("published_at"),
            "ingestion_timestamp": F.date_format("published_at", "yyyy-MM-dd HH:mm:ss"),
            "source": F.lit("stats"),
        }
    )
    return stamped


def trending(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every order once more, seen with one view more; the seen-again rows of
    finished orders are newer than the statistics, the others as old as them."""
    again = video_stats(spark, sf_dir)
    finished = F.col("description") == "status F"
    later = F.date_format(
        F.col("published_at") + F.expr("INTERVAL 1 DAY"), "yyyy-MM-dd HH:mm:ss"
    )
    return again.withColumns(
        {
            "views": F.col("views") + 1,
            "source": F.lit("trending"),
            "ingestion_timestamp": F.when(finished, later).otherwise(
                F.col("ingestion_timestamp")
            ),
        }
    )


def categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All nations; some videos have a category that is not among them."""
    nation = table(spark, sf_dir, "nation")
    return nation.select(
        _text("n_nationkey").alias("category_id"),
        F.col("n_name").alias("category_name"),
        (F.col("n_regionkey") != 0).alias("assignable"),
        F.lit(AS_OF).alias("ingestion_date"),
        F.lit("2001-09-01 00:00:00").alias("ingestion_timestamp"),
        F.lit("categories").alias("source"),
    )


def channels(spark: SparkSession, sf_dir: str, before: bool | None = None) -> DataFrame:
    """Channel statistics: customers with an order before, from, or on any side
    of ``HISTORY_DAY``. Finished orders are the subscribers, unknown when none."""
    orders = table(spark, sf_dir, "orders")
    if before is not None:
        day = F.to_date("o_orderdate")
        orders = orders.where(day < F.lit(HISTORY_DAY) if before else day >= F.lit(HISTORY_DAY))
    totals = orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.sum(F.when(F.col("o_orderstatus") == "F", 1)).alias("subscriber_count"),
        F.sum(F.floor("o_totalprice").cast("bigint")).alias("total_views"),
        F.count_if(F.col("o_orderpriority") == "1-URGENT").alias("video_count"),
        F.date_format(F.max("o_orderdate"), "yyyy-MM-dd HH:mm:ss").alias("ingestion_timestamp"),
    )
    return totals.join(table(spark, sf_dir, "customer"), "c_custkey").select(
        _text("c_custkey").alias("channel_id"),
        F.col("c_name").alias("channel_name"),
        F.col("c_mktsegment").alias("country"),
        "subscriber_count",
        "total_views",
        "video_count",
        "ingestion_timestamp",
    )


def dirty_videos(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as sightings of a video, some without title or with negative
    counts, and several for each video."""
    lines = table(spark, sf_dir, "lineitem")
    return lines.select(
        F.when(F.col("l_linestatus") == "O", _text("l_orderkey")).otherwise(
            F.nullif(_text("l_orderkey"), _text("l_partkey"))
        ).alias("video_id"),
        F.nullif("l_returnflag", F.lit("N")).alias("title"),
        _text("l_suppkey").alias("channel_id"),
        (F.floor("l_extendedprice") - 5000).cast("bigint").alias("views"),
        F.nullif(F.floor("l_quantity").cast("bigint"), F.lit(1)).alias("likes"),
        (F.floor("l_quantity") - 3).cast("bigint").alias("comment_count"),
        F.concat(
            F.date_format("l_shipdate", "yyyy-MM-dd HH:mm:ss"), F.lit("."),
            F.lpad(_text("l_linenumber"), 3, "0"), F.lit("."),
            F.lpad(_text("l_partkey"), 12, "0"), F.lit("."),
            F.lpad(_text("l_suppkey"), 12, "0"),
        ).alias("ingestion_timestamp"),
    )


# --- nested items --------------------------------------------------------------


def _iso(column: str) -> Column:
    return F.date_format(column, "yyyy-MM-dd'T'HH:mm:ss'Z'")


def video_items(flat: DataFrame) -> DataFrame:
    """Flat videos as API items: nested, counts as text, tags as a list."""
    tags = F.when(
        F.col("likes").isNotNull(), F.array_repeat(F.lit("tag"), F.col("tag_count"))
    )
    return flat.select(
        F.col("video_id").alias("id"),
        F.struct(
            "title",
            F.col("channel_id").alias("channelId"),
            F.col("channel_title").alias("channelTitle"),
            F.col("category_id").alias("categoryId"),
            _iso("published_at").alias("publishedAt"),
            "description",
            tags.alias("tags"),
            F.struct(F.struct(F.col("thumbnail_url").alias("url")).alias("high")).alias(
                "thumbnails"
            ),
        ).alias("snippet"),
        F.struct("duration").alias("contentDetails"),
        F.struct(
            _text("views").alias("viewCount"),
            _text("likes").alias("likeCount"),
            _text("comment_count").alias("commentCount"),
            _text("favorite_count").alias("favoriteCount"),
        ).alias("statistics"),
    )


def search_items(flat: DataFrame) -> DataFrame:
    return flat.select(
        F.struct(F.col("video_id").alias("videoId")).alias("id"),
        F.struct(
            "title",
            F.col("channel_id").alias("channelId"),
            F.col("channel_title").alias("channelTitle"),
            _iso("published_at").alias("publishedAt"),
            "description",
            F.struct(F.struct(F.col("thumbnail_url").alias("url")).alias("high")).alias(
                "thumbnails"
            ),
        ).alias("snippet"),
    )


def channel_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return channels(spark, sf_dir).select(
        F.col("channel_id").alias("id"),
        F.struct(
            F.col("channel_name").alias("title"),
            F.lit(None).cast("string").alias("description"),
            "country",
            F.regexp_replace("ingestion_timestamp", "^(.{10}) (.*)$", "$1T$2Z").alias(
                "publishedAt"
            ),
        ).alias("snippet"),
        F.struct(
            _text("subscriber_count").alias("subscriberCount"),
            _text("total_views").alias("viewCount"),
            _text("video_count").alias("videoCount"),
        ).alias("statistics"),
    )


def category_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return categories(spark, sf_dir).select(
        F.col("category_id").alias("id"),
        F.struct(F.col("category_name").alias("title"), "assignable").alias("snippet"),
    )


def to_pages(items: DataFrame, number: Column, **request: Column) -> DataFrame:
    """Items as answers of at most ``PAGE_ROWS``: numbers that differ by the page
    length fall on different pages."""
    page = items.select(
        F.floor(number / PAGE_ROWS).alias("_page"),
        *[value.alias(name) for name, value in request.items()],
        F.struct(*items.columns).alias("item"),
    )
    return (
        page.groupBy("_page", *request)
        .agg(F.collect_list("item").alias("items"))
        .select("items", F.lit(None).cast("string").alias("nextPageToken"), *request)
    )


def keyword_pages(spark: SparkSession, sf_dir: str, flat: DataFrame | None = None) -> DataFrame:
    """Keyword search answers over all orders, with unusable ones among them: an
    empty list for every nation and no list at all for every region."""
    search = search_items(videos(spark, sf_dir) if flat is None else flat)
    keyword = F.split_part("snippet.title", F.lit(" #"), F.lit(1))
    pages = to_pages(search, F.col("id.videoId").cast("bigint"), _source_keyword=keyword)
    items_type = pages.schema["items"].dataType
    token = F.lit(None).cast("string").alias("nextPageToken")
    empty = table(spark, sf_dir, "nation").select(
        F.array().cast(items_type).alias("items"), token, F.col("n_name").alias("_source_keyword")
    )
    missing = table(spark, sf_dir, "region").select(
        F.lit(None).cast(items_type).alias("items"), token, F.col("r_name").alias("_source_keyword")
    )
    return pages.unionByName(empty).unionByName(missing)
