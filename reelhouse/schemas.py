"""Declared schemas of every layer. Nothing in the library infers one.

A declared raw schema makes a field that no item carries a null column instead
of an analysis error, and lets a scan start without a pass over the data.
"""

from __future__ import annotations

from pyspark.sql import types as T

CORRUPT = "_corrupt_record"

_STRING, _LONG, _INT = T.StringType(), T.LongType(), T.IntegerType()
_DOUBLE, _BOOLEAN = T.DoubleType(), T.BooleanType()
_DATE, _TIMESTAMP = T.DateType(), T.TimestampType()


def _of(kind: T.DataType, *names: str) -> list[T.StructField]:
    return [T.StructField(name, kind) for name in names]


def _text(*names: str) -> list[T.StructField]:
    return _of(_STRING, *names)


def _row(*parts: list[T.StructField]) -> T.StructType:
    return T.StructType([field for part in parts for field in part])


def columns(schema: T.StructType) -> list[str]:
    return [field.name for field in schema.fields]


# --- raw: nested items as the API answers them; every count is text --------------

_RUN_AUDIT = ("_batch_id", "_ingestion_ts", "_source_system")
_REQUEST_AUDIT = ("_api_endpoint", "_source_category", "_source_keyword")
_ITEM_AUDIT = _text(*_RUN_AUDIT, *_REQUEST_AUDIT)
_THUMBNAILS = _of(_row(_of(_row(_text("url")), "high")), "thumbnails")

RAW_ITEMS = {
    "video": _row(
        _text("id"),
        _of(
            _row(
                _text("title", "channelId", "channelTitle", "categoryId", "publishedAt"),
                _text("description"),
                _of(T.ArrayType(_STRING), "tags"),
                _THUMBNAILS,
            ),
            "snippet",
        ),
        _of(_row(_text("duration")), "contentDetails"),
        _of(_row(_text("viewCount", "likeCount", "commentCount", "favoriteCount")), "statistics"),
        _ITEM_AUDIT,
    ),
    "channel": _row(
        _text("id"),
        _of(_row(_text("title", "description", "country", "publishedAt")), "snippet"),
        _of(_row(_text("subscriberCount", "viewCount", "videoCount")), "statistics"),
        _ITEM_AUDIT,
    ),
    "category": _row(
        _text("id"), _of(_row(_text("title"), _of(_BOOLEAN, "assignable")), "snippet"), _ITEM_AUDIT
    ),
    "search": _row(
        _of(_row(_text("videoId")), "id"),
        _of(
            _row(
                _text("title", "channelId", "channelTitle", "publishedAt", "description"),
                _THUMBNAILS,
            ),
            "snippet",
        ),
        _ITEM_AUDIT,
    ),
}


def response_page(kind: str) -> T.StructType:
    """One API answer: the items of a request plus what the request was for."""
    fields = RAW_ITEMS[kind].fields
    item = T.StructType([f for f in fields if not f.name.startswith("_")])
    return _row(_of(T.ArrayType(item), "items"), _text("nextPageToken", *_REQUEST_AUDIT))


# --- bronze and silver ---------------------------------------------------------

_INGESTED = _of(_DATE, "ingestion_date") + _text("ingestion_timestamp", "source")


def bronze(kind: str) -> T.StructType:
    return _row(RAW_ITEMS[kind].fields, _INGESTED)


_SILVER_VIDEO = _row(
    _text("video_id", "title", "channel_id", "channel_title", "category_id"),
    _of(_TIMESTAMP, "published_at"),
    _text("description", "duration"),
    _of(_INT, "tag_count"),
    _of(_LONG, "views", "likes", "comment_count", "favorite_count"),
    _text("thumbnail_url"),
    _INGESTED,
)
_SILVER_SEARCH = _row(
    _text("video_id", "title", "channel_id", "channel_title"),
    _of(_TIMESTAMP, "published_at"),
    _text("description", "thumbnail_url", "source_keyword"),
    _INGESTED,
)

SILVER = {
    "silver_video_stats": _SILVER_VIDEO,
    "silver_trending": _SILVER_VIDEO,
    "silver_trending_by_category": _SILVER_VIDEO,
    "silver_channel_stats": _row(
        _text("channel_id", "channel_name", "description", "country"),
        _of(_TIMESTAMP, "published_at"),
        _of(_LONG, "subscriber_count", "total_views", "video_count"),
        _INGESTED,
    ),
    "silver_categories": _row(
        _text("category_id", "category_name"), _of(_BOOLEAN, "assignable"), _INGESTED
    ),
    "silver_keyword_videos": _SILVER_SEARCH,
    "silver_channel_videos": _SILVER_SEARCH,
}

# --- gold and warehouse --------------------------------------------------------

GOLD = {
    "gold_video_engagement": _row(
        _text("video_id", "title", "channel_id", "channel_title", "category_id", "category_name"),
        _of(_TIMESTAMP, "published_at"),
        _text("duration"),
        _of(_INT, "tag_count"),
        _of(_LONG, "views", "likes", "comment_count", "favorite_count"),
        _text("thumbnail_url"),
        _of(_DOUBLE, "engagement_rate", "like_ratio", "view_velocity"),
        _of(_INT, "days_since_published", "year", "month"),
        _of(_DATE, "ingestion_date"),
        _text("ingestion_timestamp"),
    ),
    "gold_channel_performance": _row(
        _text("channel_id", "channel_title"),
        _of(_LONG, "total_videos", "total_views", "total_likes", "total_comments"),
        _of(_DOUBLE, "avg_views"),
        _of(_LONG, "max_views", "min_views"),
        _of(_DOUBLE, "avg_engagement_rate"),
        _of(_DATE, "ingestion_date"),
    ),
    "gold_category_performance": _row(
        _text("category_id", "category_name"),
        _of(_LONG, "total_videos", "total_views", "total_likes"),
        _of(_DOUBLE, "avg_views"),
        _of(_LONG, "max_views"),
        _of(_DOUBLE, "avg_engagement_rate"),
        _of(_DATE, "ingestion_date"),
    ),
}

WAREHOUSE = {
    "dim_video": _row(
        _text("video_id", "title", "channel_id", "channel_title", "category_id"),
        _of(_TIMESTAMP, "published_at"),
        _text("duration"),
        _of(_INT, "tag_count"),
        _text("thumbnail_url"),
    ),
    "dim_channel": _row(
        _of(_LONG, "channel_key"),
        _text("channel_id", "channel_name", "country"),
        _of(_LONG, "subscriber_count", "total_views", "video_count"),
        _of(_DATE, "effective_start_date", "effective_end_date"),
        _of(_BOOLEAN, "is_current"),
    ),
    "dim_category": _row(_text("category_id", "category_name"), _of(_BOOLEAN, "assignable")),
    "dim_date": _row(
        _text("date_id"),
        _of(_DATE, "full_date"),
        _of(_INT, "year", "month"),
        _text("month_name"),
        _of(_INT, "quarter"),
        _text("day_of_week"),
        _of(_BOOLEAN, "is_weekend"),
    ),
    "fact_video_performance": _row(
        _text("video_id", "channel_id", "category_id", "date_id"),
        _of(_LONG, "views", "likes", "comment_count", "favorite_count"),
        _of(_INT, "tag_count"),
        _of(_DOUBLE, "engagement_rate", "like_ratio", "view_velocity"),
        _of(_INT, "year", "month"),
    ),
}

# --- state and log ---------------------------------------------------------------

MARKS = _row(_text("source_type", "source_key"), _of(_TIMESTAMP, "last_ts"))

LINEAGE = _row(
    _text("pipeline", "source", "destination"),
    _of(
        T.ArrayType(_row(_text("table", "status"), _of(_LONG, "rows"), _text("error"), _of(T.MapType(_STRING, _LONG), "checks"))), "tables"
    ),
    _of(T.MapType(_STRING, _STRING), "details"),
    _text("logged_at"),
    _of(_DATE, "run_date"),
)
