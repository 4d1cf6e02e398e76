"""Values a run is made of: source map, quality rules, defaults."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date


@dataclass(frozen=True)
class SourceSpec:
    """One landed document set: where it lies, which table it feeds, its label."""

    raw_name: str
    table: str
    label: str
    kind: str  # key into schemas.RAW_ITEMS


@dataclass(frozen=True)
class QualityRules:
    """Checks of one table; columns the frame does not have are skipped."""

    key: str
    required: tuple[str, ...] = ()
    non_negative: tuple[str, ...] = ()


# Landed file -> (bronze table, source label, item kind).
SOURCES = (
    SourceSpec("raw_trending", "bronze_trending", "youtube_api_trending", "video"),
    SourceSpec(
        "raw_trending_by_category",
        "bronze_trending_by_category",
        "youtube_api_trending_category",
        "video",
    ),
    SourceSpec(
        "raw_channel_videos", "bronze_channel_videos", "youtube_api_channel_search", "search"
    ),
    SourceSpec(
        "raw_keyword_videos", "bronze_keyword_videos", "youtube_api_keyword_search", "search"
    ),
    SourceSpec("raw_video_stats", "bronze_video_stats", "youtube_api_video_stats", "video"),
    SourceSpec("raw_channel_stats", "bronze_channel_stats", "youtube_api_channel_stats", "channel"),
    SourceSpec("raw_categories", "bronze_categories", "youtube_api_categories", "category"),
)

# Columns that must be present, and counts that cannot be negative.
REQUIRED_VIDEO = ("video_id", "title", "channel_id")
REQUIRED_CHANNEL = ("channel_id", "subscriber_count")
REQUIRED_CATEGORY = ("category_id", "category_name")
NON_NEGATIVE = ("views", "likes", "comment_count", "subscriber_count")

VIDEO_RULES = QualityRules("video_id", REQUIRED_VIDEO, NON_NEGATIVE)
SEARCH_RULES = QualityRules("video_id", REQUIRED_VIDEO)
CHANNEL_RULES = QualityRules("channel_id", REQUIRED_CHANNEL, NON_NEGATIVE)
CATEGORY_RULES = QualityRules("category_id", REQUIRED_CATEGORY)

# Category ids the trending list is also fetched for.
TRENDING_CATEGORIES = {
    "1": "Film & Animation",
    "10": "Music",
    "17": "Sports",
    "22": "People & Blogs",
    "23": "Comedy",
    "24": "Entertainment",
    "25": "News & Politics",
    "28": "Science & Technology",
}
TRENDING_ALL = "0"
SOURCE_SYSTEM = "youtube_data_api_v3"
UNKNOWN_KEYWORD = "unknown"

DEFAULT_MARK = "2025-01-01T00:00:00Z"
OPEN_END = date(9999, 12, 31)
TRACKED_CHANNEL_COLUMNS = ("subscriber_count", "video_count")
