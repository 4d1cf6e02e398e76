from __future__ import annotations

from datetime import date

import pytest
from pyspark.sql import functions as F

from reelhouse.functions import labels, metrics, parse

AS_OF = date(2025, 6, 11)
COUNTS = "views bigint, likes bigint, comment_count bigint"


@pytest.mark.parametrize(
    ("views", "likes", "comments", "engagement", "ratio"),
    [
        (100000, 8000, 2000, 10.0, 8.0),
        (None, 5, 5, 0.0, 0.0),
        (0, 5, 5, 0.0, 0.0),
        (-3, 5, 5, 0.0, 0.0),
        (200, None, 1, 0.5, 0.0),
        (200, 1, None, 0.5, 0.5),
        (3, 1, 1, 66.6667, 33.3333),
    ],
)
def test_shares_of_views(rows, views, likes, comments, engagement, ratio):
    df = rows(COUNTS, (views, likes, comments))
    got = df.select(metrics.engagement_rate(), metrics.like_ratio()).first()
    assert tuple(got) == (engagement, ratio)


@pytest.mark.parametrize(
    ("published", "views", "days", "velocity"),
    [
        ("2025-06-01 23:59:59", 1000, 10, 100.0),
        ("2025-06-11 00:00:00", 1000, 1, 1000.0),
        ("2025-07-01 00:00:00", 1000, 1, 1000.0),
        (None, 1000, 1, 1000.0),
        ("2025-06-08 00:00:00", None, 3, 0.0),
        ("2025-06-08 00:00:00", 100, 3, 33.33),
    ],
)
def test_velocity(rows, published, views, days, velocity):
    df = rows("published_at string, views bigint", (published, views))
    df = df.withColumn("published_at", F.col("published_at").cast("timestamp"))
    df = df.withColumn("days_since_published", metrics.days_since(as_of=AS_OF))
    got = df.select("days_since_published", metrics.view_velocity()).first()
    assert tuple(got) == (days, velocity)


def test_days_default_to_today(rows):
    df = rows("published_at timestamp", (None,))
    assert df.select(metrics.days_since()).first()[0] == 1


def test_steady_round_ignores_noise(rows):
    df = rows("x double", (0.00004999999999999999,), (0.12345,), (2.5,))
    assert [r[0] for r in df.select(metrics.steady_round(F.col("x"), 4)).collect()] == [
        0.0001, 0.1235, 2.5,
    ]


@pytest.mark.parametrize(
    ("count", "bucket"),
    [
        (0, "No tags"), (1, "1-5 tags"), (5, "1-5 tags"), (6, "6-15 tags"), (15, "6-15 tags"),
        (16, "15+ tags"), (None, "15+ tags"),
    ],
)
def test_tag_bucket(rows, count, bucket):
    assert rows("n int", (count,)).select(labels.tag_bucket(F.col("n"))).first()[0] == bucket


def test_display_columns(rows):
    df = rows(
        "title string, views bigint, per_day double, name string, year int, weekend boolean",
        ("short", 125000, 250.0, "May", 2025, None),
    )
    got = df.select(
        labels.shortened(F.col("title"), 40),
        labels.in_units(F.col("views"), 1_000_000, 2),
        labels.in_units(F.col("per_day"), 1_000, 1),
        labels.period(F.col("name"), F.col("year")),
        labels.day_type(F.col("weekend")),
        labels.millions_text(F.col("views")),
        labels.grouped_integer(F.col("views")),
    ).first()
    assert tuple(got) == ("short...", 0.12, 0.2, "May 2025", "Weekday", "0.1M", "125,000")


def test_unreadable_text_is_null(rows):
    df = rows("n string, t string", ("12", "2025-01-01T10:00:00Z"), ("abc", "bad"), (None, None))
    count, when = parse.to_count(F.col("n")), parse.to_utc(F.col("t"))
    got = df.select(count, when.cast("string"), parse.unreadable(F.col("n"), count)).collect()
    assert [tuple(r) for r in got] == [
        (12, "2025-01-01 10:00:00", False), (None, None, True), (None, None, False),
    ]


@pytest.mark.parametrize(
    ("raw", "found"),
    [
        ("abc", "abc"), ('{"videoId":"abc"}', "abc"), ('{"kind":"x"}', None), ("", None),
        ('{"videoId":""}', None), (None, None),
    ],
)
def test_video_id(rows, raw, found):
    assert rows("id string", (raw,)).select(parse.video_id(F.col("id"))).first()[0] == found
