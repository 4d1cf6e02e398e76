from __future__ import annotations

from datetime import date

import pytest
from pyspark.sql import functions as F

from reelhouse.operators import scd2
from reelhouse.settings import OPEN_END

DAY1, DAY2, DAY3 = date(2025, 1, 1), date(2025, 6, 1), date(2025, 9, 1)
SCHEMA = (
    "channel_id string, channel_name string, country string, subscriber_count bigint,"
    " total_views bigint, video_count bigint"
)


def _channels(rows, **subscribers):
    return rows(SCHEMA, *[(k, k.upper(), "IN", v, 10, 1) for k, v in subscribers.items()])


def _versions(df):
    return sorted(
        (
            r.channel_id, r.subscriber_count, r.effective_start_date, r.effective_end_date,
            r.is_current,
        )
        for r in df.collect()
    )


@pytest.fixture
def history(rows):
    return scd2.first_load(_channels(rows, sun=5_000_000, still=1, gone=2), DAY1)


def test_first_load_is_open(history):
    assert {(r.effective_start_date, r.effective_end_date, r.is_current) for r in history.collect()} == {
        (DAY1, OPEN_END, True)
    }


def test_merge(rows, history):
    merged = scd2.merge(history, _channels(rows, sun=6_000_000, still=1, fresh=3), DAY2)
    assert _versions(merged) == [
        ("fresh", 3, DAY2, OPEN_END, True),
        ("gone", 2, DAY1, OPEN_END, True),
        ("still", 1, DAY1, OPEN_END, True),
        ("sun", 5_000_000, DAY1, DAY2, False),
        ("sun", 6_000_000, DAY2, OPEN_END, True),
    ]


def test_unchanged_input_changes_nothing(rows, history):
    new = _channels(rows, sun=6_000_000, still=1)
    once = scd2.merge(history, new, DAY2)
    again = scd2.merge(once, new, DAY3)
    assert sorted(map(tuple, once.collect()), key=repr) == sorted(map(tuple, again.collect()), key=repr)


def test_second_change_on_one_day_replaces_the_version(rows, history):
    once = scd2.merge(history, _channels(rows, sun=6), DAY2)
    again = scd2.merge(once, _channels(rows, sun=7), DAY2)
    assert [v for v in _versions(again) if v[0] == "sun"] == [
        ("sun", 7, DAY2, OPEN_END, True), ("sun", 5_000_000, DAY1, DAY2, False),
    ]


def test_values_that_appear_or_disappear_are_changes(rows):
    history = scd2.first_load(
        rows(SCHEMA, ("a", "A", None, None, 1, 1), ("b", "B", None, 4, 1, 1), ("c", "C", None, None, 1, 1)),
        DAY1,
    )
    new = rows(SCHEMA, ("a", "A", None, 4, 1, 1), ("b", "B", None, None, 1, 1), ("c", "C", None, None, 1, 1))
    assert sorted(r.channel_id for r in scd2.changed_keys(new, history).collect()) == ["a", "b"]
    assert scd2.merge(history, new, DAY2).count() == 5


def test_tracked_columns(rows, history):
    new = _channels(rows, still=1).withColumn("video_count", F.lit(2).cast("bigint"))
    assert scd2.changed_keys(new, history).count() == 1
    assert scd2.changed_keys(new, history, ["subscriber_count"]).count() == 0
    assert scd2.merge(history, new, DAY2, ["subscriber_count"]).count() == 3


def test_one_current_version_and_no_overlap(rows, history):
    h = scd2.merge(history, _channels(rows, sun=6, still=2, fresh=1), DAY2)
    h = scd2.merge(h, _channels(rows, sun=7, fresh=1, gone=9), DAY3).cache()
    assert h.where("is_current").groupBy("channel_id").count().where("count <> 1").count() == 0
    a, b = h.alias("a"), h.alias("b")
    overlap = a.join(b, "channel_id").where(
        "a.channel_key <> b.channel_key and a.effective_start_date < b.effective_end_date"
        " and b.effective_start_date < a.effective_end_date"
    )
    assert overlap.count() == 0
    assert h.select("channel_key").distinct().count() == h.count()


def test_as_of_is_half_open(rows, history):
    merged = scd2.merge(history, _channels(rows, sun=6_000_000), DAY2)
    asked = rows("channel_id string, at date", ("sun", date(2025, 3, 1)), ("sun", DAY2),
                 ("sun", date(2025, 5, 31)), ("sun", date(2024, 1, 1)))
    got = scd2.as_of(asked, merged, "at").select("at", "subscriber_count")
    assert sorted(map(tuple, got.collect())) == [
        (date(2025, 3, 1), 5_000_000), (date(2025, 5, 31), 5_000_000), (DAY2, 6_000_000),
    ]
    assert scd2.as_of(asked, merged, "at", "left").count() == 4


def test_prepare_keeps_the_latest_per_channel(rows):
    twice = rows(
        SCHEMA + ", ingestion_timestamp string",
        ("a", "A", "IN", 1, 1, 1, "2025-01-01 00:00:00"),
        ("a", "A", "IN", 2, 1, 1, "2025-01-02 00:00:00"),
        (None, "x", "IN", 2, 1, 1, "2025-01-02 00:00:00"),
    )
    row, = scd2.prepare(twice).collect()
    assert row.subscriber_count == 2
