from __future__ import annotations

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from reelhouse import schemas, settings
from reelhouse.operators import audit, columns, dedup, dimensions, flatten, marts, quality

RUN_TS = datetime(2025, 6, 1, 8, 30, 5)


def _facts(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


# --- flattening -----------------------------------------------------------------


def _video(spark, **parts):
    item = {"id": "v1", **parts}
    return audit.ingestion_columns(
        spark.createDataFrame([item], schemas.RAW_ITEMS["video"]), "label", RUN_TS
    )


@pytest.mark.parametrize(("tags", "count"), [(None, 0), ([], 0), (["a", "b", "c"], 3)])
def test_tag_count(spark, tags, count):
    flat = flatten.video_stats(_video(spark, snippet={"title": "t", "tags": tags}))
    assert flat.first().tag_count == count


def test_video_columns_and_types(spark):
    flat = flatten.video_stats(_video(spark))
    assert flat.columns == schemas.columns(schemas.SILVER["silver_video_stats"])
    assert [f.dataType for f in flat.schema] == [
        f.dataType for f in schemas.SILVER["silver_video_stats"]
    ]


@pytest.mark.parametrize(
    ("kind", "make", "table"),
    [
        ("channel", flatten.channel_stats, "silver_channel_stats"),
        ("category", flatten.categories, "silver_categories"),
        ("search", flatten.search_videos, "silver_keyword_videos"),
    ],
)
def test_other_kinds_match_silver(spark, kind, make, table):
    items = spark.createDataFrame([], schemas.RAW_ITEMS[kind])
    flat = make(audit.ingestion_columns(items, "label", RUN_TS))
    assert flat.columns == schemas.columns(schemas.SILVER[table])


def test_unreadable_counts_are_null_and_named(spark):
    item = _video(
        spark,
        snippet={"publishedAt": "bad"},
        statistics={"viewCount": "abc", "likeCount": "7"},
    )
    row = flatten.video_stats(item, keep_unparsed=True).first()
    assert (row.views, row.likes, row.published_at) == (None, 7, None)
    assert sorted(row.unparsed) == ["published_at", "views"]


def test_missing_keyword_is_unknown(spark):
    items = spark.createDataFrame(
        [{"id": {"videoId": "v"}}, {"id": {"videoId": "w"}, "_source_keyword": "k"}],
        schemas.RAW_ITEMS["search"],
    )
    flat = flatten.search_videos(audit.ingestion_columns(items, "label", RUN_TS))
    assert _facts(flat.select("video_id", "source_keyword")) == [("v", "unknown"), ("w", "k")]


def test_batch_ids_differ_and_carry_the_time():
    first, second = audit.new_batch_id(RUN_TS), audit.new_batch_id(RUN_TS)
    assert first != second
    assert first.startswith("batch_20250601_083005_")


# --- quality ---------------------------------------------------------------------

ROWS = "video_id string, title string, channel_id string, views bigint, likes bigint"


def _dirty(rows):
    return rows(
        ROWS,
        ("a", "t", "c", 1, 1),
        ("b", None, "c", 1, 1),
        ("c", "t", "c", -1, 1),
        ("d", None, None, -1, None),
        ("e", "t", "c", None, None),
        ("a", "t", "c", 2, 2),
    )


def test_first_failed_check_names_the_issue(rows):
    judged = quality.judge(_dirty(rows), settings.VIDEO_RULES)
    got = {r.video_id: (r.dq_issue, r.dq_failed_cols) for r in judged.collect()}
    nulls = "NULL in: ['video_id', 'title', 'channel_id']"
    assert got["a"] == (None, [])
    assert got["b"] == (nulls, ["title"])
    assert got["c"] == ("Negative values in: ['views', 'likes']", ["views"])
    assert got["d"] == (nulls, ["title", "channel_id", "views"])
    assert got["e"] == (None, [])


def test_good_and_bad_make_the_input(rows):
    df = _dirty(rows)
    for good, bad in (
        quality.completeness(df, settings.REQUIRED_VIDEO),
        quality.validity(df, settings.NON_NEGATIVE),
    ):
        back = good.unionByName(bad.select(good.columns))
        assert _facts(back) == _facts(df)


def test_checks_on_absent_columns_are_skipped(rows):
    df = _dirty(rows)
    for good, bad in (quality.completeness(df, ["nope"]), quality.validity(df, ["nope"])):
        assert good.count() == 6
        assert bad.count() == 0
        assert "dq_issue" in bad.columns
    assert quality.uniqueness(df, "nope").count() == 6


def test_run_checks(rows):
    clean, bad = quality.run_checks(_dirty(rows), settings.VIDEO_RULES)
    assert sorted(r.video_id for r in clean.collect()) == ["a", "e"]
    assert clean.columns == _dirty(rows).columns
    assert sorted(r.video_id for r in bad.collect()) == ["b", "c", "d"]


def test_check_counts_on_nothing(rows):
    empty = columns.empty_like(_dirty(rows))
    assert set(quality.check_counts(empty, settings.VIDEO_RULES).first()) == {0}


# --- deduplication ---------------------------------------------------------------


def test_latest_row_is_kept_and_nulls_come_last(rows):
    df = rows(
        "k string, ingestion_timestamp string, v int",
        ("a", "2025-01-01 00:00:00", 1), ("a", "2025-01-02 00:00:00", 2), ("a", None, 3),
        (None, "2025-01-01 00:00:00", 4), (None, "2025-01-03 00:00:00", 5),
    )
    assert _facts(dedup.keep_latest(df, "k").select("k", "v")) == [("a", 2), (None, 5)]
    assert _facts(dedup.unique_key(df, "k").select("k", "v")) == [("a", 2)]


def test_survivor_of_a_tie_depends_on_the_rows_alone(spark):
    data = [(i % 5, "2025-01-01 00:00:00", i) for i in range(200)]
    schema = "k int, ingestion_timestamp string, v int"
    first = _facts(dedup.keep_latest(spark.createDataFrame(data, schema), "k"))
    other = spark.createDataFrame(data[::-1], schema).repartition(7)
    assert len(first) == 5
    assert _facts(dedup.keep_latest(other, "k")) == first


def test_first_seen_prefers_earlier_frames(rows):
    one = rows("id string, v int", ("a", 1), (None, 9))
    two = rows("id string, v int, extra int", ("a", 2, 0), ("b", 3, 0))
    got = dedup.first_seen([one, two], "id").select("id", "v", "extra")
    assert _facts(got) == [("a", 1, None), ("b", 3, 0)]


def test_first_seen_follows_the_sequence(rows):
    df = rows("id string, seq int", ("a", 3), ("a", 1), ("a", 2))
    assert _facts(dedup.first_seen([df], "id", "seq")) == [("a", 1)]


def test_first_seen_of_known_keys(rows):
    one = rows("id string, v int", ("a", 1), ("a", 0), (None, 9))
    two = rows("id string, v int, extra array<string>", ("a", 2, ["x"]), ("b", 3, None), ("b", 4, []))
    last = rows("id string, v int", ("a", 5), ("b", 6), ("c", 8), ("c", 7), ("d", 9), (None, 9))
    known = rows("id string", ("a",), ("c",), ("c",), ("e",), (None,))
    got = dedup.first_seen_of([one, two, last], "id", known).select("id", "v", "extra")
    assert _facts(got) == [("a", 0, None), ("b", 3, None), ("c", 7, None)]


# --- columns ---------------------------------------------------------------------


def test_conform_channels_fills_what_is_missing(rows):
    mart = rows("channel_id string, channel_title string, total_videos bigint", ("c", "n", 7))
    row = columns.conform_channels(mart).first()
    assert (row.channel_name, row.country, row.subscriber_count) == ("n", None, 0)
    assert (row.total_views, row.video_count) == (0, 7)


def test_union_common_keeps_shared_columns(rows):
    got = columns.union_common([rows("a int, b int", (1, 2)), rows("c int, a int", (3, 4))])
    assert (got.columns, _facts(got)) == (["a"], [(1,), (4,)])


# --- marts and dimensions --------------------------------------------------------

VIDEO = (
    "video_id string, channel_id string, channel_title string, category_id string,"
    " published_at timestamp, views bigint, likes bigint, comment_count bigint,"
    " ingestion_timestamp string"
)


def _stats(rows, *data):
    return rows(VIDEO, *data)


def test_trending_adds_videos_and_statistics_win_ties(rows):
    when = datetime(2025, 1, 1)
    stats = _stats(rows, ("a", "c", "n", "1", when, 1, 0, 0, "t1"), ("b", "c", "n", "1", when, 2, 0, 0, "t1"))
    trend = _stats(rows, ("a", "c", "n", "1", when, 9, 0, 0, "t1"), ("b", "c", "n", "1", when, 8, 0, 0, "t2"),
                   ("z", "c", "n", "1", when, 7, 0, 0, "t0"))
    got = marts.combine_videos(stats, trend).select("video_id", "views")
    assert _facts(got) == [("a", 1), ("b", 8), ("z", 7)]


def test_video_mart_keeps_unknown_categories(rows):
    stats = _stats(rows, ("a", "c", "n", "1", None, 10, 1, 0, "t"), ("b", "c", "n", "x", None, 10, 1, 0, "t"))
    names = rows("category_id string, category_name string", ("1", "Film"), ("1", "Film"))
    got = marts.video_engagement(stats, None, names, date(2025, 1, 1))
    assert _facts(got.select("video_id", "category_name", "year")) == [
        ("a", "Film", None), ("b", None, None),
    ]


def test_channel_mart_takes_the_latest_title(rows):
    stats = _stats(
        rows,
        ("a", "c", "old", "1", None, 10, 1, 1, "2025-01-01 00:00:00"),
        ("b", "c", "new", "1", None, None, None, None, "2025-01-02 00:00:00"),
        ("d", "c", "old", "1", None, 20, 1, 1, "2024-01-01 00:00:00"),
    )
    row = marts.channel_performance(stats, date(2025, 1, 3)).first()
    assert row.channel_title == "new"
    assert (row.total_videos, row.total_views, row.avg_views) == (3, 30, 15.0)
    assert (row.max_views, row.min_views, row.avg_engagement_rate) == (20, 10, 10.0)


def test_channel_without_views_has_null_averages(rows):
    stats = _stats(rows, ("a", "c", "n", "1", None, None, None, None, None))
    row = marts.channel_performance(stats, date(2025, 1, 3)).first()
    assert (row.total_views, row.avg_views, row.avg_engagement_rate) == (None, None, 0.0)


def test_mart_and_star_schemas_are_the_declared_ones(spark):
    empty = lambda name: spark.createDataFrame([], schemas.SILVER[name])
    stats, names = empty("silver_video_stats"), empty("silver_categories")
    made = {
        "gold_video_engagement": marts.video_engagement(stats, stats, names),
        "gold_channel_performance": marts.channel_performance(stats, date(2025, 1, 1)),
        "gold_category_performance": marts.category_performance(stats, names, date(2025, 1, 1)),
    }
    gold = made["gold_video_engagement"]
    star = {
        "dim_video": dimensions.dim_video(gold),
        "dim_category": dimensions.dim_category(names),
        "dim_date": dimensions.dim_date(gold),
        "fact_video_performance": dimensions.fact_video_performance(gold),
    }
    for declared, frames in ((schemas.GOLD, made), (schemas.WAREHOUSE, star)):
        for name, df in frames.items():
            expected = [(f.name, f.dataType) for f in declared[name]]
            assert [(f.name, f.dataType) for f in df.schema] == expected, name


def test_dim_date(rows):
    gold = rows("published_at timestamp", (datetime(2025, 5, 31, 23),), (datetime(2025, 5, 31, 1),), (None,))
    row, = dimensions.dim_date(gold).collect()
    assert tuple(row) == (
        "20250531", date(2025, 5, 31), 2025, 5, "May", 2, "Saturday", True,
    )


def test_facts_without_a_key_drop_out(rows):
    gold = rows("video_id string, published_at timestamp, ingestion_timestamp string",
                ("a", None, "1"), ("a", None, "2"), (None, None, "3"))
    assert dimensions.fact_video_performance(gold).count() == 1
    assert dimensions.dim_video(gold).count() == 1
    assert gold.where(F.col("video_id").isNull()).count() == 1
