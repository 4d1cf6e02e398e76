"""The physical plans the design relies on."""

from __future__ import annotations

from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from checks import inputs
from reelhouse import schemas
from reelhouse.operators import dedup, flatten, marts
from reelhouse.plans import reports
from tests.conftest import SF_DIR


@pytest.fixture
def shuffled(spark):
    """A session in which no side is small enough to broadcast by its size."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield spark
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.fixture
def star(spark, tmp_path):
    """Empty star tables on disk: enough to plan on."""
    opened = {}
    for name, schema in schemas.WAREHOUSE.items():
        path = str(tmp_path / name)
        spark.createDataFrame([], schema).write.parquet(path)
        opened[name] = spark.read.schema(schema).parquet(path)
    return reports.Star(
        opened["fact_video_performance"], opened["dim_video"], opened["dim_category"],
        opened["dim_date"], opened["dim_channel"],
    )


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_keep_latest_reduces_before_the_shuffle(spark):
    events = spark.read.parquet(f"{SF_DIR}/events.parquet")
    text = plan(dedup.keep_latest(events, "user_id", "ts"))
    final, exchange, partial = (
        text.index("1, Final"), text.index("Exchange hashpartitioning"), text.index("1, Partial"),
    )
    assert final < exchange < partial


def test_ties_leave_unused_columns_unread(spark):
    events = spark.read.parquet(f"{SF_DIR}/events.parquet")
    latest = dedup.keep_latest(events, "user_id", "ts", ties=[F.col("event_id")])
    assert "props" not in plan(latest.select("user_id", "value"))


def test_flattening_reads_only_the_named_nested_fields(spark, tmp_path):
    schema = schemas.bronze("video")
    spark.createDataFrame([], schema).write.parquet(str(tmp_path / "b"))
    bronze = spark.read.schema(schema).parquet(str(tmp_path / "b"))
    text = plan(flatten.video_stats(bronze).select("video_id", "title", "views"))
    read = text[text.index("ReadSchema"):]
    assert "title" in read
    assert "viewCount" in read
    for unread in ("description", "likeCount", "thumbnails", "tags"):
        assert unread not in read


def test_report_filters_reach_the_scan(star):
    text = plan(reports.most_engaging_videos(star))
    assert "GreaterThan(views,10000)" in text
    assert "thumbnail_url" not in text


def test_top_lists_shuffle_ids_only(shuffled, star):
    """The long side of the join that ranks carries the video id and nothing else;
    descriptions are fetched by broadcasting the few rows that remain."""
    text = plan(reports.top_trending_videos(star))
    ranking, describing = text.split("BroadcastExchange", 1)[1].rsplit("FileScan", 1)
    assert "LeftSemi" in ranking
    assert ranking.count("ReadSchema: struct<video_id:string>") == 1
    assert "title#" not in ranking
    assert "title#" in describing
    assert "Exchange" not in ranking.rsplit("FileScan", 1)[1]  # on the way to the join
    assert "TakeOrderedAndProject(limit=20" in text
    assert "rangepartitioning" not in text


@pytest.mark.parametrize(
    "report",
    [reports.top_performing_categories, reports.monthly_trend_analysis, reports.weekend_vs_weekday],
)
def test_group_reports_total_before_they_join(shuffled, star, report):
    """Below the join on the fact side there is already a finished aggregate."""
    text = plan(report(star))
    below = text[text.index("SortMergeJoin"):]
    fact_side = below[: below.index("ReadSchema")]
    assert fact_side.count("HashAggregate") == 2


def test_unique_facts_are_counted_without_shuffling_their_ids(star):
    counted = replace(star, unique_videos=True)
    for report in (reports.channel_performance, reports.summary):
        assert plan(report(star)).count("Aggregate(") == 4
        assert plan(report(counted)).count("Aggregate(") == 2


def test_marts_keep_hash_aggregates(spark):
    stats = inputs.video_stats(spark, SF_DIR)
    text = plan(marts.channel_performance(stats, inputs.AS_OF))
    rows_side = text[text.index("Exchange hashpartitioning(channel_id"):]
    assert "SortAggregate" in text  # over about one row per channel
    assert "HashAggregate(keys=[channel_id" in rows_side
    text = plan(marts.category_performance(stats, inputs.categories(spark, SF_DIR), inputs.AS_OF))
    assert "SortAggregate" not in text


def test_library_code_collects_nothing_and_broadcasts_only_limited_rows():
    from pathlib import Path

    import reelhouse

    root = Path(reelhouse.__file__).parent
    files = [p for p in root.rglob("*.py") if "llm" not in p.relative_to(root).parts]
    source = "".join(p.read_text() for p in files).replace("(``.toPandas()``)", "")
    for call in (".collect()", ".toPandas()", "localCheckpoint", ".rdd"):
        assert call not in source, call
    assert source.count("broadcast(") == 1
    assert "F.broadcast(best)" in source


@pytest.mark.parametrize("name", ["top_trending_videos", "most_engaging_videos", "fastest_growing_videos", "tag_count_vs_views"])
def test_one_mart_state_spares_shuffling_the_fact_by_video(shuffled, star, name):
    report = getattr(reports, name)
    assert "hashpartitioning(video_id" in plan(report(star))
    assert "hashpartitioning(video_id" not in plan(report(replace(star, unique_videos=True)))
