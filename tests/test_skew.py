"""Hot keys: a third of all rows under one key, and results still whole."""

from __future__ import annotations

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from reelhouse.operators import dedup, marts, quality
from reelhouse.plans import reports
from reelhouse.settings import QualityRules
from reelhouse.sources import marks

ROWS, TASKS, KEYS = 120_000, 8, 50


@pytest.fixture
def hot(spark):
    """``k`` is "hot" for a third of the rows; ``at`` is unique and rises with ``v``."""
    return spark.range(0, ROWS, 1, TASKS).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % KEYS)).alias("k"),
        F.col("id").alias("v"),
        F.format_string("%012d", F.col("id")).alias("ingestion_timestamp"),
    )


def records_shuffled(df) -> list[int]:
    """Rows written by each shuffle of the plan that ran, top down."""
    out = []

    def walk(node):
        name = node.nodeName()
        if name == "AdaptiveSparkPlan":
            return walk(node.finalPhysicalPlan())
        if name.endswith("QueryStage"):
            return walk(node.plan())
        if name == "Exchange":
            out.append(node.metrics().get("shuffleRecordsWritten").get().value())
        children = node.children()
        for i in range(children.size()):
            walk(children.apply(i))

    walk(df._jdf.queryExecution().executedPlan())
    return out


def test_latest_per_key_shuffles_one_row_per_task_and_key(hot):
    latest = dedup.keep_latest(hot, "k")
    got = {r.k: r.v for r in latest.collect()}
    assert got["hot"] == ROWS - 3
    assert len(got) == KEYS + 1
    assert records_shuffled(latest) and max(records_shuffled(latest)) <= TASKS * (KEYS + 1)


def test_first_seen_shuffles_one_row_per_task_and_key(hot):
    first = dedup.first_seen([hot, hot], "k", "v")
    assert {r.k: r.v for r in first.collect()}["hot"] == 0
    assert max(records_shuffled(first)) <= 2 * TASKS * (KEYS + 1)


def test_first_seen_of_known_keys_shuffles_once(hot):
    first = dedup.first_seen_of([hot, hot], "k", hot)
    assert len(first.collect()) == KEYS + 1
    shuffled = records_shuffled(first)
    assert len(shuffled) == 1 and shuffled[0] <= 3 * TASKS * (KEYS + 1)


def test_check_counts_total_before_the_shuffle(hot):
    counts = quality.check_counts(hot, QualityRules("k", ("k",), ("v",)))
    row = counts.first()
    assert (row.input_rows, row.unique_rows) == (ROWS, KEYS + 1)
    assert row.duplicates_removed == ROWS - KEYS - 1


def test_marks_total_before_the_shuffle(hot):
    landed = marks.marks_from(hot.withColumn("at", F.timestamp_seconds("v")), "channel", "k", "at")
    assert len(landed.collect()) == KEYS + 1
    assert max(records_shuffled(landed)) <= TASKS * (KEYS + 1)


def test_category_mart_joins_totals(spark, hot):
    stats = hot.select(
        F.col("v").cast("string").alias("video_id"), F.col("k").alias("category_id"),
        F.col("v").alias("views"), F.lit(1).cast("bigint").alias("likes"),
        F.lit(1).cast("bigint").alias("comment_count"),
    )
    names = spark.createDataFrame([("hot", "Hot")], "category_id string, category_name string")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        mart = marts.category_performance(stats, names, date(2025, 1, 1))
        got = {r.category_id: (r.category_name, r.total_videos) for r in mart.collect()}
        assert got["hot"] == ("Hot", ROWS // 3)
        assert sum(n for _, n in got.values()) == ROWS
        assert max(records_shuffled(mart)) <= TASKS * (KEYS + 1)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_date_report_joins_totals(spark):
    fact = spark.range(0, ROWS, 1, TASKS).select(
        F.col("id").cast("string").alias("video_id"),
        F.when(F.col("id") % 3 == 0, "20250101").otherwise("20250106").alias("date_id"),
        F.col("id").alias("views"), F.lit(1).cast("bigint").alias("likes"),
        F.lit(1.0).alias("engagement_rate"),
    )
    days = spark.createDataFrame(
        [("20250101", False), ("20250106", True)], "date_id string, is_weekend boolean"
    )
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        report = reports.weekend_vs_weekday(reports.Star(fact, None, None, days))
        assert {r.day_type: r.total_videos for r in report.collect()} == {
            "Weekday": ROWS // 3, "Weekend": ROWS - ROWS // 3,
        }
        assert max(records_shuffled(report)) <= TASKS * 2
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_hot_source_is_split_when_marks_are_too_large_to_broadcast(spark, hot):
    """Spark splits the hot partition of the join at run time; no row is lost."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "50k",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.shuffle.partitions": "16",
    }
    old = {name: spark.conf.get(name, None) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        known = spark.createDataFrame(
            [("channel", "hot", datetime(1970, 1, 1))],
            "source_type string, source_key string, last_ts timestamp",
        )
        seen = hot.withColumn("at", F.timestamp_seconds("v"))
        fresh = marks.rows_since_marks(seen, known, "channel", "k", "at", "1970-01-01T00:00:00Z")
        assert len(fresh.collect()) == ROWS
        assert "skew=true" in fresh._jdf.queryExecution().executedPlan().toString()
    finally:
        for name, value in old.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)
