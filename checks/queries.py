"""Every operator as a query over the test tables."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from datetime import datetime, time
from functools import reduce
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import days, inputs, workspace
from checks.inputs import AS_OF, FIRST_RUN, RUN_TS, SECOND_RUN
from reelhouse import schemas, settings
from reelhouse.functions import labels, metrics, parse
from reelhouse.operators import audit, columns, dedup, dimensions, flatten, marts, quality, scd2
from reelhouse.plans import bronze, catalog, dashboard, reports, warehouse
from reelhouse.sinks import landing, lineage, tables
from reelhouse.sources import json_items, layers, marks, shards, storage
from reelhouse.streaming import bronze_stream

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL_FOLDER = str(Path(__file__).parent / "sql")


def query(run: Query) -> Query:
    QUERIES[run.__name__] = run
    return run


def on_star(name: str, report: Callable[[reports.Star], DataFrame]) -> None:
    QUERIES[name] = lambda spark, sf_dir: report(workspace.star(spark, sf_dir))


def _as_text(df: DataFrame, *names: str) -> DataFrame:
    """Times as text, which every engine hashes alike."""
    return df.withColumns({name: F.col(name).cast("string") for name in names})


def _gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.video_engagement(
        inputs.video_stats(spark, sf_dir),
        inputs.trending(spark, sf_dir),
        inputs.categories(spark, sf_dir),
        AS_OF,
    )


# --- reports -------------------------------------------------------------------

on_star("top_trending_videos", reports.top_trending_videos)
on_star("most_engaging_videos", reports.most_engaging_videos)
on_star("fastest_growing_videos", reports.fastest_growing_videos)
on_star("channel_performance", reports.channel_performance)
on_star("top_performing_categories", reports.top_performing_categories)
on_star("monthly_trend", reports.monthly_trend_analysis)
on_star("weekend_vs_weekday", reports.weekend_vs_weekday)
on_star("tag_count_vs_views", reports.tag_count_vs_views)
on_star("summary_kpis", reports.summary)
# The same two without relying on one fact row per video.
on_star(
    "channel_performance_distinct",
    lambda star: reports.channel_performance(replace(star, unique_videos=False)),
)
on_star(
    "summary_kpis_distinct", lambda star: reports.summary(replace(star, unique_videos=False))
)
on_star("category_top10", reports.category_top)
on_star("top_videos_dashboard", dashboard.top_videos)
on_star("fastest_growing_dashboard", dashboard.velocity)
on_star("monthly_trend_dashboard", dashboard.monthly)
on_star("weekend_vs_weekday_dashboard", reports.weekend_split)
on_star("kpi_texts", dashboard.kpi_texts)


def _of_any_state(report: Callable[[reports.Star], DataFrame]):
    """The report for a fact and dimensions that may come from different states."""
    return lambda star: report(replace(star, unique_videos=False))


on_star("top_trending_any_state", _of_any_state(reports.top_trending_videos))
on_star("most_engaging_any_state", _of_any_state(reports.most_engaging_videos))
on_star("fastest_growing_any_state", _of_any_state(reports.fastest_growing_videos))
on_star("tag_count_any_state", _of_any_state(reports.tag_count_vs_views))


# --- joins and filters of the star ----------------------------------------------


@query
def join_star_inner(spark, sf_dir):
    star = workspace.star(spark, sf_dir)
    return (
        star.fact.join(star.dim_video.select("video_id", "title"), "video_id")
        .join(star.dim_category.select("category_id", "category_name"), "category_id")
        .select("video_id", "title", "category_name", "views")
    )


@query
def join_fact_date(spark, sf_dir):
    star = workspace.star(spark, sf_dir)
    days = star.dim_date.select("date_id", "month_name", "day_of_week", "is_weekend")
    return star.fact.join(days, "date_id").select(
        "video_id", "date_id", "month_name", "day_of_week", "is_weekend"
    )


@query
def join_fact_video(spark, sf_dir):
    star = workspace.star(spark, sf_dir)
    video = star.dim_video.select("video_id", F.col("tag_count").alias("video_tags"))
    return star.fact.join(video, "video_id").select("video_id", "video_tags", "views")


@query
def join_fact_category(spark, sf_dir):
    star = workspace.star(spark, sf_dir)
    return star.fact.join(star.dim_category, "category_id").select(
        "video_id", "category_name", "assignable"
    )


@query
def join_left_dim(spark, sf_dir):
    named = marts.with_category(inputs.videos(spark, sf_dir), inputs.categories(spark, sf_dir))
    return named.select("video_id", "category_id", "category_name")


@query
def filter_threshold(spark, sf_dir):
    fact = workspace.star(spark, sf_dir).fact
    return fact.where(F.col("views") > 10000).select("video_id", "views")


@query
def filter_not_null_key(spark, sf_dir):
    rows = inputs.dirty_videos(spark, sf_dir)
    return rows.where(F.col("title").isNotNull()).groupBy("title").agg(
        F.count("*").alias("rows"), F.sum("views").alias("views")
    )


# --- column functions -----------------------------------------------------------


@query
def engagement_rate(spark, sf_dir):
    return inputs.videos(spark, sf_dir).select(
        "video_id", metrics.engagement_rate().alias("engagement_rate")
    )


@query
def like_ratio(spark, sf_dir):
    return inputs.videos(spark, sf_dir).select("video_id", metrics.like_ratio().alias("like_ratio"))


@query
def view_velocity(spark, sf_dir):
    dated = inputs.videos(spark, sf_dir).withColumn(
        "days_since_published", metrics.days_since(as_of=AS_OF)
    )
    return dated.select(
        "video_id", "days_since_published", metrics.view_velocity().alias("view_velocity")
    )


@query
def year_month_cols(spark, sf_dir):
    return marts.with_year_month(inputs.videos(spark, sf_dir)).select("video_id", "year", "month")


@query
def tag_bucket(spark, sf_dir):
    return inputs.videos(spark, sf_dir).select(
        "video_id", labels.tag_bucket(F.col("tag_count")).alias("tag_group")
    )


@query
def day_type(spark, sf_dir):
    return dimensions.dim_date(inputs.videos(spark, sf_dir)).select(
        "date_id", labels.day_type(F.col("is_weekend")).alias("day_type")
    )


@query
def presentation_cols(spark, sf_dir):
    gold = _gold(spark, sf_dir)
    return gold.select(
        "video_id",
        labels.period(F.date_format("published_at", "MMMM"), F.col("year")).alias("period"),
        labels.shortened(F.col("title"), 40).alias("title_40"),
        labels.shortened(F.col("title"), 9).alias("title_9"),
        labels.in_units(F.col("views"), 1_000_000, 2).alias("views_m"),
        labels.in_units(F.col("view_velocity"), 1_000, 1).alias("views_per_day_k"),
    )


@query
def scalar_functions(spark, sf_dir):
    """One row-wise projection of the scalar functions the library builds on."""
    ts = F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss'Z'")
    orders = inputs.table(spark, sf_dir, "orders")
    return orders.select(
        "o_orderkey",
        parse.to_utc(ts).cast("string").alias("as_timestamp"),
        F.to_date(parse.to_utc(ts)).alias("as_date"),
        parse.to_count(F.col("o_orderpriority")).alias("bad_count"),
        parse.to_count(F.col("o_orderkey").cast("string")).alias("good_count"),
        parse.to_utc(F.col("o_orderstatus")).cast("string").alias("bad_time"),
        dimensions.date_id(F.col("o_orderdate")).alias("date_id"),
        F.date_format("o_orderdate", "MMMM").alias("month_name"),
        F.date_format("o_orderdate", "EEEE").alias("day_name"),
        F.quarter("o_orderdate").alias("quarter"),
        F.dayofweek("o_orderdate").isin(1, 7).alias("weekend"),
        F.datediff(F.lit(AS_OF), F.to_date("o_orderdate")).alias("days"),
        F.greatest(F.lit(None).cast("int"), F.lit(1)).alias("greatest_skips_null"),
        F.coalesce(F.nullif("o_orderstatus", F.lit("F")), F.lit("none")).alias("status"),
        F.round(F.col("o_totalprice") / 7, 2).alias("rounded"),
        F.size(F.split("o_orderpriority", "-")).alias("parts"),
        F.when(F.col("o_totalprice").between(1000, 100000), "low").otherwise("high").alias("band"),
    )


# --- audit and flattening -------------------------------------------------------


@query
def audit_columns(spark, sf_dir):
    events = inputs.table(spark, sf_dir, "events").select("event_id", "event_type")
    return audit.ingestion_columns(events, "youtube_api_trending", RUN_TS)


@query
def source_audit(spark, sf_dir):
    events = inputs.table(spark, sf_dir, "events").select("event_id")
    return audit.item_columns(
        events, "batch_20010901_010000_0a1b2c3d", RUN_TS, "videos.list[trending][cat=10]",
        category="10",
    )


def _bronze_videos(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = inputs.video_items(inputs.videos(spark, sf_dir))
    return audit.ingestion_columns(items, "youtube_api_video_stats", RUN_TS)


@query
def flatten_video_stats(spark, sf_dir):
    return _as_text(flatten.video_stats(_bronze_videos(spark, sf_dir)), "published_at")


@query
def flatten_channel_stats(spark, sf_dir):
    items = audit.ingestion_columns(
        inputs.channel_items(spark, sf_dir), "youtube_api_channel_stats", RUN_TS
    )
    return _as_text(flatten.channel_stats(items), "published_at")


@query
def flatten_categories(spark, sf_dir):
    items = audit.ingestion_columns(
        inputs.category_items(spark, sf_dir), "youtube_api_categories", RUN_TS
    )
    return flatten.categories(items)


@query
def flatten_search_videos(spark, sf_dir):
    found = inputs.search_items(inputs.videos(spark, sf_dir))
    keyword = F.nullif(F.split_part("snippet.title", F.lit(" #"), F.lit(1)), F.lit("5-LOW"))
    items = found.withColumn("_source_keyword", keyword)
    flat = flatten.search_videos(
        audit.ingestion_columns(items, "youtube_api_keyword_search", RUN_TS)
    )
    return _as_text(flat, "published_at")


@query
def extract_video_ids(spark, sf_dir):
    """Ids as plain text, inside a struct, absent from the struct, and empty."""
    plain = F.col("o_orderkey").cast("string")
    urgent = F.col("o_orderpriority") == "1-URGENT"
    raw = (
        F.when(F.col("o_orderstatus") == "F", plain)
        .when(F.col("o_orderstatus") == "O", F.to_json(F.struct(plain.alias("videoId"))))
        .when(urgent, F.lit(""))
        .otherwise(F.to_json(F.struct(plain.alias("playlistId"))))
    )
    ids = inputs.table(spark, sf_dir, "orders").select(parse.video_id(raw).alias("video_id"))
    return ids.where(F.col("video_id").isNotNull())


@query
def select_existing(spark, sf_dir):
    orders = inputs.table(spark, sf_dir, "orders")
    return columns.select_existing(orders, ["o_custkey", "no_such_column", "o_orderkey"])


@query
def conform_channel_input(spark, sf_dir):
    mart = marts.channel_performance(inputs.video_stats(spark, sf_dir), AS_OF)
    return columns.conform_channels(mart).select(
        "channel_id", "channel_name", "country", "subscriber_count", "total_views", "video_count"
    )


# --- quality --------------------------------------------------------------------


def _dirty_rows(df: DataFrame, outcome: str) -> DataFrame:
    return df.select(
        F.lit(outcome).alias("outcome"), "video_id", "title", "channel_id", "views", "likes",
        "comment_count", "ingestion_timestamp",
        (F.col("dq_issue") if "dq_issue" in df.columns else F.lit(None).cast("string")).alias(
            "dq_issue"
        ),
    )


def _both(good: DataFrame, bad: DataFrame) -> DataFrame:
    return _dirty_rows(good, "good").unionByName(_dirty_rows(bad, "bad"))


@query
def dq_completeness(spark, sf_dir):
    rows = inputs.dirty_videos(spark, sf_dir)
    return _both(*quality.completeness(rows, settings.REQUIRED_VIDEO))


@query
def dq_validity(spark, sf_dir):
    rows = inputs.dirty_videos(spark, sf_dir)
    return _both(*quality.validity(rows, settings.NON_NEGATIVE))


@query
def dq_failed_columns(spark, sf_dir):
    judged = quality.judge(inputs.dirty_videos(spark, sf_dir), settings.VIDEO_RULES)
    named = judged.select(F.array_join(quality.FAILED, ",").alias("failed"), quality.ISSUE)
    return named.groupBy("failed", quality.ISSUE).agg(F.count("*").alias("rows"))


@query
def dq_unique_latest(spark, sf_dir):
    events = inputs.table(spark, sf_dir, "events")
    latest = dedup.keep_latest(events, "user_id", "ts", ties=[F.col("event_id").desc()])
    return latest.select("user_id", "event_id", "event_type", "value")


@query
def dq_run_all(spark, sf_dir):
    return _both(*quality.run_checks(inputs.dirty_videos(spark, sf_dir), settings.VIDEO_RULES))


@query
def dq_metrics(spark, sf_dir):
    return quality.check_counts(inputs.dirty_videos(spark, sf_dir), settings.VIDEO_RULES)


@query
def union_quarantine(spark, sf_dir):
    good, incomplete = quality.completeness(
        inputs.dirty_videos(spark, sf_dir), settings.REQUIRED_VIDEO
    )
    _, negative = quality.validity(good, settings.NON_NEGATIVE)
    return columns.union_common([incomplete, negative]).select(
        "video_id", "title", "views", "ingestion_timestamp", "dq_issue"
    )


@query
def empty_like(spark, sf_dir):
    return columns.empty_like(inputs.table(spark, sf_dir, "orders"), dq_issue="string").select(
        "o_orderkey", "o_orderstatus", "dq_issue"
    )


# --- sets and deduplication -----------------------------------------------------


@query
def union_dedup_videos(spark, sf_dir):
    both = marts.combine_videos(inputs.video_stats(spark, sf_dir), inputs.trending(spark, sf_dir))
    return both.select("video_id", "views", "ingestion_timestamp", "source")


@query
def dedup_key(spark, sf_dir):
    lines = inputs.dirty_videos(spark, sf_dir)
    return dedup.unique_key(lines, "video_id").select("video_id", "ingestion_timestamp", "views")


@query
def first_seen_dedup(spark, sf_dir):
    lines = inputs.table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("id"), "l_returnflag", "l_linenumber", "l_partkey", "l_suppkey",
        F.struct("l_linenumber", "l_partkey", "l_suppkey").alias("seq"),
    )
    in_order = [lines.where(F.col("l_returnflag") == flag) for flag in ("R", "A", "N")]
    return dedup.first_seen(in_order, "id", "seq").select(
        "id", "l_returnflag", "l_linenumber", "l_partkey", "l_suppkey"
    )


@query
def distinct_ids(spark, sf_dir):
    return dedup.distinct_ids(inputs.dirty_videos(spark, sf_dir), "video_id")


@query
def distinct_dates(spark, sf_dir):
    return dimensions.distinct_dates(inputs.videos(spark, sf_dir))


# --- marts and dimensions -------------------------------------------------------


@query
def gold_video_engagement(spark, sf_dir):
    return _as_text(_gold(spark, sf_dir), "published_at")


@query
def gold_channel_performance(spark, sf_dir):
    return marts.channel_performance(inputs.video_stats(spark, sf_dir), AS_OF)


@query
def gold_category_performance(spark, sf_dir):
    return marts.category_performance(
        inputs.video_stats(spark, sf_dir), inputs.categories(spark, sf_dir), AS_OF
    ).orderBy(F.desc("total_views"))


@query
def dim_video(spark, sf_dir):
    return _as_text(dimensions.dim_video(_gold(spark, sf_dir)), "published_at")


@query
def dim_category(spark, sf_dir):
    return dimensions.dim_category(inputs.categories(spark, sf_dir))


@query
def dim_date(spark, sf_dir):
    return dimensions.dim_date(inputs.videos(spark, sf_dir))


@query
def fact_video_performance(spark, sf_dir):
    return dimensions.fact_video_performance(_gold(spark, sf_dir))


# --- channel history ------------------------------------------------------------


def _history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scd2.first_load(scd2.prepare(inputs.channels(spark, sf_dir, before=True)), FIRST_RUN)


def _incoming(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scd2.prepare(inputs.channels(spark, sf_dir, before=False))


def _merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scd2.merge(_history(spark, sf_dir), _incoming(spark, sf_dir), SECOND_RUN)


@query
def scd2_first_load(spark, sf_dir):
    return _history(spark, sf_dir).drop("channel_key")


@query
def scd2_changed(spark, sf_dir):
    return scd2.changed_keys(_incoming(spark, sf_dir), _history(spark, sf_dir))


@query
def scd2_new_keys(spark, sf_dir):
    return scd2.new_keys(_incoming(spark, sf_dir), _history(spark, sf_dir))


@query
def scd2_changed_rows(spark, sf_dir):
    return scd2.changed_rows(_incoming(spark, sf_dir), _history(spark, sf_dir))


@query
def scd2_merge(spark, sf_dir):
    return _merged(spark, sf_dir).drop("channel_key")


@query
def scd2_union(spark, sf_dir):
    """The same history put together from the single steps."""
    history, new = _history(spark, sf_dir), _incoming(spark, sf_dir)
    changed = scd2.changed_keys(new, history).withColumn("changed", F.lit(True))
    expires = F.coalesce(F.col("changed"), F.lit(False)) & F.col("is_current")
    updated = history.join(changed, "channel_id", "left").withColumns(
        {
            "effective_end_date": F.when(expires, F.lit(SECOND_RUN)).otherwise(
                F.col("effective_end_date")
            ),
            "is_current": F.col("is_current") & ~expires,
        }
    )
    opened = [
        scd2.first_load(rows, SECOND_RUN)
        for rows in (scd2.changed_rows(new, history), scd2.new_keys(new, history))
    ]
    return columns.union_common([updated.drop("changed"), *opened]).drop("channel_key")


@query
def scd2_as_of(spark, sf_dir):
    orders = inputs.table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.col("o_custkey").cast("string").alias("channel_id"),
        F.when(F.col("o_orderstatus") == "F", F.lit("2025-03-01"))
        .otherwise("2025-07-01")
        .cast("date")
        .alias("asked"),
    )
    found = scd2.as_of(orders, _merged(spark, sf_dir), "asked")
    return found.select("o_orderkey", "channel_id", "asked", "subscriber_count", "video_count")


@query
def surrogate_key(spark, sf_dir):
    merged = _merged(spark, sf_dir)
    return merged.agg(
        F.count("*").alias("versions"), F.count_distinct("channel_key").alias("keys")
    )


# --- what a second day leaves ---------------------------------------------------


@query
def silver_after_append(spark, sf_dir):
    """Rows of a first day, of appends and of a stream, each video's latest."""
    rows = layers.read_table(spark, days.roots_for(spark, sf_dir).silver, "silver_video_stats")
    return rows.select("video_id", "views", "likes", "ingestion_date", "ingestion_timestamp")


@query
def gold_mart_after_update_day(spark, sf_dir):
    mart = layers.read_table(spark, days.roots_for(spark, sf_dir).gold, "gold_video_engagement")
    return mart.select(
        "video_id", "title", "category_name", "views", "engagement_rate", "like_ratio",
        "days_since_published", "view_velocity", "year", "month",
    )


@query
def gold_channels_after_update_day(spark, sf_dir):
    return layers.read_table(
        spark, days.roots_for(spark, sf_dir).gold, "gold_channel_performance"
    )


@query
def gold_categories_after_update_day(spark, sf_dir):
    return layers.read_table(
        spark, days.roots_for(spark, sf_dir).gold, "gold_category_performance"
    )


@query
def channel_history_in_parts(spark, sf_dir):
    """The stored history after two runs, its closed versions in parts of their own."""
    root = storage.scratch(spark, "history")
    for before, day in ((True, FIRST_RUN), (False, SECOND_RUN)):
        warehouse.update_channel_history(
            spark, root, inputs.channels(spark, sf_dir, before), datetime.combine(day, time(1))
        )
    return layers.read_table(spark, root, "dim_channel").drop("channel_key")


# --- sources --------------------------------------------------------------------


def _items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inputs.video_items(inputs.videos(spark, sf_dir))


def _round_trip(spark: SparkSession, sf_dir: str, layout: str) -> DataFrame:
    path = landing.write_items(
        _items(spark, sf_dir), storage.scratch(spark, f"items-{layout}"), layout
    )
    items = json_items.read_items(spark, path, schemas.RAW_ITEMS["video"], layout)
    readable, _ = json_items.split_corrupt(items)
    flat = flatten.video_stats(
        audit.ingestion_columns(readable, "youtube_api_video_stats", RUN_TS)
    )
    return _as_text(flat, "published_at")


@query
def scan_json_array(spark, sf_dir):
    return _round_trip(spark, sf_dir, json_items.ARRAY)


@query
def sink_raw_json(spark, sf_dir):
    return _round_trip(spark, sf_dir, json_items.LINES)


@query
def scan_missing_ok(spark, sf_dir):
    roots = workspace.roots_for(spark, sf_dir)
    out = []
    for name, root in (("present", roots.silver), ("missing", f"{roots.silver}-absent")):
        found = layers.read_table(spark, root, "silver_video_stats") is not None
        rows = layers.read_or_empty(spark, root, "silver_video_stats")
        out.append(
            rows.agg(F.count("*").alias("rows")).select(
                F.lit(name).alias("case_name"), F.lit(found).alias("found"), "rows"
            )
        )
    return out[0].unionByName(out[1])


@query
def scan_layer(spark, sf_dir):
    roots = workspace.roots_for(spark, sf_dir)
    silver = layers.read_table(spark, roots.silver, "silver_video_stats")
    return silver.select("video_id", "views", "likes", "tag_count", "ingestion_date", "source")


@query
def source_map_ingest(spark, sf_dir):
    """Rows and source labels of every bronze table the source map feeds."""
    roots = workspace.roots_for(spark, sf_dir)
    parts = [
        layers.read_table(spark, roots.bronze, spec.table)
        .groupBy("source")
        .agg(F.count("*").alias("rows"))
        .select(F.lit(spec.table).alias("table_name"), "source", "rows")
        for spec in settings.SOURCES
    ]
    return reduce(DataFrame.unionByName, parts)


@query
def bronze_stream_ingest(spark, sf_dir):
    """The landed statistics as a stream: run twice, read once."""
    roots = workspace.roots_for(spark, sf_dir)
    base = storage.scratch(spark, "stream")
    spec = next(s for s in settings.SOURCES if s.table == "bronze_video_stats")
    landed = storage.join(bronze.run_folder(roots, RUN_TS), spec.raw_name)
    for _ in range(2):
        bronze_stream.ingest_new_files(
            spark, landed, spec, storage.join(base, "bronze"), storage.join(base, "bad"),
            storage.join(base, "checkpoint"), RUN_TS,
        ).awaitTermination()
    rows = bronze_stream.with_stream(spark, storage.join(base, "bronze"), spec.table)
    return flatten.video_stats(rows).select("video_id", "views", "likes", "source")


@query
def register_views(spark, sf_dir):
    roots = workspace.roots_for(spark, sf_dir)
    catalog.register_views(spark, roots.warehouse, roots.gold, aliases=True)
    return spark.sql(
        "SELECT c.category_name, count(*) AS videos, max(g.engagement_rate) AS best "
        "FROM fact f JOIN dim_cat c USING (category_id) JOIN gold_video g USING (video_id) "
        "GROUP BY c.category_name"
    )


@query
def external_tables(spark, sf_dir):
    roots = workspace.roots_for(spark, sf_dir)
    database = "reelhouse_check"
    spark.sql(
        f"CREATE DATABASE IF NOT EXISTS {database} LOCATION '{storage.scratch(spark, 'db')}'"
    )
    names = catalog.create_external_tables(spark, roots.warehouse, database)
    parts = [
        spark.table(f"{database}.{name}")
        .agg(F.count("*").alias("rows"))
        .select(F.lit(name).alias("table_name"), "rows")
        for name in names
    ]
    return reduce(DataFrame.unionByName, parts)


@query
def run_sql_file(spark, sf_dir):
    catalog.register_views(spark, workspace.roots_for(spark, sf_dir).warehouse)
    return catalog.run_sql_file(spark, f"{SQL_FOLDER}/category_views.sql")


@query
def run_sql_folder(spark, sf_dir):
    catalog.register_views(spark, workspace.roots_for(spark, sf_dir).warehouse)
    results, _ = catalog.run_sql_folder(spark, SQL_FOLDER)
    days = results["weekday_videos"].select(
        F.lit("weekday_videos").alias("file"), F.col("day_of_week").cast("string").alias("name"),
        "videos", F.lit(None).cast("bigint").alias("likes"),
    )
    categories = results["category_views"].select(
        F.lit("category_views").alias("file"), F.col("category_name").alias("name"),
        F.col("views").alias("videos"), "likes",
    )
    return days.unionByName(categories)


@query
def explode_page_items(spark, sf_dir):
    items = json_items.explode_pages(inputs.keyword_pages(spark, sf_dir))
    return items.select(
        F.col("id.videoId").alias("video_id"), "snippet.title", "_source_keyword"
    )


@query
def rejected_pages(spark, sf_dir):
    pages = json_items.rejected_pages(inputs.keyword_pages(spark, sf_dir))
    return pages.select("_source_keyword", "dq_issue")


def _purchase_marks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last purchase of each user as the mark of their events."""
    events = inputs.table(spark, sf_dir, "events")
    bought = events.where(F.col("event_type") == "purchase")
    return marks.marks_from(bought, "user", "user_id", F.col("ts").cast("timestamp"))


@query
def incremental_read(spark, sf_dir):
    # the time of every seventh user's events is unreadable
    readable = F.when(F.col("user_id") % 7 != 0, F.col("ts").cast("timestamp"))
    events = inputs.table(spark, sf_dir, "events").withColumn("at", readable)
    fresh = marks.rows_since_marks(
        events, _purchase_marks(spark, sf_dir), "user", "user_id", "at", "2024-01-05T00:00:00Z"
    )
    return fresh.select("event_id", "user_id", "event_type")


@query
def watermark_upsert(spark, sf_dir):
    """Marks of purchases advanced by views and by all other events seen later."""
    events = inputs.table(spark, sf_dir, "events")
    landed = [
        marks.marks_from(
            events.where(F.col("event_type") == kind), kind_of, "user_id",
            F.col("ts").cast("timestamp"),
        )
        for kind, kind_of in (("view", "user"), ("click", "clicker"), ("signup", "joiner"), ("error", "failer"))
    ]
    return _as_text(marks.advance(_purchase_marks(spark, sf_dir), *landed), "last_ts")


@query
def sharded_source_union(spark, sf_dir):
    """Three separately read sources with different columns as one labelled frame."""
    parts = {
        "orders": inputs.table(spark, sf_dir, "orders").select(
            F.col("o_orderkey").alias("id"), F.col("o_orderstatus").alias("status")
        ),
        "lines": inputs.table(spark, sf_dir, "lineitem").select(
            F.col("l_orderkey").alias("id"), F.col("l_linestatus").alias("status"),
            F.col("l_linenumber").alias("line"),
        ),
        "events": inputs.table(spark, sf_dir, "events").select(F.col("event_id").alias("id")),
    }
    return (
        shards.union_shards(parts, "_source_category")
        .groupBy("_source_category", "status")
        .agg(
            F.count("*").alias("rows"), F.sum("id").alias("ids"), F.count("line").alias("lines")
        )
    )


@query
def trending_shards(spark, sf_dir):
    listed = shards.label_shards(inputs.videos(spark, sf_dir), "category_id")
    return listed.select("video_id", "category_id", "_source_category")


# --- sinks ----------------------------------------------------------------------


def _silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flat videos of a year's ingestion, one partition per day."""
    narrow = inputs.table(spark, sf_dir, "orders")
    return narrow.select(
        F.col("o_orderkey").cast("string").alias("video_id"),
        F.floor("o_totalprice").cast("bigint").alias("views"),
        F.trunc("o_orderdate", "month").alias("ingestion_date"),
        F.year("o_orderdate").alias("year"),
        F.month("o_orderdate").alias("month"),
    )


def _read_back(spark: SparkSession, root: str, rows: DataFrame) -> DataFrame:
    return layers.read_table(spark, root, "videos", rows.schema)


@query
def sink_append_partitioned(spark, sf_dir):
    """Two appends: every row is there twice."""
    rows, root = _silver(spark, sf_dir), storage.scratch(spark, "append")
    for _ in range(2):
        tables.append(tables.by_partition(rows, ["ingestion_date"]), root, "videos")
    return _read_back(spark, root, rows).select("video_id", "views", "ingestion_date")


@query
def sink_replace_partitions(spark, sf_dir):
    """The months from 2000 on rewritten, the others kept."""
    rows, root = _silver(spark, sf_dir), storage.scratch(spark, "replace")
    tables.overwrite(rows, root, "videos")
    late = rows.where(F.col("ingestion_date") >= F.lit("2000-01-01")).withColumn(
        "views", F.col("views") + 1
    )
    tables.replace_partitions(tables.by_partition(late, ["ingestion_date"]), root, "videos")
    return _read_back(spark, root, rows).select("video_id", "views", "ingestion_date")


@query
def sink_overwrite_partitioned(spark, sf_dir):
    """Two overwrites: only the second is left."""
    rows, root = _silver(spark, sf_dir), storage.scratch(spark, "overwrite")
    tables.overwrite(rows, root, "videos")
    tables.overwrite(rows.withColumn("views", F.col("views") + 1), root, "videos")
    return _read_back(spark, root, rows).select("video_id", "views", "ingestion_date")


@query
def sink_gold(spark, sf_dir):
    """Partitioned by those of the wanted columns that exist."""
    rows, root = _silver(spark, sf_dir), storage.scratch(spark, "gold")
    tables.overwrite_gold(rows, root, "videos", ["year", "month", "no_such_column"])
    return _read_back(spark, root, rows).select("video_id", "views", "year", "month")


@query
def sink_dim(spark, sf_dir):
    root = storage.scratch(spark, "dim")
    tables.overwrite_dimension(
        dimensions.dim_date(inputs.videos(spark, sf_dir)), root, "dim_date"
    )
    return layers.read_table(spark, root, "dim_date")


@query
def sink_fact(spark, sf_dir):
    """Facts without a date have a partition of their own and come back."""
    rows = _silver(spark, sf_dir)
    dated = F.col("views") > 10000
    undated = rows.withColumns(
        {"year": F.when(dated, F.col("year")), "month": F.when(dated, F.col("month"))}
    )
    root = storage.scratch(spark, "fact")
    tables.overwrite_fact(undated, root, "videos")
    return _read_back(spark, root, rows).select("video_id", "views", "year", "month")


@query
def sink_quarantine(spark, sf_dir):
    """Written twice for one run and once for another."""
    _, bad = quality.run_checks(inputs.dirty_videos(spark, sf_dir), settings.VIDEO_RULES)
    root = storage.scratch(spark, "quarantine")
    for day in (FIRST_RUN, FIRST_RUN, SECOND_RUN):
        tables.quarantine(bad, root, "quarantine_video_stats", day)
    kept = spark.read.parquet(storage.join(root, "quarantine_video_stats"))
    return kept.groupBy("quarantine_date", "dq_issue").agg(F.count("*").alias("rows"))


@query
def sink_lineage(spark, sf_dir):
    roots = workspace.roots_for(spark, sf_dir)
    return (
        lineage.read(spark, roots.lineage)
        .select("pipeline", F.explode("tables").alias("t"), "logged_at")
        .select(
            "pipeline", F.col("t.table").alias("table_name"), F.col("t.status").alias("status"),
            F.col("t.rows").alias("rows"), "logged_at",
        )
    )


@query
def layer_row_counts(spark, sf_dir):
    roots = workspace.roots_for(spark, sf_dir)
    found = [
        ("silver", name, layers.read_table(spark, roots.silver, name)) for name in schemas.SILVER
    ]
    found += [("gold", name, layers.read_table(spark, roots.gold, name)) for name in schemas.GOLD]
    found += [
        ("warehouse", name, layers.read_table(spark, roots.warehouse, name))
        for name in schemas.WAREHOUSE
    ]
    parts = [
        df.agg(F.count("*").alias("rows")).select(
            F.lit(layer).alias("layer"), F.lit(name).alias("table_name"), "rows"
        )
        for layer, name, df in found
    ]
    return reduce(DataFrame.unionByName, parts)
