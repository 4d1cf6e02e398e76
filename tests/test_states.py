"""Commit logs, tables in shared parts, and what a run writes of them."""

from __future__ import annotations

from datetime import date, datetime
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from reelhouse import schemas
from reelhouse.operators import audit, scd2
from reelhouse.plans import silver
from reelhouse.plans.gold import build_gold
from reelhouse.plans.roots import Roots
from reelhouse.plans.warehouse import update_channel_history
from reelhouse.sinks import commits as commits_out
from reelhouse.sinks import tables
from reelhouse.sources import commits, layers, snapshots, states

DAYS = [datetime(2025, 5, day, 1) for day in range(1, 7)]
STATS = next(s for s in silver.TABLES if s.table == "silver_video_stats")


@pytest.fixture
def roots(tmp_path):
    return Roots.under(str(tmp_path))


def videos(spark, first, last, views=100):
    return spark.range(first, last).select(
        F.concat(F.lit("v"), "id").alias("id"),
        F.struct(
            F.lit("t").alias("title"), F.lit("c1").alias("channelId"), F.lit("Sun").alias("channelTitle"),
            F.lit("1").alias("categoryId"), F.lit("2025-04-01T00:00:00Z").alias("publishedAt"),
            F.lit(None).cast("string").alias("description"), F.array(F.lit("x")).alias("tags"),
            F.struct(F.struct(F.lit(None).cast("string").alias("url")).alias("high")).alias("thumbnails"),
        ).alias("snippet"),
        F.struct(F.lit("PT1M").alias("duration")).alias("contentDetails"),
        F.struct(
            F.lit(str(views)).alias("viewCount"), F.lit("10").alias("likeCount"),
            F.lit("5").alias("commentCount"), F.lit("0").alias("favoriteCount"),
        ).alias("statistics"),
    )


def append(roots, items, run_ts):
    tables.append(audit.ingestion_columns(items, "s", run_ts).coalesce(1), roots.bronze, STATS.bronze)


def refine(spark, roots, run_ts, **options):
    checks = {}
    silver.refine(spark, roots, STATS, run_ts, checks=checks, **options)
    return checks[STATS.table]


def content(spark, roots):
    return sorted(map(tuple, layers.read_table(spark, roots.silver, STATS.table).collect()), key=repr)


def written_by_runs(root, table):
    """Part folders with rows, by the run that wrote them."""
    found = {}
    for file in Path(root, table).glob("rows=*/**/*.parquet"):
        found.setdefault(file.relative_to(Path(root, table)).parts[0], set()).add(str(file.parent))
    return found


def test_a_small_day_writes_its_buckets_only(spark, roots):
    append(roots, videos(spark, 0, 400), DAYS[0])
    refine(spark, roots, DAYS[0], buckets=64)
    append(roots, videos(spark, 7, 9, views=5), DAYS[1])
    append(roots, videos(spark, 900, 901), DAYS[0])  # late rows of a day silver holds
    assert refine(spark, roots, DAYS[1])["input_rows"] == 3
    first, second = sorted(written_by_runs(roots.silver, STATS.table).items())
    assert len(first[1]) > 50 and 1 <= len(second[1]) <= 3
    by_days = content(spark, roots)
    assert len(by_days) == 401 and {r[9] for r in by_days} == {100, 5}
    # a quiet day leaves a state and no rows
    assert refine(spark, roots, DAYS[2])["input_rows"] == 0
    assert len(written_by_runs(roots.silver, STATS.table)) == 2
    assert content(spark, roots) == by_days
    refine(spark, roots, DAYS[3], from_scratch=True)
    assert content(spark, roots) == by_days


def test_bronze_is_scanned_once(spark, roots):
    append(roots, videos(spark, 0, 20), DAYS[0])
    read = []
    scan = silver._read

    def counted(*args):
        read.append(args)
        return scan(*args)

    silver._read = counted
    try:
        counts = refine(spark, roots, DAYS[0])
    finally:
        silver._read = scan
    assert len(read) == 1
    assert (counts["input_rows"], counts["unique_rows"], counts["valid_bad"]) == (20, 20, 0)
    assert not list(Path(spark.conf.get("spark.checkpoint.dir")).glob("judged-*"))


def test_silver_shuffles_wide_rows_once(spark, roots, monkeypatch):
    plans = {}
    overwrite = tables.overwrite

    def noted(rows, path, own, by, together):
        plans[path.rsplit("/", 1)[1]] = (rows._jdf.queryExecution().executedPlan().toString(), together)
        return overwrite(rows, path, own, by, together)

    monkeypatch.setattr(tables, "overwrite", noted)
    append(roots, videos(spark, 0, 50), DAYS[0])
    append(roots, videos(spark, 20, 30, 5), DAYS[1])
    refine(spark, roots, DAYS[1])
    plan, together = plans[STATS.table]
    assert plan.count("Exchange ") == 1 and not together
    one_shuffle = content(spark, roots)
    assert len(one_shuffle) == 50 and [r[9] for r in one_shuffle].count(5) == 10
    build_gold(spark, roots, DAYS[1])
    plan, together = plans["gold_video_engagement"]
    assert "Exchange hash" not in plan and not together
    # a key of many rows is reduced before it is moved; the rows are the same
    monkeypatch.setattr(silver, "HOT_ROWS", 1)
    refine(spark, roots, DAYS[2], from_scratch=True)
    assert plans[STATS.table][1]
    assert content(spark, roots) == one_shuffle


def test_a_day_without_a_commit_is_reported(spark, roots):
    append(roots, videos(spark, 0, 3), DAYS[0])
    stray = f"{roots.bronze}/{STATS.bronze}/ingestion_date=2025-05-02"
    audit.ingestion_columns(videos(spark, 3, 5), "s", DAYS[1]).drop("ingestion_date").write.parquet(stray)
    refine(spark, roots, DAYS[0])
    with pytest.raises(RuntimeError, match="2025-05-02"):
        refine(spark, roots, DAYS[1])
    commits_out.adopt(spark, f"{roots.bronze}/{STATS.bronze}")
    refine(spark, roots, DAYS[1])
    assert len(content(spark, roots)) == 5


def test_log_of_appends_and_replacements(spark, tmp_path):
    root, path = str(tmp_path), f"{tmp_path}/t"
    rows = lambda n, day: spark.range(n).withColumn("ingestion_date", F.lit(day)).coalesce(1)
    one, two = date(2025, 1, 1), date(2025, 1, 2)
    tables.append(rows(2, one), root, "t")
    tables.append(rows(3, one).unionByName(rows(1, two)).coalesce(1), root, "t")
    tables.replace_partitions(rows(5, two), root, "t")
    log = commits.read(spark, path)
    assert [(c.number, sorted(c.replaced)) for c in log] == [(0, []), (1, []), (2, ["ingestion_date=2025-01-02"])]
    held = commits.current(log)
    assert [c.number for c in held["ingestion_date=2025-01-01"]] == [0, 1]
    assert [c.number for c in held["ingestion_date=2025-01-02"]] == [2]
    assert commits.unlogged(spark, path, log) == []
    assert commits_out.record(spark, path) is None
    assert spark.read.parquet(path).count() == 10


def test_parts_in_use_survive_pruning(spark, roots):
    append(roots, videos(spark, 0, 50), DAYS[0])
    refine(spark, roots, DAYS[0], buckets=16)
    for k, run_ts in enumerate(DAYS[1:]):
        append(roots, videos(spark, 1, 2, views=k), run_ts)
        refine(spark, roots, run_ts, keep=2)
    assert len(snapshots.run_times(spark, roots.silver, STATS.table)) == 2
    found = content(spark, roots)
    assert len(found) == 50 and {r[9] for r in found} == {100, 4}
    state = states.load(spark, roots.silver, STATS.table, DAYS[-1])
    folders = {f"{roots.silver}/{STATS.table}/{f}" for places in state.parts.values() for f in places}
    on_disk = {f for found in written_by_runs(roots.silver, STATS.table).values() for f in found}
    # what is left beyond the newest state is the one part the state before it refers to
    assert folders <= on_disk and len(on_disk - folders) == 1


def test_marts_write_changed_buckets_only(spark, roots):
    append(roots, videos(spark, 0, 200), DAYS[0])
    refine(spark, roots, DAYS[0], buckets=32)
    build_gold(spark, roots, DAYS[0])
    assert layers.read_table(spark, roots.gold, "gold_video_engagement").first().days_since_published == 30
    build_gold(spark, roots, DAYS[1])  # quiet: only the day it is measured on
    tables_ = ("gold_video_engagement", "gold_channel_totals", "gold_category_totals")
    for table in tables_[:2]:
        assert len(written_by_runs(roots.gold, table)) == 1, table
    assert layers.read_table(spark, roots.gold, "gold_video_engagement").first().days_since_published == 31
    append(roots, videos(spark, 3, 4, views=9000), DAYS[2])
    refine(spark, roots, DAYS[2])
    build_gold(spark, roots, DAYS[2])
    for table in tables_[:2]:
        assert [len(parts) for _, parts in sorted(written_by_runs(roots.gold, table).items())][1:] == [1], table
    mart = layers.read_table(spark, roots.gold, "gold_channel_performance").first()
    assert (mart.total_videos, mart.max_views, mart.total_views) == (200, 9000, 199 * 100 + 9000)
    # the largest goes again: a maximum is not kept beyond its row
    tables.replace_partition(
        audit.ingestion_columns(videos(spark, 3, 4, views=1), "s", DAYS[2]), roots.bronze, STATS.bronze, DAYS[2].date()
    )
    refine(spark, roots, DAYS[3])
    build_gold(spark, roots, DAYS[3])
    mart = layers.read_table(spark, roots.gold, "gold_channel_performance").first()
    assert (mart.max_views, mart.min_views, mart.total_views) == (100, 1, 199 * 100 + 1)


def test_closed_versions_stay_where_they_are(spark, roots, rows):
    schema = (
        "channel_id string, channel_name string, country string, subscriber_count bigint,"
        " total_views bigint, video_count bigint, ingestion_timestamp string"
    )
    merged = None
    for k, run_ts in enumerate(DAYS[:4]):
        seen = rows(schema, *[(c, c, "IN", k if c == "a" else 1, 1, 1, f"{run_ts}") for c in ("a", "b", "c")])
        update_channel_history(spark, roots.warehouse, seen, run_ts)
        merged = scd2.first_load(scd2.prepare(seen), run_ts.date()) if merged is None else scd2.merge(
            merged, scd2.prepare(seen), run_ts.date()
        )
    found = layers.read_table(spark, roots.warehouse, "dim_channel")
    assert found.columns == schemas.columns(schemas.WAREHOUSE["dim_channel"])
    assert sorted(map(tuple, found.collect()), key=repr) == sorted(map(tuple, merged.collect()), key=repr)
    state = states.load(spark, roots.warehouse, "dim_channel", DAYS[3])
    closed = {part: places for part, places in state.parts.items() if part.endswith("is_current=false")}
    # each closed version lies in the folder of the run that closed it
    assert [places[0].split("-")[0] for _, places in sorted(closed.items())] == [
        f"rows={run_ts:%Y%m%dT%H%M%S}" for run_ts in DAYS[1:4]
    ]


@pytest.mark.parametrize("how", ["inner", "left"])
def test_as_of_matches_the_range_join(spark, rows, how):
    facts = spark.range(600).select(
        "id",
        F.when(F.col("id") % 10 < 6, F.lit("hot")).when(F.col("id") % 10 < 9, F.concat(F.lit("c"), F.col("id") % 7)).alias("channel_id"),
        F.when(F.col("id") % 50 != 3, F.expr("date_add(date'2025-01-01', cast(id % 211 as int))")).alias("asked"),
        F.lit("clash").alias("country"),
    )
    versions = []
    for channel, step in (("hot", 3), ("c1", 40), ("c2", 500), ("c5", 33)):
        starts = list(range(20, 230, step))
        for a, b in zip(starts, [*starts[1:], None], strict=True):
            if channel != "c5" or a % 2:  # gaps
                versions.append((channel, a, b))
    day = "date_add(date'2025-01-01', {})".format
    history = rows("channel_id string, a int, b int", *versions).select(
        F.xxhash64("channel_id", "a").alias("channel_key"), "channel_id", F.col("a").alias("subscriber_count"),
        F.expr(day("a")).alias("effective_start_date"),
        F.coalesce(F.expr(day("b")), F.lit(date(9999, 12, 31))).alias("effective_end_date"),
    )
    other = history.withColumnRenamed("channel_id", "_c")
    within = (F.col("channel_id") == F.col("_c")) & (F.col("effective_start_date") <= F.col("asked")) & (F.col("asked") < F.col("effective_end_date"))
    expected = facts.join(other, within, how).drop("_c")
    found = scd2.as_of(facts, history, "asked", how, block_days=16, most=20)
    assert found.columns == expected.columns
    assert sorted(map(tuple, found.collect()), key=repr) == sorted(map(tuple, expected.collect()), key=repr)


def test_as_of_never_pairs_facts_with_versions(spark, rows):
    """One channel with a third of the facts and many versions: no step has more rows
    than facts and versions together, and no task most of the facts."""
    facts = spark.range(30_000).selectExpr("if(id % 3 = 0, 'hot', concat('c', id)) as channel_id", "date_add(date'2020-01-01', cast(id % 900 as int)) as asked")
    history = spark.range(900).selectExpr(
        "id as channel_key", "'hot' as channel_id", "date_add(date'2020-01-01', cast(id as int)) as effective_start_date",
        "date_add(date'2020-01-01', cast(id + 1 as int)) as effective_end_date",
    )
    found = scd2.as_of(facts, history, "asked", most=2000)
    assert found.count() == 10_000
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        spread = found.groupBy(F.spark_partition_id()).count()
        assert spread.agg(F.max("count")).first()[0] < 5_000
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "effective_start_date" not in "".join(
        line for line in plan.splitlines() if "Join" in line
    )


def test_large_tables_are_written_in_rounds(spark, roots, monkeypatch):
    append(roots, videos(spark, 0, 200), DAYS[0])
    append(roots, videos(spark, 50, 80, 5), DAYS[1])
    refine(spark, roots, DAYS[1])
    build_gold(spark, roots, DAYS[1])
    mart = lambda: sorted(map(tuple, layers.read_table(spark, roots.gold, "gold_video_engagement").collect()), key=repr)
    silver_whole, gold_whole = content(spark, roots), mart()
    written = {}
    write = tables._write

    def noted(rows, path, *args, **options):
        written.setdefault(path.split("/rows=")[0].rsplit("/", 1)[1], []).append(rows.count())
        return write(rows, path, *args, **options)

    monkeypatch.setattr(tables, "ROUND_BYTES", 1)
    monkeypatch.setattr(tables, "_write", noted)
    refine(spark, roots, DAYS[2], from_scratch=True)
    build_gold(spark, roots, DAYS[2])
    for table in (STATS.table, "gold_video_engagement"):
        assert len(written[table]) == 4 and sum(written[table]) == 200 and max(written[table]) < 100
    assert content(spark, roots) == silver_whole and len(mart()) == len(gold_whole)
    # a further day reads and writes the buckets it touches, in rounds too
    append(roots, videos(spark, 199, 202, 7), DAYS[3])
    assert refine(spark, roots, DAYS[3])["input_rows"] == 3
    found = content(spark, roots)
    assert len(found) == 202 and [r[9] for r in found].count(7) == 3 and [r[9] for r in found].count(5) == 30
    bad = layers.read_table(spark, roots.silver, STATS.table)
    assert "_round" not in bad.columns


def test_a_table_of_rounds_is_complete_with_the_last(spark, tmp_path):
    frames = [spark.range(3).withColumn("k", F.lit("a")), spark.range(2).select(F.raise_error(F.lit("x")).alias("id"), F.lit("b").alias("k"))]
    with pytest.raises(Exception, match="x"):
        tables.overwrite(frames, str(tmp_path), "t", ("k",))
    assert not (tmp_path / "t" / "_SUCCESS").exists()
    tables.overwrite([frames[0], frames[0]], str(tmp_path), "t", ("k",))
    assert (tmp_path / "t" / "_SUCCESS").exists()
    assert spark.read.parquet(f"{tmp_path}/t").count() == 6
