"""Whole runs on a few handmade items."""

from __future__ import annotations

import json
import shutil
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from reelhouse import schemas
from reelhouse.plans import bronze, catalog, dashboard, landing, reports
from reelhouse.plans.gold import build_gold
from reelhouse.plans.landing import Pages
from reelhouse.plans.roots import Roots
from reelhouse.plans.run import run_all
from reelhouse.plans.silver import build_silver
from reelhouse.plans.status import FAILED, SKIPPED, WRITTEN, RunFailed
from reelhouse.plans.warehouse import build_warehouse, channel_input
from reelhouse.sinks import lineage
from reelhouse.sources import layers, snapshots

DAY1, DAY2, DAY3, DAY4 = (datetime(2025, 5, day, 1) for day in (1, 2, 3, 4))


def video(n, views="100", title="t", category="1", published="2025-04-01T00:00:00Z"):
    return {
        "id": n,
        "snippet": {
            "title": title, "channelId": "c1", "channelTitle": "Sun", "categoryId": category,
            "publishedAt": published,
        },
        "statistics": {"viewCount": views, "likeCount": "10", "commentCount": "5"},
    }


def channel(subscribers):
    return {
        "id": "c1",
        "snippet": {"title": "Sun", "country": "IN"},
        "statistics": {"subscriberCount": subscribers, "viewCount": "1", "videoCount": "2"},
    }


CATEGORY = {"id": "1", "snippet": {"title": "Film", "assignable": True}}


def put(roots, run_ts, name, items):
    from pathlib import Path

    folder = Path(roots.raw) / f"{run_ts:%Y-%m-%d}"
    folder.mkdir(parents=True, exist_ok=True)
    text = items if isinstance(items, str) else "\n".join(json.dumps(i) for i in items)
    (folder / name).write_text(text)


@pytest.fixture
def roots(tmp_path):
    return Roots.under(str(tmp_path))


def day_one(roots):
    put(roots, DAY1, "raw_video_stats", [
        video("a"), video("b", views="-1"), video("c", title=None), video("d", category="77"),
        video("e", views="abc"),
    ])
    put(roots, DAY1, "raw_trending", [video("a", views="999"), video("z")])
    put(roots, DAY1, "raw_channel_stats", [channel("5")])
    put(roots, DAY1, "raw_categories", [CATEGORY])


def status_of(statuses):
    return {s.table: (s.status, s.rows) for s in statuses}


def content(spark, root, table):
    return sorted(map(tuple, layers.read_table(spark, root, table).collect()), key=repr)


def test_daily_run(spark, roots):
    day_one(roots)
    got = status_of(run_all(spark, roots, DAY1))
    assert got["bronze_video_stats"] == (WRITTEN, 5)
    assert got["bronze_keyword_videos"] == (SKIPPED, None)
    assert got["silver_video_stats"] == (WRITTEN, 3)
    assert got["gold_video_engagement"] == (WRITTEN, 4)
    assert got["fact_video_performance"] == (WRITTEN, 4)
    assert got["dim_channel"] == (WRITTEN, 1)

    mart = layers.read_table(spark, roots.gold, "gold_video_engagement")
    rows = {r.video_id: r for r in mart.collect()}
    assert (rows["a"].views, rows["a"].engagement_rate, rows["a"].category_name) == (100, 15.0, "Film")
    assert (rows["d"].category_name, rows["e"].views, rows["e"].engagement_rate) == (None, None, 0.0)
    assert (rows["a"].days_since_published, rows["a"].year, rows["a"].month) == (30, 2025, 4)

    bad = spark.read.parquet(f"{roots.quarantine}/quarantine_video_stats")
    assert sorted((r.video_id, r.dq_issue[:4]) for r in bad.collect()) == [("b", "Nega"), ("c", "NULL")]
    assert "dq_issue" not in spark.read.parquet(f"{roots.silver}/silver_video_stats").columns


def test_a_repeated_run_leaves_the_same_tables(spark, roots):
    day_one(roots)
    run_all(spark, roots, DAY1)
    tables = [(roots.bronze, "bronze_video_stats"), (roots.silver, "silver_video_stats"),
              (roots.gold, "gold_video_engagement"), (roots.gold, "gold_channel_performance"),
              (roots.warehouse, "fact_video_performance"), (roots.warehouse, "dim_date")]
    before = [content(spark, *t) for t in tables]
    history = sorted(map(tuple, layers.read_table(spark, roots.warehouse, "dim_channel").collect()))
    run_all(spark, roots, DAY1)
    assert [content(spark, *t) for t in tables] == before
    assert sorted(map(tuple, layers.read_table(spark, roots.warehouse, "dim_channel").collect())) == history
    assert spark.read.parquet(f"{roots.quarantine}/quarantine_video_stats").count() == 2


def test_second_day_keeps_the_latest_and_the_history(spark, roots):
    day_one(roots)
    run_all(spark, roots, DAY1)
    put(roots, DAY2, "raw_video_stats", [video("a", views="150")])
    put(roots, DAY2, "raw_channel_stats", [channel("6")])
    run_all(spark, roots, DAY2)
    silver = layers.read_table(spark, roots.silver, "silver_video_stats")
    assert {r.video_id: r.views for r in silver.collect()} == {"a": 150, "d": 100, "e": None}
    assert layers.read_table(spark, roots.bronze, "bronze_video_stats").count() == 6
    versions = layers.read_table(spark, roots.warehouse, "dim_channel")
    assert sorted((r.subscriber_count, r.effective_start_date, r.is_current) for r in versions.collect()) == [
        (5, DAY1.date(), False), (6, DAY2.date(), True),
    ]


def test_corrupt_text_is_quarantined(spark, roots):
    put(roots, DAY1, "raw_video_stats", json.dumps(video("a")) + '\n{"id": "b", "sn')
    got = status_of(bronze.build_bronze(spark, roots, DAY1))
    assert got["bronze_video_stats"] == (WRITTEN, 1)
    bad = spark.read.parquet(f"{roots.quarantine}/quarantine_bronze_video_stats").collect()
    assert [(r.dq_issue, r._corrupt_record) for r in bad] == [("corrupt_record", '{"id": "b", "sn')]


def test_array_layout(spark, roots):
    put(roots, DAY1, "raw_video_stats", json.dumps([video("a"), video("b")], indent=2))
    got = status_of(bronze.build_bronze(spark, roots, DAY1, layout="array"))
    assert got["bronze_video_stats"] == (WRITTEN, 2)


def test_one_broken_table_does_not_stop_the_others(spark, roots, monkeypatch):
    day_one(roots)
    from reelhouse.sinks import tables

    real = tables.overwrite

    def broken(df, root, table, *rest):
        if "silver_trending/" in f"{root}/{table}":
            raise OSError("disk gone")
        return real(df, root, table, *rest)

    monkeypatch.setattr(tables, "overwrite", broken)
    with pytest.raises(RunFailed, match="disk gone") as failed:
        run_all(spark, roots, DAY1)
    got = status_of(failed.value.statuses)
    assert got["silver_trending"][0] == FAILED
    assert got["silver_video_stats"] == (WRITTEN, 3)
    assert got["fact_video_performance"] == (WRITTEN, 3)
    silver = lineage.read(spark, roots.lineage).where("pipeline = 'silver'").first()
    assert "disk gone" in {t.table: t.error for t in silver.tables}["silver_trending"]


def test_nothing_landed(spark, roots):
    assert {s.status for s in run_all(spark, roots, DAY1)} == {SKIPPED}


def test_channel_mart_stands_in_for_statistics(spark, roots):
    put(roots, DAY1, "raw_video_stats", [video("a")])
    bronze.build_bronze(spark, roots, DAY1)
    build_silver(spark, roots, DAY1)
    build_gold(spark, roots, DAY1)
    row = channel_input(spark, roots).first()
    assert (row.channel_name, row.subscriber_count, row.video_count) == ("Sun", 0, 1)
    assert status_of(build_warehouse(spark, roots, DAY1))["dim_channel"] == (WRITTEN, 1)


# --- landing -----------------------------------------------------------------------


def pages(spark, kind, *answers):
    return spark.createDataFrame(list(answers), schemas.response_page(kind))


def found(n, published, channel_id="c1"):
    return {"id": {"videoId": n}, "snippet": {"title": "t", "channelId": channel_id, "publishedAt": published}}


def landed(spark, roots, name, kind, run_ts):
    df = spark.read.schema(schemas.RAW_ITEMS[kind]).json(f"{bronze.run_folder(roots, run_ts)}/raw_{name}")
    return df.collect()


def test_landing_is_incremental(spark, roots):
    first = Pages(
        trending=pages(spark, "video", {"items": [video("a")], "_source_category": "0"}),
        trending_by_category=pages(spark, "video", {"items": [video("a", views="7"), video("k")], "_source_category": "1"}),
        channel_videos=pages(
            spark, "search",
            {"items": [found("b", "2025-02-01T00:00:00Z"), found("old", "2024-02-01T00:00:00Z")]},
            {"items": []},
        ),
        keyword_videos=pages(spark, "search", {"items": [found("q", "2025-03-01T00:00:00Z")], "_source_keyword": "k1"}),
        video_stats=pages(spark, "video", {"items": [video("a", views="1"), video("b"), video("q"), video("unasked")]}),
    )
    got = status_of(landing.land(spark, roots, first, DAY1, batch_id="batch_1"))
    assert got["video_stats"][0] == got["marks"][0] == WRITTEN
    assert got["categories"][0] == SKIPPED
    stats = {r.id: r for r in landed(spark, roots, "video_stats", "video", DAY1)}
    assert set(stats) == {"a", "k", "b", "q"}
    assert stats["a"].statistics.viewCount == "100"
    assert stats["a"]._source_category == "0"
    assert {r._batch_id for r in stats.values()} == {"batch_1"}
    assert {r._ingestion_ts for r in stats.values()} == {"2025-05-01T01:00:00Z"}
    assert [r.id.videoId for r in landed(spark, roots, "channel_videos", "search", DAY1)] == ["b"]
    rejected = spark.read.parquet(f"{roots.quarantine}/quarantine_pages_channel_videos")
    assert [r.dq_issue for r in rejected.collect()] == ["empty items"]

    marks = lambda: {(r[0], r[1]): str(r[2]) for r in landing.read_marks(spark, roots).collect()}
    assert marks() == {
        ("channel", "c1"): "2025-02-01 00:00:00", ("keyword", "k1"): "2025-03-01 00:00:00",
    }
    second = Pages(
        channel_videos=pages(
            spark, "search",
            {"items": [found("b", "2025-02-01T00:00:00Z"), found("n", "2025-02-03T00:00:00Z"),
                       found("x", "2025-01-15T00:00:00Z")]},
        )
    )
    landing.land(spark, roots, second, DAY2)
    fresh = landed(spark, roots, "channel_videos", "search", DAY2)
    assert sorted(r.id.videoId for r in fresh) == ["b", "n"]
    assert marks() == {
        ("channel", "c1"): "2025-02-03 00:00:00", ("keyword", "k1"): "2025-03-01 00:00:00",
    }


def test_marks_may_follow_the_run_time(spark, roots):
    answer = Pages(channel_videos=pages(spark, "search", {"items": [found("b", "2025-02-01T00:00:00Z")]}))
    landing.land(spark, roots, answer, DAY1, mark_at_run_time=True)
    row, = landing.read_marks(spark, roots).collect()
    assert row.last_ts == DAY1


def test_an_empty_landing_moves_no_mark(spark, roots):
    answer = Pages(channel_videos=pages(spark, "search", {"items": [found("b", "2020-02-01T00:00:00Z")]}))
    landing.land(spark, roots, answer, DAY1)
    assert landing.read_marks(spark, roots).count() == 0


def test_a_quiet_day(spark, roots):
    """Searches bring only old items, trending is there, one answer is unusable."""
    answer = Pages(
        trending=pages(spark, "video", {"items": [video("a")], "_source_category": "0"}, {"items": []}),
        channel_videos=pages(spark, "search", {"items": [found("old", "2020-02-01T00:00:00Z")]}, {"items": None}),
        video_stats=pages(spark, "video", {"items": [video("x")]}, {"items": []}),
    )
    got = status_of(run_all(spark, roots, DAY1, pages=answer))
    assert got["video_stats"][0] == got["silver_trending"][0] == WRITTEN
    assert FAILED not in {status for status, _ in got.values()}
    assert [r.id for r in landed(spark, roots, "video_stats", "video", DAY1)] == ["a"]
    for name, reason in (("trending", "empty items"), ("channel_videos", "no items"), ("video_stats", "empty items")):
        bad = spark.read.parquet(f"{roots.quarantine}/quarantine_pages_{name}").collect()
        assert [r.dq_issue for r in bad] == [reason], name
    unasked = spark.read.parquet(f"{roots.quarantine}/quarantine_unrequested_video_stats").collect()
    assert [(r.id, r.dq_issue) for r in unasked] == [("x", "not requested")]


def test_a_day_whose_items_were_dropped_takes_no_second_run(spark, roots):
    answer = Pages(trending=pages(spark, "video", {"items": [video("a")], "_source_category": "0"}))
    run_all(spark, roots, DAY1, pages=answer, keep_landed=["raw_video_stats"])
    assert landing.storage.child_folders(spark, bronze.run_folder(roots, DAY1)) == ["raw_video_stats"]
    run_all(spark, roots, DAY1)  # a repeat leaves bronze as it is
    assert spark.read.parquet(f"{roots.bronze}/bronze_trending").count() == 1
    later = DAY1.replace(minute=59)
    with pytest.raises(RunFailed, match="dropped"):
        run_all(spark, roots, later, pages=answer)
    assert spark.read.parquet(f"{roots.bronze}/bronze_trending").count() == 1


def test_statistics_without_a_search_are_kept(spark, roots):
    answer = Pages(video_stats=pages(spark, "video", {"items": [video("x")]}, {"items": []}))
    assert status_of(landing.land(spark, roots, answer, DAY1))["video_stats"][0] == WRITTEN
    assert [r.id for r in landed(spark, roots, "video_stats", "video", DAY1)] == ["x"]


def test_statistics_are_landed_in_rounds(spark, roots, monkeypatch):
    ids = [f"v{n}" for n in range(40)]
    answer = Pages(
        trending=pages(spark, "video", {"items": [video(i) for i in ids[:10]], "_source_category": "0"}),
        channel_videos=pages(spark, "search", {"items": [found(i, "2025-02-01T00:00:00Z") for i in ids]}),
        video_stats=pages(spark, "video", {"items": [video(i) for i in [*ids, "x"]]}, {"items": [video("v1")]}),
    )
    rounds = []
    write = landing.landing.write_lines
    monkeypatch.setattr(landing.tables, "ROUND_BYTES", 1)
    monkeypatch.setattr(
        landing.landing, "write_lines", lambda df, path, *more: (rounds.append((path, df.count())), write(df, path, *more))[1]
    )
    assert status_of(landing.land(spark, roots, answer, DAY1))["video_stats"][0] == WRITTEN
    assert sorted(r.id for r in landed(spark, roots, "video_stats", "video", DAY1)) == sorted(ids)
    sizes = [n for path, n in rounds if path.endswith("raw_video_stats")]
    assert len(sizes) == 4 and sum(sizes) == 40 and max(sizes) < 25


def _unrequested_looked_for(monkeypatch):
    """Whether statistics nobody asked for are looked for, run by run."""
    looked, quarantine = [], landing.tables.quarantine

    def noted(rows, root, table, *args, **more):
        if table == "quarantine_unrequested_video_stats":
            looked.append(more.get("any_rows", True))
        return quarantine(rows, root, table, *args, **more)

    monkeypatch.setattr(landing.tables, "quarantine", noted)
    return looked


def test_unrequested_statistics_are_looked_for_only_when_some_came(spark, roots, monkeypatch):
    looked = _unrequested_looked_for(monkeypatch)

    def answer(*ids, trending=("t",)):
        return Pages(
            trending=pages(spark, "video", {"items": [video(i) for i in trending], "_source_category": "0"}),
            channel_videos=pages(spark, "search", {"items": [found(i, "2025-02-01T00:00:00Z") for i in ("a", "b")]}),
            video_stats=pages(spark, "video", {"items": [video(i) for i in ids]}),
        )

    bad = lambda: spark.read.parquet(f"{roots.quarantine}/quarantine_unrequested_video_stats")
    landing.land(spark, roots, answer("a", "b", "b"), DAY1)
    assert looked == [False]
    assert sorted(r.id for r in landed(spark, roots, "video_stats", "video", DAY1)) == ["a", "b", "t"]
    # ids without a plain text are none that a search gives; trending does not ask for a video
    odd = [None, "", json.dumps({"videoId": "a"}), "x", "x", "t"]
    landing.land(spark, roots, answer("a", *odd), DAY1)
    assert looked == [False, True]
    assert sorted(r.id for r in landed(spark, roots, "video_stats", "video", DAY1)) == ["a", "t"]
    assert sorted(map(repr, (r.id for r in bad().collect()))) == sorted(map(repr, odd))
    # a repeat without them takes back what the run had put there
    landing.land(spark, roots, answer("a", "b"), DAY1)
    assert looked == [False, True, False] and bad().count() == 0
    # one that the choice does not come across, as its id is no text of its own
    landing.land(spark, roots, answer("a", None), DAY2)
    assert looked[-1] is True and [r.id for r in bad().collect()] == [None]


def test_chosen_statistics_are_landed_as_their_texts(spark, roots, monkeypatch):
    """Texts are not read and written again: the lines are those the choice was made of."""
    kept = []
    write = landing.landing.write_lines
    monkeypatch.setattr(
        landing.landing, "write_lines",
        lambda df, path, *more: (kept.append((path.rsplit("/", 1)[1], df)), write(df, path, *more))[1],
    )
    odd = video("a", title='q"\\ \n\t\u2028 \u00e9 \U0001f600') | {"contentDetails": {}}
    answer = Pages(
        channel_videos=pages(spark, "search", {"items": [found(i, "2025-02-01T00:00:00Z") for i in "ab"]}),
        video_stats=pages(spark, "video", {"items": [odd, video("b", views=None)]}),
    )
    landing.land(spark, roots, answer, DAY1)
    frames = [df for name, df in kept if name == "raw_video_stats"]
    assert frames and all("JsonToStructs" not in df._jdf.queryExecution().toString() and "from_json" not in df._jdf.queryExecution().toString() for df in frames)
    a, b = sorted(landed(spark, roots, "video_stats", "video", DAY1), key=lambda r: r.id)
    assert (a.snippet.title, a.contentDetails.duration) == (odd["snippet"]["title"], None)
    assert (b.statistics.viewCount, b.statistics.likeCount, b._ingestion_ts) == (None, "10", "2025-05-01T01:00:00Z")


def test_without_marks_searches_are_not_shuffled(spark, roots):
    rows = spark.range(9).selectExpr("cast(id as string) as k", "timestamp'2025-02-01' as at")
    fresh = landing.marks.rows_since_marks(rows, landing.read_marks(spark, roots), "channel", "k", "at")
    plan = fresh._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Join" not in plan
    assert fresh.count() == 9


def test_a_second_run_of_a_day_adds_to_the_first(spark, roots):
    def search(*ids):
        return pages(spark, "search", {"items": [found(n, f"2025-02-0{day}T00:00:00Z") for n, day in ids]}, {"items": []})

    late = datetime(2025, 5, 1, 13)
    run_all(spark, roots, DAY1, pages=Pages(channel_videos=search(("m1", 1), ("m2", 2))))
    for _ in range(2):  # a repeat changes nothing
        run_all(spark, roots, late, pages=Pages(channel_videos=search(("m2", 2), ("n1", 3))))
        rows = layers.read_table(spark, roots.bronze, "bronze_channel_videos").collect()
        assert sorted(r.id.videoId for r in rows) == ["m1", "m2", "m2", "n1"]
        silver = layers.read_table(spark, roots.silver, "silver_channel_videos")
        assert sorted(r.video_id for r in silver.collect()) == ["m1", "m2", "n1"]
        assert spark.read.parquet(f"{roots.quarantine}/quarantine_pages_channel_videos").count() == 2


def test_items_without_a_readable_time_are_kept(spark, roots):
    items = [found("a", None), found("b", "yesterday"), found("c", "2025-02-01T00:00:00Z")]
    landing.land(spark, roots, Pages(channel_videos=pages(spark, "search", {"items": items})), DAY1)
    assert sorted(r.id.videoId for r in landed(spark, roots, "channel_videos", "search", DAY1)) == ["a", "b", "c"]


def test_answers_in_parts(spark, roots):
    parts = {
        "k1": pages(spark, "search", {"items": [found("q", "2025-03-01T00:00:00Z")]}).drop("_source_keyword"),
        "k2": pages(spark, "search", {"items": [found("r", "2025-03-02T00:00:00Z")]}).drop("_source_keyword"),
    }
    landing.land(spark, roots, Pages(keyword_videos=parts), DAY1)
    rows = landed(spark, roots, "keyword_videos", "search", DAY1)
    assert sorted((r.id.videoId, r._source_keyword) for r in rows) == [("q", "k1"), ("r", "k2")]


def test_backfilled_and_rewritten_days_reach_silver(spark, roots):
    def day(run_ts, *videos):
        put(roots, run_ts, "raw_video_stats", list(videos))
        bronze.build_bronze(spark, roots, run_ts)
        build_silver(spark, roots, run_ts)

    def silver():
        return {r.video_id: r.views for r in layers.read_table(spark, roots.silver, "silver_video_stats").collect()}

    day(DAY1, video("a"))
    day(DAY3, video("c"), video("a", views="3"))
    day(DAY2, video("b"), video("a", views="2"))  # landed late
    day(DAY4, video("d"))
    assert silver() == {"a": 3, "b": 100, "c": 100, "d": 100}
    put(roots, DAY2, "raw_video_stats", [video("b", views="8"), video("e")])  # corrected
    bronze.build_bronze(spark, roots, DAY2)
    day(datetime(2025, 5, 5, 1), video("f"))
    by_days = silver()
    assert by_days == {"a": 3, "b": 8, "c": 100, "d": 100, "e": 100, "f": 100}
    run_all(spark, roots, datetime(2025, 5, 5, 1), from_scratch=True)
    assert silver() == by_days


def test_a_backfill_older_than_the_kept_days(spark, roots):
    for run_ts in (DAY2, DAY3, DAY4):
        put(roots, run_ts, "raw_channel_stats", [channel("5")])
        put(roots, run_ts, "raw_video_stats", [video(f"v{run_ts.day}")])
        run_all(spark, roots, run_ts)
    put(roots, DAY1, "raw_video_stats", [video("v1")])
    got = status_of(run_all(spark, roots, DAY1))
    assert got["silver_video_stats"] == (WRITTEN, 1)
    put(roots, datetime(2025, 5, 5, 1), "raw_video_stats", [video("v5")])
    run_all(spark, roots, datetime(2025, 5, 5, 1))
    silver = layers.read_table(spark, roots.silver, "silver_video_stats")
    assert sorted(r.video_id for r in silver.collect()) == ["v1", "v2", "v3", "v4", "v5"]


def test_quality_counts_are_recorded(spark, roots):
    day_one(roots)
    run_all(spark, roots, DAY1)
    record = lineage.read(spark, roots.lineage).where("pipeline = 'silver'").first()
    checks = {t.table: t.checks for t in record.tables}["silver_video_stats"]
    assert (checks["input_rows"], checks["complete_bad"], checks["valid_bad"], checks["unique_rows"]) == (5, 1, 1, 3)


def test_reports_as_a_stage(spark, roots, tmp_path, monkeypatch):
    day_one(roots)

    def broken(star):
        return star.fact.selectExpr("raise_error('bad row') as x")

    monkeypatch.setitem(reports.REPORTS, "broken", broken)
    with pytest.raises(RunFailed, match="bad row") as failed:
        run_all(spark, roots, DAY1, reports_to=str(tmp_path / "reports"))
    got = status_of(failed.value.statuses)
    assert got["broken"][0] == FAILED
    assert all(got[name][0] == WRITTEN for name in reports.REPORTS if name != "broken")


def test_history_does_not_restart_silently(spark, roots):
    day_one(roots)
    run_all(spark, roots, DAY1)
    from pathlib import Path

    for done in Path(roots.warehouse, "dim_channel").glob("*/_SUCCESS"):
        done.unlink()
    statuses = {s.table: s for s in build_warehouse(spark, roots, DAY2)}
    assert statuses["dim_channel"].status == FAILED and "start anew" in statuses["dim_channel"].error


# --- catalog and dashboard -----------------------------------------------------------


def test_views_and_sql_files(spark, roots, tmp_path):
    day_one(roots)
    run_all(spark, roots, DAY1)
    names = catalog.register_views(spark, roots.warehouse, roots.gold, aliases=True)
    assert {"fact", "fact_video_performance", "dim_cat", "dim_channel", "gold_chan"} <= set(names)

    folder = tmp_path / "sql"
    folder.mkdir()
    (folder / "b.sql").write_text("-- title\n\nSELECT count(*) AS n -- rows\n  FROM fact;\n")
    (folder / "a.sql").write_text("SELECT no_such_column FROM fact")
    (folder / "c.txt").write_text("not sql")
    results, errors = catalog.run_sql_folder(spark, str(folder))
    assert list(results) == ["b"]
    assert results["b"].first().n == 4
    assert list(errors) == ["a"]

    star = reports.Star.from_views(spark)
    frames = dashboard.frames(star)
    assert set(frames) == {"top_videos", "categories", "monthly", "velocity", "weekend", "summary"}
    assert [r.views for r in frames["top_videos"].collect()] == [100, 100]
    assert frames["monthly"].first().period == "April 2025"
    assert frames["summary"].first().total_videos == 3
    for report in reports.REPORTS.values():
        report(star).collect()


def test_external_tables(spark, roots):
    day_one(roots)
    run_all(spark, roots, DAY1)
    spark.sql("CREATE DATABASE IF NOT EXISTS ext")
    for _ in range(2):
        assert set(catalog.create_external_tables(spark, roots.warehouse, "ext")) == set(schemas.WAREHOUSE)
    fact = spark.table("ext.fact_video_performance")
    assert fact.columns == schemas.columns(schemas.WAREHOUSE["fact_video_performance"])
    assert fact.where("year = 2025 and month = 4").count() == 4
    spark.sql("DROP DATABASE ext CASCADE")
    assert layers.read_table(spark, roots.warehouse, "fact_video_performance").count() == 4


def test_history_is_kept_per_run(spark, roots):
    day_one(roots)
    run_all(spark, roots, DAY1)
    build_warehouse(spark, roots, DAY2)
    assert snapshots.run_times(spark, roots.warehouse, "dim_channel") == [DAY2, DAY1]
    df = layers.read_table(spark, roots.warehouse, "dim_channel")
    assert df.where(F.col("is_current")).count() == 1
    assert df.first().effective_start_date == date(2025, 5, 1)


def test_a_corrected_repeat_forgets_its_first_attempt(spark, roots):
    day_one(roots)
    run_all(spark, roots, DAY1)
    put(roots, DAY2, "raw_channel_stats", [channel("999")])
    put(roots, DAY2, "raw_video_stats", [video("a", views="999"), video("bad", views="-1")])
    run_all(spark, roots, DAY2)
    put(roots, DAY2, "raw_channel_stats", [channel("5")])
    put(roots, DAY2, "raw_video_stats", [video("n")])
    run_all(spark, roots, DAY2)
    versions = layers.read_table(spark, roots.warehouse, "dim_channel").collect()
    assert [(r.subscriber_count, r.is_current) for r in versions] == [(5, True)]
    silver = layers.read_table(spark, roots.silver, "silver_video_stats")
    assert {r.video_id: r.views for r in silver.collect()} == {"a": 100, "d": 100, "e": None, "n": 100}
    bad = spark.read.parquet(f"{roots.quarantine}/quarantine_video_stats")
    assert sorted(r.video_id for r in bad.collect()) == ["b", "c"]


def test_silver_by_days_equals_silver_from_scratch(spark, roots):
    day_one(roots)
    run_all(spark, roots, DAY1)
    put(roots, DAY2, "raw_video_stats", [video("a", views="7"), video("d"), video("n"), video("b")])
    bronze.build_bronze(spark, roots, DAY2)
    # The third day was landed but never refined; the fourth has to take it along.
    put(roots, DAY3, "raw_video_stats", [video("n", views="8")])
    bronze.build_bronze(spark, roots, DAY3)
    build_silver(spark, roots, DAY2)
    put(roots, DAY4, "raw_video_stats", [video("m", views="9"), video("c", title=None)])
    bronze.build_bronze(spark, roots, DAY4)
    build_silver(spark, roots, DAY4)
    by_days = content(spark, roots.silver, "silver_video_stats")
    build_silver(spark, roots, DAY4, from_scratch=True)
    assert content(spark, roots.silver, "silver_video_stats") == by_days
    assert {r[0]: r[9] for r in by_days} == {
        "a": 7, "b": 100, "d": 100, "e": None, "m": 9, "n": 8,
    }


def test_silver_reads_new_days_only(spark, roots):
    day_one(roots)
    run_all(spark, roots, DAY1)
    put(roots, DAY2, "raw_video_stats", [video("a", views="7")])
    bronze.build_bronze(spark, roots, DAY2)
    # Without the first day's files the second day still has its rows.
    shutil.rmtree(f"{roots.bronze}/bronze_video_stats/ingestion_date={DAY1:%Y-%m-%d}")
    build_silver(spark, roots, DAY2)
    silver = layers.read_table(spark, roots.silver, "silver_video_stats")
    assert {r.video_id: r.views for r in silver.collect()} == {"a": 7, "d": 100, "e": None}
    bad = spark.read.parquet(f"{roots.quarantine}/quarantine_video_stats")
    assert bad.count() == 2


def test_empty_landing(spark, roots):
    for name in ("raw_video_stats", "raw_trending", "raw_channel_stats", "raw_categories"):
        put(roots, DAY1, name, "")
    got = status_of(run_all(spark, roots, DAY1))
    assert got["bronze_video_stats"] == got["silver_video_stats"] == (WRITTEN, 0)
    assert got["fact_video_performance"] == got["dim_channel"] == (WRITTEN, 0)
    star = reports.Star.from_warehouse(spark, roots.warehouse)
    assert reports.top_trending_videos(star).collect() == []
    assert reports.summary(star).first().total_videos == 0


def test_reports_on_a_missing_warehouse_are_empty(spark, roots):
    star = reports.Star.from_warehouse(spark, roots.warehouse)
    for name, report in reports.REPORTS.items():
        assert report(star).collect() == [], name
