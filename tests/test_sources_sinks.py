from __future__ import annotations

import json
import time
from datetime import date, datetime
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from reelhouse import schemas, settings
from reelhouse.operators import flatten
from reelhouse.sinks import landing, lineage, tables
from reelhouse.sinks import snapshots as snapshots_out
from reelhouse.sources import json_items, layers, marks, shards, snapshots, storage
from reelhouse.streaming import bronze_stream

VIDEO = schemas.RAW_ITEMS["video"]
DAY1, DAY2 = date(2025, 1, 1), date(2025, 1, 2)
RUN_TS = datetime(2025, 1, 1, 6)


def _items(spark, *ids):
    return spark.createDataFrame([{"id": i, "snippet": {"title": "ü, \"q\""}} for i in ids], VIDEO)


# --- JSON -----------------------------------------------------------------------


@pytest.mark.parametrize("layout", [json_items.LINES, json_items.ARRAY])
@pytest.mark.parametrize("parts", [1, 3])
def test_layouts_round_trip(spark, tmp_path, layout, parts):
    ids = [f"v{i}" for i in range(50)]
    path = landing.write_items(_items(spark, *ids).repartition(parts), str(tmp_path / "x"), layout)
    good, bad = json_items.split_corrupt(json_items.read_items(spark, path, VIDEO, layout))
    assert sorted(r.id for r in good.collect()) == sorted(ids)
    assert {r.snippet.title for r in good.collect()} == {'ü, "q"'}
    assert bad.collect() == []


def test_array_layout_is_json(spark, tmp_path):
    path = landing.write_items(_items(spark, "a", "b").coalesce(1), str(tmp_path / "x"), "array")
    text, = [p.read_text() for p in Path(path).glob("part-*")]
    assert [item["id"] for item in json.loads(text)] == ["a", "b"]


def test_landed_lines_are_small_files_for_many_tasks(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(landing, "FILE_ITEMS", 1000)
    items = _items(spark, *[f"v{i}" for i in range(3000)]).coalesce(1)
    files = list(Path(landing.write_items(items, str(tmp_path / "x"))).glob("part-*"))
    assert len(files) == 3
    plain = sum(len(row) for row in items.toJSON().collect())
    assert sum(f.stat().st_size for f in files) * 5 < plain
    assert json_items.read_items(spark, str(tmp_path / "x"), VIDEO).select("id").distinct().count() == 3000


def test_written_arrays_are_split_at_items(spark, tmp_path):
    ids = [f"v{i}" for i in range(500)]
    confs = {"spark.sql.files.maxPartitionBytes": "4096", "spark.sql.execution.arrow.maxRecordsPerBatch": "70"}
    for name, value in confs.items():
        spark.conf.set(name, value)
    try:
        path = landing.write_items(_items(spark, *ids).coalesce(1), str(tmp_path / "x"), json_items.ARRAY)
        file, = Path(path).glob("part-*")
        assert [item["id"] for item in json.loads(file.read_text())] == ids
        found = json_items.read_items(spark, path, VIDEO, json_items.ARRAY)
        tasks = found.select(F.spark_partition_id()).distinct().count()
        good, bad = json_items.split_corrupt(found)
        read = [(r.id, r.title) for r in good.select("id", "snippet.title").collect()]
        assert bad.collect() == []
    finally:
        for name in confs:
            spark.conf.unset(name)
    assert tasks > 5
    assert sorted(read) == sorted((i, 'ü, "q"') for i in ids)


def test_indented_array_of_an_api_dump(spark, tmp_path):
    path = tmp_path / "raw.json"
    path.write_text(json.dumps([{"id": "a", "statistics": {"viewCount": "12"}}, {"id": "b"}], indent=2))
    items = json_items.read_items(spark, str(path), VIDEO, json_items.ARRAY)
    assert [(r.id, r.statistics and r.statistics.viewCount) for r in items.collect()] == [
        ("a", "12"), ("b", None),
    ]


def test_truncated_array_is_one_corrupt_row(spark, tmp_path):
    path = tmp_path / "raw.json"
    path.write_text('[{"id": "a"}, {"id": "b", "snip')
    items = json_items.read_items(spark, str(path), VIDEO, json_items.ARRAY)
    _, bad = json_items.split_corrupt(items)
    assert [r.dq_issue for r in bad.collect()] == ["corrupt_record"]


def test_ids_may_be_structs_or_text(spark, tmp_path):
    path = tmp_path / "raw.json"
    path.write_text('{"id": {"videoId": "a"}}\n{"id": "b"}\n')
    ids = [r.id for r in json_items.read_items(spark, str(path), VIDEO).collect()]
    assert sorted(ids) == ["b", '{"videoId":"a"}']


def test_missing_input_is_none(spark, tmp_path):
    assert json_items.read_items(spark, str(tmp_path / "no"), VIDEO) is None
    assert layers.read_table(spark, str(tmp_path), "silver_trending") is None
    empty = layers.read_or_empty(spark, str(tmp_path), "silver_trending")
    assert (empty.count(), empty.columns) == (0, schemas.columns(schemas.SILVER["silver_trending"]))


def test_unknown_layout_is_refused(spark, tmp_path):
    with pytest.raises(ValueError, match="layout"):
        json_items.read_items(spark, str(tmp_path), VIDEO, "xml")
    with pytest.raises(ValueError, match="layout"):
        landing.write_items(_items(spark, "a"), str(tmp_path / "x"), "xml")


def test_pages(spark):
    pages = spark.createDataFrame(
        [
            {"items": [{"id": "a"}, {"id": "b"}], "_source_category": "1"},
            {"items": [], "_source_category": "2"},
            {"items": None, "_source_category": "3"},
        ],
        schemas.response_page("video"),
    )
    items = json_items.explode_pages(pages)
    assert sorted((r.id, r._source_category) for r in items.collect()) == [("a", "1"), ("b", "1")]
    bad = {r._source_category: r.dq_issue for r in json_items.rejected_pages(pages).collect()}
    assert bad == {"2": "empty items", "3": "no items"}


# --- marks and shards -------------------------------------------------------------


def _at(text):
    return datetime.fromisoformat(text)


def test_marks(spark, rows):
    known = rows("source_type string, source_key string, last_ts timestamp",
                 ("channel", "a", _at("2025-02-01")), ("keyword", "b", _at("2030-01-01")))
    seen = rows("ch string, at timestamp", ("a", _at("2025-01-31")), ("a", _at("2025-02-01")),
                ("b", _at("2024-12-31")), ("b", _at("2025-01-01")), (None, _at("2025-01-05")))
    fresh = marks.rows_since_marks(seen, known, "channel", "ch", "at")
    assert sorted(map(tuple, fresh.collect()), key=repr) == sorted(
        [("a", _at("2025-02-01")), ("b", _at("2025-01-01")), (None, _at("2025-01-05"))], key=repr
    )
    landed = marks.marks_from(fresh, "channel", "ch", "at")
    late = marks.marks_from(rows("ch string, at timestamp", ("a", _at("2020-01-01"))), "channel", "ch", "at")
    got = {(r[0], r[1]): r[2] for r in marks.advance(known, landed, late).collect()}
    assert got == {
        ("channel", "a"): _at("2025-02-01"),
        ("channel", "b"): _at("2025-01-01"),
        ("keyword", "b"): _at("2030-01-01"),
    }


def test_shards(rows):
    one, two = rows("id int, extra int", (1, 5)), rows("id int", (2,))
    both = shards.union_shards({"x": one, "y": two}, "label")
    assert sorted(map(tuple, both.collect())) == [(1, 5, "x"), (2, None, "y")]
    listed = shards.label_shards(rows("id int, cat string", (1, "10"), (2, "99"), (3, None)), "cat")
    assert sorted((r.id, r._source_category) for r in listed.collect()) == [
        (1, "0"), (1, "10"), (2, "0"), (3, "0"),
    ]


# --- tables -----------------------------------------------------------------------


def _dated(rows, *data):
    return rows("k string, v int, ingestion_date date", *data)


def _stored(spark, root, table="t"):
    schema = "k string, v int, ingestion_date date"
    df = spark.read.schema(schema).parquet(f"{root}/{table}")
    return sorted((r.k, r.v, r.ingestion_date) for r in df.collect())


def test_append_overwrite_and_replace(spark, rows, tmp_path):
    root = str(tmp_path)
    tables.append(_dated(rows, ("a", 1, DAY1)), root, "t")
    tables.append(_dated(rows, ("b", 1, DAY2)), root, "t")
    assert _stored(spark, root) == [("a", 1, DAY1), ("b", 1, DAY2)]
    for _ in range(2):
        tables.replace_partitions(_dated(rows, ("c", 2, DAY2)), root, "t")
    assert _stored(spark, root) == [("a", 1, DAY1), ("c", 2, DAY2)]
    tables.replace_partition(_dated(rows, ("d", 3, DAY1)), root, "t", DAY1)
    assert _stored(spark, root) == [("c", 2, DAY2), ("d", 3, DAY1)]
    tables.overwrite(_dated(rows, ("e", 4, DAY1)), root, "t")
    assert _stored(spark, root) == [("e", 4, DAY1)]


def test_replacing_with_nothing_empties_the_partition(spark, rows, tmp_path):
    root = str(tmp_path)
    tables.append(_dated(rows, ("a", 1, DAY1), ("b", 1, DAY2)), root, "t")
    tables.replace_partition(_dated(rows).where("false"), root, "t", DAY1)
    assert _stored(spark, root) == [("b", 1, DAY2)]


def test_gold_ignores_absent_partition_columns(spark, rows, tmp_path):
    tables.overwrite_gold(rows("k string, year int", ("a", 1)), str(tmp_path), "g", ["year", "month"])
    assert [p.name for p in (tmp_path / "g").glob("year*")] == ["year=1"]


def test_facts_without_a_date_come_back(spark, rows, tmp_path):
    fact = rows("video_id string, year int, month int", ("a", 2025, 1), ("b", None, None))
    tables.overwrite_fact(fact, str(tmp_path), "f")
    back = spark.read.schema(fact.schema).parquet(str(tmp_path / "f"))
    assert sorted(map(tuple, back.collect())) == [("a", 2025, 1), ("b", None, None)]
    assert "__HIVE_DEFAULT_PARTITION__" in str(list((tmp_path / "f").iterdir()))


def test_one_partition_value_is_written_by_several_tasks(spark, tmp_path):
    """A value that holds all rows is split by the rebalance, not sent to one task."""
    rows = spark.range(200_000).select(
        F.sha2(F.col("id").cast("string"), 256).alias("k"), F.lit(DAY1).alias("ingestion_date")
    )
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "1m")
    try:
        tables.overwrite(rows, str(tmp_path), "t")
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    assert len(list((tmp_path / "t" / f"ingestion_date={DAY1}").glob("part-*"))) > 2


def test_small_partitions_are_one_file_each(spark, tmp_path):
    rows = spark.range(1000).repartition(8).select(
        F.col("id"), F.expr("date'2025-01-01' + cast(id % 3 as int)").alias("ingestion_date")
    )
    tables.overwrite(rows, str(tmp_path), "t")
    counts = [len(list(d.glob("part-*"))) for d in (tmp_path / "t").glob("ingestion_date=*")]
    assert counts == [1, 1, 1]


def test_quarantine(spark, rows, tmp_path):
    root, bad = str(tmp_path), rows("k string, dq_issue string", ("a", "x"))
    assert tables.quarantine(bad, root, "q", DAY1, any_rows=False) is None
    assert not (tmp_path / "q").exists()
    for _ in range(2):
        tables.quarantine(bad, root, "q", DAY1)
    tables.quarantine(bad, root, "q", DAY2)
    read = lambda: sorted(r.quarantine_date for r in spark.read.parquet(f"{root}/q").collect())
    assert read() == [DAY1, DAY2]
    # A repeated run that finds nothing takes back what its first attempt kept.
    tables.quarantine(bad, root, "q", DAY1, any_rows=False)
    assert read() == [DAY2]


@pytest.mark.parametrize(("indent", "newline"), [(2, "\n"), ("\t", "\n"), (4, "\r\n"), (None, "\n")])
def test_arrays_are_split_at_items(spark, tmp_path, indent, newline):
    schema = schemas.RAW_ITEMS["video"]
    items = [
        {"id": f"v{i}", "snippet": {"title": '},\n  { tr"i}}cky é', "tags": ["a"]}, "statistics": {"viewCount": str(i)}}
        for i in range(400)
    ]
    items[0] = items[6] = items[7] = items[-1] = {}
    items[9] = {"snippet": {"tags": []}, "id": []}  # not of the schema
    text = json.dumps(items, indent=indent, ensure_ascii=False).replace("\n", newline)
    (tmp_path / "raw").write_bytes(text.encode())
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        found = json_items.read_items(spark, str(tmp_path / "raw"), schema, json_items.ARRAY)
        tasks = found.select(F.spark_partition_id()).distinct().count()
        rows = found.select("id", "snippet.title", "snippet.tags", "statistics.viewCount").collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert tasks > 5 or indent is None
    expected = [(i.get("id"), i.get("snippet", {}).get("title"), i.get("statistics", {}).get("viewCount")) for i in items]
    expected[9] = ("[]", None, None)
    assert sorted(((r.id, r.title, r.viewCount) for r in rows), key=repr) == sorted(expected, key=repr)


def test_a_broken_item_of_a_split_array_is_kept_apart(spark, tmp_path):
    text = json.dumps([{"id": "a"}, {"id": "b"}, {"id": "c"}], indent=2).replace('"b"', '"b" oops')
    (tmp_path / "raw").write_text(text)
    found = json_items.read_items(spark, str(tmp_path / "raw"), schemas.RAW_ITEMS["video"], json_items.ARRAY)
    good, bad = json_items.split_corrupt(found)
    assert sorted(r.id for r in good.select("id").collect()) == ["a", "c"]
    assert "oops" in bad.select(schemas.CORRUPT).first()[0]


# --- snapshots and lineage ---------------------------------------------------------


RUNS = [datetime(2025, 1, day, 6) for day in range(1, 6)]


def test_snapshots_are_computed_from_earlier_ones(spark, rows, tmp_path):
    root, schema = str(tmp_path), rows("n int", (1,)).schema
    assert snapshots.read(spark, root, "s", schema) is None
    snapshots_out.write(rows("n int", (1,)), root, "s", RUNS[0])
    for expected, run_ts in ((2, RUNS[1]), (3, RUNS[2]), (3, RUNS[2])):
        earlier = snapshots.read(spark, root, "s", schema, before=run_ts)
        grown = earlier.select((F.col("n") + 1).cast("int").alias("n"))
        snapshots_out.write(grown, root, "s", run_ts)
        assert snapshots.read(spark, root, "s", schema).first().n == expected


def test_incomplete_snapshots_are_passed_over(spark, rows, tmp_path):
    root, df = str(tmp_path), rows("n int", (1,))
    snapshots_out.write(df, root, "s", RUNS[0])
    (tmp_path / "s" / snapshots.name(RUNS[1])).mkdir()
    assert snapshots.newest(spark, root, "s") == RUNS[0]
    assert snapshots.newest(spark, root, "s", before=RUNS[0]) is None


def test_pruning_keeps_the_newest_complete_ones(spark, rows, tmp_path):
    root, df = str(tmp_path), rows("n int", (1,))
    for run_ts in (RUNS[0], RUNS[1], RUNS[3]):
        snapshots_out.write(df, root, "s", run_ts)
    for run_ts in (RUNS[2], RUNS[4]):
        (tmp_path / "s" / snapshots.name(run_ts)).mkdir()
    assert len(snapshots_out.prune(spark, root, "s", RUNS[-1], keep=2)) == 1
    assert snapshots.run_times(spark, root, "s") == RUNS[:0:-1]
    assert snapshots_out.prune(spark, root, "s", RUNS[-1], keep=2) == []
    # Repeats within a day do not push out the day before.
    again = [RUNS[3].replace(hour=hour) for hour in (7, 8, 9)]
    for run_ts in again:
        snapshots_out.write(df, root, "s", run_ts)
    assert snapshots_out.prune(spark, root, "s", RUNS[-1], keep=2) == []
    assert RUNS[1] in snapshots.run_times(spark, root, "s")


def test_lineage(spark, tmp_path):
    assert lineage.read(spark, str(tmp_path)).count() == 0
    for n in (1, 2):
        lineage.record(
            spark, str(tmp_path), "p", "src", "dst", [("t", "written", n, None)], RUN_TS, {"a": "b"}
        )
    got = lineage.read(spark, str(tmp_path)).collect()
    assert sorted(r.tables[0].rows for r in got) == [1, 2]
    assert {(r.run_date, r.logged_at, r.details["a"]) for r in got} == {
        (DAY1, "2025-01-01 06:00:00", "b")
    }


def test_scratch_is_in_the_shared_folder(spark):
    shared = spark.conf.get("spark.checkpoint.dir")
    first, second = storage.scratch(spark, "x"), storage.scratch(spark, "x")
    assert first != second
    assert first.startswith(shared)


# --- streaming ----------------------------------------------------------------------


def test_stream_reads_each_file_once(spark, tmp_path):
    landed, base = tmp_path / "landed", str(tmp_path)
    landed.mkdir()
    spec = next(s for s in settings.SOURCES if s.raw_name == "raw_trending")

    def run():
        bronze_stream.ingest_new_files(
            spark, str(landed), spec, f"{base}/bronze", f"{base}/bad", f"{base}/check", RUN_TS
        ).awaitTermination()
        return bronze_stream.with_stream(spark, f"{base}/bronze", spec.table)

    (landed / "1.json").write_text('{"id": "a"}\n{"id": "b"\n')
    assert [r.id for r in run().collect()] == ["a"]
    assert [r.id for r in run().collect()] == ["a"]
    (landed / "2.json").write_text('{"id": "c"}\n')
    bronze = run()
    assert sorted(r.id for r in bronze.collect()) == ["a", "c"]
    assert flatten.video_stats(bronze).first().source == spec.label
    bad = spark.read.parquet(f"{base}/bad/quarantine_bronze_trending_stream")
    assert [r._corrupt_record for r in bad.collect()] == ['{"id": "b"']


def test_a_stream_batch_repeated_on_another_day(spark, tmp_path):
    import shutil

    landed, base = tmp_path / "landed", str(tmp_path)
    landed.mkdir()
    spec = next(s for s in settings.SOURCES if s.raw_name == "raw_trending")
    (landed / "1.json").write_text('{"id": "a"}\n{"id": "b"}\n')
    for day in (RUN_TS, RUN_TS.replace(day=2)):
        bronze_stream.ingest_new_files(
            spark, str(landed), spec, f"{base}/bronze", f"{base}/bad", f"{base}/check", day
        ).awaitTermination()
        shutil.rmtree(f"{base}/check")  # the commit of the batch is lost
    assert sorted(r.id for r in bronze_stream.with_stream(spark, f"{base}/bronze", spec.table).collect()) == ["a", "b"]
    # beside rows of the batch load
    stream = bronze_stream.with_stream(spark, f"{base}/bronze", spec.table)
    tables.replace_partition(stream.limit(1), f"{base}/bronze", spec.table, RUN_TS.date())
    assert bronze_stream.with_stream(spark, f"{base}/bronze", spec.table).count() == 3


def _shuffled(spark) -> set[str]:
    """Names of the shuffle files that lie on disk."""
    found = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    names = (found.apply(k).getName() for k in range(found.size()))
    return {name for name in names if name.startswith("shuffle_")}


def test_shuffles_of_a_job_end_with_it(spark, tmp_path):
    rows = spark.range(0, 5000, 1, 4).withColumn("day", F.col("id") % 3)
    before, cleanup = _shuffled(spark), spark.conf.get(storage._CLEANUP, None)
    with storage.shuffles_dropped(spark):
        tables.overwrite(rows, str(tmp_path), "t", ["day"])
    assert spark.conf.get(storage._CLEANUP, None) == cleanup
    for _ in range(100):  # executors are told to delete, and do so on their own
        if not _shuffled(spark) - before:
            break
        time.sleep(0.1)
    assert not _shuffled(spark) - before
    assert spark.read.parquet(str(tmp_path / "t")).count() == 5000


def test_tables_are_stored_small(spark, tmp_path):
    rows = spark.range(100).withColumn("day", F.lit("2025-01-01").cast("date"))
    tables.overwrite(rows, str(tmp_path), "a", ["day"])
    tables.replace_partition(rows, str(tmp_path), "b", date(2025, 1, 1), "day")
    files = list(tmp_path.glob("[ab]/*/part-*"))
    assert len(files) >= 2 and all(f.name.endswith(".zstd.parquet") for f in files)


def test_landed_items_go_once_bronze_has_them(spark):
    from checks import workspace

    roots = workspace.roots_for(spark, "/root/testdata/sf0.001")
    landed = {p.parent.name for p in Path(roots.raw).glob("*/run-*/*/part-*")}
    assert landed == {"raw_video_stats"}
    assert {p.name for p in Path(roots.bronze).iterdir()} == {s.table for s in settings.SOURCES}


def test_a_built_lakehouse_keeps_what_its_jobs_keep(spark):
    from checks import workspace

    roots = workspace.roots_for(spark, "/root/testdata/sf0.001")
    base = Path(roots.raw).parent
    assert {p.name for p in base.iterdir()} == {
        "raw_json", "bronze", "silver", "gold", "warehouse", "quarantine", "watermark", "lineage"
    }
