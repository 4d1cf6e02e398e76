"""API response pages to landed items, incrementally.

Fetching is the caller's; what arrives here are the answers as JSON pages with
the columns of the request they answer (``schemas.response_page``).
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, fields, replace
from datetime import datetime
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelhouse import schemas
from reelhouse.functions import parse
from reelhouse.operators import audit, dedup
from reelhouse.plans.bronze import run_folder
from reelhouse.plans.roots import Roots
from reelhouse.plans.status import Run, Seen, TableStatus
from reelhouse.settings import DEFAULT_MARK
from reelhouse.sinks import landing, lineage, tables
from reelhouse.sinks import snapshots as snapshots_out
from reelhouse.sources import json_items, marks, shards, snapshots, storage


@dataclass(frozen=True)
class Pages:
    """Pages per request kind; None where nothing was requested.

    Answers that were fetched in parts may come as a mapping from category or keyword
    to its pages.
    """

    trending: DataFrame | None = None
    trending_by_category: DataFrame | Mapping[str, DataFrame] | None = None
    channel_videos: DataFrame | None = None
    keyword_videos: DataFrame | Mapping[str, DataFrame] | None = None
    video_stats: DataFrame | None = None
    channel_stats: DataFrame | None = None
    categories: DataFrame | None = None


_ROUND = "_round"

#: Which request column tells the parts of an answer apart.
PART_LABELS = {"trending_by_category": "_source_category", "keyword_videos": "_source_keyword"}


def _joined(pages: Pages) -> Pages:
    """Answers in parts as one labelled frame each."""
    parts = {
        name: shards.union_shards(answer, label) if answer else None
        for name, label in PART_LABELS.items()
        if isinstance(answer := getattr(pages, name), Mapping)
    }
    return replace(pages, **parts)


def read_marks(
    spark: SparkSession, roots: Roots, before: datetime | None = None
) -> DataFrame:
    """The newest marks, or those a run at ``before`` has to start from."""
    saved = snapshots.read(spark, roots.marks, "marks", schemas.MARKS, before)
    if saved is not None:
        return saved
    # known to be empty by the limit, so that a join with it moves no rows
    return spark.createDataFrame([], schemas.MARKS).limit(0)


def land(
    spark: SparkSession,
    roots: Roots,
    pages: Pages,
    run_ts: datetime,
    batch_id: str | None = None,
    default_mark: str = DEFAULT_MARK,
    mark_at_run_time: bool = False,
    done: Callable[[str], None] | None = None,
) -> list[TableStatus]:
    """Land one run. Marks advance only for sources that landed rows: to the last
    publication seen, or with ``mark_at_run_time`` to the time of the run. ``done`` is
    told each answer whose pages are not needed any more."""
    run = Run(spark, "landing")
    batch = batch_id or audit.new_batch_id(run_ts)
    folder = run_folder(roots, run_ts)
    pages = _joined(pages)
    known = read_marks(spark, roots, before=run_ts)
    published = F.try_to_timestamp(F.col("snippet.publishedAt"))

    part = f"{run_ts:%H%M%S}"
    unusable = {kind.name: Seen() for kind in fields(Pages)}

    def items_of(name: str) -> DataFrame | None:
        answer = getattr(pages, name)
        if answer is None:
            return None
        watched = unusable[name].watch(answer, json_items.page_problem().isNotNull())
        return audit.item_columns(json_items.explode_pages(watched), batch, run_ts)

    def since_marks(name: str, source_type: str, key: str) -> DataFrame | None:
        items = items_of(name)
        if items is None:
            return None
        dated = items.withColumns({"_published": published, "_key": F.col(key)})
        fresh = marks.rows_since_marks(
            dated, known, source_type, "_key", "_published", default_mark
        )
        return fresh.drop("_published", "_key")

    def write(name: str, items: DataFrame | Callable[[str], str] | None) -> str | None:
        if items is None:
            return None
        path = storage.join(folder, f"raw_{name}")
        path = landing.write_items(items, path) if isinstance(items, DataFrame) else items(path)
        answer = getattr(pages, name)
        if answer is not None:
            tables.quarantine(
                json_items.rejected_pages(answer), roots.quarantine,
                f"quarantine_pages_{name}", run_ts.date(), any_rows=unusable[name].any(),
                part=part,
            )
            if done is not None:
                done(name)
        return path

    def write_all(items: dict[str, DataFrame | None]) -> None:
        run.build({name: partial(write, name, df) for name, df in items.items()}, counted=())

    def landed(name: str, kind: str) -> DataFrame | None:
        """What this run wrote: later steps read it back instead of redoing it."""
        path = storage.join(folder, f"raw_{name}")
        if not storage.is_complete(spark, path):
            return None
        return spark.read.schema(schemas.RAW_ITEMS[kind]).json(path)

    write_all(
        {
            "trending": items_of("trending"),
            "trending_by_category": items_of("trending_by_category"),
            "channel_videos": since_marks("channel_videos", "channel", "snippet.channelId"),
            "keyword_videos": since_marks("keyword_videos", "keyword", "_source_keyword"),
            "channel_stats": items_of("channel_stats"),
            "categories": items_of("categories"),
        }
    )

    found = [landed(name, "search") for name in ("channel_videos", "keyword_videos")]
    stats, requested = items_of("video_stats"), None
    if stats is not None:
        requested = _requested([df for df in found if df is not None])
    in_order = [landed("trending", "video"), landed("trending_by_category", "video"), stats]
    in_order = [df for df in in_order if df is not None]
    unique = None
    if in_order:
        keyed = [df.withColumn("_id", parse.video_id(F.col("id"))) for df in in_order]
        if requested is not None:
            # statistics are of the id they were requested by: one that is no such text has none
            plain = F.when(F.col("id") == F.col("_id"), F.col("_id"))
            keyed[-1] = keyed[-1].withColumn("_id", plain)
        if requested is None:
            unique = dedup.first_seen(keyed, "_id").drop("_id")
        else:
            asked = requested.withColumnRenamed("id", "_id")
            unasked = stats.join(dedup.distinct_ids(requested, "id"), "id", "left_anti")

            def unique(path: str) -> str:
                left_out = _land_first(keyed, "_id", asked, path)
                # looked for only when the choice met an id that was not asked for
                tables.quarantine(
                    unasked.withColumn("dq_issue", F.lit("not requested")), roots.quarantine,
                    "quarantine_unrequested_video_stats", run_ts.date(),
                    any_rows=left_out, part=part,
                )
                return path

    new_marks = []
    for df, source_type, key in zip(
        found, ("channel", "keyword"), ("snippet.channelId", "_source_keyword"), strict=True
    ):
        if df is not None:
            at = F.lit(run_ts).cast("timestamp") if mark_at_run_time else published
            seen = df.withColumn("_key", F.col(key))
            new_marks.append(marks.marks_from(seen, source_type, "_key", at))
    last: dict[str, Callable[[], str | None]] = {"video_stats": partial(write, "video_stats", unique)}
    if new_marks:
        advanced = marks.advance(known, *new_marks)
        last["marks"] = partial(snapshots_out.write, advanced, roots.marks, "marks", run_ts)
    run.build(last, counted=("marks",))  # side by side: marks come from the searches alone
    lineage.record(
        spark, roots.lineage, "landing", "api pages", folder, run.lineage_rows(), run_ts,
        {"batch_id": batch},
    )
    return run.statuses


def _land_first(frames: list[DataFrame], key: str, known: DataFrame, path: str) -> bool:
    """Land what ``dedup.first_seen_of`` gives, in rounds of keys; returns whether the last
    frame has rows without a key or of one that is not known. The texts it chooses from are kept compressed, a
    round shuffles its own share of them, and those chosen are the lines that are landed."""
    spark = known.sparkSession
    unkeyed = Seen()
    texts = dedup.texts_of(frames, key, known, unkeyed.watch).withColumn(
        _ROUND, F.pmod(F.xxhash64(key), F.lit(tables.MOST_ROUNDS)).cast("int")
    )
    scratch = storage.scratch(spark, "asked")
    try:
        texts.write.partitionBy(_ROUND).parquet(scratch, compression=storage.COMPRESSION)
        kept = spark.read.schema(texts.schema).parquet(scratch)
        rounds = tables.rounds_for(storage.size(spark, scratch))
        left_out = [Seen() for _ in range(rounds)]
        chosen = []
        for r, seen in enumerate(left_out):
            found = dedup.chosen_text(kept.where(F.col(_ROUND) % rounds == r).drop(_ROUND), key)
            found = seen.watch(found, F.col(dedup.UNASKED)).where(F.col(dedup.CHOSEN).isNotNull())
            chosen.append(found.select(F.col(dedup.CHOSEN).alias(landing.TEXT)))
        landing.write_parts(chosen, path)
        return any(seen.any() for seen in [unkeyed, *left_out])
    finally:
        storage.delete(spark, scratch)


def _requested(found: list[DataFrame]) -> DataFrame | None:
    """Ids of the videos the searches turned up; None when nothing was searched, and
    then no statistics are left out."""
    if not found:
        return None
    ids = [df.select(F.col("id.videoId").alias("id")) for df in found]
    requested = ids[0]
    for more in ids[1:]:
        requested = requested.unionByName(more)
    return requested.select(parse.video_id(F.col("id")).alias("id"))
