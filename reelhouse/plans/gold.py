"""Silver to gold marts.

Silver lies in hash buckets of the video, and what a mart takes from one bucket
depends on that bucket alone. So every mart keeps its own rows, or its partial totals,
in the same buckets with a note of the silver folders they were made from, and a run
makes anew only those whose folders have changed. Partial totals of a bucket are
replaced whole: counts, sums, maxima and minima stay exact when rows change or go.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from datetime import date, datetime
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelhouse.operators import marts
from reelhouse.plans.roots import Roots
from reelhouse.plans.status import Run, TableStatus
from reelhouse.sinks import lineage, tables
from reelhouse.sinks import snapshots as snapshots_out
from reelhouse.sinks import states as states_out
from reelhouse.sources import layers, snapshots, states, storage

Make = Callable[[set[int] | None], DataFrame]


def _state(spark: SparkSession, root: str, table: str) -> states.State | None:
    found = snapshots.newest(spark, root, table)
    return None if found is None else states.load(spark, root, table, found)


def _folders(state: states.State | None, buckets: int) -> dict[int, list[str]]:
    """Silver folders by bucket, of a table that may have more or fewer buckets; both
    numbers are powers of two, so one bucket is part of the other or made of several."""
    found: dict[int, list[str]] = {bucket: [] for bucket in range(buckets)}
    for part, places in state.parts.items() if state else ():
        number = int(part.split("=")[1])
        for bucket in range(number % buckets, buckets, max(1, min(state.buckets, buckets))):
            found[bucket] += places
    return found


def _rows(
    spark: SparkSession, root: str, table: str, state: states.State | None, key: str, buckets: int,
    only: set[int] | None,
) -> DataFrame:
    """Rows of a silver table in these buckets, with ``bucket``; other folders are not read."""
    if state is None:
        found = layers.read_table(spark, root, table)
    else:
        wanted = None
        if only is not None:
            wanted = {
                part
                for part in state.parts
                if any((int(part.split("=")[1]) - b) % min(state.buckets, buckets) == 0 for b in only)
            }
        found = states.scan(spark, root, table, state, layers.schema_of(table), wanted)
    found = found.withColumn(states.BUCKET, states.bucket_of(key, buckets))
    return found if only is None else found.where(F.col(states.BUCKET).isin(*sorted(only)))


def refreshed(
    spark: SparkSession,
    root: str,
    table: str,
    run_ts: datetime,
    inputs: Mapping[int, str],
    make: Make,
    notes: Mapping | None = None,
    together: bool = True,
    rounds: int = 1,
) -> str:
    """Bring a table in buckets up to date: ``make`` gives the rows, with ``bucket``, of
    the buckets whose entry in ``inputs`` is not that of the last state; the others are
    referred to. When nothing has changed, no rows are read or written. ``together`` is
    False for rows that come by bucket already. The buckets are made in so many rounds."""
    before = _state(spark, root, table) or states.State()
    noted = before.notes.get("inputs", {})
    same = {b for b, made_from in inputs.items() if noted.get(str(b)) == made_from and len(noted) == len(inputs)}
    changed = set(inputs) - same
    carried = {part: places for part, places in before.parts.items() if int(part.split("=")[1]) in same}
    parts = [found for r in range(rounds) if (found := {b for b in changed if b % rounds == r})]
    if len(parts) > 1:
        rows = [make(part) for part in parts]
    else:
        rows = make(None if not same else changed) if changed else None
    all_notes = dict(notes or {}) | {"buckets": len(inputs), "inputs": {str(b): text for b, text in inputs.items()}}
    written = states_out.write(
        spark, rows, root, table, run_ts, (states.BUCKET,), carried, all_notes, together
    )
    states_out.prune(spark, root, table, run_ts)
    return written


def build_gold(
    spark: SparkSession, roots: Roots, run_ts: datetime, as_of: date | None = None
) -> list[TableStatus]:
    """``as_of`` is the day view velocity is measured on, the run date by default.

    Each mart is one state per run: readers keep the last one until it is complete. The
    video mart stores nothing that depends on ``as_of``; those columns are worked out
    when it is read.
    """
    run = Run(spark, "gold")
    measured_on = as_of or run_ts.date()
    silver = partial(layers.read_table, spark, roots.silver)
    stats, categories = silver("silver_video_stats"), silver("silver_categories")
    trending = silver("silver_trending")
    stats_state, trending_state = (
        _state(spark, roots.silver, table) for table in ("silver_video_stats", "silver_trending")
    )
    buckets = stats_state.buckets if stats_state else 8
    by_bucket = {
        name: _folders(state, buckets) for name, state in (("stats", stats_state), ("trending", trending_state))
    }
    rows = partial(_rows, spark, roots.silver)
    # a silver table not kept in buckets tells nothing of what has changed in it
    unknown = "" if stats_state else f"{run_ts.isoformat()} {storage.scratch(spark, '')}"

    def of_stats(bucket: int) -> str:
        return "|".join(sorted(by_bucket["stats"][bucket])) + unknown

    def stats_rows(only: set[int] | None) -> DataFrame:
        return rows("silver_video_stats", stats_state, "video_id", buckets, only)

    def names() -> str:
        """Stands for all category names, which every video row carries."""
        if categories is None:
            return ""
        found = marts.category_names(categories).agg(
            F.count("*"), F.sum(F.xxhash64("category_id", "category_name").cast("decimal(38,0)"))
        )
        return "|".join(map(str, found.first()))

    def keep(mart: DataFrame, table: str) -> str:
        columns = tables.existing_partitions(mart, tables.BY_DATE)
        written = snapshots_out.write(mart, roots.gold, table, run_ts, columns)
        snapshots_out.prune(spark, roots.gold, table, run_ts)
        return written

    def videos() -> str | None:
        if stats is None:
            return None

        size = storage.size(spark, storage.join(roots.silver, "silver_video_stats"))
        # several states may lie there, which makes the parts smaller
        dealt = partial(states.in_buckets, key="video_id", buckets=buckets, parts=states.parts_for(size, buckets))

        def make(only: set[int] | None) -> DataFrame:
            found = stats_rows(only)
            if trending is not None:
                # a video has a row in each, so none holds many
                seen = rows("silver_trending", trending_state, "video_id", buckets, only)
                found = marts.combine_videos(found, seen, dealt, (states.BUCKET, states.PART))
            return marts.engagement_of(found, categories, also=[states.BUCKET]).drop(*marts.DAILY)

        named = names()
        inputs = {
            b: f"{of_stats(b)} {'|'.join(sorted(by_bucket['trending'][b]))} {trending is None} {named}"
            for b in range(buckets)
        }
        return refreshed(
            spark, roots.gold, "gold_video_engagement", run_ts, inputs, make, {"as_of": f"{measured_on}"},
            together=stats_state is None and trending is None, rounds=tables.rounds_for(size),
        )

    def totals(table: str, make: Callable[..., DataFrame]) -> DataFrame:
        """All partial totals, those of changed buckets made anew."""
        by = lambda only: make(stats_rows(only), states.BUCKET)
        refreshed(
            spark, roots.gold, table, run_ts, {b: of_stats(b) for b in range(buckets)}, by
        )
        state = states.load(spark, roots.gold, table, run_ts)
        return states.scan(spark, roots.gold, table, state, by(set()).drop(states.BUCKET).schema)

    def channels() -> str | None:
        if stats is None:
            return None
        found = totals("gold_channel_totals", marts.channel_totals)
        return keep(marts.channels_of(found, run_ts.date()), "gold_channel_performance")

    def by_category() -> str | None:
        if stats is None or categories is None:
            return None
        found = totals("gold_category_totals", marts.category_totals)
        return keep(marts.categories_of(found, categories, run_ts.date()), "gold_category_performance")

    run.build(
        {
            "gold_video_engagement": videos,
            "gold_channel_performance": channels,
            "gold_category_performance": by_category,
        }
    )
    lineage.record(
        spark, roots.lineage, "gold", roots.silver, roots.gold, run.lineage_rows(), run_ts
    )
    return run.statuses
