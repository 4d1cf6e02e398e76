"""Gold to the star schema."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, time
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelhouse import schemas
from reelhouse.operators import columns, dimensions, scd2
from reelhouse.plans.roots import Roots
from reelhouse.plans.status import Run, TableStatus
from reelhouse.settings import TRACKED_CHANNEL_COLUMNS
from reelhouse.sinks import lineage, tables
from reelhouse.sinks import snapshots as snapshots_out
from reelhouse.sinks import states as states_out
from reelhouse.sources import layers, snapshots, states, storage


def channel_input(spark: SparkSession, roots: Roots) -> DataFrame | None:
    """Channel statistics, or the channel mart made to look like them."""
    stats = layers.read_table(spark, roots.silver, "silver_channel_stats")
    if stats is not None:
        return stats
    mart = layers.read_table(spark, roots.gold, "gold_channel_performance")
    return None if mart is None else columns.conform_channels(mart)


def update_channel_history(
    spark: SparkSession,
    root: str,
    incoming: DataFrame,
    run_ts: datetime,
    tracked: Sequence[str] = TRACKED_CHANNEL_COLUMNS,
) -> str:
    """Merge into ``dim_channel`` as the last earlier day left it.

    The table lies in parts by end date. Versions once closed are never written again:
    a run reads and writes the open ones and those it closes, and refers to the rest.
    """
    new = scd2.prepare(incoming)
    table = "dim_channel"
    today = datetime.combine(run_ts.date(), time.min)
    since = snapshots.newest(spark, root, table, today)
    if since is None and any(t < today for t in snapshots.run_times(spark, root, table)):
        raise RuntimeError(
            f"{table} has snapshots of earlier days but none is complete; history would start anew"
        )
    closed: dict[str, list[str]] = {}
    if since is None:
        merged = scd2.first_load(new, run_ts.date())
    else:
        before = states.load(spark, root, table, since)
        if before is None:  # kept whole until now
            history = snapshots.read(spark, root, table, schemas.WAREHOUSE[table], before=today)
        else:
            still_open = {part for part in before.parts if part.endswith("is_current=true")}
            closed = {part: places for part, places in before.parts.items() if part not in still_open}
            history = states.scan(spark, root, table, before, schemas.WAREHOUSE[table], still_open)
        merged = scd2.merge(history, new, run_ts.date(), tracked)
    written = states_out.write(
        spark, merged, root, table, run_ts, ("effective_end_date", "is_current"), closed, {}
    )
    states_out.prune(spark, root, table, run_ts)
    return written


def build_warehouse(
    spark: SparkSession,
    roots: Roots,
    run_ts: datetime,
    tracked: Sequence[str] = TRACKED_CHANNEL_COLUMNS,
) -> list[TableStatus]:
    run = Run(spark, "warehouse")
    gold = layers.read_table(spark, roots.gold, "gold_video_engagement")
    categories = layers.read_table(spark, roots.silver, "silver_categories")
    channels = channel_input(spark, roots)

    def keep(rows: DataFrame | Sequence[DataFrame], table: str, partitions: Sequence[str] = ()) -> str:
        written = snapshots_out.write(rows, roots.warehouse, table, run_ts, partitions)
        snapshots_out.prune(spark, roots.warehouse, table, run_ts)
        return written

    # The video mart has one row per video, so its dimension and fact need no
    # second deduplication, which would shuffle the whole mart twice more.
    def dimension(table: str, source: DataFrame | None, make) -> str | None:
        if source is None:
            return None
        return keep(make(source), table)

    def channel_history() -> str | None:
        if channels is None:
            return None
        return update_channel_history(spark, roots.warehouse, channels, run_ts, tracked)

    def fact() -> str | None:
        if gold is None:
            return None
        rows = dimensions.fact_video_performance(gold, deduplicate=False)
        # several states may lie there, which makes more rounds
        size = storage.size(spark, storage.join(roots.gold, "gold_video_engagement"))
        if (rounds := tables.rounds_for(size)) > 1:
            which = F.pmod(F.xxhash64("year", "month"), F.lit(rounds))
            rows = [rows.where(which == r) for r in range(rounds)]
        return keep(rows, "fact_video_performance", ("year", "month"))

    videos = partial(dimensions.dim_video, deduplicate=False)
    run.build(
        {
            "dim_video": partial(dimension, "dim_video", gold, videos),
            "dim_category": partial(dimension, "dim_category", categories, dimensions.dim_category),
            "dim_date": partial(dimension, "dim_date", gold, dimensions.dim_date),
            "dim_channel": channel_history,
            "fact_video_performance": fact,
        }
    )
    lineage.record(
        spark, roots.lineage, "warehouse", roots.gold, roots.warehouse, run.lineage_rows(),
        run_ts, {"schema": "star", "history": "type 2 on dim_channel"},
    )
    return run.statuses
