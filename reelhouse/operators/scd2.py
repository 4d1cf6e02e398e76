"""Channel history: one row per channel and version (type 2).

A version is valid in ``[effective_start_date, effective_end_date)``; the open
one ends on 9999-12-31 and is flagged ``is_current``.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reelhouse import schemas
from reelhouse.operators import dedup
from reelhouse.settings import OPEN_END, TRACKED_CHANNEL_COLUMNS

KEY = "channel_id"
_DIMENSION = schemas.columns(schemas.WAREHOUSE["dim_channel"])
_ATTRIBUTES = ("channel_name", "country", "subscriber_count", "total_views", "video_count")


def prepare(incoming: DataFrame) -> DataFrame:
    """The attributes kept in history, one row per channel, the latest."""
    latest = dedup.unique_key(incoming, KEY)
    return latest.select(KEY, *_ATTRIBUTES)


def version_key(channel: Column, start: Column) -> Column:
    """A key that depends on the version alone: the same on every run, and new
    versions need no knowledge of the keys already given out."""
    return F.xxhash64(channel, start)


def _same(left: str, right: str, tracked: Sequence[str]) -> Column:
    return reduce(
        and_, [F.col(f"{left}.{name}").eqNullSafe(F.col(f"{right}.{name}")) for name in tracked]
    )


def current_versions(history: DataFrame) -> DataFrame:
    return history.where("is_current")


def changed_keys(
    incoming: DataFrame, history: DataFrame, tracked: Sequence[str] = TRACKED_CHANNEL_COLUMNS
) -> DataFrame:
    """Channels whose tracked values differ from their current version; a value
    that appears or disappears is a difference."""
    return (
        incoming.alias("n")
        .join(current_versions(history).alias("o"), KEY)
        .where(~_same("n", "o", tracked))
        .select(KEY)
    )


def new_keys(incoming: DataFrame, history: DataFrame) -> DataFrame:
    """Rows of channels the history has never seen."""
    return incoming.join(history.select(KEY), KEY, "left_anti")


def changed_rows(
    incoming: DataFrame, history: DataFrame, tracked: Sequence[str] = TRACKED_CHANNEL_COLUMNS
) -> DataFrame:
    return incoming.join(changed_keys(incoming, history, tracked), KEY, "left_semi")


def first_load(incoming: DataFrame, run_date: date) -> DataFrame:
    start = F.lit(run_date)
    return incoming.select(
        version_key(F.col(KEY), start).alias("channel_key"),
        KEY,
        *_ATTRIBUTES,
        start.alias("effective_start_date"),
        F.lit(OPEN_END).alias("effective_end_date"),
        F.lit(True).alias("is_current"),
    )


def merge(
    history: DataFrame,
    incoming: DataFrame,
    run_date: date,
    tracked: Sequence[str] = TRACKED_CHANNEL_COLUMNS,
) -> DataFrame:
    """The history after ``incoming`` (unique per channel) was seen on ``run_date``.

    Changed channels: the open version is closed on the run date and a new one
    opened. New channels: opened. Unchanged and absent ones: left as they are.
    A version opened on the run date itself is replaced, not closed, so a second
    run on the same day leaves no empty interval.

    One full outer join over the open versions decides everything; closed
    versions pass through without a shuffle.
    """
    today = F.lit(run_date)
    has_old, has_new = F.col(f"o.{KEY}").isNotNull(), F.col(f"n.{KEY}").isNotNull()
    differs = has_old & has_new & ~_same("n", "o", tracked)
    replaced = differs & (F.col("o.effective_start_date") >= today)
    start = F.when(replaced, F.col("o.effective_start_date")).otherwise(today)

    kept = F.struct(
        F.col("o.channel_key"),
        F.col(f"o.{KEY}"),
        *[F.col(f"o.{name}") for name in _ATTRIBUTES],
        F.col("o.effective_start_date"),
        F.when(differs, today).otherwise(F.col("o.effective_end_date")).alias("effective_end_date"),
        (~differs).alias("is_current"),
    )
    opened = F.struct(
        version_key(F.col(f"n.{KEY}"), start).alias("channel_key"),
        F.col(f"n.{KEY}"),
        *[F.col(f"n.{name}") for name in _ATTRIBUTES],
        start.alias("effective_start_date"),
        F.lit(OPEN_END).alias("effective_end_date"),
        F.lit(True).alias("is_current"),
    )
    versions = F.array(
        F.when(has_old & ~replaced, kept), F.when((has_new & ~has_old) | differs, opened)
    )
    open_side = current_versions(history).alias("o")
    decided = (
        open_side.join(
            incoming.alias("n"), F.col(f"o.{KEY}") == F.col(f"n.{KEY}"), "full_outer"
        )
        .select(F.explode(versions).alias("version"))
        .where(F.col("version").isNotNull())
        .select("version.*")
    )
    closed = history.where(~F.col("is_current"))
    return closed.select(_DIMENSION).unionByName(decided.select(_DIMENSION))


def as_of(
    facts: DataFrame,
    history: DataFrame,
    at: str,
    how: str = "inner",
    block_days: int = 32,
    most: int = 1_000_000,
) -> DataFrame:
    """Join each fact with the channel version valid on its date column ``at``.

    Facts and versions of one channel and time block are put in one order of time, and
    the last version is carried forward to the facts after it; the version that is open
    when a block begins is carried into it from the blocks before. So a fact meets one
    version however many its channel has had, a channel is split by time, and a block
    of more than ``most`` facts by a number of the row as well. Versions of a channel do
    not overlap. With ``how="left"`` facts without a valid version stay, as do those
    without a channel or date.
    """
    if how not in ("inner", "left"):
        raise ValueError(f"how must be 'inner' or 'left', not {how!r}")
    kind = facts.schema[at].dataType
    spot = ["_key", "_block"]
    block = F.floor(F.datediff(F.col("_on").cast("date"), F.lit(date(1970, 1, 1))) / block_days).alias("_block")
    asked = facts.select(
        F.struct(*[F.col(f"`{name}`") for name in facts.columns]).alias("_fact"),
        F.col(KEY).alias("_key"),
        F.col(at).alias("_on"),
        F.monotonically_increasing_id().alias("_number"),
    )
    # a version's start is compared as a date or time, as the facts have it
    others = [name for name in history.columns if name != KEY]
    versions = history.select(
        F.col(KEY).alias("_key"),
        F.col("effective_start_date").cast(kind).alias("_on"),
        F.struct(*others).alias("_version"),
    ).select("*", block)
    dated = asked.where(F.col("_key").isNotNull() & F.col("_on").isNotNull()).select("*", block)

    last = versions.groupBy(*spot).agg(F.max_by("_version", "_on").alias("_last"))
    spots = dated.groupBy(*spot).agg(F.count("_on").alias("_n")).join(last, spot, "full_outer")
    # one row per channel and block; of a channel no more than there are blocks
    earlier = Window.partitionBy("_key").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    spots = spots.withColumn("_before", F.last("_last", ignorenulls=True).over(earlier)).where("_n > 0")
    parts = F.ceil(F.col("_n") / most).cast("long")
    split = spots.where(parts > 1).select(*spot, parts.alias("_parts"))
    none = F.lit(0).cast("long")
    placed = dated.join(split, spot, "left").select(
        *spot, F.coalesce(F.pmod("_number", F.col("_parts")), none).alias("_part"), "_on",
        F.lit(1).alias("_kind"), "_fact", F.lit(None).cast(versions.schema["_version"].dataType).alias("_version"),
    )
    begun = spots.where("_before is not null").select(
        *spot, F.col("_before.effective_start_date").cast(kind).alias("_on"), F.col("_before").alias("_version"), parts.alias("_parts")
    )
    within = versions.join(spots.select(*spot, parts.alias("_parts")), spot).select(*spot, "_on", "_version", "_parts")
    known = begun.unionByName(within).select(
        *spot, F.explode(F.sequence(none, F.col("_parts") - 1)).alias("_part"), "_on",
        F.lit(0).alias("_kind"), F.lit(None).cast(asked.schema["_fact"].dataType).alias("_fact"), "_version",
    )
    in_time = Window.partitionBy(*spot, "_part").orderBy("_on", "_kind")
    so_far = in_time.rowsBetween(Window.unboundedPreceding, 0)
    found = (
        placed.unionByName(known)
        .withColumn("_version", F.last("_version", ignorenulls=True).over(so_far))
        .where("_kind = 1")
    )
    valid = F.col("_on") < F.col("_version.effective_end_date")
    if how == "inner":
        found = found.where(valid)
    else:
        found = found.select("_fact", F.when(valid, F.col("_version")).alias("_version"))
        undated = asked.where(F.col("_key").isNull() | F.col("_on").isNull())
        found = found.unionByName(
            undated.select("_fact", F.lit(None).cast(versions.schema["_version"].dataType).alias("_version"))
        )
    return found.select("_fact.*", "_version.*")
