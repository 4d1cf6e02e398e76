"""One row per key, chosen by a total order.

``row_number() = 1`` makes Spark keep only each task's own first row per key
before the shuffle (a partial window group limit), so a key that holds a large
share of the input sends one row per task to the reducer, not all its copies.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

_RANK = "_rank"
CHOSEN, UNASKED = "_text", "_unasked"


def _first_per_key(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    ranked = df.withColumn(
        _RANK, F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    )
    return ranked.where(F.col(_RANK) == 1).drop(_RANK)


def row_hash(df: DataFrame) -> Column:
    """A tie-breaker that depends on the row alone, not on where it was read."""
    return F.xxhash64(*[F.col(name) for name in sorted(df.columns)])


def keep_latest(
    df: DataFrame,
    key: str | list[str],
    latest_by: str | None = "ingestion_timestamp",
    ties: list[Column] | None = None,
) -> DataFrame:
    """The latest row of each key; a frame without the key is left alone.

    Ties are settled by a hash of the whole row, so the survivor is the same on
    every run and under any partitioning. Where columns are known that tell all
    rows of a key apart, giving them as ``ties`` instead lets the scan leave out
    the columns nobody else reads.
    """
    keys = [key] if isinstance(key, str) else list(key)
    if any(name not in df.columns for name in keys):
        return df
    order = [F.col(latest_by).desc_nulls_last()] if latest_by in df.columns else []
    return _first_per_key(df, keys, order + (ties or [row_hash(df)]))


def unique_key(df: DataFrame, key: str, latest_by: str | None = "ingestion_timestamp") -> DataFrame:
    """Rows that have the key, one for each."""
    return keep_latest(df.where(F.col(key).isNotNull()), key, latest_by)


def first_seen(frames: list[DataFrame], key: str, sequence: str | None = None) -> DataFrame:
    """The first row of each key over frames given in order of preference.

    Within a frame the lowest ``sequence`` counts as first. Rows without a key
    are dropped.
    """
    rows = _ranked_union(frames).where(F.col(key).isNotNull())
    order = [F.col("_source_rank")]
    if sequence:
        order.append(F.col(sequence))
    return _first_per_key(rows, [key], order + [row_hash(rows)]).drop("_source_rank")


def first_seen_of(frames: list[DataFrame], key: str, known: DataFrame) -> DataFrame:
    """``first_seen`` of rows that JSON can hold, those of the last frame only for keys
    that ``known`` has. Among rows of a frame the least text is the first.

    Join and choice share one shuffle: every task sends its first row of each key among
    the other frames, its first among the last one, and whether the key is known. Rows
    travel as JSON text, which takes less than two thirds of nested rows.
    """
    return first_text(texts_of(frames, key, known), key, row_type(frames, key))


def _ranked_union(frames: list[DataFrame]) -> DataFrame:
    labelled = [
        frame.withColumn("_source_rank", F.lit(rank)) for rank, frame in enumerate(frames)
    ]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), labelled)


def _whole(rows: DataFrame, key: str) -> Column:
    return F.struct(*[name for name in rows.columns if name not in (key, "_source_rank")])


def row_type(frames: list[DataFrame], key: str) -> T.DataType:
    """Type of the rows of ``first_seen_of`` without their key."""
    rows = _ranked_union(frames)
    return rows.select(_whole(rows, key).alias("_row")).schema["_row"].dataType


def texts_of(
    frames: list[DataFrame],
    key: str,
    known: DataFrame,
    watch: Callable[[DataFrame, Column], DataFrame] | None = None,
) -> DataFrame:
    """What ``first_seen_of`` chooses from: rows as text, and the known keys. ``watch`` is
    given them before those without a key are dropped, and which of the last frame these are."""
    rows = _ranked_union(frames)
    whole = _whole(rows, key)
    last = F.col("_source_rank") == len(frames) - 1
    texts = rows.select(
        key,
        F.when(~last, F.struct("_source_rank", F.to_json(whole).alias("text"))).alias("_seen"),
        F.when(last, F.to_json(whole)).alias("_asked"),
    )
    if watch is not None:
        texts = watch(texts, F.col(key).isNull() & F.col("_asked").isNotNull())
    asked = known.select(key, F.lit(True).alias("_known"))
    return texts.unionByName(asked, allowMissingColumns=True).where(F.col(key).isNotNull())


def first_text(texts: DataFrame, key: str, kind: T.DataType) -> DataFrame:
    """The choice of ``first_seen_of`` among the keys that ``texts_of`` gave."""
    found = chosen_text(texts, key).where(F.col(CHOSEN).isNotNull())
    return found.select(key, F.from_json(CHOSEN, kind).alias("_row")).select(key, "_row.*")


def chosen_text(texts: DataFrame, key: str) -> DataFrame:
    """The same as the texts themselves, with a row for every key: null for one that only
    the last frame has and that is not known (``UNASKED``), or that no frame has."""
    first = texts.groupBy(key).agg(
        F.min("_seen").alias("_seen"), F.min("_asked").alias("_asked"), F.max("_known").alias("_known")
    )
    text = F.coalesce(F.col("_seen.text"), F.when(F.col("_known"), F.col("_asked")))
    unasked = F.col("_asked").isNotNull() & F.col("_known").isNull()
    return first.select(key, text.alias(CHOSEN), unasked.alias(UNASKED))


def distinct_ids(df: DataFrame, key: str) -> DataFrame:
    return df.select(key).where(F.col(key).isNotNull()).distinct()
