"""Mixing sources to target weights by repeating documents.

Sizes are totalled per source, targets follow from weights, and each document is
emitted floor(rate) times plus once more with a probability equal to the
fraction, drawn from a hash of its id. Documents are only scanned: the table of
rates has one row per source and is written first, so Spark knows its size when
it chooses the join (broadcast below ``autoBroadcastJoinThreshold``, else a
shuffled join whose hot sources AQE splits).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reelhouse.llm.text import stored, word_count

#: Fixed values of the mix: weights in turn over the sources, share of all words, limit.
WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST = 2.0


def source_rates(
    sizes: DataFrame, weights: Sequence[int] = WEIGHTS, share: float = SHARE, most: float = MOST
) -> DataFrame:
    """Target and rate of every source, from its size.

    ``sizes`` has (source, source_size), one row per source. Sources sorted by code
    point, null last, take ``weights`` in turn and divide ``share`` times the sum of
    sizes; a target stops at ``most`` times its source's size and the excess goes to
    the others by weight. The level at which that settles is found in one pass over
    the sources sorted by size per weight. The windows run over one row per source.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    turn = (F.row_number().over(order) - 1) % len(weights)
    weighted = sizes.withColumn(
        "weight", F.element_at(F.array(*map(F.lit, weights)), (turn + 1).cast("int")).cast("double")
    ).withColumn("cap", F.col("source_size") * F.lit(float(most)))
    fill = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before = fill.rowsBetween(Window.unboundedPreceding, -1)
    after = fill.rowsBetween(0, Window.unboundedFollowing)
    every = Window.partitionBy().rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    total = F.sum("source_size").over(every) * F.lit(float(share))
    level = (total - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / F.sum("weight").over(after)
    settled = weighted.withColumn("level", level).withColumn(
        "level", F.when(F.col("level") <= F.col("cap") / F.col("weight"), F.col("level"))
    )
    # of the levels that fit, later ones hold back sources that need not be
    highest = F.max("level").over(every)
    target = F.least(F.col("cap"), F.coalesce(highest * F.col("weight"), F.col("cap")))
    return settled.select("source", "source_size", target.alias("target")).withColumn(
        "rate", F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    )


def draw(id_col: Column, seed: str) -> Column:
    """A number in [0, 1) from seed and id; equal on every run."""
    digest = F.sha2(F.concat(F.lit(seed), F.coalesce(id_col.cast("string"), F.lit(""))), 256)
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("long") / F.lit(4294967296.0)


def with_copies(
    docs: DataFrame,
    weights: Sequence[int] = WEIGHTS,
    share: float = SHARE,
    most: float = MOST,
    seed: str = "mix-",
) -> DataFrame:
    """``docs`` with ``_size``, ``_source_size``, ``_target`` and ``_copies``.

    A null text has size 0; null is a source of its own, after the others. Repeated
    rows count and are drawn alike. An empty table gives an empty result.
    """
    sized = docs.withColumn("_size", word_count(F.col("text")))
    sizes = sized.groupBy("source").agg(F.sum("_size").alias("source_size"))
    rates = stored(source_rates(sizes, weights, share, most), "mix-rates").select(
        F.col("source").alias("_of"),
        F.col("source_size").alias("_source_size"),
        F.col("target").alias("_target"),
        F.col("rate").alias("_rate"),
    )
    whole = F.floor("_rate")
    extra = (draw(F.col("doc_id"), seed) < F.col("_rate") - whole).cast("long")
    return (
        sized.join(rates, sized["source"].eqNullSafe(rates["_of"]))
        .withColumn("_copies", whole + extra)
        .drop("_of", "_rate")
    )


def mixed(docs: DataFrame, **how) -> DataFrame:
    """The mix itself: every row of ``docs`` as often as it is taken, same columns."""
    drawn = with_copies(docs, **how).where("_copies > 0")
    return drawn.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_copies")))).select(
        *[drawn[c] for c in docs.columns]
    )
