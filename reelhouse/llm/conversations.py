"""Chat formatting: logged snapshots of one conversation collapse into the longest.

A conversation that is logged after every turn appears many times, each log a
prefix of the next. Every turn gets a hash of its position and content; their
running sums are rolling hashes of the prefixes, and the last one stands for the
whole. A conversation whose whole is a proper prefix of another is dropped by an
anti-join, of equal ones the smallest id stays, and only then is text rendered.

Sums do not depend on order, so totals per conversation need no window. The
running sums do, and a single conversation may be very long: they run within
blocks of ``BLOCK`` turns, and over one row per block.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reelhouse.llm.text import stored

BLOCK = 256
#: Order of the turns of a conversation: by number, then, where one number holds several
#: texts, by role, the start of the text and a hash; null comes first.
ORDER = ("turn", "role", "head", "content")
_PARTS = ("h0", "h1", "h2")
_UNKNOWN = -(1 << 62)


def _marked(column: str) -> Column:
    """Text that tells null from every value."""
    return F.coalesce(F.concat(F.lit("+"), F.col(column).cast("string")), F.lit("-"))


def _key() -> Column:
    """The conversation of a row; one without conv_id is a conversation of its own, and
    equal ones are one."""
    alone = F.concat(F.lit("-"), F.md5(F.concat(_marked("role"), F.lit("\x1f"), _marked("text")).cast("binary")))
    return F.when(F.col("conv_id").isNull(), alone).otherwise(F.concat(F.lit("+"), F.col("conv_id").cast("string")))


def _turn() -> Column:
    return F.when(F.col("conv_id").isNotNull(), F.col("turn").cast("long"))


def _content() -> Column:
    return F.unhex(F.md5(F.concat(_marked("role"), F.lit("\x1f"), _marked("text")).cast("binary")))


def _head() -> Column:
    return F.substring("text", 1, 64)


def rendered_turn() -> Column:
    """How one turn is written; a null role is ``unknown``, a null text is empty."""
    return F.concat(
        F.lit("<|"), F.coalesce("role", F.lit("unknown")), F.lit("|>\n"), F.coalesce("text", F.lit("")), F.lit("<|end|>\n")
    )


def prefixes(turns: DataFrame) -> DataFrame:
    """(key, id, position, h0, h1, h2): rolling hash of the first turns of every conversation.

    Turns are in the order ``ORDER``; rows that repeat number, role and text count once.
    Positions count from 1, so gaps in the numbers do not matter. A row without conv_id
    is a conversation of one turn, so such rows never come together.
    """
    rows = turns.select(
        _key().alias("key"),
        F.col("conv_id").alias("id"),
        F.coalesce(_turn(), F.lit(_UNKNOWN)).alias("turn"),
        "role",
        _head().alias("head"),
        _content().alias("content"),
    ).distinct().withColumn("block", F.floor(F.col("turn") / BLOCK))
    rows = stored(rows, "turns")
    inside = Window.partitionBy("key", "block").orderBy(*ORDER)
    over_blocks = Window.partitionBy("key").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    started = rows.groupBy("key", "block").agg(F.count("turn").alias("k")).select(
        "key", "block", F.coalesce(F.sum("k").over(over_blocks), F.lit(0)).alias("before")
    )
    placed = rows.withColumn("at", F.row_number().over(inside)).join(started, ["key", "block"])
    position = F.col("before") + F.col("at")
    # 36 bits each, so that sums over a hundred million turns fit a long
    mixed = F.md5(F.concat(F.hex("content"), F.lit("@"), position.cast("string")).cast("binary"))
    placed = placed.select("key", "id", "block", position.alias("position"), mixed.alias("mixed")).select(
        "key", "id", "block", "position",
        *[F.conv(F.substring("mixed", 1 + 9 * k, 9), 16, 10).cast("long").alias(p) for k, p in enumerate(_PARTS)],
    )
    so_far = Window.partitionBy("key", "block").orderBy("position").rowsBetween(Window.unboundedPreceding, 0)
    earlier = placed.groupBy("key", "block").agg(*[F.sum(p).alias(p) for p in _PARTS]).select(
        "key", "block", *[F.coalesce(F.sum(p).over(over_blocks), F.lit(0)).alias(f"{p}_before") for p in _PARTS]
    )
    running = placed.select("key", "id", "block", "position", *[F.sum(p).over(so_far).alias(p) for p in _PARTS])
    return running.join(earlier, ["key", "block"]).select(
        "key", "id", "position", *[(F.col(p) + F.col(f"{p}_before")).alias(p) for p in _PARTS]
    )


def maximal(turns: DataFrame) -> DataFrame:
    """(key, conv_id, n_turns, n_logged): conversations that no other one continues.

    ``n_logged`` counts the conversations with exactly these turns.
    """
    found = stored(prefixes(turns), "turn-prefixes")
    size = found.groupBy("key").agg(F.max("position").alias("n"))
    marked = found.join(size, "key")
    whole = marked.where("position = n").groupBy("position", *_PARTS).agg(
        F.min(F.struct(F.col("id").isNull().alias("no_id"), "id", "key")).alias("first"),
        F.count("key").alias("n_logged"),
    )
    proper = marked.where("position < n").select("position", *_PARTS).distinct()
    return whole.join(proper, ["position", *_PARTS], "left_anti").select(
        F.col("first.key").alias("key"),
        F.col("first.id").alias("conv_id"),
        F.col("position").cast("long").alias("n_turns"),
        "n_logged",
    )


def formatted(turns: DataFrame) -> DataFrame:
    """One row per maximal conversation: conv_id, n_turns, n_logged, text.

    Further columns of ``turns`` play no part; an empty table gives an empty result.
    """
    kept = stored(maximal(turns), "conversations")
    written = turns.select(
        _key().alias("key"),
        F.struct(
            _turn().alias("turn"), "role", _head().alias("head"), _content().alias("content"), rendered_turn().alias("line")
        ).alias("turn"),
    )
    texts = (
        written.join(kept.select("key"), "key", "left_semi").groupBy("key")
        .agg(F.sort_array(F.collect_set("turn")).alias("turns"))
        .select("key", F.array_join(F.transform("turns", lambda t: t["line"]), "").alias("text"))
    )
    return kept.join(texts, "key").drop("key")
