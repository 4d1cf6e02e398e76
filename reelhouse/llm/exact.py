"""Exact duplicates by merging sorted digest runs up a tree.

Every partition of the input makes one run: its distinct digests, each with the
smallest identifier and the number of rows. In each round ``FAN`` neighbouring
runs merge into one, until one run is left; the merge keeps the smallest
identifier per digest and adds the counts. A run is spread over the cluster by
digest, so merging all runs needs no task that sees a whole run, and a text that
a third of all rows share sends one row per run into a round.

A digest counts as the same text only together with an independent second hash
and the length, at every level: rows that disagree there stay apart.

On the way down the winner goes to the runs first and from there to the rows, so
rows of a popular text are joined within their own partition's run.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelhouse.llm.text import SPACE, stored

FAN = 16
_KEY = ["digest", "second", "length"]


def normalised(text: Column) -> Column:
    """Each stretch of separators as one space; null as empty text."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), f"{SPACE}+", " ")


def _merge(runs: DataFrame) -> DataFrame:
    return runs.groupBy("run", *_KEY).agg(F.min("first").alias("first"), F.sum("n").alias("n"))


def duplicate_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: the id, and which row of its group stays.

    Columns: the id, ``keep_id``, ``group_size``, ``kept``, ``text_sha256``.
    Null texts are empty texts. Null ids lose against any id. Of rows that repeat
    both id and text exactly one is kept. Other columns of ``docs`` play no part.
    An empty table gives an empty result.
    """
    text = F.col("_text")
    rows = stored(
        docs.select(F.col(id_col).alias("_id"), normalised(F.col(text_col)).alias("_text")).select(
            "_id",
            F.monotonically_increasing_id().alias("row"),
            F.unhex(F.sha2(text, 256)).alias("digest"),
            F.xxhash64(text).alias("second"),
            F.length(text).alias("length"),
        ),
        "digest-rows",
    )
    # the upper bits of the row number are the partition that wrote the row
    leaves = _merge(
        rows.select(
            F.shiftright("row", 33).alias("run"),
            *_KEY,
            F.struct(F.col("_id").isNull().alias("no_id"), F.col("_id").alias("id"), "row").alias("first"),
            F.lit(1).cast("long").alias("n"),
        )
    )
    last = rows.agg(F.max(F.shiftright("row", 33))).first()[0] or 0
    merged = leaves
    while True:
        merged = _merge(merged.withColumn("run", F.floor(F.col("run") / FAN)))
        last //= FAN
        if not last:
            break
    winners = leaves.select("run", *_KEY).join(merged.drop("run"), _KEY)
    return rows.withColumn("run", F.shiftright("row", 33)).join(winners, ["run", *_KEY]).select(
        F.col("_id").alias(id_col),
        F.col("first.id").alias("keep_id"),
        F.col("n").alias("group_size"),
        (F.col("row") == F.col("first.row")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def without_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each group of equal texts: whole rows, same columns.

    Rows are matched by id; where an id is null or repeated with different texts,
    by id and digest, and of fully equal rows one stays.
    """
    groups = stored(duplicate_groups(docs, id_col, text_col), "digest-groups")
    kept = groups.where("kept").select(F.col(id_col).alias("_keep"), F.col("text_sha256").alias("_sha"))
    marked = docs.withColumn("_own_sha", F.sha2(normalised(F.col(text_col)), 256))
    same = marked[id_col].eqNullSafe(kept["_keep"]) & (marked["_own_sha"] == kept["_sha"])
    found = marked.join(kept, same, "left_semi")
    # rows that repeat id and text are all matched above; one of them stays
    if not groups.where(~F.col("kept") & F.col(id_col).eqNullSafe(F.col("keep_id"))).isEmpty():
        found = found.dropDuplicates([id_col, "_own_sha"])
    return found.drop("_own_sha")
