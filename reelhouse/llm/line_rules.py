"""Quality rules: base counts of each text, and lines that repeat across a host.

A line, lower-cased and with its separators collapsed, is boilerplate when more
distinct documents of one host hold it than the host's limit allows. Such lines
are removed; a document that loses more than its share of words is rejected.
Exact copies of a text count as one document, so a popular document does not
condemn its own lines.

Lines are hashed where they are read. One row per (host, line, text) and task
leaves the first aggregation, one per (host, line) the second; a line that a
third of all documents hold is a count by then. Only lines above the limit go
back to the documents that hold them, by a join AQE can broadcast or split.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelhouse.llm.text import SPACE, ascii_lower, stored, trimmed, words

SYMBOLS = "#*$%&|<>"

#: A line is over the limit in more than this share of its host's distinct documents;
#: in so few documents as this it may be chance, whatever their share.
LEAST_DOCS = 5
SHARE_OF_HOST = 0.005
#: A document is depleted when removed lines held more than this share of its words.
MOST_REMOVED = 0.5
#: Base rule: fewer words, or a larger percentage of repeated ones, fail.
LEAST_WORDS = 50
MOST_REPEATED = 50


def repeated_words(tokens: Column) -> Column:
    """How many words lie in three-word windows that occur twice or more.

    ``tokens`` must be a column, not an expression: it is read once per window.
    """
    windows = F.transform(
        F.slice(tokens, F.lit(1), F.greatest(F.size(tokens) - 2, F.lit(0))),
        lambda word, i: F.struct(
            F.concat_ws(" ", word, F.get(tokens, i + 1), F.get(tokens, i + 2)).alias("gram"),
            i.alias("at"),
        ),
    )
    return windows


def _covered(ordered: Column) -> Column:
    twice = F.filter(
        ordered,
        lambda x, i: (x["gram"] == F.get(ordered, i - 1)["gram"])
        | (x["gram"] == F.get(ordered, i + 1)["gram"]),
    )
    spots = F.flatten(F.transform(twice, lambda x: F.array(x["at"], x["at"] + 1, x["at"] + 2)))
    return F.size(F.array_distinct(spots)).cast("long")


def _line(line: Column) -> Column:
    """The line as it is compared: lower case, separators as one space, no ends."""
    return ascii_lower(F.regexp_replace(trimmed(line), f"{SPACE}+", " "))


def _hash(line: Column) -> Column:
    return F.unhex(F.md5(line.cast("binary")))


def counted(docs: DataFrame, host_col: str = "source") -> DataFrame:
    """One narrow row per row of ``docs``, from one pass over the texts.

    Columns: doc_id, row, host, copy (hash of the text), the base counts, and the
    text's lines as (hash, number of words). Null text counts as empty.
    """
    text = F.col("_text")
    lines = F.filter(F.split(text, "\n"), lambda line: trimmed(line) != "")
    split = docs.select(
        "doc_id",
        F.monotonically_increasing_id().alias("row"),
        F.col(host_col).alias("host"),
        F.coalesce("text", F.lit("")).alias("_text"),
    ).select("*", words(text).alias("_words"), lines.alias("_lines"))
    ordered = split.select(
        "*",
        F.sort_array(repeated_words(F.col("_words"))).alias("_windows"),
        F.transform("_lines", _line).alias("_plain"),
    )
    return stored(
        ordered.select(
            "doc_id",
            "row",
            "host",
            _hash(text).alias("copy"),
            F.size("_words").cast("long").alias("n_words"),
            F.length(F.translate(text, " \t\n\x0b\f\r", "")).cast("long").alias("word_chars"),
            (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("long").alias("n_symbols"),
            (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
            _covered(F.col("_windows")).alias("n_repeat_words"),
            F.transform(
                "_plain",
                lambda line: F.struct(
                    _hash(line).alias("line"), F.size(F.split(line, " ")).cast("long").alias("words")
                ),
            ).alias("lines"),
        ),
        "line-counts",
    )


def frequent_lines(
    table: DataFrame, least_docs: int = LEAST_DOCS, share_of_host: float = SHARE_OF_HOST
) -> DataFrame:
    """(host, line, n_docs) of the lines above their host's limit."""
    held = table.select("host", "copy", F.explode(F.array_distinct(F.transform("lines", lambda x: x["line"]))).alias("line"))
    per_line = (
        held.groupBy("host", "line", "copy").agg(F.lit(1).alias("one"))
        .groupBy("host", "line").agg(F.count("one").alias("n_docs"))
        .where(F.col("n_docs") > least_docs)
    )
    copies = table.groupBy("host", "copy").agg(F.lit(1).alias("one"))
    hosts = copies.groupBy(F.col("host").alias("_of")).agg(F.count("one").alias("_all"))
    return (
        per_line.join(hosts, F.col("host").eqNullSafe(F.col("_of")))
        .where(F.col("n_docs") > F.col("_all") * share_of_host)
        .select("host", "line", "n_docs")
    )


def judge(
    docs: DataFrame,
    host_col: str = "source",
    least_docs: int = LEAST_DOCS,
    share_of_host: float = SHARE_OF_HOST,
    most_removed: float = MOST_REMOVED,
) -> DataFrame:
    """One row per row of ``docs``: base counts, n_removed, base_failed, kept.

    Null texts are empty and fail. A null host is a host of its own. Repeated rows
    are judged each. Further columns of ``docs`` play no part; an empty table gives
    an empty result.
    """
    table = counted(docs, host_col)
    often = frequent_lines(table, least_docs, share_of_host)
    held = table.select("row", F.col("host").alias("_host"), F.explode("lines").alias("held"))
    hit = F.col("_host").eqNullSafe(F.col("host")) & (F.col("held.line") == F.col("line"))
    removed = held.join(often, hit).groupBy("row").agg(F.sum("held.words").alias("n_removed"))
    failed = (F.col("n_words") < LEAST_WORDS) | (
        100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words")
    )
    return (
        table.drop("lines", "copy", "host").join(removed, "row", "left")
        .withColumn("n_removed", F.coalesce("n_removed", F.lit(0).cast("long")))
        .withColumn("base_failed", failed)
        .withColumn("kept", ~failed & (F.col("n_removed") <= most_removed * F.col("n_words")))
        .drop("row")
    )


def cleaned(docs: DataFrame, host_col: str = "source", **limits) -> DataFrame:
    """The documents that are kept, without their frequent lines; same columns."""
    table = counted(docs, host_col)
    often = frequent_lines(table, **limits)
    held = table.select("row", "doc_id", "copy", "n_words", "n_repeat_words", F.col("host").alias("_host"), F.posexplode("lines"))
    hit = F.col("_host").eqNullSafe(F.col("host")) & (F.col("col.line") == F.col("line"))
    cut = (
        held.join(often, hit).groupBy("row", "doc_id", "copy", "_host")
        .agg(F.collect_set("line").alias("_cut"), F.sum("col.words").alias("_gone"))
        .groupBy("doc_id", "copy", "_host").agg(F.first("_cut").alias("_cut"), F.first("_gone").alias("_gone"))
    )
    good = table.where(
        (F.col("n_words") >= LEAST_WORDS)
        & (100 * F.col("n_repeat_words") <= MOST_REPEATED * F.col("n_words"))
    ).select(F.col("doc_id").alias("_id"), F.col("copy").alias("_copy"), F.col("host").alias("_from"), F.col("n_words").alias("_n")).distinct()
    verdict = (
        good.join(
            cut,
            F.col("_id").eqNullSafe(F.col("doc_id"))
            & (F.col("_copy") == F.col("copy"))
            & F.col("_from").eqNullSafe(F.col("_host")),
            "left",
        )
        .where(F.coalesce("_gone", F.lit(0)) <= MOST_REMOVED * F.col("_n"))
        .select("_id", "_copy", "_from", "_cut")
    )
    marked = docs.withColumn("_text_hash", _hash(F.coalesce("text", F.lit(""))))
    found = marked.join(
        verdict,
        marked["doc_id"].eqNullSafe(verdict["_id"])
        & (marked["_text_hash"] == verdict["_copy"])
        & marked[host_col].eqNullSafe(verdict["_from"]),
    )
    left = F.array_join(
        F.filter(
            F.split("text", "\n"),
            lambda line: F.coalesce(~F.array_contains("_cut", _hash(_line(line))), F.lit(True)),
        ),
        "\n",
    )
    return found.withColumn("_left", F.when(F.col("_cut").isNull(), F.col("text")).otherwise(left)).select(
        *[F.col("_left").alias("text") if c == "text" else marked[c] for c in docs.columns]
    )
