"""Completeness, validity and uniqueness checks.

A row is judged once, in one projection: ``dq_issue`` holds the first check it
fails (null when it passes) and ``dq_failed_cols`` the columns at fault. The
clean and the quarantined rows are two filters over that one frame.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelhouse.operators import dedup
from reelhouse.operators.columns import empty_like
from reelhouse.operators.flatten import UNPARSED
from reelhouse.settings import QualityRules

ISSUE = "dq_issue"
FAILED = "dq_failed_cols"


def _existing(df: DataFrame, names) -> list[str]:
    return [name for name in names if name in df.columns]


def _present(name: str) -> Column:
    return F.col(name).isNotNull()


def _not_negative(name: str) -> Column:
    return F.col(name).isNull() | (F.col(name) >= 0)


def _all(tests: list[Column]) -> Column:
    return reduce(and_, tests, F.lit(True))


def judge(df: DataFrame, rules: QualityRules) -> DataFrame:
    """Add ``dq_issue`` and ``dq_failed_cols`` to every row."""
    required = _existing(df, rules.required)
    counts = _existing(df, rules.non_negative)
    incomplete = ~_all([_present(name) for name in required])
    negative = ~_all([_not_negative(name) for name in counts])
    failed = [F.when(~_present(name), F.lit(name)) for name in required]
    failed += [F.when(~_not_negative(name), F.lit(name)) for name in counts]
    culprits = F.array_compact(F.array(*failed)) if failed else F.array().cast("array<string>")
    if UNPARSED in df.columns:
        culprits = F.array_union(culprits, F.col(UNPARSED))
    judged = df.withColumns(
        {
            ISSUE: F.when(incomplete, F.lit(f"NULL in: {required}")).when(
                negative, F.lit(f"Negative values in: {counts}")
            ),
            FAILED: culprits,
        }
    )
    return judged.drop(UNPARSED)


def passed(judged: DataFrame) -> DataFrame:
    return judged.where(F.col(ISSUE).isNull()).drop(ISSUE, FAILED)


def quarantined(judged: DataFrame) -> DataFrame:
    return judged.where(F.col(ISSUE).isNotNull())


def completeness(df: DataFrame, required) -> tuple[DataFrame, DataFrame]:
    """Split on required columns; with none of them present every row is good."""
    if not _existing(df, required):
        return df, empty_like(df, dq_issue="string", dq_failed_cols="array<string>")
    judged = judge(df, QualityRules("", required=tuple(required)))
    return passed(judged), quarantined(judged)


def validity(df: DataFrame, non_negative) -> tuple[DataFrame, DataFrame]:
    """Split on counts below zero; null passes."""
    if not _existing(df, non_negative):
        return df, empty_like(df, dq_issue="string", dq_failed_cols="array<string>")
    judged = judge(df, QualityRules("", non_negative=tuple(non_negative)))
    return passed(judged), quarantined(judged)


def uniqueness(df: DataFrame, key: str | list[str]) -> DataFrame:
    """The latest row of each key."""
    return dedup.keep_latest(df, key)


def run_checks(df: DataFrame, rules: QualityRules) -> tuple[DataFrame, DataFrame]:
    """All checks in order: (clean and unique rows, quarantined rows)."""
    judged = judge(df, rules)
    return uniqueness(passed(judged), rules.key), quarantined(judged)


def check_counts(df: DataFrame, rules: QualityRules) -> DataFrame:
    """One row of counts for every check, from one aggregation over the input."""
    return counts_of(judge(df, rules), rules)


def counts_of(judged: DataFrame, rules: QualityRules, also: dict[str, Column] | None = None) -> DataFrame:
    """The same from rows that are judged already; of them only key and outcome are read.
    ``also`` are further aggregates over the counts of each key."""
    flags = judged.select(
        F.col(rules.key).alias("key"),
        F.coalesce(F.startswith(ISSUE, F.lit("NULL in")), F.lit(False)).alias("incomplete"),
        F.coalesce(F.startswith(ISSUE, F.lit("Negative")), F.lit(False)).alias("negative"),
        F.col(ISSUE).isNull().alias("good"),
    )
    # Per key first: the distinct count below then needs no second pass, and a
    # hot key is one row per task before anything is shuffled.
    per_key = flags.groupBy("key").agg(
        F.count("*").alias("rows"),
        F.count_if("incomplete").alias("incomplete"),
        F.count_if("negative").alias("negative"),
        F.count_if("good").alias("good"),
        F.max("good").alias("kept"),
    )
    total = lambda name: F.coalesce(F.sum(name), F.lit(0)).alias
    return per_key.agg(
        total("rows")("input_rows"),
        (F.coalesce(F.sum(F.col("rows") - F.col("incomplete")), F.lit(0))).alias("complete_good"),
        total("incomplete")("complete_bad"),
        total("good")("valid_good"),
        total("negative")("valid_bad"),
        F.count_if("kept").alias("unique_rows"),
        (F.coalesce(F.sum("good"), F.lit(0)) - F.count_if("kept")).alias("duplicates_removed"),
        *[value.alias(name) for name, value in (also or {}).items()],
    )
