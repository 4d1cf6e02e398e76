"""Landed JSON: item files in either layout, and API response pages."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reelhouse import schemas
from reelhouse.sources import storage

LINES = "lines"
ARRAY = "array"
_PERMISSIVE = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": schemas.CORRUPT}
#: The start of an indented array: its line break and the indent of its items.
_INDENTED = re.compile(rb"\[(\r?\n)([ \t]+)\{(?:\r?\n|\})")
_HEAD = 256


def read_items(
    spark: SparkSession, path: str | list[str], schema: T.StructType, layout: str = LINES
) -> DataFrame | None:
    """Items of a landed document set, or None when nothing was landed there.

    ``lines`` is one item per line and splits into many tasks. ``array`` is one
    JSON array per file. An indented one, each item opened and closed on lines of its
    own, is split at the borders of items and read by many tasks; any other is read
    whole by one task. The layout has to be said, since reading one as the other
    raises nothing and returns wrong rows. Text that is not JSON of the schema is
    returned as a row with ``_corrupt_record`` set: of a split file the item, of others
    the line or the file.
    """
    if layout not in (LINES, ARRAY):
        raise ValueError(f"layout must be {LINES!r} or {ARRAY!r}, not {layout!r}")
    paths = [p for p in ([path] if isinstance(path, str) else path) if storage.exists(spark, p)]
    if not paths:
        return None
    with_corrupt = T.StructType(schema.fields + [T.StructField(schemas.CORRUPT, T.StringType())])

    def whole(files: list[str], multi_line: bool) -> DataFrame:
        reader = spark.read.schema(with_corrupt).options(**_PERMISSIVE)
        return reader.option("encoding", "UTF-8").option("multiLine", multi_line).json(files)

    if layout == LINES:
        return whole(paths, False)
    by_indent: dict[tuple[str, str] | None, list[str]] = {}
    for file in [file for place in paths for file in storage.all_files(spark, place)]:
        found = _INDENTED.match(storage.head(spark, file, _HEAD))
        by_indent.setdefault(found and (found[1].decode(), found[2].decode()), []).append(file)
    parts = [
        whole(files, True) if indent is None else _split_arrays(spark, files, with_corrupt, *indent)
        for indent, files in by_indent.items()
    ]
    return reduce(DataFrame.unionByName, parts) if parts else whole(paths, True)


def _split_arrays(
    spark: SparkSession, files: list[str], schema: T.StructType, newline: str, indent: str
) -> DataFrame:
    """Items of indented arrays, the files split where one item ends and the next begins.

    Within a string JSON has no line breaks, so a closing brace at the indent of the
    items, a comma and an opening brace there are a border and nothing else. An item
    written on one line, as an empty one is, has no such border and comes with its
    neighbour; those pieces are read as arrays of their own.
    """
    border = f"{newline}{indent}}},{newline}{indent}{{"
    piece = F.col("value")
    opens = piece.startswith(f"[{newline}{indent}{{")
    last = f"{newline}{indent}\\}}\\s*\\]\\s*$"
    body = F.when(opens, F.expr("substring(value, 2)")).otherwise(F.concat(F.lit("{"), piece))
    body = F.when(piece.rlike(last), F.regexp_replace(body, "\\s*\\]\\s*$", "")).otherwise(
        F.concat(body, F.lit(f"{newline}{indent}}}"))
    )
    texts = spark.read.option("lineSep", border).text(files).select(F.btrim(body).alias("text"))
    several = F.col("text").rlike(f"{newline}{indent}[^\\s}}]|^\\{{[ \\t]*\\}}\\s*,|{newline}{indent}\\}}\\s*,")
    one = F.from_json("text", schema, _PERMISSIVE)
    listed = F.from_json(F.concat(F.lit("["), "text", F.lit("]")), T.ArrayType(schema), _PERMISSIVE)
    broken = F.struct(
        *[F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields[:-1]],
        F.col("text").alias(schemas.CORRUPT),
    )
    items = F.when(several, F.coalesce(listed, F.array(broken))).otherwise(F.array(one))
    return texts.select(F.explode(items).alias("item")).select("item.*")


def split_corrupt(items: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(readable items, unreadable text with its reason and what could be read of it).

    Spark refuses to read ``_corrupt_record`` without any other column, as in a
    bare ``count()`` of either frame.
    """
    corrupt = F.col(schemas.CORRUPT)
    good = items.where(corrupt.isNull()).drop(schemas.CORRUPT)
    bad = items.where(corrupt.isNotNull()).withColumn("dq_issue", F.lit("corrupt_record"))
    return good, bad


def page_problem(items: str = "items"):
    """Why a response page is unusable, null when it is fine."""
    column = F.col(items)
    return F.when(column.isNull(), "no items").when(F.size(column) == 0, "empty items")


def explode_pages(pages: DataFrame) -> DataFrame:
    """The items of all valid pages, each with the request columns of its page."""
    request = [name for name in pages.columns if name not in ("items", "nextPageToken")]
    valid = pages.where(page_problem().isNull())
    return valid.select(*request, F.explode("items").alias("item")).select(*request, "item.*")


def rejected_pages(pages: DataFrame) -> DataFrame:
    return pages.withColumn("dq_issue", page_problem()).where(F.col("dq_issue").isNotNull())
