"""Text to typed value. Text that cannot be read becomes null, never an error."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def to_count(text: Column) -> Column:
    return text.try_cast("bigint")


def to_utc(text: Column) -> Column:
    return F.try_to_timestamp(text)


def unreadable(text: Column, value: Column) -> Column:
    """True where there was text but no value came out of it."""
    return text.isNotNull() & value.isNull()


def video_id(id_text: Column) -> Column:
    """The id of an item whose ``id`` may be plain text or ``{"videoId": …}``.

    Read with ``id`` declared as string, a nested id arrives as its JSON text. A
    nested id without ``videoId`` has no id at all and so does an empty one.
    """
    inner = F.when(
        id_text.startswith("{"), F.get_json_object(id_text, "$.videoId")
    ).otherwise(id_text)
    return F.nullif(inner, F.lit(""))
