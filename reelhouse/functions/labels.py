"""Display labels and the numbers shown beside them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


# The labels below are those reports show.


def tag_bucket(tag_count: Column) -> Column:
    return (
        F.when(tag_count == 0, "No tags")
        .when(tag_count.between(1, 5), "1-5 tags")
        .when(tag_count.between(6, 15), "6-15 tags")
        .otherwise("15+ tags")
    )


def day_type(is_weekend: Column) -> Column:
    return F.when(is_weekend, "Weekend").otherwise("Weekday")


def period(month_name: Column, year: Column) -> Column:
    return F.concat_ws(" ", month_name, year.cast("string"))


def shortened(title: Column, length: int) -> Column:
    """The first characters and an ellipsis, which short titles get as well."""
    return F.concat(F.substring(title, 1, length), F.lit("..."))


def in_units(value: Column, unit: int, digits: int) -> Column:
    """A count in thousands or millions, ties to the even digit."""
    return F.bround(value / unit, digits)


def grouped_integer(value: Column) -> Column:
    return F.format_number(value, 0)


def millions_text(value: Column) -> Column:
    """Millions with one digit, ties to the even digit."""
    return F.concat(F.format_string("%.1f", F.bround(value / 1_000_000, 1)), F.lit("M"))


def percent_text(value: Column) -> Column:
    """The number as it is, never in powers of ten."""
    plain = F.regexp_replace(F.format_string("%.10f", value), r"(\.[0-9]+?)0+$", "$1")
    return F.concat(plain, F.lit("%"))
