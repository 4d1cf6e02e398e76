"""Engagement metrics of one video."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F


def _count(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(0))


def _share_of_views(amount: Column, views: str) -> Column:
    seen = F.col(views)
    return F.when(seen > 0, F.round(amount / seen * 100, 4)).otherwise(F.lit(0.0))


def engagement_rate(
    views: str = "views", likes: str = "likes", comments: str = "comment_count"
) -> Column:
    """Percent of views that led to a like or a comment; 0 without views."""
    return _share_of_views(_count(likes) + _count(comments), views)


def like_ratio(views: str = "views", likes: str = "likes") -> Column:
    """Percent of views that led to a like; 0 without views."""
    return _share_of_views(_count(likes), views)


def days_since(published: str = "published_at", as_of: date | None = None) -> Column:
    """Whole days up to ``as_of``, at least 1; null and future dates count as 1."""
    today = F.current_date() if as_of is None else F.lit(as_of)
    return F.greatest(F.datediff(today, F.to_date(F.col(published))), F.lit(1))


def view_velocity(views: str = "views", days: str = "days_since_published") -> Column:
    """Views per day since publication."""
    return F.round(_count(views) / F.col(days), 2)


def steady_round(value: Column, digits: int) -> Column:
    """Round half up after dropping the noise a floating-point sum picks up.

    An average of doubles differs in its last bits with the order the partial
    sums arrive in. Cutting it to ten decimals first gives a tie the same answer
    however the rows were partitioned.
    """
    return F.round(value.cast("decimal(28,10)"), digits).cast("double")
