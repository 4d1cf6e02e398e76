"""Reports come in their stated order."""

from __future__ import annotations

import pytest

from checks import workspace
from reelhouse.plans import dashboard, reports
from tests.conftest import SF_DIR

DESCENDING = {
    reports.top_trending_videos: ("views",),
    reports.most_engaging_videos: ("engagement_rate",),
    reports.fastest_growing_videos: ("views_per_day",),
    reports.channel_performance: ("total_views",),
    reports.top_performing_categories: ("total_views",),
    reports.category_top: ("total_views",),
    reports.monthly_trend_analysis: ("year", "month"),
    reports.weekend_vs_weekday: ("avg_views",),
    reports.tag_count_vs_views: ("avg_views",),
    dashboard.top_videos: ("views",),
    dashboard.velocity: ("views_per_day",),
}


@pytest.mark.parametrize("report", DESCENDING, ids=lambda report: report.__name__)
def test_descending(spark, report):
    keys = [tuple(row[c] for c in DESCENDING[report]) for row in report(workspace.star(spark, SF_DIR)).collect()]
    assert len(keys) > 1
    assert keys == sorted(keys, reverse=True)


def test_the_monthly_series_ascends(spark):
    keys = [(r.year, r.month) for r in dashboard.monthly(workspace.star(spark, SF_DIR)).collect()]
    assert keys == sorted(keys)


@pytest.mark.parametrize(
    ("report", "rows"),
    [
        (reports.top_trending_videos, 20), (reports.most_engaging_videos, 20),
        (reports.fastest_growing_videos, 20), (reports.category_top, 10), (dashboard.velocity, 15),
    ],
    ids=lambda value: getattr(value, "__name__", str(value)),
)
def test_lengths(spark, report, rows):
    assert report(workspace.star(spark, SF_DIR)).count() == rows
