"""The daily run, stage by stage."""

from __future__ import annotations

from collections.abc import Collection, Sequence
from datetime import date, datetime
from functools import partial

from pyspark.sql import SparkSession

from reelhouse.plans import reports
from reelhouse.plans.bronze import build_bronze, drop_landed
from reelhouse.plans.gold import build_gold
from reelhouse.plans.landing import Pages, land
from reelhouse.plans.roots import Roots
from reelhouse.plans.silver import build_silver
from reelhouse.plans.status import FAILED, Run, RunFailed, TableStatus
from reelhouse.plans.warehouse import build_warehouse
from reelhouse.settings import DEFAULT_MARK, TRACKED_CHANNEL_COLUMNS
from reelhouse.sinks import tables
from reelhouse.sources import storage
from reelhouse.sources.json_items import LINES


def write_reports(spark: SparkSession, roots: Roots, folder: str) -> list[TableStatus]:
    """Run every report over the warehouse; one that fails leaves the others."""
    run, star = Run(spark, "reports"), reports.Star.from_warehouse(spark, roots.warehouse)

    def write(name: str) -> str:
        return tables.overwrite(reports.REPORTS[name](star), folder, name, ())

    run.build({name: partial(write, name) for name in reports.REPORTS})
    return run.statuses


def run_all(
    spark: SparkSession,
    roots: Roots,
    run_ts: datetime,
    as_of: date | None = None,
    pages: Pages | None = None,
    layout: str = LINES,
    default_mark: str = DEFAULT_MARK,
    mark_at_run_time: bool = False,
    batch_id: str | None = None,
    from_scratch: bool = False,
    tracked: Sequence[str] = TRACKED_CHANNEL_COLUMNS,
    reports_to: str | None = None,
    keep_landed: Collection[str] | None = None,
) -> list[TableStatus]:
    """Land (when pages are given), then bronze, silver, gold and warehouse.

    With ``reports_to`` the reports are written there too, a folder each. With
    ``keep_landed`` landed items of other names are deleted once bronze has them all, for
    days of one run. Every
    table and report is attempted; if any failed, ``RunFailed`` is raised at the
    end with the status of all of them.
    """
    statuses: list[TableStatus] = []
    with storage.shuffles_dropped(spark):
        if pages is not None:
            statuses += land(
                spark, roots, pages, run_ts, batch_id, default_mark, mark_at_run_time
            )
        statuses += build_bronze(spark, roots, run_ts, layout=layout)
        if keep_landed is not None and all(status.status != FAILED for status in statuses):
            drop_landed(spark, roots, run_ts, keep_landed)
        statuses += build_silver(spark, roots, run_ts, from_scratch)
        statuses += build_gold(spark, roots, run_ts, as_of)
        statuses += build_warehouse(spark, roots, run_ts, tracked)
        if reports_to is not None:
            statuses += write_reports(spark, roots, reports_to)
    if any(status.status == FAILED for status in statuses):
        raise RunFailed(statuses)
    return statuses
