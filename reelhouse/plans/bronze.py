"""Landed JSON to bronze tables."""

from __future__ import annotations

from collections.abc import Collection, Sequence
from datetime import datetime
from functools import partial

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from reelhouse import schemas, settings
from reelhouse.operators import audit
from reelhouse.plans.roots import Roots
from reelhouse.plans.status import Run, Seen, TableStatus
from reelhouse.sinks import lineage, tables
from reelhouse.sources import json_items, storage


_RUN = "run-"


def raw_folder(roots: Roots, run_ts: datetime) -> str:
    """Where the items of a day lie: directly, or in a folder per landing run."""
    return storage.join(roots.raw, f"{run_ts:%Y-%m-%d}")


def run_folder(roots: Roots, run_ts: datetime) -> str:
    """Where one landing run writes; a repeat of it replaces its own items only."""
    return storage.join(raw_folder(roots, run_ts), f"{_RUN}{run_ts:%H%M%S}")


def landed_paths(spark: SparkSession, roots: Roots, run_ts: datetime, name: str) -> list[str]:
    """All places where items of that name were landed on the day of the run."""
    day = raw_folder(roots, run_ts)
    runs = sorted(f for f in storage.child_folders(spark, day) if f.startswith(_RUN))
    places = [storage.join(day, name), *[storage.join(day, run, name) for run in runs]]
    there = [place for place in places if storage.exists(spark, place)]
    gone = [p for p in places if p not in there and storage.exists(spark, _taken(p))]
    if there and gone:
        raise RuntimeError(
            f"{', '.join(gone)} was dropped once in bronze; a day that lands again needs it"
        )
    return there


def _taken(place: str) -> str:
    """Tells that items lay there which bronze has and which were dropped."""
    folder, name = place.rsplit("/", 1)
    return storage.join(folder, f"_taken-{name}")


def drop_landed(
    spark: SparkSession, roots: Roots, run_ts: datetime, keep: Collection[str] = ()
) -> None:
    """Delete the day's landed items that bronze has, all but those of the names in
    ``keep``. Bronze of a day is replaced from all its landing runs, so it raises when a
    later run lands on that day."""
    for spec in settings.SOURCES:
        if spec.raw_name not in keep:
            for place in landed_paths(spark, roots, run_ts, spec.raw_name):
                storage.write_text(spark, _taken(place), "")
                storage.delete(spark, place)


def ingest_source(
    spark: SparkSession,
    roots: Roots,
    spec: settings.SourceSpec,
    run_ts: datetime,
    layout: str = json_items.LINES,
) -> str | None:
    """Write one source's items of the day, from all its landing runs, to its bronze
    table, unreadable text to quarantine."""
    paths = landed_paths(spark, roots, run_ts, spec.raw_name)
    items = json_items.read_items(spark, paths, schemas.RAW_ITEMS[spec.kind], layout)
    if items is None:
        return None
    unreadable = Seen()
    watched = unreadable.watch(items, F.col(schemas.CORRUPT).isNotNull())
    good, _ = json_items.split_corrupt(watched)
    written = tables.replace_partition(
        audit.ingestion_columns(good, spec.label, run_ts), roots.bronze, spec.table, run_ts.date()
    )
    _, corrupt = json_items.split_corrupt(items)
    tables.quarantine(
        audit.ingestion_columns(corrupt, spec.label, run_ts).drop("ingestion_date"),
        roots.quarantine,
        spec.table.replace("bronze", "quarantine_bronze", 1),
        run_ts.date(),
        any_rows=unreadable.any(),
    )
    return written


def build_bronze(
    spark: SparkSession,
    roots: Roots,
    run_ts: datetime,
    sources: Sequence[settings.SourceSpec] = settings.SOURCES,
    layout: str = json_items.LINES,
) -> list[TableStatus]:
    run = Run(spark, "bronze")
    run.build(
        {
            spec.table: partial(ingest_source, spark, roots, spec, run_ts, layout)
            for spec in sources
        },
        run_date=run_ts.date(),
    )
    lineage.record(
        spark, roots.lineage, "bronze", roots.raw, roots.bronze, run.lineage_rows(), run_ts
    )
    return run.statuses
