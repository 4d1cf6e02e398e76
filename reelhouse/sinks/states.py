"""Writing tables kept as shared parts; ``reelhouse.sources.states`` says what they are."""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping, Sequence
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession

from reelhouse.sinks import snapshots as snapshots_out
from reelhouse.sinks import tables
from reelhouse.sources import commits, snapshots, states, storage

_ROWS = "rows="


def write(
    spark: SparkSession,
    rows: DataFrame | Sequence[DataFrame] | None,
    root: str,
    table: str,
    run_ts: datetime,
    by: Sequence[str],
    carried: Mapping[str, Sequence[str]],
    notes: Mapping,
    together: bool = True,
) -> str:
    """Write the parts that ``rows`` holds and the state of the run.

    ``carried`` are parts taken over from an earlier state; one that ``rows`` also has
    then lies in several folders. ``rows`` may read any state, also that of an earlier
    attempt of the run: nothing is overwritten, and the state is complete only when
    its folder is. Several frames, and ``together``, as for ``tables.overwrite``.
    """
    path = storage.join(root, table)
    parts = {part: list(places) for part, places in carried.items()}
    if rows is not None:
        own = f"{_ROWS}{run_ts:%Y%m%dT%H%M%S}-{uuid.uuid4().hex[:12]}"
        tables.overwrite(rows, path, own, by, together)
        for part in commits.partitions(spark, storage.join(path, own), len(by)):
            parts.setdefault(part, []).append(f"{own}/{part}")
    folder = snapshots.folder(root, table, run_ts)
    if storage.exists(spark, folder):
        storage.delete(spark, folder)
    text = json.dumps({"parts": parts, "notes": dict(notes)})
    storage.write_text(spark, storage.join(folder, states.MANIFEST), text)
    storage.write_text(spark, storage.join(folder, "_SUCCESS"), "")
    return folder


def prune(
    spark: SparkSession, root: str, table: str, run_ts: datetime, keep: int = snapshots_out.KEEP
) -> list[str]:
    """Delete states older than those of the newest ``keep`` days, and folders that no
    state left refers to; returns the deleted folders. One run at a time may write a table.
    """
    path = storage.join(root, table)

    def told() -> dict[datetime, set[str]]:
        found = {t: states.load(spark, root, table, t) for t in snapshots.run_times(spark, root, table)}
        return {
            t: {folder for places in state.parts.values() for folder in places}
            for t, state in found.items()
            if state is not None
        }

    before = told()
    removed = snapshots_out.prune(spark, root, table, run_ts, keep)
    after = told()
    used = set().union(*after.values())
    unused = set().union(*before.values()) - used
    owners = {folder.split("/", 1)[0] for folder in used}
    for folder in storage.child_folders(spark, path):
        if folder.startswith(_ROWS) and folder not in owners:
            storage.delete(spark, storage.join(path, folder))
            removed.append(storage.join(path, folder))
    for folder in unused:
        if folder.split("/", 1)[0] in owners:
            storage.delete(spark, storage.join(path, folder))
            removed.append(storage.join(path, folder))
    return removed
