"""Writing the commit log; ``reelhouse.sources.commits`` says what it is for."""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

from pyspark.sql import SparkSession

from reelhouse.sources import commits, storage


def record(
    spark: SparkSession,
    path: str,
    depth: int = 1,
    only: Sequence[str] | None = None,
    replaced: bool = False,
    day: str | None = None,
) -> str | None:
    """Log what a finished write has changed: files no entry names are added ones, and a
    partition that has lost files was replaced.

    ``only`` names the partitions that were written, so that no others are listed;
    ``replaced`` says that those were replaced. Nothing changed, nothing logged. An
    entry is created under the next free number and never overwritten, so writers at
    the same time get an entry each; each then logs what it finds, and a reader takes
    a file once.
    """
    log = commits.read(spark, path)
    held = {
        name: {file for commit in entries for file in commit.files[name]}
        for name, entries in commits.current(log).items()
    }
    files, gone = {}, set()
    for name in commits.partitions(spark, path, depth) if only is None else only:
        place = storage.join(path, name) if name else path
        there = storage.data_files(spark, place)
        before = held.get(name, set())
        if replaced or before - set(there):
            gone.add(name)
            files[name] = there
        elif new := [file for file in there if file not in before]:
            files[name] = new
    if not files:
        return None
    entry = {"key": uuid.uuid4().hex, "files": files, "replaced": sorted(gone), "day": day}
    number = log[-1].number + 1 if log else 0
    while not storage.create_text(
        spark, storage.join(path, commits.FOLDER, f"{number:020d}.json"), json.dumps(entry)
    ):
        number += 1
    return entry["key"]


def adopt(spark: SparkSession, path: str, depth: int = 1) -> str | None:
    """Log all partitions that are there, for a table written by other means."""
    return record(spark, path, depth)
