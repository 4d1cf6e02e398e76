"""The commit log of a table: which files its writers have added, in which order.

Every write of ``reelhouse.sinks.tables`` leaves a numbered entry in ``_commits``
beside the partitions: the files it added to each, and which partitions it
replaced. A reader that remembers the last entry it has taken of a partition reads
just the files of later ones, whoever wrote them and for whatever day.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import SparkSession

from reelhouse.sources import storage

FOLDER = "_commits"


@dataclass(frozen=True)
class Commit:
    number: int
    key: str
    files: dict[str, list[str]]
    replaced: frozenset[str]
    day: str | None = None


def _day_of(partition: str) -> str | None:
    for part in partition.split("/"):
        if part.startswith("ingestion_date="):
            return part.split("=", 1)[1]
    return None


def day(commit: Commit, partition: str) -> str:
    """The day a partition's rows were ingested on, as text; empty when nothing tells."""
    return _day_of(partition) or commit.day or ""


def read(spark: SparkSession, path: str) -> list[Commit]:
    """All entries in order, none for a table that never had one."""
    folder = storage.join(path, FOLDER)
    if not storage.exists(spark, folder):
        return []
    found = []
    for name in storage.files(spark, folder, ".json"):
        entry = json.loads(storage.read_text(spark, name) or "{}")
        found.append(
            Commit(
                int(name.rsplit("/", 1)[-1].removesuffix(".json")), entry["key"], entry["files"],
                frozenset(entry["replaced"]), entry.get("day"),
            )
        )
    return sorted(found, key=lambda commit: commit.number)


def current(log: Iterable[Commit]) -> dict[str, list[Commit]]:
    """Of every partition the entries whose files it holds now, oldest first."""
    held: dict[str, list[Commit]] = {}
    for commit in log:
        for partition in commit.files:
            if partition in commit.replaced:
                held[partition] = []
            held.setdefault(partition, []).append(commit)
    return held


def partitions(spark: SparkSession, path: str, depth: int = 1) -> list[str]:
    """Names of the partition folders, ``depth`` columns deep."""
    names = [""]
    for _ in range(depth):
        names = [
            f"{name}/{child}".lstrip("/")
            for name in names
            for child in storage.child_folders(spark, storage.join(path, name) if name else path)
            if "=" in child
        ]
    return sorted(names)


def unlogged(spark: SparkSession, path: str, log: Sequence[Commit]) -> list[str]:
    """Partitions no entry speaks of: an unfinished write, or one by other means."""
    held = current(log)
    depth = max((p.count("/") + 1 for p in held), default=1)
    return [name for name in partitions(spark, path, depth) if name not in held]
