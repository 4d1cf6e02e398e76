"""A record of every run: what was read, what was written, how many rows."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession

from reelhouse import schemas
from reelhouse.sources import storage

TABLE = "lineage"


def record(
    spark: SparkSession,
    root: str,
    pipeline: str,
    source: str,
    destination: str,
    tables: Iterable[tuple],
    logged_at: datetime,
    details: Mapping[str, str] | None = None,
) -> str:
    """Append one record. ``tables`` are (table, status, rows, error), and, where the
    rows were checked, the counts of the checks."""
    row = (
        pipeline, source, destination, [(*t, None)[:5] for t in tables], dict(details or {}),
        f"{logged_at:%Y-%m-%d %H:%M:%S}", logged_at.date(),
    )
    path = storage.join(root, TABLE)
    frame = spark.createDataFrame([row], schemas.LINEAGE).coalesce(1)
    frame.write.mode("append").partitionBy("run_date").json(path)
    return path


def read(spark: SparkSession, root: str) -> DataFrame:
    path = storage.join(root, TABLE)
    if not storage.exists(spark, path):
        return spark.createDataFrame([], schemas.LINEAGE)
    return spark.read.schema(schemas.LINEAGE).json(path)
