"""Bronze as a stream over the landing folder: each landed file is read once.

The rows are those of the batch load, in a table of their own beside it, whose
only partition column is the number of the micro-batch. Progress is kept in a
checkpoint folder, so a run picks up only files it has not seen, however many lie
there. Every micro-batch is entered in the commit log of its table, from which the
silver job takes each once, as it does the days of the batch load.
"""

from __future__ import annotations

from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from reelhouse import schemas, settings
from reelhouse.operators import audit
from reelhouse.sinks import tables
from reelhouse.sources import json_items, layers, storage
from reelhouse.sources.layers import stream_table

BATCH = "stream_batch"


def with_stream(spark: SparkSession, bronze_root: str, table: str) -> DataFrame | None:
    """Rows of the batch load and of the stream, None when neither has written."""
    schema = layers.schema_of(table)
    parts = [
        layers.read_table(spark, bronze_root, name, schema) for name in (table, stream_table(table))
    ]
    parts = [part for part in parts if part is not None]
    return reduce(DataFrame.unionByName, parts) if parts else None


def ingest_new_files(
    spark: SparkSession,
    landing: str,
    spec: settings.SourceSpec,
    bronze_root: str,
    quarantine_root: str,
    checkpoint_root: str,
    run_ts: datetime,
    files_per_batch: int = 1000,
) -> StreamingQuery:
    """Read all files not read before, then stop. JSON Lines layout only.

    Every micro-batch owns a partition named by its number and replaces it, so a
    batch that is repeated after a failure, even on another day, leaves no
    duplicates. ``with_stream`` reads batch and stream rows together.
    """
    schema = T.StructType(
        schemas.RAW_ITEMS[spec.kind].fields + [T.StructField(schemas.CORRUPT, T.StringType())]
    )
    items = (
        spark.readStream.schema(schema)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", schemas.CORRUPT)
        .option("maxFilesPerTrigger", files_per_batch)
        .json(landing)
    )

    def write(batch: DataFrame, number: int) -> None:
        good, corrupt = json_items.split_corrupt(batch)
        for rows, root, table in (
            (good, bronze_root, spec.table),
            (corrupt, quarantine_root, spec.table.replace("bronze", "quarantine_bronze", 1)),
        ):
            stamped = audit.ingestion_columns(rows, spec.label, run_ts)
            numbered = stamped.withColumn(BATCH, F.lit(number).cast("bigint"))
            tables.replace_partitions(
                numbered, root, stream_table(table), (BATCH,), day=f"{run_ts:%Y-%m-%d}"
            )

    return (
        items.writeStream.foreachBatch(write)
        .option("checkpointLocation", storage.join(checkpoint_root, spec.table))
        .trigger(availableNow=True)
        .start()
    )

