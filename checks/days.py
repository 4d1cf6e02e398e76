"""A lakehouse of two days, its second day of appends, late rows and stream batches.

Built by the library's own jobs over all orders; queries read what the second day
leaves, which has to be what the SQL gives for all rows at once.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import inputs
from reelhouse import settings
from reelhouse.operators import audit
from reelhouse.plans import silver
from reelhouse.plans.gold import build_gold
from reelhouse.plans.roots import Roots
from reelhouse.sinks import landing, tables
from reelhouse.sources import storage
from reelhouse.streaming import bronze_stream

FIRST, LATE = datetime(2001, 9, 1, 1), datetime(2001, 9, 1, 2)
SECOND, STREAMED, TRENDED = datetime(2001, 9, 2, 1), datetime(2001, 9, 2, 3), datetime(2001, 9, 2, 4)
#: What is added to the views of videos whose number ends so, and by which way.
APPENDED, LATE_ROWS, STREAM, TRENDING = 0, 3, 7, 9
_built: dict[tuple[str, str], Roots] = {}


def _some(videos: DataFrame, digit: int) -> DataFrame:
    """The videos whose number ends in ``digit``, with as many views more; 5 for 0."""
    ends_so = F.col("video_id").cast("bigint") % 10 == digit
    return videos.where(ends_so).withColumn("views", F.col("views") + (digit or 5))


def build(spark: SparkSession, sf_dir: str) -> Roots:
    base = storage.scratch(spark, "days")
    roots = Roots.under(base)
    inputs.videos(spark, sf_dir).write.parquet(storage.join(base, "videos"))
    videos = spark.read.parquet(storage.join(base, "videos"))
    stats = next(s for s in settings.SOURCES if s.table == "bronze_video_stats")

    def append(items: DataFrame, table: str, run_ts: datetime) -> None:
        tables.append(audit.ingestion_columns(items, stats.label, run_ts), roots.bronze, table)

    def refine(run_ts: datetime) -> None:
        for spec in silver.TABLES:
            silver.refine(spark, roots, spec, run_ts)
        build_gold(spark, roots, run_ts, as_of=inputs.AS_OF)

    append(inputs.video_items(videos), stats.table, FIRST)
    append(inputs.category_items(spark, sf_dir), "bronze_categories", FIRST)
    refine(FIRST)

    append(inputs.video_items(_some(videos, APPENDED)), stats.table, SECOND)
    append(inputs.video_items(_some(videos, LATE_ROWS)), stats.table, LATE)  # to the day before
    append(inputs.video_items(_some(videos, TRENDING)), "bronze_trending", TRENDED)
    landed = storage.join(base, "landed", stats.raw_name)
    landing.write_items(inputs.video_items(_some(videos, STREAM)), landed)
    bronze_stream.ingest_new_files(
        spark, landed, stats, roots.bronze, storage.join(base, "bad"),
        storage.join(base, "checkpoint"), STREAMED,
    ).awaitTermination()
    refine(SECOND)
    return roots


def roots_for(spark: SparkSession, sf_dir: str) -> Roots:
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _built:
        _built[key] = build(spark, sf_dir)
    return _built[key]
