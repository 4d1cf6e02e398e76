"""Columns that say which run, source and request a row came from."""

from __future__ import annotations

import uuid
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelhouse import settings


def ingestion_columns(df: DataFrame, source: str, run_ts: datetime) -> DataFrame:
    """Add ``ingestion_date``, ``ingestion_timestamp`` and ``source``."""
    return df.withColumns(
        {
            "ingestion_date": F.lit(run_ts.date()),
            "ingestion_timestamp": F.lit(f"{run_ts:%Y-%m-%d %H:%M:%S}"),
            "source": F.lit(source),
        }
    )


def new_batch_id(run_ts: datetime) -> str:
    """One per run, made where the run starts."""
    return f"batch_{run_ts:%Y%m%d_%H%M%S}_{uuid.uuid4().hex[:8]}"


def item_columns(
    df: DataFrame,
    batch_id: str,
    run_ts: datetime,
    endpoint: str | None = None,
    source_system: str = settings.SOURCE_SYSTEM,
    **labels: str,
) -> DataFrame:
    """Stamp raw items; ``labels`` such as ``category="10"`` become ``_source_category``."""
    stamped = {
        "_batch_id": F.lit(batch_id),
        "_ingestion_ts": F.lit(f"{run_ts:%Y-%m-%dT%H:%M:%SZ}"),
        "_source_system": F.lit(source_system),
    }
    if endpoint is not None:
        stamped["_api_endpoint"] = F.lit(endpoint)
    for name, value in labels.items():
        stamped[f"_source_{name}"] = F.lit(value)
    return df.withColumns(stamped)
