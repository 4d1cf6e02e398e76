"""One source fetched in parts (per category, per keyword) as one frame."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelhouse import settings


def union_shards(shards: Mapping[str, DataFrame], label: str) -> DataFrame:
    """Separately landed parts in one frame, each row labelled with its part.

    A column that some parts lack is null there.
    """
    labelled = [frame.withColumn(label, F.lit(name)) for name, frame in shards.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), labelled)


def label_shards(
    rows: DataFrame,
    category: str,
    label: str = "_source_category",
    listed: Iterable[str] = tuple(settings.TRENDING_CATEGORIES),
    all_label: str = settings.TRENDING_ALL,
) -> DataFrame:
    """Each row once for the overall list and once more for its category's list
    when that category has one: the same rows as a union over all parts, from a
    single scan."""
    own = F.when(F.col(category).isin(*listed), F.col(category))
    labelled = rows.withColumn(label, F.explode(F.array(F.lit(all_label), own)))
    return labelled.where(F.col(label).isNotNull())
