"""Raw items into the landing folder."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelhouse.sinks import tables
from reelhouse.sources import storage
from reelhouse.sources.json_items import ARRAY, LINES


#: Items a compressed file holds at most: such a file is not split, so many tasks read many.
FILE_ITEMS = 100_000


#: The one column of a frame whose items are JSON text already.
TEXT = "_json"


def write_lines(
    df: DataFrame, path: str, mode: str = "overwrite", options: Mapping[str, str] | None = None
) -> str:
    """JSON lines in compressed files of ``FILE_ITEMS``; as plain text the field names, which
    every line repeats, take most of the space. Of a frame with ``TEXT`` alone the texts are
    the lines."""
    writer = df.write.mode(mode).options(compression="gzip", **(options or {}))
    writer = writer.option("maxRecordsPerFile", FILE_ITEMS)
    if df.columns == [TEXT]:
        writer.text(path)
    else:
        writer.json(path)
    return path


def write_items(df: DataFrame, path: str, layout: str = LINES) -> str:
    """Land items as JSON, one per line, or as one JSON array per output file, indented so
    that readers can split it between items."""
    if layout == LINES:
        write_lines(df, path)
    elif layout == ARRAY:
        lines = df.select(F.to_json(F.struct("*")).alias("value"))
        lines.mapInPandas(_indented, "value string").write.mode("overwrite").text(path)
    else:
        raise ValueError(f"layout must be {LINES!r} or {ARRAY!r}, not {layout!r}")
    return path


def write_parts(parts: Sequence[DataFrame], path: str) -> str:
    """Land items that come in several frames as JSON lines, a frame at a time. The folder
    is complete with the last, and gone when one fails."""
    try:
        for n, part in enumerate(parts, 1):
            write_lines(part, path, "overwrite" if n == 1 else "append", tables.marks(n == len(parts)))
    except Exception:
        storage.delete(parts[0].sparkSession, path)
        raise
    return path


def _indented(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """A task's items as an array, a batch at a time: each item is opened and closed by
    lines of its own, which is where ``json_items`` splits."""
    held = None  # whether a comma follows is known with the next batch
    for batch in batches:
        if len(batch):
            text = ",\n".join("  {\n" + batch["value"].str[1:-1] + "\n  }")
            if held is not None:
                yield pd.DataFrame({"value": [f"{held},"]})
            held = text if held is not None else f"[\n{text}"
    yield pd.DataFrame({"value": ["[]" if held is None else f"{held}\n]"]})
