"""What the operators share: words, splits by id, and tables in the shared folder."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reelhouse.sources import storage

#: Characters that separate words, as a character class.
SPACE = r"[\x20\x09-\x0D]"
_SPACES = " \t\n\x0b\f\r"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def trimmed(text: Column) -> Column:
    """The text without separators at its ends; null stays null."""
    return F.btrim(text, F.lit(_SPACES))


def words(text: Column) -> Column:
    """Words in order; null and empty texts have none."""
    inner = trimmed(F.coalesce(text, F.lit("")))
    return F.when(inner == "", F.array().cast("array<string>")).otherwise(
        F.split(inner, f"{SPACE}+")
    )


def word_count(text: Column) -> Column:
    return F.size(words(text)).cast("long")


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case, every other character as it is."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(text, upper, upper.lower())


def fold(doc_id: Column, n: int) -> Column:
    """crc32 of the id as text, modulo ``n``; a null id counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % n


def short_batches(spark: SparkSession) -> None:
    """Sends texts to Python in batches of few rows, for this session: texts are long,
    and a worker keeps the memory of its largest batch."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 1000)


def _written(df: DataFrame, path: str) -> DataFrame:
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table in the shared folder.

    Cuts the lineage: a lost executor costs no more than the tasks that read the
    table, and what was chosen while writing (row numbers, sizes) stays chosen.
    """
    return _written(df, storage.scratch(df.sparkSession, name))


class Scratch:
    """Tables of one computation, which are deleted when nothing reads them any more."""

    def __init__(self) -> None:
        self._tables: list[tuple[str, DataFrame]] = []

    def stored(self, df: DataFrame, name: str) -> DataFrame:
        path = storage.scratch(df.sparkSession, name)
        table = _written(df, path)
        self._tables.append((path, table))
        return table

    def drop(self, *kept: DataFrame) -> None:
        """Delete all tables but these."""
        left = []
        for path, table in self._tables:
            if any(table is one for one in kept):
                left.append((path, table))
            else:
                storage.delete(table.sparkSession, path)
        self._tables = left
