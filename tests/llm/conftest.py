from __future__ import annotations

import pandas as pd
import pytest
from pyspark.sql import functions as F

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture
def docs(spark):
    """``docs((id, text, source), …)`` makes a table of documents with clashing extra columns."""

    def make(*rows):
        full = [(i, t, "en", s, len(t or "")) for i, t, s in rows]
        frame = spark.createDataFrame(full, SCHEMA)
        for name in ("row", "size", "kept", "score", "n", "id", "class", "node", "hash", "run", "y", "_piece"):
            frame = frame.withColumn(name, F.lit("extra"))
        return frame

    return make


@pytest.fixture(scope="session")
def corpus(spark):
    return spark.read.parquet(f"{SF_DIR}/documents.parquet")


@pytest.fixture(scope="session")
def corpus_rows():
    return pd.read_parquet(f"{SF_DIR}/documents.parquet")


def dicts(df):
    return [r.asDict(recursive=True) for r in df.collect()]
