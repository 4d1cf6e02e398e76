"""Every registered query against its SQL, on the smallest tables."""

from __future__ import annotations

import pytest

import __spark_entry__ as contract
from checks import compare, queries
from tests.conftest import SF_DIR

RUN, SQL = contract.queries(), contract.oracle_sql()
QUERIES = {name: RUN[name] for name in queries.QUERIES}


@pytest.fixture(scope="module")
def duck():
    return compare.connect(SF_DIR)


def test_every_query_has_sql():
    assert set(QUERIES) <= set(SQL) <= set(RUN)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_agrees_with_sql(spark, duck, name):
    df = QUERIES[name](spark, SF_DIR)
    assert compare.differences(df, duck, SQL[name]) == []
    plan = df._jdf.queryExecution().executedPlan().toString()
    for avoided in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "InPandas"):
        assert avoided not in plan


def test_entry_has_rows(spark):
    df = contract.entry(spark)
    assert df.columns == [
        "title", "channel_title", "category_name", "views", "likes", "comment_count",
        "engagement_rate", "views_per_day", "published_at",
    ]
    assert len(df.collect()) == 20


def test_comparison_notices_a_wrong_value(spark, duck):
    sql = SQL["filter_threshold"].replace("views > 10000", "views > 10001 or views > 400000")
    wrong = sql.replace("select video_id, views from fact", "select video_id, views + 1 as views from fact")
    assert compare.differences(QUERIES["filter_threshold"](spark, SF_DIR), duck, wrong)
