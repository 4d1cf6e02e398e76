"""Queries against their SQL, and what plans may not hold."""

from __future__ import annotations

import pytest

from checks import compare
from reelhouse.llm import queries
from tests.llm.conftest import SF_DIR


@pytest.fixture(scope="module")
def duck():
    return compare.connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_agrees_with_sql(spark, duck, name):
    assert compare.differences(queries.QUERIES[name](spark, SF_DIR), duck, queries.SQL[name]) == []


@pytest.mark.parametrize("name", ["op1_line_frequency", "op2_chat_format", "op3_mixing", "op10_exact_dedup"])
def test_native_plans(spark, name):
    plan = queries.QUERIES[name](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    for avoided in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "InPandas", "InArrow"):
        assert avoided not in plan


def test_all_registered():
    import __spark_entry__ as contract

    found = contract.queries()
    for n in range(1, 14):
        assert sum(name.startswith(f"op{n}_") for name in found) == 1
    assert "pipeline" in found
    assert set(contract.oracle_sql()) <= set(found)


def test_line_rule_agrees_with_sql_where_production_limits_remove(spark, tmp_path):
    import duckdb

    rows = []
    for i in range(600):
        notice = f"All Rights\tReserved by the Publisher of these many pages number {'x ' * 20}"
        own = " ".join(f"u{i}x{k}" for k in range(60 if i % 3 else 25))
        # 120 of 400 distinct texts of a hold the notice, of b 100 of 200
        a, held = i < 400, i < 120 or 400 <= i < 500
        rows.append((i, f"{notice}\n{own}" if held else own + " " + own[::-1], "en", "a" if a else "b", 0))
    rows += [(600 + i, rows[i][1], "en", None, 0) for i in range(110)]
    rows += [(800 + i, rows[130][1], "en", "a", 0) for i in range(110)]  # copies count once
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    frame.write.parquet(f"{tmp_path}/documents.parquet")
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{tmp_path}/documents.parquet/*.parquet'")
    found = queries.op1_line_frequency(spark, str(tmp_path))
    assert compare.differences(found, con, queries.SQL["op1_line_frequency"]) == []
    judged = {r["doc_id"]: r for r in found.collect()}
    with_notice = [*range(120), *range(400, 500), *range(600, 710)]
    assert all(judged[i]["n_removed"] > 0 for i in with_notice)
    assert all(judged[i]["n_removed"] == 0 for i in [*range(120, 400), *range(500, 600), *range(800, 910)])
    rejected = {i for i, r in judged.items() if not r["base_failed"] and not r["kept"]}
    assert len(rejected) > 40 and rejected <= set(with_notice)
