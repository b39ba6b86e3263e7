import os

import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


def test_every_sql_text_belongs_to_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert len(entry.queries()) >= 100


def test_flagship(spark):
    df = entry.entry(spark)
    assert df.columns[:2] == ["lat", "lon"] and df.count() > 0


# One query per family on the smallest tables, against its SQL text.
@pytest.mark.parametrize("name", [
    "read_reference", "decode_calendar", "validate_range", "regrid_bilinear", "regrid_conservative", "training_table",
    "test_report", "classification_metrics", "change_signal", "select_models", "pending_jobs",
])
def test_against_sql(spark, name):
    import duckdb

    from check import TABLES, compare

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    df = entry.queries()[name](spark, SF)
    cur = con.execute(entry.oracle_sql()[name])
    names = [d[0] for d in cur.description]
    assert compare([tuple(r) for r in df.collect()], cur.fetchall(), df.columns, names) is None


def test_no_python_in_the_plans(spark):
    for name in ("cell_metrics", "training_table", "test_report", "to_grid", "classification_metrics", "ensemble_stats"):
        plan = entry.queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
        for bad in ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
            assert bad not in plan, (name, bad)
