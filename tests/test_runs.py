"""Tables written in runs: what readers see before, between and after commits."""

import pytest
from pyspark.sql import functions as F

from isohyet.sources import runs, sinks


def table(spark, rows):
    return spark.createDataFrame(rows, "year int, model string, x double")


def rows_of(spark, path):
    return sorted((tuple(r[c] for c in ("year", "model", "x")) for r in sinks.read_table(spark, path).collect()), key=str)


@pytest.fixture
def path(tmp_path):
    return str(tmp_path / "t")


def test_a_rebuilt_table_has_no_stale_partitions(spark, path):
    sinks.write_table(table(spark, [(2000, "a", 1.0), (2001, "a", 2.0)]), path, ("year",))
    sinks.write_table(table(spark, [(2002, "a", 3.0)]), path, ("year",))
    assert rows_of(spark, path) == [(2002, "a", 3.0)]


def test_a_job_killed_midway_leaves_the_old_run(spark, path):
    sinks.write_table(table(spark, [(2000, "a", 1.0)]), path, ("year",))
    boom = F.when(F.col("x") > 1, F.raise_error(F.lit("killed"))).otherwise(F.col("x"))
    with pytest.raises(Exception, match="killed"):
        sinks.write_table(table(spark, [(2000, "a", 0.0), (2000, "a", 9.0)]).withColumn("x", boom), path, ("year",))
    # Files of a run without a record, and a record that was cut off.
    table(spark, [(1999, "b", 5.0)]).write.parquet(runs.new_run(path))
    (tmp := __import__("pathlib").Path(path) / "_commits" / "00000002.json").write_text('{"parts": [{"fol')
    assert rows_of(spark, path) == [(2000, "a", 1.0)]
    tmp.unlink()
    sinks.write_table(table(spark, [(2003, "c", 1.0)]), path, ("year",))
    assert rows_of(spark, path) == [(2003, "c", 1.0)]


def test_some_models_are_replaced_and_the_rest_stays(spark, path):
    write = lambda rows, *names: sinks.write_table(table(spark, rows), path, ("model",), ("model",), [(n,) for n in names])
    write([(2000, "a", 1.0), (2000, "b", 1.0)], "a", "b")
    write([(2001, "b", 2.0), (2001, "c", 2.0)], "b", "c")
    assert rows_of(spark, path) == [(2000, "a", 1.0), (2001, "b", 2.0), (2001, "c", 2.0)]
    write([], "c")  # a run that found no rows for c
    assert rows_of(spark, path) == [(2000, "a", 1.0), (2001, "b", 2.0)]
    plan = sinks.read_table(spark, path).filter("model = 'a'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(model" in plan


def test_part_of_a_whole_table_is_replaced(spark, path):
    sinks.write_table(table(spark, [(2000, "a", 1.0), (2000, "b", 1.0), (2000, None, 1.0), (2001, "b", 1.0)]), path)
    sinks.write_table(table(spark, [(2000, "b", 7.0)]), path, (), ("model", "year"), [("b", 2000)])
    assert rows_of(spark, path) == sorted([(2000, "a", 1.0), (2000, None, 1.0), (2000, "b", 7.0), (2001, "b", 1.0)], key=str)
    sinks.write_table(table(spark, [(2005, "z", 0.0)]), path)
    assert rows_of(spark, path) == [(2005, "z", 0.0)]


def test_two_writers_conflict(spark, path, monkeypatch):
    sinks.write_table(table(spark, [(2000, "a", 1.0)]), path)
    before = runs.records(spark, path)
    sinks.write_table(table(spark, [(2001, "b", 1.0)]), path)
    folder = runs.new_run(path)
    table(spark, [(2002, "c", 1.0)]).write.parquet(folder)
    monkeypatch.setattr(runs, "records", lambda *a: before)
    with pytest.raises(runs.CommitConflict):
        runs.commit(spark, path, folder, table(spark, []).schema)
    monkeypatch.undo()
    assert rows_of(spark, path) == [(2001, "b", 1.0)]


def test_old_runs_go_and_readers_of_the_last_but_one_go_on(spark, path):
    reader = None
    for i in range(4):
        reader, last = last if i else None, None
        sinks.write_table(table(spark, [(2000 + i, "a", 1.0)]), path)
        last = sinks.read_table(spark, path)
    assert [r["year"] for r in reader.collect()] == [2002] and [r["year"] for r in last.collect()] == [2003]
    assert len(runs.records(spark, path)) == 2


def test_plain_parquet_and_nothing(spark, path):
    with pytest.raises(runs.NoTable):
        sinks.read_table(spark, path)
    assert not runs.exists(spark, path)
    table(spark, [(2000, "a", 1.0)]).write.parquet(runs.new_run(path))
    with pytest.raises(runs.NoTable, match="committed"):
        sinks.read_table(spark, path)
    table(spark, [(2000, "a", 1.0)]).write.parquet(path + "2")
    assert rows_of(spark, path + "2") == [(2000, "a", 1.0)] and runs.exists(spark, path + "2")
