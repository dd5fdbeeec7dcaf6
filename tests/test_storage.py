"""Scratch space and literal frames."""

from types import SimpleNamespace

import pytest

from tagweave import storage


def session(master, **settings):
    conf = SimpleNamespace(get=lambda name, default=None: settings.get(name.rsplit(".", 1)[-1], default))
    return SimpleNamespace(conf=conf, sparkContext=SimpleNamespace(master=master))


def test_scratch_root():
    assert storage.scratch_root(session("yarn", dir="hdfs://shared/x")) == "hdfs://shared/x"
    assert storage.scratch_root(session("local[2]", dir="/shared")) == "/shared"
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        storage.scratch_root(session("yarn"))


def test_scratch_paths_are_fresh_and_under_the_root(spark):
    first, second = (storage.scratch_path(spark, "x") for _ in range(2))
    assert first != second
    assert all(p.startswith(spark.conf.get("spark.checkpoint.dir")) for p in (first, second))


def test_staged_rows_come_from_what_was_written(spark, plan_of):
    df = spark.range(10).selectExpr("id % 3 as k", "rand() as x")
    staged = storage.stage(df, "rows")
    assert sorted(staged.collect()) == sorted(staged.collect()) and staged.dtypes == df.dtypes
    assert "FileScan" in plan_of(staged) or "Scan parquet" in plan_of(staged)
    assert "Range" not in plan_of(staged)


def test_literal_rows(spark, plan_of):
    df = storage.literal_rows(spark, {"a": [1, 2], "b": ["x", None], "c": [[1.0], [2.0]]})
    assert df.dtypes == [("a", "bigint"), ("b", "string"), ("c", "array<double>")]
    assert "LocalTableScan" in plan_of(df)
    assert storage.local_copy(df).collect() == df.collect()
