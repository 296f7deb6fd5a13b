from types import SimpleNamespace

import pytest

from amberline.sources import tables


def test_staging_folder():
    def session(checkpoint):
        settings = {"spark.checkpoint.dir": checkpoint, "spark.sql.warehouse.dir": "/shared/warehouse/"}
        return SimpleNamespace(conf=SimpleNamespace(get=lambda key, default=None: settings[key] or default))

    assert tables.shared_folder(session("hdfs:///checkpoints")) == "hdfs:///checkpoints"
    assert tables.shared_folder(session(None)) == "/shared/warehouse/_amberline"


def test_staged_folders_do_not_outlive_their_job(spark):
    from pathlib import Path

    with tables.staging(spark):
        staged = tables.stage(frame(spark), "short-lived")
        folder = Path(staged.inputFiles()[0].removeprefix("file://").removeprefix("file:")).parent
        assert staged.count() == 2 and folder.exists()
    assert not folder.exists()

def frame(spark):
    return spark.createDataFrame([(1, "a", 1.5), (2, None, None)], "i int, t string, x double")


def test_table_then_csv_fallback(spark, tmp_path):
    df = frame(spark)
    path = str(tmp_path / "csv")
    tables.export_csv(df, path, single_file=True)
    got = tables.read_table_or_csv(spark, "no_such_table", path, df.schema)
    assert sorted(map(str, got.collect())) == sorted(map(str, df.collect()))
    tables.save_table(df.limit(1), "fallback_test")
    assert tables.read_table_or_csv(spark, "fallback_test", path, df.schema).count() == 1
    tables.save_table(df, "fallback_test")  # replaces
    assert tables.table_count(spark, "fallback_test").first()["rows"] == 2


def test_failed_csv_copy_does_not_fail_the_table(spark, tmp_path):
    blocked = tmp_path / "file"
    blocked.write_text("in the way")
    assert tables.save_with_csv_copy(frame(spark), "copy_test", str(blocked / "sub")) is False
    assert spark.table("copy_test").count() == 2
    assert tables.save_with_csv_copy(frame(spark), "copy_test", str(tmp_path / "ok")) is True


def test_failed_table_raises(spark):
    with pytest.raises(Exception):
        tables.save_table(frame(spark), "no_such_schema.t")


def test_stage_reads_only_what_is_asked(spark):
    staged = tables.stage(frame(spark))
    plan = staged.select("x").where("x > 1")._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<x:double>" in plan and "GreaterThan(x,1.0)" in plan


def test_nan_becomes_null(spark):
    df = spark.createDataFrame([(float("nan"),), (1.0,)], "x double")
    assert [r.x for r in tables.normalise_missing(df).collect()] == [None, 1.0]
