"""Rows of the models are known by key and target; features are made of the rows that are read."""

from pyspark.sql import functions as F

from amberline import presets
from amberline.catalog import modelling
from amberline.operators import models, sample
from amberline.plans import prepare
from amberline.sources import tables

KEY = modelling.KEY


def _orders(spark, path):
    spark.range(400).select((F.col("id") * 3).alias("o_orderkey"), F.lit("x").alias("o_comment")).write.parquet(f"{path}/orders.parquet")
    return str(path)


def test_only_keys_and_targets_are_written(spark, tmp_path):
    d = _orders(spark, tmp_path)
    rows = modelling.model_rows(spark, d)
    assert rows.columns == ["o_orderkey", KEY, presets.TARGET]
    whole = prepare.serving_features(prepare.build_accidents(spark.read.parquet(f"{d}/orders.parquet").select("o_orderkey"), "o_orderkey", method="md5"))
    columns = [KEY, *presets.FEATURES, presets.TARGET]
    made = modelling.with_features(rows).select(*columns).collect()
    assert len(made) == 400 and sorted(made, key=lambda r: r[0]) == sorted(whole.select(*columns).collect(), key=lambda r: r[0])


def test_rows_are_drawn_before_their_features_are_made(spark, tmp_path, monkeypatch):
    plans = []
    monkeypatch.setattr(models, "stage", lambda df, name: (plans.append(df._jdf.queryExecution().optimizedPlan().toString()), tables.stage(df, name))[1])
    monkeypatch.setattr(modelling, "FIT_ROWS", 50)
    rows = modelling.Rows(spark, _orders(spark, tmp_path))
    assert rows.fit.count() == 50 and rows.test.count() == 80
    last = plans[0].strip().splitlines()
    at = [i for i, line in enumerate(last) if "lluvia_mm.a" in line]
    below = [i for i, line in enumerate(last) if "Filter" in line and "rank" in line]
    assert at and below and max(at) < min(below)


def test_a_split_reads_no_features(spark, tmp_path, monkeypatch):
    plans, cuts = [], sample.exact_cuts
    monkeypatch.setattr(sample, "exact_cuts", lambda df, *a, **b: (plans.append(df._jdf.queryExecution().optimizedPlan().toString()), cuts(df, *a, **b))[1])
    assert modelling.Rows(spark, _orders(spark, tmp_path)).train.count() == 320
    assert plans and not any("lluvia_mm" in p for p in plans)
