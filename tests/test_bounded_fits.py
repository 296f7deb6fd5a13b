"""What a bound on fitting rows may and may not bound."""

import pytest
from pyspark.sql import functions as F

from amberline import presets
from amberline.catalog import modelling
from amberline.operators import models, sample
from amberline.plans import prepare, tune
from amberline.sources import tables
from conftest import SMALL

KEY = "id_siniestro"
QUICK = {"maxIter": 2, "maxDepth": 2}


@pytest.fixture(scope="module")
def rows(spark):
    table = prepare.serving_features(prepare.accidents(spark, 900, 42))
    table = table.withColumn("n", F.regexp_extract(KEY, r"(\d+)$", 1).cast("long"))
    return tables.stage(table.select(KEY, "n", *presets.FEATURES, presets.TARGET))


@pytest.fixture
def parts(monkeypatch):
    """Rows fitted on and rows judged, of each fold."""
    seen = []

    def accuracy(fit, held, *rest, kept=models._fold_accuracy):
        seen.append((fit.count(), held.count()))
        return kept(fit, held, *rest)

    monkeypatch.setattr(models, "_fold_accuracy", accuracy)
    return seen


def test_all_rows_of_a_fold_are_judged(rows, parts):
    folded = sample.stratified_folds(rows, KEY, presets.TARGET, 3)
    total = rows.where(F.col(presets.TARGET).isNotNull()).count()
    models.cross_validate(folded, "fold", 3, presets.FEATURES, presets.TARGET, QUICK, key=KEY, fit_rows=100)
    assert [fit for fit, _ in parts] == [100] * 3 and sum(held for _, held in parts) == total
    del parts[:]
    models.grid_search(folded, "fold", 3, presets.FEATURES, presets.TARGET, {"maxDepth": [1, 2]}, QUICK, key=KEY, fit_rows=100)
    assert [fit for fit, _ in parts] == [100] * 6 and sum(held for _, held in parts) == 2 * total


def test_tuning_judges_all_training_rows(rows, parts):
    done = tune.tune(rows, KEY, grid={"maxDepth": [1]}, base=QUICK, cv_folds=2, grid_folds=2, order="n", fit_rows=100)
    assert all(fit == 100 for fit, _ in parts) and sum(held for _, held in parts) == 2 * done.params["n_train_samples"]


@pytest.mark.parametrize("name, judge", [("fold_scores", "cross_validate"), ("grid_scores", "grid_search")])
def test_queries_make_folds_of_all_training_rows(spark, monkeypatch, name, judge):
    seen = []
    monkeypatch.setattr(models, judge, lambda df, *a, **b: (seen.append((df.count(), b)), None))
    monkeypatch.setattr(modelling, "FIT_ROWS", 50)
    getattr(modelling, name)(spark, SMALL)
    assert seen == [(modelling._split(spark, SMALL)[0].count(), {"key": KEY, "fit_rows": 50})]


def test_one_fit_serves_all_numbers_of_rounds(rows, parts):
    folded = sample.stratified_folds(rows, KEY, presets.TARGET, 2)
    base = {"stepSize": 0.3, "maxDepth": 2, "subsamplingRate": 0.8, "featureSubsetStrategy": "0.8"}
    _, table = models.grid_search(folded, "fold", 2, presets.FEATURES, presets.TARGET, {"maxIter": [1, 4], "maxDepth": [1, 2]}, base)
    assert len(parts) == 4
    del parts[:]
    for r in table.collect():
        params = {**base, "maxIter": int(r.maxIter), "maxDepth": int(r.maxDepth)}
        alone = models.cross_validate(folded, "fold", 2, presets.FEATURES, presets.TARGET, params).collect()
        assert r.mean_accuracy == pytest.approx(sum(x.accuracy for x in alone) / 2)
    assert [(r.maxIter, r.maxDepth) for r in table.orderBy("setting").collect()] == [(1, 1), (1, 2), (4, 1), (4, 2)]


def test_queries_run_the_presets_in_full(spark, monkeypatch):
    seen = {}
    monkeypatch.setattr(models, "cross_validate", lambda df, fold, k, features, target, params, **b: seen.update(fold=(k, params)))
    monkeypatch.setattr(models, "grid_search", lambda df, fold, k, features, target, grid, base, **b: (seen.update(grid=(k, grid, base)), None))
    modelling.fold_scores(spark, SMALL)
    modelling.grid_scores(spark, SMALL)
    assert seen == {"fold": (presets.CV_FOLDS, presets.BOOSTED_PLAIN), "grid": (presets.GRID_FOLDS, presets.GRID, presets.BOOSTED_PLAIN)}


def test_only_drawn_rows_meet_in_one_task(spark, monkeypatch):
    plans = []
    monkeypatch.setattr(models, "stage", lambda df, name: (plans.append(df._jdf.queryExecution().executedPlan().toString()), tables.stage(df, name))[1])
    keys = spark.range(0, 5000, 1, 7).withColumnRenamed("id", "k")
    out = models.drawn(keys, "k", 40)
    assert "Coalesce" not in plans[0] and "Exchange SinglePartition" in plans[0]
    drawn = [r.k for r in out.collect()]
    assert len(drawn) == 40 and drawn == sorted(drawn) and out.rdd.getNumPartitions() == 1
