"""Models of the queries are fitted on all training rows, however many there are."""

import pytest
from pyspark.sql import functions as F

from amberline import presets
from amberline.catalog import evidence, modelling
from amberline.operators import models

ORDERS = 3000  # 2,400 training rows
QUICK = {"logistic": ({"maxIter": 2}, True), "forest": ({"numTrees": 2, "maxDepth": 2}, True), "boosted": ({"maxIter": 2, "maxDepth": 2}, True),
         "boosted_plain": ({"maxIter": 2, "maxDepth": 2}, False)}


@pytest.fixture
def orders(spark, tmp_path):
    columns = [(F.col("id") * 3).alias("o_orderkey"), F.lit("F").alias("o_orderstatus"), (F.col("id") * 1.5).alias("o_totalprice")]
    spark.range(ORDERS).select(*columns).write.parquet(f"{tmp_path}/orders.parquet")
    return str(tmp_path)


@pytest.fixture
def fitted_on(monkeypatch):
    """Rows that the models of each kind were fitted on."""
    seen = {}

    def fit(rows, kind, features, target, params, *rest, kept=models.fit_model):
        seen[kind, rest[0]] = rows.count()
        return kept(rows, kind, features, target, QUICK[kind][0], *rest)

    monkeypatch.setattr(models, "fit_model", fit)
    monkeypatch.setattr(modelling, "_models", {})
    monkeypatch.setattr(modelling, "SETTINGS", QUICK)
    return seen


def _train_rows(spark, d):
    return modelling.Rows(spark, d).train.where(F.col(presets.TARGET).isNotNull()).count()


@pytest.mark.parametrize("name, kind", [("boosted_plain_summary", "boosted_plain"), ("boosted_summary", "boosted"), ("forest_summary", "forest"),
                                        ("logistic_summary", "logistic")])
def test_summaries(spark, orders, fitted_on, name, kind):
    evidence._summary(spark, orders, kind).collect()
    assert fitted_on == {(kind.split("_")[0], QUICK[kind][1]): _train_rows(spark, orders)} and _train_rows(spark, orders) == 0.8 * ORDERS


@pytest.mark.parametrize("name, kinds", [
    ("boosted_scores_unweighted", ["boosted_plain"]), ("forest_scores", ["forest"]), ("route_summary_by_class", ["boosted"]),
    ("prediction_table", ["forest", "boosted_plain"]), ("trained_comparison", ["logistic", "forest", "boosted"])])
def test_queries(spark, orders, fitted_on, name, kinds):
    assert getattr(modelling, name)(spark, orders).count() > 0
    assert fitted_on == {(k.split("_")[0], QUICK[k][1]): 0.8 * ORDERS for k in kinds}


def test_three_jobs(spark, orders, fitted_on):
    assert modelling.three_jobs(spark, orders).count() > 0
    assert len(fitted_on) == 3 and set(fitted_on.values()) == {0.8 * ORDERS}


@pytest.mark.parametrize("shown", [modelling.fold_scores, evidence.fold_sizes])
def test_folds(spark, orders, monkeypatch, shown):
    seen = []

    def accuracy(fit, held, classes, params, *rest, kept=models._fold_accuracy):
        seen.append((fit.count(), held.count()))
        return kept(fit, held, classes, {"maxIter": 2, "maxDepth": 2}, *rest)

    monkeypatch.setattr(models, "_fold_accuracy", accuracy)
    monkeypatch.setattr(modelling, "_tables", {})
    assert shown(spark, orders).count() == presets.CV_FOLDS
    assert seen == [(1920, 480)] * presets.CV_FOLDS
