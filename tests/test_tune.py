import pytest
from pyspark.sql import functions as F

from amberline import presets
from amberline.functions.draws import poisson_steps
from amberline.operators import evaluate, models, profile, sample
from amberline.plans import prepare, train, tune
from amberline.sources import tables

KEY = "id_siniestro"


def test_tuning_job_logs_and_saves(spark, tmp_path):
    prepared = prepare.clean_accidents(tables.stage(prepare.accidents(spark, 1500, 42)))
    table = prepared.table.withColumn("n", F.regexp_extract(KEY, r"(\d+)$", 1).cast("long"))
    done = tune.tune(table, KEY, grid={"maxDepth": [1, 3], "maxIter": [2]}, base={"stepSize": 0.3, "maxIter": 2}, cv_folds=2, grid_folds=2, order="n",
                     fit_rows=600)
    assert done.best["maxDepth"] == 3.0 and done.grid.count() == 2 and done.cross_validation.count() == 2
    tune.log_tuned(spark, done, str(tmp_path / "runs"))
    logged = {(r.kind, r.key) for r in evaluate.read_runs(spark, str(tmp_path / "runs")).collect()}
    assert logged == {("param", k) for k in ("maxDepth", "maxIter", "n_features", "n_train_samples", "n_test_samples", "cv_folds")} | {
        ("metric", k) for k in ("accuracy", "f1_macro", "f1_weighted", "auc_roc", "cv_score_mean", "cv_score_std")}
    assert done.params["n_train_samples"] + done.params["n_test_samples"] == table.where(F.col(presets.TARGET).isNotNull()).count()
    tune.save_bundle(done.model, prepared.stats, prepared.labels, str(tmp_path / "bundle"))
    model, stats, labels = tune.load_bundle(spark, str(tmp_path / "bundle"))
    assert stats == prepared.stats and labels == {c: list(v) for c, v in prepared.labels.items()}
    assert models.class_probabilities(model, table.limit(5)).count() == 5


def test_best_of_a_comparison(spark):
    rows = spark.createDataFrame([(0, train.NAMES["logistic"], .5, .5, .9, .1), (1, train.NAMES["forest"], .5, .5, .9, .8)],
                                 "position int, model string, accuracy double, f1_macro double, f1_weighted double, auc double")
    done = train.Trained({"logistic": "a", "forest": "b"}, rows, None, None)
    assert done.best() == ("logistic", "a") and done.best("auc") == ("forest", "b")


def test_only_boosted_models_have_a_curve(spark):
    rows = spark.createDataFrame([(float(i), "a" if i % 2 else "b") for i in range(20)], "x double, y string")
    model = models.fit_model(rows, "logistic", ["x"], "y", {"maxIter": 2})
    with pytest.raises(ValueError, match="boosted"):
        models.boosting_curve(model, rows, "y")


def test_a_missing_score_leaves_the_area_undefined(spark):
    rows = spark.createDataFrame([("a", .9), ("a", None), ("b", .1), ("b", .2)], "y string, p double")
    assert evaluate.roc_auc_by_class(rows, "y", {"a": "p"}).first().auc is None
    assert evaluate.roc_auc_by_class(rows.where("p is not null"), "y", {"a": "p"}).first().auc == 1.0


def test_describe_takes_dates(spark):
    rows = spark.createDataFrame([("1970-01-02",), ("1970-01-04",), (None,)], "t string").select(F.col("t").cast("date").alias("t"))
    found = profile.describe(rows, ["t"]).first()
    assert (found["count"], found["mean"], found["q50"], found["min"], found["max"]) == (2, 3.0 - 1.0, 2.0, 1.0, 3.0)


def test_poisson_with_a_large_mean():
    steps = poisson_steps(600.0)
    assert 600 < len(steps) and steps == sorted(steps) and abs(steps[-1] - 1) < 1e-9
    with pytest.raises(ValueError, match="mean"):
        poisson_steps(800.0)


def test_shared_keys_in_folds_are_refused_whatever_the_size(spark):
    rows = spark.createDataFrame([(1, "a"), (1, "a"), (2, "a"), (3, "b"), (4, "b")], "k long, y string")
    with pytest.raises(Exception, match="does not identify rows"):
        sample.stratified_folds(rows, "k", "y", 2).collect()
