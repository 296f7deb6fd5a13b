"""Test rows that several models score are written once and read from there."""

from pyspark.sql import functions as F

from amberline import presets
from amberline.catalog import evidence, modelling
from amberline.operators import models
from amberline.plans import prepare, train
from amberline.sources import tables


def _staged(df):
    files = df.inputFiles()
    return len(files) > 0 and all("/test-rows-" in f for f in files)


def test_models_that_are_compared_read_one_copy(spark):
    rows = tables.stage(prepare.serving_features(prepare.accidents(spark, 900, 42)).select("id_siniestro", *presets.FEATURES, presets.TARGET))
    kinds = {"logistic": {"maxIter": 2}, "forest": {"numTrees": 2}}
    fitted = {kind: models.fit_model(rows, kind, presets.FEATURES, presets.TARGET, p) for kind, p in kinds.items()}
    test = rows.where(F.col("lluvia_mm") > 5)
    made = train.compare_models(fitted, rows, test, presets.TARGET)
    assert _staged(made.test) and {df.count() for df in made.scored.values()} == {test.count()}
    assert not _staged(train.compare_models({"logistic": fitted["logistic"]}, rows, test, presets.TARGET).test)


def test_losses_by_round_read_one_copy(spark, small, monkeypatch):
    monkeypatch.setattr(modelling, "SETTINGS", {"boosted_plain": ({"maxIter": 2}, False)})
    monkeypatch.setattr(modelling, "_models", {})
    monkeypatch.setattr(evidence, "_SHOWN", [1, 2])
    scored, batches = [], models.batch_probabilities
    monkeypatch.setattr(models, "batch_probabilities", lambda model, df, *a: (scored.append(df), batches(model, df, *a))[1])
    found = evidence.loss_by_round(spark, small).collect()
    assert len(scored) == 2 and all(map(_staged, scored))
    assert sorted(r.round for r in found) == [1, 2] and all(r.is_log_loss and r.is_lower for r in found)
