"""Tuning job: cross-validation, grid search on the training rows, refit, final metrics, run log, saved bundle."""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import presets
from ..operators import evaluate, models, sample
from ..operators.clean import CleanStats
from ..sources.tables import path_exists, remove_path, stage
from .train import split_table


@dataclass(frozen=True)
class Tuned:
    """The refitted model, its setting, and what the run log says about it."""

    model: PipelineModel
    best: dict[str, float]
    params: dict[str, object]
    metrics: dict[str, float]
    cross_validation: DataFrame
    grid: DataFrame


def tune(df: DataFrame, key: str, features: Sequence[str] = tuple(presets.FEATURES), target: str = presets.TARGET,
         grid: Mapping[str, Sequence] = presets.GRID, base: Mapping = presets.BOOSTED_PLAIN, cv_folds: int = presets.CV_FOLDS,
         grid_folds: int = presets.GRID_FOLDS, order: str | None = None, seed: int = 42, fit_rows: int | None = None) -> Tuned:
    """Validate ``base``, search ``grid`` over it, and judge the best setting on the test rows.

    Only training rows are fitted on; ``fit_rows`` bounds how many of them each model is fitted on, and all rows of a fold are judged.  ``order`` is a whole number that identifies rows and gives the
    order of the unshuffled folds of the search; without it these are shuffled too.
    """
    spark = df.sparkSession
    train, test = split_table(df, key, target, seed=presets.SPLIT_SEED)
    shuffled = sample.stratified_folds(train, key, target, cv_folds, seed)
    validation = models.cross_validate(shuffled, "fold", cv_folds, features, target, base, seed, key=key, fit_rows=fit_rows)
    spread = models.fold_summary(validation).first()
    blocks = (sample.block_folds(train, order, target, grid_folds) if order else sample.stratified_folds(train, key, target, grid_folds, seed))
    model, scores = models.grid_search(blocks, "fold", grid_folds, features, target, grid, base, seed, key=key, fit_rows=fit_rows)
    top = scores.where("best").first()
    best = {name: top[name] for name in grid}
    scored = stage(models.batch_probabilities(model, test), "tuned")
    labels = models.labels_of(model)
    flat = scored.withColumns({f"p_{i}": F.col("probabilities")[i] for i in range(len(labels))})
    row = evaluate.final_metrics(evaluate.metrics(flat, target, "predicted", {label: f"p_{i}" for i, label in enumerate(labels)})).first()
    params = {**best, "n_features": len(features), "n_train_samples": train.count(), "n_test_samples": test.count(), "cv_folds": cv_folds}
    measured = {"accuracy": row["accuracy"], "f1_macro": row["f1_macro"], "f1_weighted": row["f1_weighted"], "auc_roc": row["auc"],
                "cv_score_mean": spread["mean_accuracy"], "cv_score_std": spread["std_accuracy"]}
    return Tuned(model, best, params, measured, validation, scores)


def log_tuned(spark: SparkSession, tuned: Tuned, path: str, run_name: str = "boosted") -> str:
    """Appends the run's parameters and metrics to the log folder; returns the run id."""
    return evaluate.log_run(spark, path, run_name, tuned.params, tuned.metrics)


# --- one bundle for serving --------------------------------------------------------------

MANIFEST = "number long, version string"


def _versions(spark: SparkSession, path: str) -> DataFrame:
    """Saved versions, the last first."""
    if not path_exists(spark, f"{path}/manifest"):
        return spark.createDataFrame([], MANIFEST)
    return spark.read.schema(MANIFEST).parquet(f"{path}/manifest").orderBy(F.desc("number"), "version")


def save_bundle(model: PipelineModel, stats: CleanStats, labels: Mapping[str, Sequence[str]], path: str) -> int:
    """Model, cleaning statistics and label lists as a new version below one folder; returns its number.

    The version is entered in the manifest when all its parts are written, so a reader gets the three parts of one version, and an interrupted save
    changes nothing.
    """
    spark, version = SparkSession.getActiveSession(), uuid.uuid4().hex
    folder = f"{path}/versions/{version}"
    last = _versions(spark, path).first()
    models.save_model(model, f"{folder}/model")
    stats.to_table(spark).write.parquet(f"{folder}/stats")
    spark.createDataFrame([(json.dumps({c: list(v) for c, v in labels.items()}, ensure_ascii=False),)], "labels string").write.parquet(f"{folder}/labels")
    number = last["number"] + 1 if last else 1
    spark.createDataFrame([(number, version)], MANIFEST).coalesce(1).write.mode("append").parquet(f"{path}/manifest")
    return number


def load_bundle(spark: SparkSession, path: str, number: int | None = None) -> tuple[PipelineModel, CleanStats, dict[str, list[str]]]:
    """The last whole version, or the one with a number."""
    known = _versions(spark, path)
    entry = (known if number is None else known.where(F.col("number") == number)).first()
    if entry is None:
        raise FileNotFoundError(f"no bundle in {path}" + ("" if number is None else f" with number {number}"))
    folder = f"{path}/versions/{entry['version']}"
    found = json.loads(spark.read.parquet(f"{folder}/labels").first()["labels"])
    return models.load_model(f"{folder}/model"), CleanStats.from_table(spark.read.parquet(f"{folder}/stats")), found


def drop_old_bundles(spark: SparkSession, path: str, keep: int = 2) -> None:
    """Removes the parts of all but the last ``keep`` versions; their numbers stay in the manifest."""
    for entry in _versions(spark, path).offset(keep).collect():  # one row a saved version
        remove_path(spark, f"{path}/versions/{entry['version']}")
