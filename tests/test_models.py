import pytest
from pyspark.sql import functions as F

from amberline import presets
from amberline.operators import evaluate, models, rate, sample
from amberline.plans import prepare, rate_routes, train
from amberline.sources import tables
from amberline.streaming import feed

KEY = "id_siniestro"
BOOSTED = {"maxIter": 4, "maxDepth": 3, "stepSize": 0.3}


@pytest.fixture(scope="module")
def rows(spark):
    table = prepare.serving_features(prepare.accidents(spark, 3000, 42))
    table = table.withColumn("n", F.regexp_extract(KEY, r"(\d+)$", 1).cast("long"))
    return tables.stage(table.select(KEY, "n", *presets.FEATURES, presets.TARGET))


@pytest.fixture(scope="module")
def boosted(rows):
    return models.fit_model(rows, "boosted", presets.FEATURES, presets.TARGET, BOOSTED, weighted=True)


@pytest.fixture(scope="module")
def routes(spark):
    return tables.stage(prepare.build_routes(spark.range(200).withColumnRenamed("id", "n"), "n"))


def test_probabilities_sum_to_one_and_follow_the_class(rows, boosted):
    scored = models.class_probabilities(boosted, rows.limit(500))
    assert models.labels_of(boosted) == ["ALTO", "BAJO", "MEDIO"]
    assert models.features_of(boosted) == presets.FEATURES
    for r in scored.collect():
        assert sum(r.probabilities) == pytest.approx(1.0)
        assert r.probabilities[models.labels_of(boosted).index(r.predicted)] == pytest.approx(max(r.probabilities))


def test_scoring_has_no_python_and_no_shuffle(rows, boosted):
    plan = models.class_probabilities(boosted, rows)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Exchange" not in plan and "Arrow" not in plan


def test_models_beat_the_majority_class(rows):
    settings = {"logistic": {"maxIter": 30}, "forest": {"numTrees": 8, "maxDepth": 6}, "boosted": {**BOOSTED, "maxIter": 8}}
    done = train.train_and_compare(rows, KEY, settings=settings, weighted=False)
    share = rows.where("nivel_riesgo is not null").groupBy("nivel_riesgo").count().agg(F.max("count") / F.sum("count")).first()[0]
    found = {r.model: r for r in done.comparison.collect()}
    assert len(found) == 3
    assert all(r.accuracy > share for r in found.values())
    assert all(0.5 < r.auc <= 1 for r in found.values())
    table = train.prediction_table(done, KEY, presets.FEATURES)
    assert len(table.columns) == 26 and table.count() == done.test.count()


def test_logistic_solves_the_scaled_problem(rows):
    model = models.fit_model(rows, "logistic", presets.FEATURES, presets.TARGET, {"maxIter": 50}, weighted=True)
    scored = models.class_probabilities(model, rows)
    assert evaluate.class_metrics(scored, presets.TARGET, "predicted").first().accuracy > 0.7
    assert models.features_of(model) == presets.FEATURES


def test_saved_model_gives_the_same_answers(spark, boosted, routes, tmp_path):
    path = str(tmp_path / "model")
    models.save_model(boosted, path)
    requests = routes.select("ruta_id", "lluvia_mm", "tipo_via")
    one = rate_routes.score_requests(requests, boosted).orderBy("ruta_id").collect()
    two = rate_routes.score_requests(requests, models.load_model(path)).orderBy("ruta_id").collect()
    assert one == two


def test_a_target_column_in_scored_rows_is_ignored(spark, boosted, rows):
    odd = rows.limit(5).withColumn(presets.TARGET, F.lit("OTRO"))
    assert models.class_probabilities(boosted, odd).count() == 5


def test_importances_sum_to_one(boosted):
    table = models.importances(boosted).collect()
    assert sum(r.importance for r in table) == pytest.approx(1.0)
    assert [r.importance for r in table] == sorted((r.importance for r in table), reverse=True)
    assert models.importances(boosted, 10).count() == 10


def test_loss_curve_falls(rows, boosted):
    curve = models.boosting_curve(boosted, rows, presets.TARGET, every=1).where("label = 'BAJO'").orderBy("round").collect()
    assert len(curve) == 4 and curve[-1].loss < curve[0].loss


def test_cross_validation_and_grid(rows):
    folded = sample.stratified_folds(rows, KEY, presets.TARGET, 3)
    scores = models.cross_validate(folded, "fold", 3, presets.FEATURES, presets.TARGET, {"maxIter": 2, "maxDepth": 3})
    found = scores.collect()
    assert [r.fold for r in found] == [1, 2, 3] and all(0.5 < r.accuracy <= 1 for r in found)
    summary = models.fold_summary(scores).first()
    mean = sum(r.accuracy for r in found) / 3
    assert summary.std_accuracy == pytest.approx((sum((r.accuracy - mean) ** 2 for r in found) / 3) ** 0.5)
    blocks = sample.block_folds(rows, "n", presets.TARGET, 2)
    best, table = models.grid_search(blocks, "fold", 2, presets.FEATURES, presets.TARGET, {"maxDepth": [1, 3], "maxIter": [2]})
    grid = {r.maxDepth: r for r in table.collect()}
    assert grid[3.0].mean_accuracy > grid[1.0].mean_accuracy and grid[3.0].best and not grid[1.0].best
    assert models.class_probabilities(best, rows.limit(10)).count() == 10


def test_rated_routes_and_publication(spark, boosted, routes, tmp_path):
    rated = rate_routes.rate_routes(routes, boosted)
    assert len(rated.routes.columns) == 33  # the published 32 and the score tier
    assert rated.by_class.agg(F.sum("total_rutas")).first()[0] == 200
    assert rated.by_score.agg(F.sum("rutas_alto")).first()[0] == 0  # 60 points are the most there are
    tables.ensure_schema(spark, "rating_test")
    rate_routes.publish(rated, "rating_test.scoring_rutas", "rating_test.scoring_region", str(tmp_path))
    assert tables.table_count(spark, "rating_test.scoring_rutas").first()[0] == 200
    assert len(spark.table("rating_test.scoring_rutas").columns) == 32
    back = spark.read.option("header", True).schema(rated.by_class.schema).csv(f"{tmp_path}/scoring_region")
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, rated.by_class.collect()))


def test_example_request(spark, boosted):
    request = spark.createDataFrame(
        [(1, 120.0, 2.0, 8000.0, "Camión", "Secundaria", "Noche (18-24)", "Cusco", 3)],
        "id int, lluvia_mm double, visibilidad_km double, flujo_vehicular double, tipo_vehiculo string, tipo_via string, "
        "franja_horaria string, region string, infracciones_prev int")
    row = rate_routes.score_requests(request, boosted).first()
    assert row.nivel_riesgo == "ALTO" and row.emoji == "🔴"
    assert row.proba_ALTO + row.proba_MEDIO + row.proba_BAJO == pytest.approx(100, abs=0.2)


def test_stream_gives_the_batch_answers(spark, boosted, routes, tmp_path):
    source = str(tmp_path / "in")
    requests = routes.select("ruta_id", "lluvia_mm", "tipo_via", "region")
    requests.repartition(3).write.parquet(source)
    stream = feed.read_feed(spark, source, requests.schema, max_files=1)
    answers = feed.score_feed(stream, boosted)
    feed.drain(answers, str(tmp_path / "out"), str(tmp_path / "progress"))
    got = sorted(map(tuple, spark.read.schema(answers.schema).parquet(str(tmp_path / "out")).collect()))
    assert got == sorted(map(tuple, rate_routes.score_requests(requests, boosted).collect()))


def test_stream_keeps_one_row_per_key(spark, tmp_path):
    source = str(tmp_path / "events")
    df = spark.range(1000).select((F.col("id") % 70).alias("k"), F.expr("timestamp_ntz'2024-01-01 00:00:00'").alias("ts"))
    df.write.parquet(source)
    stream = feed.first_of_key(feed.read_feed(spark, source, df.schema), ["k"], "ts", "1 day")
    feed.drain(stream.select("k"), str(tmp_path / "out"), str(tmp_path / "progress"))
    assert spark.read.schema("k long").parquet(str(tmp_path / "out")).count() == 70


def test_compat_positions_change_the_published_names(boosted, routes):
    rows_ = rate.score_batch(prepare.serving_features(routes), boosted)
    compat = rate.score_batch(prepare.serving_features(routes), boosted, compat_positions=True)
    a = {r.ruta_id: r for r in rows_.collect()}
    for r in compat.collect():
        assert r.proba_ALTO == a[r.ruta_id].proba_MEDIO and r.proba_MEDIO == a[r.ruta_id].proba_BAJO
