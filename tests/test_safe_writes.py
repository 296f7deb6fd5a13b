"""Jobs that fail in the middle: tables, bundles and published batches stay as they were."""

import pytest
from pyspark.sql import functions as F

from amberline import presets
from amberline.operators import evaluate, models, profile
from amberline.plans import prepare, tune
from amberline.sources import tables
from amberline.streaming import feed


def failing(df):
    """The rows, but for one that raises an error when it is written."""
    return df.withColumn("id", F.when(F.col("id") == 7, F.raise_error(F.lit("broken row")).cast("long")).otherwise(F.col("id")))


def names(spark):
    return sorted(t.name for t in spark.catalog.listTables() if not t.isTemporary)


@pytest.fixture
def name(spark):
    yield "swapped_table"
    spark.sql("DROP TABLE IF EXISTS swapped_table")


@pytest.mark.parametrize("external", [False, True])
def test_a_failing_job_leaves_the_old_table(spark, tmp_path, name, external):
    path = str(tmp_path / "t") if external else None
    tables.save_table(spark.range(5), name, path=path)
    before = names(spark)
    with pytest.raises(Exception, match="broken row"):
        tables.save_table(failing(spark.range(20)), name, path=path)
    assert sorted(r.id for r in spark.table(name).collect()) == list(range(5))
    assert names(spark) == before
    assert not external or [p.name for p in tmp_path.iterdir()] == ["t"]
    tables.save_table(spark.range(3).withColumn("part", F.col("id") % 2), name, partition_by=["part"], path=path)
    assert sorted(r.id for r in spark.table(name).where("part = 0").collect()) == [0, 2]
    assert names(spark) == before


@pytest.mark.parametrize("external", [False, True])
def test_a_table_is_replaced_by_what_reads_it(spark, tmp_path, name, external):
    path = str(tmp_path / "t") if external else None
    tables.save_table(spark.range(5), name, path=path)
    tables.save_table(spark.table(name).where("id > 2"), name, path=path)
    assert sorted(r.id for r in spark.table(name).collect()) == [3, 4]


def test_a_failing_swap_is_undone():
    places = {"t": "old rows", "t_new": "new rows"}

    def move(a, b):
        if a == "t_new":
            raise OSError("no")
        places[b] = places.pop(a)

    with pytest.raises(OSError):
        tables.swapped(move, "t_new", "t", "t_old", True)
    assert places == {"t": "old rows", "t_new": "new rows"}


def test_an_interrupted_bundle_is_not_loaded(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "bundle")
    with pytest.raises(FileNotFoundError):
        tune.load_bundle(spark, path)
    prepared = prepare.clean_accidents(tables.stage(prepare.accidents(spark, 400, 42)))
    model = models.fit_model(prepared.table, "boosted", presets.FEATURES, presets.TARGET, {"maxIter": 1, "maxDepth": 1})
    assert tune.save_bundle(model, prepared.stats, {"a": ["one"]}, path) == 1

    class Broken:
        def to_table(self, spark):
            raise OSError("interrupted")

    with pytest.raises(OSError):
        tune.save_bundle(model, Broken(), {"a": ["two"]}, path)
    assert tune.load_bundle(spark, path)[2] == {"a": ["one"]}
    assert tune.save_bundle(model, prepared.stats, {"a": ["three"]}, path) == 2
    assert tune.load_bundle(spark, path)[2] == {"a": ["three"]} and tune.load_bundle(spark, path, 1)[2] == {"a": ["one"]}
    assert tune.load_bundle(spark, path)[1] == prepared.stats
    tune.drop_old_bundles(spark, path, keep=1)
    assert tune.load_bundle(spark, path)[2] == {"a": ["three"]}
    with pytest.raises(Exception):
        tune.load_bundle(spark, path, 1)


def test_reading_one_run_touches_one_folder(spark, tmp_path):
    path = str(tmp_path / "runs")
    ids = [evaluate.log_run(spark, path, f"run {i}", {"depth": i}, {"accuracy": .5}) for i in range(3)]
    one = evaluate.read_runs(spark, path, ids[1])
    assert {(r.run_id, r.key, r.value) for r in one.collect()} == {(ids[1], "depth", "1"), (ids[1], "accuracy", "0.5")}
    assert len(one.inputFiles()) == 3 and "PartitionFilters: [isnotnull(run_id" in one._jdf.queryExecution().executedPlan().toString()
    assert evaluate.read_runs(spark, path).count() == 6


# --- fingerprints ------------------------------------------------------------------------------

ROWS = [("a", None, 1.0), (None, "a", 1.0), ("a", None, 1.0), ("a", None, 1.0), (None, None, None), (None, None, None), ("b", "", 0.0), ("b", "", -0.0),
        ("b", None, 0.0), ("c", "x", float("nan")), ("c", "x", float("nan"))]


@pytest.mark.parametrize("limit", [0, 1_000_000])
def test_duplicates_by_fingerprints(spark, monkeypatch, limit):
    monkeypatch.setattr(profile, "BROADCAST_FINGERPRINTS", limit)
    df = spark.createDataFrame(ROWS, "x string, y string, `a.z` double")
    assert profile.duplicate_rows(df).first()[0] == 2 + 1 + 1 + 1
    assert profile.duplicate_rows(df.limit(0)).first()[0] == 0
    got = {r.measure: r.value for r in profile.dirty_profile(df, ["x", "y"]).collect()}
    assert got == {"rows": 11, "nulls:x": 3, "nulls:y": 6, "duplicates": 5}


def test_rows_without_copies_are_not_shuffled(spark, tmp_path):
    spark.range(50).select(F.col("id").cast("string").alias("x"), F.repeat(F.lit("wide"), 100).alias("y")).write.parquet(str(tmp_path / "w"))
    wide = spark.read.parquet(str(tmp_path / "w"))
    plan = profile.duplicate_rows(wide)._jdf.queryExecution().executedPlan().toString()
    first_exchange = plan[:plan.rindex("BroadcastExchange")]
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan and first_exchange.count("Exchange hashpartitioning(x") == 1


# --- published batches ---------------------------------------------------------------------------

def test_a_batch_that_failed_after_its_write_is_published_once(spark, tmp_path, monkeypatch):
    source, path, checkpoint = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "progress")
    spark.range(10).coalesce(1).write.parquet(source)

    def stream():
        return feed.read_feed(spark, source, spark.range(1).schema)

    enter = feed.enter_batch
    monkeypatch.setattr(feed, "enter_batch", lambda *a: (_ for _ in ()).throw(OSError("lost after the write")))
    with pytest.raises(Exception, match="lost after the write"):
        feed.publish(stream(), path, checkpoint)
    assert tables.path_exists(spark, f"{path}/data") and feed.published(spark, path, spark.range(1).schema).count() == 0
    monkeypatch.setattr(feed, "enter_batch", enter)
    feed.publish(stream(), path, checkpoint)
    assert sorted(r.id for r in feed.published(spark, path, spark.range(1).schema).collect()) == list(range(10))
    spark.range(10, 14).coalesce(1).write.mode("append").parquet(source)
    feed.publish(stream(), path, checkpoint)
    feed.publish(stream(), path, checkpoint)
    assert sorted(r.id for r in feed.published(spark, path, spark.range(1).schema).collect()) == list(range(14))
    assert sorted((r.batch, r.rows) for r in feed.ledger(spark, path).collect()) == [(0, 10), (1, 4)]


def test_a_batch_in_the_ledger_is_left_alone(spark, tmp_path):
    path = str(tmp_path / "out")
    assert feed.publish_batch(spark.range(4), path, "q", 3)
    assert not feed.publish_batch(spark.range(9), path, "q", 3)
    assert feed.publish_batch(spark.range(2), path, "another", 3)
    assert feed.published(spark, path, spark.range(1).schema).count() == 6
