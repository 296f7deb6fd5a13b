"""Queries that show, against SQL, the parts of modelling, publishing and streaming that do not depend on a fitted tree.

Fitted models are shown by counts that SQL can compute: test rows per tier, probabilities that sum to 1, classes that
are the most probable ones, answers that a saved model repeats.
"""

from __future__ import annotations

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from .. import presets
from ..functions import draws
from ..functions.scalar import cut, round_half_even
from ..operators import evaluate, models, trees
from ..operators.sample import bernoulli_mask
from ..plans import prepare, train
from ..sources import tables
from ..streaming import feed
from . import metrics, modelling
from .rating import LINE_KEY
from .registry import query, sql_cut, sql_round, sql_uniform, table
from .synthesis import ACCIDENTS, orders_as_dirty_accidents

MEASURES = ["l_quantity", "l_extendedprice", "l_discount"]


@query("feature_vectors", """
SELECT l_orderkey, l_linenumber, l_quantity::DOUBLE AS x0, l_extendedprice::DOUBLE AS x1, l_discount::DOUBLE AS x2 FROM lineitem""")
def feature_vectors(spark, d):
    lines = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", *MEASURES)
    wide = VectorAssembler(inputCols=MEASURES, outputCol="x").transform(lines).withColumn("x", vector_to_array("x"))
    return wide.select("l_orderkey", "l_linenumber", *[F.col("x")[i].alias(f"x{i}") for i in range(3)])


def _margins(spark, d):
    u = draws.uniforms(77, ["m.0", "m.1", "m.2"], "o_orderkey", "md5")
    rows = table(spark, d, "orders").select("o_orderkey", F.col("o_orderstatus").alias("y"), u.alias("u"))
    return rows.withColumn("m", F.transform("u", lambda x: x * 4.0 - 2.0)).drop("u")


_M = ", ".join(f"{sql_uniform(77, f'm.{i}', 'o_orderkey')}*4::DOUBLE - 2::DOUBLE AS m{i}" for i in range(3))
_ODDS = ", ".join(f"1::DOUBLE/(1::DOUBLE + exp(m{i}*-2::DOUBLE)) AS q{i}" for i in range(3))


@query("margin_probabilities", f"""
WITH a AS (SELECT o_orderkey, {_M} FROM orders), b AS (SELECT *, {_ODDS} FROM a)
SELECT o_orderkey, {', '.join(f"{sql_round(f'q{i}/(q0+q1+q2)', 6)} AS p{i}" for i in range(3))},
  CASE WHEN m0 >= m1 AND m0 >= m2 THEN 1 WHEN m1 >= m2 THEN 2 ELSE 3 END AS class FROM b""")
def margin_probabilities(spark, d):
    out = models.with_margin_probabilities(_margins(spark, d), "m", "p", "class")
    return out.select("o_orderkey", *[round_half_even(F.col("p")[i], 6).alias(f"p{i}") for i in range(3)], F.col("class").cast("int").alias("class"))


ROUNDS = [1, 50, 100]


@query("log_loss_by_round", f"""
WITH a AS (SELECT o_orderkey, o_orderstatus AS y, {_M} FROM orders),
b AS (SELECT y, r, m0*r/100::DOUBLE AS m0, m1*r/100::DOUBLE AS m1, m2*r/100::DOUBLE AS m2 FROM a, (VALUES {', '.join(f'({r})' for r in ROUNDS)}) v(r)),
c AS (SELECT *, {_ODDS} FROM b)
SELECT r AS "round", {sql_round("avg(-ln(CASE y WHEN 'F' THEN q0 WHEN 'O' THEN q1 ELSE q2 END/(q0+q1+q2)))", 6)} AS log_loss FROM c GROUP BY r""")
def log_loss_by_round(spark, d):
    """Three-class log-loss after some rounds of boosting, whose margins grow towards the final ones."""
    rounds = _margins(spark, d).withColumn("round", F.explode(F.array(*[F.lit(r) for r in ROUNDS])))
    staged = rounds.withColumn("m", F.transform("m", lambda x: x * F.col("round") / 100.0))
    scored = models.with_margin_probabilities(staged, "m", "p", "at")
    loss = evaluate.log_loss(scored, "y", {c: F.col("p")[i] for i, c in enumerate(metrics.CLASSES)}, by=["round"])
    return loss.select("round", round_half_even("log_loss", 6).alias("log_loss"))


@query("top_importances", """
SELECT p_name AS feature, p_retailprice::DOUBLE AS importance FROM part ORDER BY p_retailprice DESC, p_partkey LIMIT 10""")
def top_importances(spark, d):
    parts = table(spark, d, "part").select(F.col("p_name").alias("feature"), F.col("p_retailprice").cast("double").alias("importance"),
                                           F.col("p_partkey").alias("position"))
    return models.top_importances(parts, 10)


@query("fold_accuracy", f"""WITH {metrics._pred_sql('a', 'a')}
SELECT (o_orderkey % 5)::INTEGER AS fold, {sql_round('avg((y = pred)::INTEGER)', 6)} AS accuracy FROM a GROUP BY 1""")
def fold_accuracy(spark, d):
    rows = metrics.predictions(spark, d).withColumn("fold", F.pmod("o_orderkey", F.lit(5)).cast("int"))
    return evaluate.accuracy_by(rows, "fold", "y", "pred").select("fold", round_half_even("accuracy", 6).alias("accuracy"))


_P = f"{metrics._pred_sql('a', 'a')}, {metrics._pred_sql('b', 'b')}"


@query("predictions_side_by_side", f"""WITH {_P}
SELECT a.o_orderkey, a.y AS y_real, a.pred AS {presets.BOOSTED_PREDICTION}, {', '.join(f'a.p_{c} AS {presets.BOOSTED_PROBABILITY}{c}' for c in metrics.CLASSES)},
  b.pred AS {presets.FOREST_PREDICTION} FROM a JOIN b ON a.o_orderkey = b.o_orderkey""")
def predictions_side_by_side(spark, d):
    a, b = (metrics.predictions(spark, d, v).withColumnRenamed("pred", "predicted").withColumn(
        "probabilities", F.array(*[F.col(f"p_{c}") for c in metrics.CLASSES])) for v in "ab")
    return train.predictions_side_by_side(a, b, metrics.CLASSES, "o_orderkey", [], "y")


# --- publishing ---------------------------------------------------------------------------

@query("table_with_csv_copy", "SELECT c_custkey, c_name, c_acctbal, true AS copied FROM customer")
def table_with_csv_copy(spark, d):
    customers = table(spark, d, "customer").select("c_custkey", "c_name", "c_acctbal")
    path = tables.scratch_path(spark, "copied")
    name = "amberline_" + path.rpartition("-")[2]
    copied = tables.save_with_csv_copy(customers, name, f"{path}/csv", path=f"{path}/table")
    return spark.read.schema(customers.schema).option("header", True).csv(f"{path}/csv").withColumn("copied", F.lit(copied))


@query("managed_table", "SELECT n_nationkey, n_name, (SELECT count(*) FROM nation) AS saved FROM nation")
def managed_table(spark, d):
    """A schema is made if there is none, and a table in it is replaced."""
    tables.ensure_schema(spark, "amberline_made")
    name = "amberline_made.nation_" + tables.scratch_path(spark, "name").rpartition("-")[2]
    nations = table(spark, d, "nation").select("n_nationkey", "n_name")
    tables.save_table(nations.limit(1), name)
    tables.save_table(nations, name)
    saved = tables.table_count(spark, name).first()["rows"]
    return spark.table(name).withColumn("saved", F.lit(saved).cast("long"))


@query("existing_columns", "SELECT o_orderkey, o_totalprice FROM orders")
def existing_columns(spark, d):
    orders = table(spark, d, "orders")
    return orders.select([c for c in ("o_orderkey", "no_such_column", "o_totalprice") if c in orders.columns])


# --- streaming ----------------------------------------------------------------------------

@query("streamed_tiers", f"SELECT event_id, {sql_cut('value', presets.TIER_EDGES, presets.TIERS)} AS tier FROM events")
def streamed_tiers(spark, d):
    """A rule tier of every arriving event."""
    events = feed.read_feed(spark, d, table(spark, d, "events").schema, "events.parquet")
    rated = events.select("event_id", cut("value", presets.TIER_EDGES, presets.TIERS).alias("tier"))
    out = tables.scratch_path(spark, "tiers")
    feed.drain(rated, out, tables.scratch_path(spark, "tiers-progress"))
    return spark.read.schema(rated.schema).parquet(out)


SLICES, DELAY_DAYS, FILES = 5, 2, 2
EVENTS = ["event_id", "user_id", "ts", "value"]


def _feed_in_slices(spark, d, late: bool):
    """Folder of a feed whose files are the events of five spans of time, one after the other.

    With ``late`` each span repeats events of the one before, and the last one brings some that are older than all others, under other ids.
    """
    events = table(spark, d, "events").select(*EVENTS)
    day = F.to_date("ts")
    ends = events.agg(F.min(day).alias("lo"), F.datediff(F.max(day), F.min(day)).alias("days")).first()
    number = F.coalesce(F.floor(F.datediff(day, F.lit(ends["lo"])) * SLICES / ((ends["days"] or 0) + 1)), F.lit(0))
    path = tables.scratch_path(spark, "feed")
    for b in range(SLICES):
        rows = events.where(number == b)
        if late:
            rows = rows.unionByName(events.where((number == b - 1) & (F.col("event_id") % 7 == 0)))
        if late and b == SLICES - 1:
            older = events.where((number == 0) & (F.col("event_id") % 3 == 0))
            rows = rows.unionByName(older.select((-1 - F.col("event_id")).alias("event_id"), "user_id", (F.col("ts") - F.expr("INTERVAL 1 SECOND")).alias("ts"), "value"))
        rows.repartition(FILES).write.mode("append").parquet(path)
    return feed.read_feed(spark, path, events.schema, max_files=FILES)


@query("streamed_window_firsts", f"""
WITH e AS (SELECT *, row_number() OVER (PARTITION BY user_id, date_trunc('day', ts) ORDER BY ts, event_id) AS place FROM events WHERE ts IS NOT NULL)
SELECT event_id, user_id, value FROM e WHERE place = 1
  AND date_trunc('day', ts) + INTERVAL 1 DAY <= (SELECT max(ts) FROM events) - INTERVAL {DELAY_DAYS} DAY""")
def streamed_window_firsts(spark, d):
    """The first event of each user and day, from a feed in batches with repeated events and some that come too late; state expires, on disk."""
    firsts = feed.first_in_window(_feed_in_slices(spark, d, True), ["user_id"], "ts", "1 day", f"{DELAY_DAYS} days", ["event_id"])
    out = tables.scratch_path(spark, "window-firsts")
    with feed.disk_state(spark):
        feed.drain(firsts, out, tables.scratch_path(spark, "window-firsts-progress"))
    return spark.read.schema(firsts.schema).parquet(out).select("event_id", "user_id", "value")


@query("published_tiers", f"""
SELECT event_id, {sql_cut('value', presets.TIER_EDGES, presets.TIERS)} AS tier, {SLICES}::BIGINT AS batches FROM events""")
def published_tiers(spark, d):
    """A rule tier of every event, published batch by batch with a ledger; asking again publishes nothing twice."""
    rated = _feed_in_slices(spark, d, False).select("event_id", cut("value", presets.TIER_EDGES, presets.TIERS).alias("tier"))
    out, progress = tables.scratch_path(spark, "published"), tables.scratch_path(spark, "published-progress")
    for _ in range(2):
        feed.publish(rated, out, progress)
    batches = feed.ledger(spark, out).count()
    return feed.published(spark, out, rated.schema).withColumn("batches", F.lit(batches).cast("long"))


# --- fitted models ------------------------------------------------------------------------

_TEST = f"""WITH {ACCIDENTS}, g AS (SELECT nivel_riesgo AS tier, count(*) AS n FROM accidents GROUP BY 1),
t AS (SELECT *, sum(n) OVER () AS total, ceil(sum(n) OVER () * 0.2::DOUBLE)::BIGINT AS k FROM g),
q AS (SELECT *, (k*n) // total AS whole, (k*n) % total AS rest FROM t),
s AS (SELECT tier, whole + CASE WHEN row_number() OVER (ORDER BY rest DESC, n DESC, tier) <= k - (SELECT sum(whole) FROM q) THEN 1 ELSE 0 END AS m FROM q)"""


def _summary(spark, d, kind):
    scored = modelling.scored_test_rows(spark, d, kind)
    total = F.aggregate("probabilities", F.lit(0.0), lambda a, x: a + x)
    labels = F.array(*[F.lit(v) for v in models.labels_of(modelling.fitted(spark, d, kind))])
    likely = F.element_at(labels, F.array_position("probabilities", F.array_max("probabilities")).cast("int"))
    return scored.groupBy(F.col(presets.TARGET).alias("tier")).agg(
        F.count(F.lit(1)).alias("n_test"), F.count_if(F.abs(total - 1.0) < 1e-9).alias("sums_to_one"),
        F.count_if(F.col("predicted") == likely).alias("most_likely"))


def _summary_sql() -> str:
    return f"{_TEST} SELECT tier, m::BIGINT AS n_test, m::BIGINT AS sums_to_one, m::BIGINT AS most_likely FROM s"


for _kind in modelling.SETTINGS:
    query(f"{_kind}_summary", _summary_sql())(lambda spark, d, kind=_kind: _summary(spark, d, kind))


def _walked(spark, d, kind):
    """Test rows for which the table of trees gives the predicted class."""
    rows = modelling.Rows(spark, d)
    model = modelling.fitted(spark, d, kind, rows)
    labels = F.array(*[F.lit(v) for v in models.labels_of(model)])
    scored = modelling.scored_test_rows(spark, d, kind, rows).select(modelling.KEY, presets.TARGET, "predicted")
    walked = trees.walked_classes(model, rows.test, modelling.KEY)
    both = scored.join(walked, modelling.KEY)
    return both.groupBy(F.col(presets.TARGET).alias("tier")).agg(
        F.count(F.lit(1)).alias("n_test"), F.count_if(F.col("predicted") == F.element_at(labels, F.col("walked").cast("int") + 1)).alias("same_class"))


for _kind in ("forest", "boosted"):
    query(f"{_kind}_by_trees", f"{_TEST} SELECT tier, m::BIGINT AS n_test, m::BIGINT AS same_class FROM s")(
        lambda spark, d, kind=_kind: _walked(spark, d, kind))


@query("importances_by_trees", " UNION ALL ".join(f"SELECT '{k}' AS model, '{f}' AS feature, true AS same" for k in ("forest", "boosted") for f in presets.FEATURES))
def importances_by_trees(spark, d):
    """Importances added up from the table of trees are those that the models give."""
    out, rows = None, modelling.Rows(spark, d)
    for kind in ("forest", "boosted"):
        model = modelling.fitted(spark, d, kind, rows)
        added = trees.importances_by_trees(trees.tree_table(model), presets.FEATURES, kind == "forest").withColumnRenamed("importance", "added")
        both = models.importances(model).join(added, "feature", "left")
        part = both.select(F.lit(kind).alias("model"), "feature", (F.abs(F.col("importance") - F.coalesce("added", F.lit(0.0))) < 1e-9).alias("same"))
        out = part if out is None else out.unionByName(part)
    return out


@query("logistic_gradients", " UNION ALL ".join(f"SELECT '{t}' AS tier, '{f}' AS feature, true AS near_zero" for t in presets.TIERS
                                                for f in [*presets.FEATURES, "(intercept)"]))
def logistic_gradients(spark, d):
    """The logistic model is the optimum: its penalised gradient vanishes over the rows it was fitted on."""
    rows = modelling.Rows(spark, d)
    gradient = models.logistic_gradient(modelling.fitted(spark, d, "logistic", rows), rows.fit, presets.TARGET)
    return gradient.select(F.col("label").alias("tier"), "feature", (F.abs("gradient") < 1e-4).alias("near_zero"))


_SHOWN = models.shown_rounds(presets.BOOSTED_PLAIN["maxIter"], 50)


@query("loss_by_round", " UNION ALL ".join(f'SELECT {r} AS "round", true AS is_log_loss, true AS is_lower' for r in _SHOWN))
def loss_by_round(spark, d):
    """The log-loss after some rounds is that of the model cut off there, and lower than after the first one."""
    rows = modelling.Rows(spark, d)
    model, test = modelling.fitted(spark, d, "boosted_plain", rows), tables.stage(rows.test, "test-rows")
    table_of = models.loss_by_round(model, test, presets.TARGET)
    inner = models.boosted_models(model)
    out = None
    for r in _SHOWN:
        cut_off = models.PipelineModel([*model.stages[:-len(inner)], *[models.first_rounds(m, r) for m in inner]])
        scored = models.batch_probabilities(cut_off, test)
        loss = evaluate.log_loss(scored, presets.TARGET, models.probability_columns(cut_off)).select(F.lit(r).alias("round"), F.col("log_loss").alias("alone"))
        out = loss if out is None else out.unionByName(loss)
    first = table_of.where(F.col("round") == 1).select(F.col("log_loss").alias("first"), F.lit(True).alias("_one"))
    both = table_of.withColumn("_one", F.lit(True)).join(out, "round").join(F.broadcast(first), "_one")
    return both.select("round", (F.abs(F.col("log_loss") - F.col("alone")) < 1e-9).alias("is_log_loss"),
                       ((F.col("round") == 1) | (F.col("log_loss") < F.col("first"))).alias("is_lower"))


_FOLDS = f"""{_TEST}, n AS (SELECT sum(t.n) - max(t.k) AS train FROM t)"""


@query("fold_sizes", f"""{_FOLDS} SELECT (f + 1)::INTEGER AS fold, ((train + {presets.CV_FOLDS} - 1 - f) // {presets.CV_FOLDS})::BIGINT AS judged,
  true AS is_share FROM n, range({presets.CV_FOLDS}) r(f)""")
def fold_sizes(spark, d):
    """Cross-validation judges every training row once."""
    scores = modelling.fold_table(spark, d)
    return scores.select("fold", "judged", F.col("accuracy").between(0.0, 1.0).alias("is_share"))


LINE_FEATURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query("return_flag_summary", """
WITH g AS (SELECT l_returnflag AS tier, count(*) AS n FROM lineitem GROUP BY 1),
t AS (SELECT *, sum(n) OVER () AS total, ceil(sum(n) OVER () * 0.2::DOUBLE)::BIGINT AS k FROM g),
q AS (SELECT *, (k*n) // total AS whole, (k*n) % total AS rest FROM t),
s AS (SELECT tier, whole + CASE WHEN row_number() OVER (ORDER BY rest DESC, n DESC, tier) <= k - (SELECT sum(whole) FROM q) THEN 1 ELSE 0 END AS m FROM q)
SELECT tier, m::BIGINT AS n_test, m::BIGINT AS sums_to_one FROM s""")
def return_flag_summary(spark, d):
    """A model on given columns: the return flag of line items."""
    lines = table(spark, d, "lineitem").select(F.concat_ws("-", *LINE_KEY).alias("line"), *LINE_FEATURES, "l_returnflag")
    rows, test = train.split_table(lines, "line", "l_returnflag", method="md5")
    fit = train.bounded(rows, "line", "l_returnflag", modelling.FIT_ROWS)
    model = models.fit_model(fit, "logistic", LINE_FEATURES, "l_returnflag", presets.LOGISTIC, True)
    total = F.aggregate("probabilities", F.lit(0.0), lambda a, x: a + x)
    return models.class_probabilities(model, test).groupBy(F.col("l_returnflag").alias("tier")).agg(
        F.count(F.lit(1)).alias("n_test"), F.count_if(F.abs(total - 1.0) < 1e-9).alias("sums_to_one"))


@query("saved_model_summary", "SELECT count(*) AS answers, count(*) AS equal_answers FROM events")
def saved_model_summary(spark, d):
    """A saved model gives the same answers."""
    model = modelling.fitted(spark, d, "boosted")
    path = tables.scratch_path(spark, "model")
    models.save_model(model, path)
    one, two = (modelling.rate_routes.score_requests(modelling._requests(spark, d), m) for m in (model, models.load_model(path)))
    answers = [c for c in one.columns if c not in modelling._requests(spark, d).columns]
    pair = one.select("event_id", F.struct(*answers).alias("a")).join(two.select("event_id", F.struct(*answers).alias("b")), "event_id")
    return pair.agg(F.count(F.lit(1)).alias("answers"), F.count_if(F.col("a").eqNullSafe(F.col("b"))).alias("equal_answers"))
