"""Classification metrics on fixed predictions, before any model is involved."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import draws
from ..functions.scalar import round_half_even
from ..operators import evaluate
from ..sources.tables import scratch_path
from .registry import query, sql_round, sql_uniform, table

CLASSES = ["F", "O", "P"]
BOOST = {"a": 0.5, "b": 0.2, "c": 0.9}


def predictions(spark: SparkSession, d: str, variant: str = "a", dp: int = 3) -> DataFrame:
    """Order status with three probabilities that lean towards the truth, and the class they favour."""
    u = draws.uniforms(31, [f"{variant}.{c}" for c in CLASSES], "o_orderkey", "md5")
    rows = table(spark, d, "orders").select("o_orderkey", F.col("o_orderstatus").alias("y"), u.alias("u"))
    rows = rows.select("o_orderkey", "y", *[F.col("u")[i].alias(f"u_{c}") for i, c in enumerate(CLASSES)])
    raw = rows.withColumns({f"u_{c}": F.col(f"u_{c}") + F.when(F.col("y") == c, BOOST[variant]).otherwise(0.0) for c in CLASSES})
    total = F.col("u_F") + F.col("u_O") + F.col("u_P")
    out = raw.select("o_orderkey", "y", *[round_half_even(F.col(f"u_{c}") / total, dp).alias(f"p_{c}") for c in CLASSES])
    best = F.array_position(F.array("p_F", "p_O", "p_P"), F.greatest("p_F", "p_O", "p_P"))
    return out.withColumn("pred", F.element_at(F.array(*[F.lit(c) for c in CLASSES]), best.cast("int")))


PROBABILITIES = {c: f"p_{c}" for c in CLASSES}


def _pred_sql(variant: str, name: str) -> str:
    us = ", ".join(f"{sql_uniform(31, f'{variant}.{c}', 'o_orderkey')} + CASE WHEN o_orderstatus = '{c}' THEN {BOOST[variant]}::DOUBLE ELSE 0::DOUBLE END AS u_{c}" for c in CLASSES)
    ps = ", ".join(f"{sql_round(f'u_{c}/(u_F+u_O+u_P)', 3)} AS p_{c}" for c in CLASSES)
    return (f"{name}0 AS (SELECT o_orderkey, o_orderstatus AS y, {us} FROM orders), {name}1 AS (SELECT o_orderkey, y, {ps} FROM {name}0), "
            f"{name} AS (SELECT *, CASE WHEN p_F >= p_O AND p_F >= p_P THEN 'F' WHEN p_O >= p_P THEN 'O' ELSE 'P' END AS pred FROM {name}1)")


def _class_sql(name: str, out: str) -> str:
    return (f"{out} AS (SELECT l AS label, (SELECT count(*) FROM {name} WHERE y = l) AS support, (SELECT count(*) FROM {name} WHERE pred = l) AS predicted, "
            f"(SELECT count(*) FROM {name} WHERE y = l AND pred = l) AS hits FROM (SELECT DISTINCT y AS l FROM {name} UNION SELECT DISTINCT pred FROM {name}) l_), "
            f"{out}m AS (SELECT *, CASE WHEN predicted = 0 THEN 0 ELSE hits::DOUBLE/predicted END AS precision, CASE WHEN support = 0 THEN 0 ELSE hits::DOUBLE/support END AS recall, "
            f"hits*2::DOUBLE/(predicted+support) AS f1 FROM {out})")


def _auc_sql(name: str, out: str) -> str:
    long = " UNION ALL ".join(f"SELECT '{c}' AS label, p_{c} AS s, (y = '{c}')::INTEGER AS pos FROM {name}" for c in CLASSES)
    return (f"{out}0 AS ({long}), {out}1 AS (SELECT label, pos, rank() OVER (PARTITION BY label ORDER BY s) + (count(*) OVER (PARTITION BY label, s) - 1)/2::DOUBLE AS r FROM {out}0), "
            f"{out} AS (SELECT label, (sum(CASE WHEN pos = 1 THEN r ELSE 0 END) - sum(pos)::DOUBLE*(sum(pos)+1)/2::DOUBLE)/(sum(pos)::DOUBLE*(count(*)-sum(pos))) AS auc FROM {out}1 GROUP BY label)")


def _metric_sql(name: str) -> str:
    return (f"(SELECT sum(hits)::DOUBLE/sum(support) FROM {name}cm) AS accuracy, (SELECT avg(f1) FROM {name}cm) AS f1_macro, "
            f"(SELECT sum(f1*support)/sum(support) FROM {name}cm) AS f1_weighted, (SELECT avg(auc) FROM {name}auc) AS auc")


def _all_sql(variant: str, name: str) -> str:
    return f"{_pred_sql(variant, name)}, {_class_sql(name, name + 'c')}, {_auc_sql(name, name + 'auc')}"


@query("accuracy", f"WITH {_pred_sql('a', 'a')} SELECT {sql_round('avg((y = pred)::INTEGER)', 6)} AS accuracy FROM a")
def accuracy(spark, d):
    return evaluate.accuracy(predictions(spark, d), "y", "pred").select(round_half_even("accuracy", 6).alias("accuracy"))


@query("confusion", f"WITH {_pred_sql('a', 'a')} SELECT y, pred, count(*) AS n FROM a GROUP BY y, pred")
def confusion(spark, d):
    return evaluate.confusion(predictions(spark, d), "y", "pred")


_REPORT = f"""
SELECT label, {sql_round('precision', 4)} AS precision, {sql_round('recall', 4)} AS recall, {sql_round('f1', 4)} AS f1, support FROM acm UNION ALL
SELECT 'accuracy', NULL, NULL, {sql_round('sum(hits)::DOUBLE/sum(support)', 4)}, sum(support)::BIGINT FROM acm UNION ALL
SELECT 'macro avg', {sql_round('avg(precision)', 4)}, {sql_round('avg(recall)', 4)}, {sql_round('avg(f1)', 4)}, sum(support)::BIGINT FROM acm UNION ALL
SELECT 'weighted avg', {sql_round('sum(precision*support)/sum(support)', 4)}, {sql_round('sum(recall*support)/sum(support)', 4)}, {sql_round('sum(f1*support)/sum(support)', 4)}, sum(support)::BIGINT FROM acm"""


@query("class_report", f"WITH {_all_sql('a', 'a')} {_REPORT}")
def class_report(spark, d):
    return evaluate.class_report(predictions(spark, d), "y", "pred")


@query("class_report_with_unpredicted_class", f"""WITH {_pred_sql('a', 'a9')}, a AS (SELECT y, CASE WHEN pred = 'P' THEN 'X' ELSE pred END AS pred FROM a9),
{_class_sql('a', 'ac')} {_REPORT}""")
def class_report_with_unpredicted_class(spark, d):
    rows = predictions(spark, d).withColumn("pred", F.when(F.col("pred") == "P", "X").otherwise(F.col("pred")))
    return evaluate.class_report(rows, "y", "pred")


@query("log_loss", f"""WITH {_pred_sql('a', 'a')} SELECT {sql_round("avg(-ln(greatest(CASE y WHEN 'F' THEN p_F WHEN 'O' THEN p_O ELSE p_P END, 1e-15::DOUBLE)))", 6)} AS log_loss FROM a""")
def log_loss(spark, d):
    return evaluate.log_loss(predictions(spark, d), "y", PROBABILITIES).select(round_half_even("log_loss", 6).alias("log_loss"))


@query("roc_auc_by_class", f"WITH {_pred_sql('a', 'a')}, {_auc_sql('a', 'x')} SELECT label, {sql_round('auc', 8)} AS auc FROM x")
def roc_auc_by_class(spark, d):
    return evaluate.roc_auc_by_class(predictions(spark, d), "y", PROBABILITIES).select(
        "label", round_half_even("auc", 8).alias("auc"))


@query("roc_auc_continuous", f"""
WITH x0 AS (SELECT (quality = 1)::INTEGER AS pos, n_chars AS s FROM labels JOIN documents USING (doc_id)),
x1 AS (SELECT pos, rank() OVER (ORDER BY s) + (count(*) OVER (PARTITION BY s) - 1)/2::DOUBLE AS r FROM x0)
SELECT 'good' AS label, {sql_round('(sum(CASE WHEN pos = 1 THEN r ELSE 0 END) - sum(pos)::DOUBLE*(sum(pos)+1)/2::DOUBLE)/(sum(pos)::DOUBLE*(count(*)-sum(pos)))', 8)} AS auc FROM x1""")
def roc_auc_continuous(spark, d):
    joined = table(spark, d, "labels").join(table(spark, d, "documents").select("doc_id", "n_chars"), "doc_id")
    rows = joined.select(F.when(F.col("quality") == 1, "good").otherwise("bad").alias("y"), "n_chars")
    return evaluate.roc_auc_by_class(rows, "y", {"good": "n_chars"}).select("label", round_half_even("auc", 8).alias("auc"))


@query("undefined_auc", "SELECT NULL::DOUBLE AS auc FROM orders LIMIT 1")
def undefined_auc(spark, d):
    """A class that never occurs leaves the macro average undefined."""
    rows = predictions(spark, d).withColumn("p_Q", F.lit(0.0))
    return evaluate.roc_auc_ovr(rows, "y", {**PROBABILITIES, "Q": "p_Q"})


@query("final_metrics", f"""WITH {_all_sql('a', 'a')}, m AS (SELECT {_metric_sql('a')})
SELECT {', '.join(f'{sql_round(c, 4)} AS {c}' for c in evaluate.METRICS)} FROM m""")
def final_metrics(spark, d):
    return evaluate.final_metrics(evaluate.metrics(predictions(spark, d), "y", "pred", PROBABILITIES))


def _compared(spark, d):
    """All models in one table, counted and ranked together."""
    together = None
    for i, v in enumerate("abc"):
        part = predictions(spark, d, v).select(F.lit(i).alias("position"), F.lit(f"model {v}").alias("model"), "y", "pred", *PROBABILITIES.values())
        together = part if together is None else together.unionByName(part)
    return evaluate.metrics(together, "y", "pred", PROBABILITIES, by=["position", "model"])


_COMPARED = ", ".join(_all_sql(v, v) for v in "abc") + ", cmp AS (" + " UNION ALL ".join(
    f"SELECT {i} AS position, 'model {v}' AS model, {_metric_sql(v)}" for i, v in enumerate("abc")) + ")"


@query("model_metrics", f"""WITH {_COMPARED} SELECT position, model, {', '.join(f'{sql_round(c, 8)} AS {c}' for c in evaluate.METRICS)},
  {', '.join(f"printf('%.1f%%', {c}*100::DOUBLE) AS {c}_text" for c in evaluate.METRICS)} FROM cmp""")
def model_metrics(spark, d):
    out = evaluate.with_percent_texts(_compared(spark, d))
    return out.withColumns({c: round_half_even(c, 8) for c in evaluate.METRICS})


@query("best_by_auc", f"WITH {_COMPARED} SELECT model FROM cmp ORDER BY auc DESC NULLS LAST, position LIMIT 1")
def best_by_auc(spark, d):
    return evaluate.best_model(_compared(spark, d), "auc").select("model")


@query("best_by_f1", f"WITH {_COMPARED} SELECT model FROM cmp ORDER BY f1_weighted DESC NULLS LAST, position LIMIT 1")
def best_by_f1(spark, d):
    return evaluate.best_model(_compared(spark, d)).select("model")


@query("run_log", f"""WITH {_all_sql('a', 'a')}, m AS (SELECT {_metric_sql('a')})
SELECT 'param' AS kind, 'n_rows' AS "key", count(*)::DOUBLE AS value FROM orders UNION ALL
SELECT 'metric', 'accuracy', {sql_round('accuracy', 4)} FROM m UNION ALL SELECT 'metric', 'auc', {sql_round('auc', 4)} FROM m""")
def run_log(spark, d):
    row = evaluate.final_metrics(evaluate.metrics(predictions(spark, d), "y", "pred", PROBABILITIES)).first()
    path = scratch_path(spark, "runs")
    evaluate.log_run(spark, path, "fixed predictions", {"n_rows": table(spark, d, "orders").count()},
                     {"accuracy": row["accuracy"], "auc": row["auc"]})
    return evaluate.read_runs(spark, path).select("kind", "key", F.col("value").cast("double").alias("value"))
