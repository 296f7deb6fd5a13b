import pytest
from pyspark.sql import functions as F

from amberline.operators import evaluate

ROWS = [("A", "A", .7, .2, .1), ("A", "B", .3, .5, .2), ("B", "B", .2, .6, .2), ("B", "B", .1, .8, .1),
        ("C", "A", .5, .1, .4), ("C", "C", .1, .2, .7), ("C", "C", .2, .2, .6), ("A", "A", .6, .2, .2)]
P = {"A": "p0", "B": "p1", "C": "p2"}


@pytest.fixture(scope="module")
def scored(spark):
    return spark.createDataFrame(ROWS, "y string, pred string, p0 double, p1 double, p2 double")


def plain_auc(label, i):
    pos = [r[2 + i] for r in ROWS if r[0] == label]
    neg = [r[2 + i] for r in ROWS if r[0] != label]
    return sum((a > b) + 0.5 * (a == b) for a in pos for b in neg) / (len(pos) * len(neg))


def test_auc_by_pairs(scored):
    got = {r.label: r.auc for r in evaluate.roc_auc_by_class(scored, "y", P).collect()}
    for i, label in enumerate("ABC"):
        assert got[label] == pytest.approx(plain_auc(label, i))
    assert evaluate.roc_auc_ovr(scored, "y", P).first().auc == pytest.approx(sum(got.values()) / 3)


def test_auc_is_missing_without_positives(scored):
    assert evaluate.roc_auc_ovr(scored.where("y <> 'C'"), "y", P).first().auc is None


def test_report_and_f1(scored):
    rows = {r.label: r for r in evaluate.class_report(scored, "y", "pred").collect()}
    assert rows["A"].precision == pytest.approx(0.6667) and rows["A"].recall == pytest.approx(0.6667)
    assert rows["B"].precision == pytest.approx(0.6667) and rows["B"].recall == 1.0
    assert rows["accuracy"].f1 == 0.75 and rows["macro avg"].support == 8
    one = evaluate.class_metrics(scored, "y", "pred").first()
    assert one.accuracy == 0.75
    assert one.f1_macro == pytest.approx((2 / 3 + 0.8 + 0.8) / 3)


def test_undefined_precision_is_zero(scored):
    rows = {r.label: r for r in evaluate.class_report(scored.withColumn("pred", F.lit("A")), "y", "pred").collect()}
    assert rows["B"].precision == 0 and rows["B"].f1 == 0


def test_first_best_on_a_tie(spark):
    table = spark.createDataFrame([(0, "x", None), (1, "y", .8), (2, "z", .8)], "position int, model string, auc double")
    assert evaluate.best_model(table, "auc").first().model == "y"


def test_run_log_appends(spark, tmp_path):
    path = str(tmp_path / "runs")
    one = evaluate.log_run(spark, path, "first", {"depth": 6}, {"accuracy": 0.5, "auc": None})
    two = evaluate.log_run(spark, path, "second", {"depth": 4}, {"accuracy": 0.6})
    rows = evaluate.read_runs(spark, path).collect()
    assert len(rows) == 5 and {r.run_id for r in rows} == {one, two}
    assert {r.value for r in rows if r.key == "auc"} == {None}
