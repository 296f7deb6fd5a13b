import pytest
from pyspark.sql import functions as F

from amberline import presets
from amberline.operators import rate

LABELS = ["ALTO", "BAJO", "MEDIO"]


def scores(spark, p, **options):
    df = spark.createDataFrame([(p,)], "p array<double>")
    named = rate.named_probabilities(LABELS, "p", **options)
    row = df.select(rate.proba_score(named).alias("s")).withColumn("t", rate.tier_from_proba_score("s")).first()
    return row.s, row.t


def test_score_by_name_and_by_position(spark):
    p = [0.2, 0.3, 0.5]
    assert scores(spark, p) == (30.0, "BAJO")
    assert scores(spark, p, compat_positions=True) == (41.0, "MEDIO")


def test_certain_high_risk(spark):
    assert scores(spark, [1.0, 0.0, 0.0]) == (60.0, "MEDIO")
    assert scores(spark, [1.0, 0.0, 0.0], compat_positions=True) == (10.0, "BAJO")


def test_missing_tier_text(spark):
    df = spark.createDataFrame([(None,), (120.0,)], "s double")
    assert [r[0] for r in df.select(rate.tier_from_proba_score("s", compat_nan_text=True)).collect()] == ["nan", "nan"]


def routes(spark):
    rows = [(f"R{i}", "Lima" if i % 3 else "Cusco", float(i), "MEDIO" if i > 5 else "BAJO") for i in range(12)]
    return spark.createDataFrame(rows + [("RX", None, 1.0, "BAJO")], "ruta_id string, region string, score double, tier string")


def test_summary(spark):
    got = [tuple(r) for r in rate.summarise(routes(spark), "region", "ruta_id", "score", "tier").collect()]
    assert got == [("Lima", 8, 6.0, 0, 5, 3), ("Cusco", 4, 4.5, 0, 2, 2)] or got[0][2] >= got[1][2]
    assert sum(r[1] for r in got) == 12


def test_lists_per_tier(spark):
    rows = rate.top_per_tier(routes(spark), "tier", "score", "ruta_id", 2).collect()
    by = {}
    for r in rows:
        by.setdefault(r.tier, []).append(r)
    assert [r.ruta_id for r in sorted(by["MEDIO"], key=lambda r: r.puesto)] == ["R11", "R10"]
    assert by["MEDIO"][0].total == 6 and by["BAJO"][0].total == 7
    assert len(by["ALTO"]) == 1 and by["ALTO"][0].ruta_id is None and "ALTO" in by["ALTO"][0].aviso


def test_lists_limit_before_the_shuffle(spark):
    tier = F.when(F.col("id") % 100 == 0, "ALTO").otherwise("BAJO")  # nearly all rows in one tier
    df = spark.range(1000).select(F.col("id").cast("string").alias("k"), F.col("id").cast("double").alias("s"), tier.alias("t"))
    plan = rate.top_per_tier(df, "t", "s", "k")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_worst_is_a_bounded_sort(spark):
    plan = rate.worst(routes(spark), "tier", "MEDIO", "score", "ruta_id")._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan


def test_defaults_fill_gaps_and_absent_columns(spark):
    df = spark.createDataFrame([(1, None), (2, "Urbana")], "id int, tipo_via string")
    rows = rate.with_defaults(df, presets.REQUEST_DEFAULTS).orderBy("id").collect()
    assert [r.tipo_via for r in rows] == ["Nacional", "Urbana"]
    assert rows[0].region == "Lima" and rows[0].lluvia_mm == 20.0


def test_answers(spark):
    df = spark.createDataFrame([("ALTO", 0.6123, 0.2, 0.1877), ("BAJO", 0.1, 0.7, 0.2)], "t string, a double, b double, m double")
    named = {"ALTO": F.col("a"), "BAJO": F.col("b"), "MEDIO": F.col("m")}
    rows = df.select(*[c.alias(n) for n, c in rate.answer_columns("t", named).items()]).collect()
    assert rows[0].emoji == "🔴" and rows[0].proba_ALTO == 61.2 and rows[0].recomendacion == presets.TIER_ADVICE["ALTO"]
    assert rows[1].emoji == "🟢" and rows[1].score_riesgo == pytest.approx(19.0)
