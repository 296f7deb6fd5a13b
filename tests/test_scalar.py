import numpy as np
import pytest
from pyspark.errors import SparkRuntimeException
from pyspark.sql import functions as F

from amberline import presets
from amberline.functions import draws
from amberline.functions import scalar as S


def column(spark, values, kind="double"):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {kind}")


def results(df, expr):
    return [r[0] for r in df.orderBy("i").select(expr).collect()]


def test_bins_are_right_closed(spark):
    df = column(spark, [0.0, 33.0, 33.01, 66.0, 66.01, 100.0, 100.01, None, float("nan"), -5.0])
    expected = [None, "BAJO", "MEDIO", "MEDIO", "ALTO", "ALTO", None, None, None, None]
    assert results(df, S.cut("x", presets.TIER_EDGES, presets.TIERS)) == expected
    assert results(df, S.text_or_nan(S.cut("x", presets.TIER_EDGES, presets.TIERS)))[0] == "nan"


def test_date_literals(spark):
    df = column(spark, ["31/13/2024", "2024-99-01", "no-date", "  2024/01/01  ", "31/12/2023", "2023-02-30", None,
                        "2024-1-5", "2024-01-05 extra"], "string")
    text = F.date_format(S.parse_dates("x", presets.DATE_FORMATS), "yyyy-MM-dd HH:mm")
    assert results(df, text) == [None, None, None, "2024-01-01 00:00", "2023-12-31 00:00", None, None,
                                 "2024-01-05 00:00", None]
    strict = S.parse_dates("x", presets.DATE_FORMATS, lenient=False)
    assert results(df, strict.isNull())[7] is True


ROUNDED = [0.125, 0.375, 2.675, 1.005, 0.285, 1.115, 0.5, 1.5, -0.125, 33.335, 77.0, 99.995] + [i / 1000 for i in range(5, 3000, 10)]


def test_rounding_like_numpy(spark):
    df = column(spark, ROUNDED)
    assert results(df, S.round_half_even("x", 2)) == [float(np.round(v, 2)) for v in ROUNDED]
    assert results(df, S.round_half_even("x")) == [float(np.round(v)) for v in ROUNDED]
    assert results(column(spark, [None]), S.round_half_even("x", 2)) == [None]


def test_rounding_like_python(spark):
    df = column(spark, ROUNDED)
    assert results(df, S.round_decimal("x", 2)) == [round(v, 2) for v in ROUNDED]
    assert results(column(spark, [None]), S.round_decimal("x", 2)) == [None]


def test_clip_keeps_missing(spark):
    assert results(column(spark, [0.1, 5.0, 30.0, None]), S.clip("x", 0.5, 20.0)) == [0.5, 5.0, 20.0, None]


def test_nan_is_missing(spark):
    df = column(spark, [float("nan"), None, 90.0, 20.0])
    assert results(df, S.out_of_range(S.number("x"), 18, 85)) == [False, False, True, False]


def test_night_flag(spark):
    df = column(spark, presets.TIME_SLOTS + [None], "string")
    assert results(df, S.flag_contains("x", presets.NIGHT_MARKERS)) == [1, 0, 0, 1, 0]


def test_lookup_strict_and_lenient(spark):
    df = column(spark, ["Nacional", "Sendero"], "string")
    assert results(df, S.lookup("x", presets.ROAD_TYPE_POINTS)) == [5, None]
    with pytest.raises(SparkRuntimeException, match="Sendero"):
        results(df, S.lookup("x", presets.ROAD_TYPE_POINTS, strict=True))


def test_index_and_ratio(spark):
    df = spark.createDataFrame([(0, 120.0, 2.0, 10, 35, 0)], "i int, rain double, vis double, exp int, age int, zero int")
    assert results(df, S.climate_index("rain", "vis", 300, 20)) == [0.65]
    assert results(df, S.ratio("exp", "age")) == [0.2857]
    assert results(df, S.ratio("exp", "zero")) == [None]


def test_percent_texts(spark):
    assert results(column(spark, [0.5625, 0.1, None]), S.percent_text("x")) == ["56.2%", "10.0%", "N/A"]


def test_ids_and_dates_by_position(spark):
    df = spark.createDataFrame([(0, 0), (1, 4), (2, 122222)], "i int, x long")
    assert results(df, S.padded_id("SIN-2024-", F.col("x") + 1, 5)) == ["SIN-2024-00001", "SIN-2024-00005", "SIN-2024-122223"]
    assert results(df, S.step_date_text("x"))[:2] == ["2022-01-01", "2022-01-02"]


def test_text_bar(spark):
    assert results(column(spark, [0.81]), S.text_bar("x")) == ["█" * 16]


@pytest.mark.parametrize("method", ["md5", "xxhash64"])
def test_draws_do_not_depend_on_partitioning(spark, method):
    df = spark.range(5000).withColumnRenamed("id", "k")
    u = draws.uniform(1, "s", "k", method)
    one = {r.k: r.u for r in df.coalesce(1).select("k", u.alias("u")).collect()}
    many = {r.k: r.u for r in df.repartition(7).select("k", u.alias("u")).collect()}
    assert one == many
    assert all(0 < x < 1 for x in one.values())
    assert abs(sum(one.values()) / 5000 - 0.5) < 0.02


def test_draw_distributions(spark):
    df = spark.range(40000).withColumnRenamed("id", "k")

    def stats(kind, *args):
        parts = draws.uniforms_needed(kind)
        u = df.select(draws.uniforms(3, [kind + s for s in parts], "k").alias("u"))
        return u.select(draws.draw(kind, args, [f"u[{i}]" for i in range(len(parts))]).alias("x")).agg(
            F.avg("x").alias("m"), F.stddev("x").alias("s"), F.min("x").alias("lo"), F.max("x").alias("hi")).first()

    p = stats("poisson", 1.2)
    assert abs(p.m - 1.2) < 0.03 and abs(p.s - 1.2**0.5) < 0.03
    n = stats("normal", 18, 8, 1)
    assert abs(n.m - 18) < 0.2 and abs(n.s - 8) < 0.15
    c = stats("clipped_normal", 12, 5, 0.5, 20, 1)
    assert c.lo >= 0.5 and c.hi <= 20
    i = stats("integer", 18, 75)
    assert (i.lo, i.hi) == (18, 74)
    assert stats("folded_normal", 25, 40, 1).lo >= 0
