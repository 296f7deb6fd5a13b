import math
import random

import pytest
from pyspark.sql import functions as F

from amberline.operators import order_stats as O


def values_frame(spark, values):
    return spark.createDataFrame([(v,) for v in values], "x double")


def plain_quantile(values, p):
    xs = sorted(v for v in values if v is not None and not math.isnan(v))
    at = (len(xs) - 1) * p
    lo, hi = xs[math.floor(at)], xs[math.ceil(at)]
    return lo if lo == hi else lo + (hi - lo) * (at - math.floor(at))


CASES = {
    "even count": [1.0, 2.0, 4.0, 10.0, None],
    "one value": [7.0],
    "all equal": [3.0] * 50,
    "a third in one value": [5.0] * 300 + [float(i) for i in range(600)],
    "outliers far away": [random.Random(1).uniform(0, 1) for _ in range(900)] + [1e12, -1e12, float("nan"), None],
    "infinite ends": [math.inf] * 40 + [-math.inf] * 30 + [float(i % 97) for i in range(5000)],
    "nearly all infinite": [math.inf] * 400 + [1.0, 2.0],
    "overflowing span": [1e308, -1e308, 5e-324] * 9 + [float(i) for i in range(6000)],
    "negative": [-random.Random(2).expovariate(1) for _ in range(700)],
}


@pytest.mark.parametrize("name", CASES)
def test_quantiles_match_plain_python(spark, name):
    probabilities = [0.25, 0.5, 0.75]
    found = O.quantiles(values_frame(spark, CASES[name]), ["x"], probabilities)["x"]
    for p in probabilities:
        assert found[p] == pytest.approx(plain_quantile(CASES[name], p), rel=1e-12)


def test_empty_column(spark):
    assert O.medians(values_frame(spark, [None, None]), ["x"])["x"] is None


def test_approximate_median_is_close(spark):
    df = spark.range(10001).select(F.col("id").cast("double").alias("x"))
    assert abs(O.medians(df, ["x"], approx=True)["x"] - 5000) < 20


def test_cuts_by_group_with_small_bins(spark):
    rows = [("a", i * 7919 % 5000) for i in range(5000)] + [("b", i % 3) for i in range(3000)]
    df = spark.createDataFrame(rows, "g string, v long")
    ties = {}
    cuts = O.exact_cuts(df, "v", {"a": [0, 777, 4999], "b": [0, 999, 1000, 2999]}, "g", bins=8, small=4, ties=ties)
    assert cuts == {("a", 0): 0, ("a", 777): 777, ("a", 4999): 4999,
                    ("b", 0): 0, ("b", 999): 0, ("b", 1000): 1, ("b", 2999): 2}
    assert ties[("b", 1000)] == (1000, 1000)


def test_wrong_guesses_do_not_change_the_result(spark):
    df = spark.range(10000).select(F.col("id").alias("v"))
    for guess in [(0, 10), (9000, 9999), (4000, 6000), (4999, 4999)]:
        assert O.exact_cuts(df, "v", {None: [5000, 42]}, guesses={None: [guess]})[(None, 5000)] == 5000


def test_rank_beyond_the_rows(spark):
    with pytest.raises(ValueError, match="beyond"):
        O.exact_cuts(spark.range(10).select(F.col("id").alias("v")), "v", {None: [10]})


def test_prefix_sums_over_slices(spark):
    rows = [(g, i, (i * 13) % 7) for g in ("a", "b") for i in range(400)]
    df = spark.createDataFrame(rows, "g string, o long, n long").repartition(5)
    got = {(r.g, r.o): r.below for r in O.prefix_sums(df, ["g"], ["o"], {"below": "n"}).collect()}
    for g in ("a", "b"):
        running = 0
        for i in range(400):
            assert got[(g, i)] == running
            running += (i * 13) % 7
