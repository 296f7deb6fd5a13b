from collections import Counter

import pytest
from pyspark.sql import functions as F

from amberline.operators import sample


def classes(spark, sizes):
    rows, k = [], 0
    for label, n in sizes.items():
        for _ in range(n):
            rows.append((k, label))
            k += 1
    return spark.createDataFrame(rows, "k long, y string").repartition(6)


SKEWED = {"ALTO": 24, "BAJO": 1460, "MEDIO": 3516}


def test_allocation_of_the_test_share():
    assert sample.allocate_test(SKEWED, 0.2) == {"ALTO": 5, "BAJO": 292, "MEDIO": 703}
    with pytest.raises(ValueError):
        sample.allocate_test({"a": 1, "b": 9}, 0.2)
    with pytest.raises(ValueError):
        sample.allocate_test({"a": 2, "b": 2, "c": 2}, 0.2)


def test_split_is_exact_and_stable(spark):
    df = classes(spark, SKEWED)
    one = {r.k: r.is_test for r in sample.stratified_split(df, "k", "y").collect()}
    two = {r.k: r.is_test for r in sample.stratified_split(df.repartition(3), "k", "y").collect()}
    assert one == two
    sizes = Counter(r.y for r in df.collect() if one[r.k])
    assert sizes == {"ALTO": 5, "BAJO": 292, "MEDIO": 703}
    other = {r.k: r.is_test for r in sample.stratified_split(df, "k", "y", seed=7).collect()}
    assert other != one


def test_rows_without_label_are_in_neither_part(spark):
    df = spark.createDataFrame([(i, "a" if i < 10 else "b" if i < 20 else None) for i in range(25)], "k long, y string")
    marks = sample.stratified_split(df, "k", "y").collect()
    assert sum(r.is_test is None for r in marks) == 5


def test_shared_keys_are_refused_or_counted(spark):
    df = spark.createDataFrame([(1, "a")] * 50 + [(2, "b")] * 50, "k long, y string")
    with pytest.raises(ValueError, match="does not identify rows"):
        sample.stratified_split(df, "k", "y")


def test_shuffled_folds_are_even_and_complete(spark):
    df = classes(spark, SKEWED)
    folded = sample.stratified_folds(df, "k", "y", 5, rows_per_slice=100)
    rows = folded.collect()
    assert len({r.k for r in rows}) == len(rows) == 5000
    total = Counter(r.fold for r in rows)
    assert max(total.values()) - min(total.values()) <= 1
    for label in SKEWED:
        per = Counter(r.fold for r in rows if r.y == label)
        assert len(per) == 5 and max(per.values()) - min(per.values()) <= 1


def test_folds_do_not_depend_on_slicing(spark):
    df = classes(spark, {"a": 300, "b": 700})
    one = {r.k: r.fold for r in sample.stratified_folds(df, "k", "y", 5, rows_per_slice=5).collect()}
    two = {r.k: r.fold for r in sample.stratified_folds(df, "k", "y", 5, rows_per_slice=10**6).collect()}
    assert one == two


def test_block_folds_follow_the_input_order(spark):
    labels = ["b", "a", "b", "a", "a", "b", "b", "a", "b", "b", "a"]
    df = spark.createDataFrame(list(enumerate(labels)), "k long, y string")
    got = [r.fold for r in sample.block_folds(df, "k", "y", 3).orderBy("k").collect()]
    # class b appears first: its 6 rows fill 2, 2, 2; the 5 rows of a then fill 2, 2, 1
    b = [f for f, y in zip(got, labels) if y == "b"]
    a = [f for f, y in zip(got, labels) if y == "a"]
    assert b == [0, 0, 1, 1, 2, 2] and a == [0, 0, 1, 1, 2]


def test_too_few_rows_for_folds(spark):
    with pytest.raises(ValueError):
        sample.stratified_folds(classes(spark, {"a": 3, "b": 50}), "k", "y", 5)


@pytest.mark.parametrize("method", ["md5", "xxhash64"])
def test_samples_have_the_exact_size(spark, method):
    df = spark.range(3000).withColumnRenamed("id", "k")
    for k in (0, 1, 80, 2999, 3000, 5000):
        assert sample.sample_rows(df, "k", k, 1, method).count() == min(k, 3000)


def test_sample_groups_are_disjoint(spark):
    df = spark.range(1000).withColumnRenamed("id", "k")
    got = Counter(r.g for r in sample.with_sample_group(df, "k", [20, 20, 20, 5], 1, "g").collect())
    assert got == {0: 20, 1: 20, 2: 20, 3: 5, None: 935}


def test_weights():
    assert sample.balanced_weights({"a": 1, "b": 3, "c": 6}) == pytest.approx({"a": 10 / 3, "b": 10 / 9, "c": 10 / 18})


def test_split_never_shuffles_the_rows(spark):
    df = classes(spark, SKEWED).select("k", "y", F.lit("payload").alias("p"))
    plan = sample.stratified_split(df, "k", "y")._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" not in plan and "Join" not in plan and "Sort" not in plan


def test_folds_refuse_a_hot_key(spark):
    """Two thirds of the rows share a key: an error, not one task with all of them."""
    key = F.when(F.col("id") % 3 == 0, F.col("id")).otherwise(F.lit(-1))
    df = spark.range(30000).select(key.alias("k"), F.when(F.col("id") % 2 == 0, "a").otherwise("b").alias("y"))
    with pytest.raises(Exception, match="does not identify rows"):
        sample.stratified_folds(df.where("y = 'a'").unionByName(df), "k", "y", 5, rows_per_slice=100).collect()
