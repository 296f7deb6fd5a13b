import pytest
from pyspark.sql import functions as F

from amberline import presets
from amberline.operators import clean, encode, profile
from amberline.operators.dirty import append_copies, inject_nulls
from amberline.plans import prepare
from amberline.sources import tables


def ages(spark, values):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, edad double")


def cleaned(spark, values, **options):
    df = ages(spark, values)
    stats = clean.fit_clean(df, {"edad": (18, 85)}, ["edad"], **options)
    return [r.edad for r in clean.apply_clean(df, stats).orderBy("i").collect()]


def test_range_fix_then_imputation(spark):
    assert cleaned(spark, [5.0, 20.0, 30.0, 40.0, 150.0, None]) == [30, 20, 30, 40, 30, 30]
    assert cleaned(spark, [18.0, 20.0, 200.0, 201.0, None]) == [18, 20, 110, 110, 65]


def test_nan_counts_as_missing(spark):
    assert cleaned(spark, [20.0, 30.0, float("nan")]) == [20, 30, 25]


def test_zero_traffic_and_negative_payment(spark):
    df = spark.createDataFrame([(0, 0.0, -1.0), (1, -100.0, 0.0), (2, 99999.0, 5.0), (3, 50000.0, 7.0)],
                               "i int, flujo double, pago double")
    stats = clean.fit_clean(df, {"flujo": (0, 50000)}, [], {"pago": (0, 0)})
    rows = clean.apply_clean(df, stats).orderBy("i").collect()
    assert [r.flujo for r in rows] == [0, 25000, 25000, 50000]
    assert [r.pago for r in rows] == [0, 0, 5, 7]


def test_median_of_an_even_number_of_dates(spark):
    df = spark.createDataFrame([("2024-01-01",), ("2024-01-02",), ("no-date",)], "fecha string")
    stats = clean.fit_clean(df, {}, [], date_column="fecha", date_formats=presets.DATE_FORMATS)
    got = sorted(r.f for r in clean.apply_clean(df, stats).select(F.date_format("fecha", "yyyy-MM-dd HH:mm").alias("f")).collect())
    assert got == ["2024-01-01 00:00", "2024-01-01 12:00", "2024-01-02 00:00"]


def test_first_copy_wins(spark):
    df = spark.createDataFrame([("A", 1), ("B", 2), ("A", 3)], "k string, n int")
    assert sorted(map(tuple, clean.dedup_first(df, ["k"], ["n"]).collect())) == [("A", 1), ("B", 2)]


def test_dedup_limits_each_key_before_the_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), F.col("id").alias("n"))
    plan = clean.dedup_first(df, ["k"], ["n"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_stats_survive_a_table(spark, tmp_path):
    df = ages(spark, [5.0, 20.0, 30.0, None])
    stats = clean.fit_clean(df, {"edad": (18, 85)}, ["edad"], maxima=["edad"])
    path = str(tmp_path / "stats")
    stats.to_table(spark).write.parquet(path)
    assert clean.CleanStats.from_table(spark.read.parquet(path)) == stats


def test_label_codes(spark):
    catalogs = encode.from_catalogs(presets.SERVING_CATALOGS)
    assert catalogs["tipo_vehiculo"] == ["Automóvil", "Bus", "Camioneta", "Camión", "Moto", "Semirremolque"]
    assert catalogs["region"][:4] == ["Ancash", "Apurímac", "Arequipa", "Cajamarca"]
    df = spark.createDataFrame([("Camión",), ("Bus",), ("Automóvil",), ("Moto",)], "tipo_vehiculo string")
    coded = encode.encode(df, {"tipo_vehiculo": catalogs["tipo_vehiculo"]})
    assert [r.tipo_vehiculo_cod for r in coded.collect()] == [3, 1, 0, 4]
    assert dict(coded.dtypes)["tipo_vehiculo_cod"] == "int"


def test_unseen_label_is_an_error(spark):
    df = spark.createDataFrame([("Tren",)], "tipo_vehiculo string")
    with pytest.raises(Exception, match="no entry for key"):
        encode.encode(df, {"tipo_vehiculo": presets.VEHICLE_TYPES}).collect()


def test_label_list_refuses_high_cardinality(spark):
    df = spark.range(50).select(F.col("id").cast("string").alias("v"))
    with pytest.raises(ValueError, match="label_table"):
        encode.fit_labels(df, ["v"], max_labels=20)
    table = encode.label_table(df, "v").orderBy("code").collect()
    assert [r.label for r in table] == sorted(str(i) for i in range(50))
    assert [r.code for r in table] == list(range(50))


def test_profile_of_a_dirty_table(spark):
    df = spark.createDataFrame([(1, None), (1, None), (2, "x"), (3, None)], "a int, b string")
    got = {r.measure: r.value for r in profile.dirty_profile(df, ["a", "b"]).collect()}
    assert got == {"rows": 4, "nulls:a": 0, "nulls:b": 3, "duplicates": 1}


def test_domain_counts_keep_absent_values(spark):
    df = spark.createDataFrame([("ALTO",), ("BAJO",), ("BAJO",), (None,)], "t string")
    assert [tuple(r) for r in profile.value_counts(df, "t", presets.TIERS).collect()] == [("BAJO", 2), ("ALTO", 1), ("MEDIO", 0)]


def test_share_counts_missing_rows(spark):
    df = spark.createDataFrame([("ALTO",), ("BAJO",), (None,)], "t string")
    assert df.agg(profile.share_of("t", "ALTO")).first()[0] == pytest.approx(100 / 3)


def test_describe_quartiles(spark):
    row = profile.describe(spark.createDataFrame([(1.0,), (2.0,), (4.0,), (10.0,), (None,)], "x double"), ["x"]).first()
    assert (row["count"], row.q25, row.q50, row.q75) == (4, 1.75, 3.0, 5.5)


def test_full_scorecard_case(spark):
    row = [(120.0, 2.0, 8000.0, 5, 3, "Secundaria", "Camión", "Noche (18-24)", "k")]
    df = spark.createDataFrame(row, "lluvia_mm double, visibilidad_km double, flujo_vehicular double, antiguedad_veh int, "
                                    "infracciones_prev int, tipo_via string, tipo_vehiculo string, franja_horaria string, k string")
    got = prepare.with_rule_score(df, "k", 1, noise_sd=0).first()
    assert (got.score_riesgo, got.nivel_riesgo) == (77.0, "ALTO")


def test_first_job_end_to_end(spark):
    raw = tables.stage(prepare.accidents(spark, 5000, 42))
    assert len(raw.columns) == 25 and raw.count() == 5000
    dirty = tables.stage(prepare.dirty_accidents(raw, seed=42))
    assert dirty.count() == 5050
    assert profile.duplicate_rows(dirty).first()[0] == 50
    done = prepare.clean_accidents(dirty)
    table = tables.stage(done.table)
    assert (table.count(), len(table.columns)) == (5000, 36)
    missing = clean.null_counts(table, [c for c in table.columns if c != "nivel_riesgo"]).where("nulls > 0").collect()
    assert missing == []
    bounds = table.agg(F.min("edad_conductor"), F.max("edad_conductor"), F.max("lluvia_mm"), F.min("pago_seguro_sol")).first()
    assert bounds[0] >= 18 and bounds[1] <= 85 and bounds[2] <= 500 and bounds[3] >= 0
    tiers = {r.nivel_riesgo: r.n for r in profile.value_counts(table, "nivel_riesgo").collect()}
    assert tiers["MEDIO"] > tiers["BAJO"] > tiers["ALTO"] > 0
    summary = profile.clean_summary(table, "score_riesgo", "nivel_riesgo", presets.TIERS).first()
    assert summary.n_rows == 5000 and 37 < summary.mean_score < 41


def test_null_injection_rate(spark):
    df = spark.range(20000).select(F.col("id").alias("k"), F.lit(1.0).alias("a"), F.lit(2.0).alias("b"))
    got = {r.column_name: r.nulls for r in clean.null_counts(inject_nulls(df, "k", ["a", "b"], 0.08, 1), ["a", "b"]).collect()}
    assert all(1400 < n < 1800 for n in got.values()) and got["a"] != got["b"]


def test_hot_key_dedup(spark):
    """A third of all rows share one key."""
    df = spark.range(30000).select(F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id")).alias("k"), "id")
    out = clean.dedup_first(df, ["k"], ["id"])
    assert out.count() == 20001 and out.where("k = -1").first().id == 0
    assert append_copies(out, "k", 50, 1).count() == 20051
