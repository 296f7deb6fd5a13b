import math
import random
from fractions import Fraction

import numpy as np
import pytest

from amberline.llm import queries, whitening
from amberline.llm.eigen import clusters, product, refined_eigenvectors
from amberline.llm.whitening import Centre, by_component, encoded, fit, whiten


def frame(spark, rows):
    # columns with names that the operator uses itself
    return spark.createDataFrame([(i, v, 1, "x") for i, v in rows], "vec_id long, embedding array<float>, d int, code string")


def plain_version(rows):
    """{id: [(deviation, whitened per component)]} with exact statistics and a plain eigendecomposition."""
    kept = [(i, [math.floor(64 * float(np.float32(c))) + 1_000_000 for c in v]) for i, v in rows
            if v and all(c is not None and math.isfinite(c) for c in v)]
    vectors = sorted({tuple(x) for _, x in kept})
    n, d = len(vectors), len(vectors[0])
    sums = [sum(v[j] for v in vectors) for j in range(d)]
    centred = np.array([[float(Fraction(v[j] * n - sums[j], n)) for j in range(d)] for v in vectors])
    values, axes = np.linalg.eigh(centred.T @ centred / n)
    values, axes = values[::-1], axes[:, ::-1]
    out = {}
    for i, x in kept:
        y = np.array([float(Fraction(x[j] * n - sums[j], n)) for j in range(d)])
        out.setdefault(i, []).append((sum((n * x[j] - sums[j]) ** 2 for j in range(d)), y @ axes / np.sqrt(np.maximum(values, 1e-300))))
    return n, values, out


def result(df):
    fitted = fit(df)
    return fitted, by_component(whiten(df, fitted), fitted).collect()


def vectors(seed=1, n=300, d=20):
    rng = np.random.default_rng(seed)
    turn, _ = np.linalg.qr(rng.normal(size=(d, d)))
    return [(i, [float(np.float32(c)) for c in v]) for i, v in enumerate(rng.normal(size=(n, d)) * np.linspace(3, .4, d) @ turn)]


def check(found, rows, n, values, want, k):
    got = {}
    for r in found:
        got.setdefault(r.vec_id, {}).setdefault(r.component, []).append(r)
    assert set(got) == set(want)
    signs = np.zeros(k)
    for i, parts in got.items():
        assert sorted(parts) == list(range(1, k + 1))
        for c, same in parts.items():
            assert len(same) == len(want[i])
            for r, (deviation, white) in zip(same, want[i]):
                assert (r.n, r.deviation) == (n, deviation)
                assert abs(r.explained - values[c - 1] / values.sum()) <= 1e-10 * abs(r.explained)
                assert r.identity_error < 1e-8
                signs[c - 1] = signs[c - 1] or np.sign(white[c - 1] * r.whitened)
                assert abs(r.whitened * signs[c - 1] - white[c - 1]) < 1e-8


def test_equals_plain_version(spark):
    rows = vectors()
    rows += [(1000, rows[0][1]), (1001, None), (1002, []), (1003, [None] + [0.5] * 19), (1004, [float("nan")] * 20), (1005, [float("inf")] + [0.0] * 19),
             (None, rows[3][1]), (7, rows[7][1]), (1006, [1.0] * 19), (1007, [0.001] * 20), (1008, [-0.001] * 20)]
    kept = [(i, v) for i, v in rows if i != 1006]  # its length is not that of the others
    n, values, want = plain_version(kept)
    fitted, found = result(frame(spark, rows).repartition(4))
    assert n == 302 and fitted.centre.n == n
    check(found, rows, n, values, want, 16)


def test_third_of_all_rows_alike(spark):
    rows = vectors(n=100, d=6)
    rows += [(2000 + i, rows[5][1]) for i in range(50)]
    n, values, want = plain_version(rows)
    fitted, found = result(frame(spark, rows))
    assert n == 100
    check(found, rows, n, values, want, 6)


def test_registered_query(spark, small):
    rows = [(r.vec_id, list(r.embedding) if r.embedding is not None else None) for r in spark.read.parquet(f"{small}/embeddings.parquet").collect()]
    n, values, want = plain_version(rows)
    check(queries.QUERIES["op12_embedding_whitening"](spark, small).collect(), rows, n, values, want, 16)


def test_does_not_depend_on_partitions_or_repeats(spark):
    rows = vectors(n=80, d=8)
    one = result(frame(spark, rows).coalesce(1))
    many = result(frame(spark, rows + rows[:30]).repartition(13))
    assert one[0].centre == many[0].centre
    a, b = ({(r.vec_id, r.component): r for r in x} for x in (one[1], many[1]))
    assert a.keys() == b.keys()
    assert all(a[k].deviation == b[k].deviation and abs(a[k].whitened - b[k].whitened) < 1e-9 for k in a)


@pytest.mark.parametrize("rows", [[], [(1, None)], [(1, [1.0, 2.0])], [(1, [1.0, 2.0]), (2, [1.0, 2.0])], [(1, []), (2, [])]])
def test_nothing_to_whiten(spark, rows):
    fitted, found = result(frame(spark, rows))
    assert fitted is None and found == []


def test_fewer_components_than_dimensions(spark):
    rows = [(i, [float(i % 7), float(i % 5), 3.0, float(i % 7)]) for i in range(35)]  # a constant and a repeated dimension
    fitted, found = result(frame(spark, rows))
    assert {r.component for r in found} == {1, 2} and len(found) == 70
    assert fitted.identity_error < 1e-9 and abs(sum(fitted.explained) - 1) < 1e-12


def test_large_and_small_integers(spark):
    rows = [(1, [0.0, 1.0]), (2, [1e30, 0.0]), (3, [2.0 ** 50, -3.0]), (4, [-2.0 ** 50, 5.0]), (5, [-2.0, 127 / 64]), (6, [127.5 / 64, -2.01])]
    codes = {r.id: r.code for r in encoded(frame(spark, rows)).collect()}
    assert set(codes) == {1, 3, 4, 5, 6}
    assert [codes[i][0] for i in (1, 3, 5, 6)] == [0, 3, 0, 1]
    fitted, found = result(frame(spark, rows))
    assert fitted.centre.n == 5 and all(r.deviation is None for r in found if r.vec_id in (3, 4))
    x = {1: (0, 64), 3: (2**56, -192), 4: (-2**56, 320), 5: (-128, 127), 6: (127, -129)}
    sums = [sum(v[j] for v in x.values()) for j in (0, 1)]
    assert fitted.centre.sums == tuple(sums)
    assert {r.vec_id: r.deviation for r in found if r.vec_id in (1, 5, 6)} == {
        i: sum((5 * x[i][j] - sums[j]) ** 2 for j in (0, 1)) for i in (1, 5, 6)}


def test_centre_is_exact():
    rng = random.Random(3)
    x = np.array([[rng.randrange(-2**40, 2**40) for _ in range(5)] for _ in range(50)])
    centre = Centre(50, tuple(int(s) for s in x.sum(axis=0)))
    want = [[float(Fraction(int(v) * 50 - s, 50)) for v, s in zip(row, centre.sums)] for row in x]
    assert np.abs(centre.centred(x) - np.array(want)).max() <= 2.0 ** -12
    exact = [sum((50 * int(v) - s) ** 2 for v, s in zip(row, centre.sums)) for row in x]
    assert centre.deviations(x) == [v if v < 2**63 else None for v in exact]


# --- eigenvectors ------------------------------------------------------------------------------

def turned(values, seed=0):
    q, _ = np.linalg.qr(np.random.default_rng(seed).normal(size=(len(values), len(values))))
    a = (q * np.array(values, dtype=float)) @ q.T
    return (a + a.T) / 2


@pytest.mark.parametrize("values", [range(1, 41), [1] * 30, [1 + 1e-9 * i for i in range(30)], [i // 8 + 1e-12 * (i % 8) for i in range(40)],
                                    [0] * 10 + [1] * 10 + [1 + 1e-7] * 10, [10.0 ** -i for i in range(40)], [-3, -3, 0, 2, 2 + 1e-8], [5]])
def test_eigenvectors(values):
    a = turned(values)
    found, x = refined_eigenvectors(a)
    assert np.all(np.diff(found) <= 0)
    top = np.abs(found).max()
    assert np.abs(found - np.linalg.eigvalsh(a)[::-1]).max() <= 1e-13 * top
    assert np.abs(x.T @ x - np.eye(len(a))).max() < 2e-15
    assert np.abs(a @ x - x * found).max() <= 2e-15 * top


def test_float32_vectors_alone_are_not_enough():
    a = turned([1 + 1e-6 * i for i in range(20)])
    _, rough = np.linalg.eigh(a.astype(np.float32))
    rough = rough.astype(float)
    assert np.abs(rough.T @ rough - np.eye(20)).max() > 1e-8
    values, x = refined_eigenvectors(a)
    _, want = np.linalg.eigh(a)
    want = want[:, ::-1] * np.sign((want[:, ::-1] * x).sum(axis=0))
    assert np.abs(x - want).max() < 1e-8


def test_high_products():
    rng = np.random.default_rng(1)
    a, b = rng.normal(size=(30, 50)).astype(np.longdouble), rng.normal(size=(50, 20)).astype(np.longdouble)
    a = a + a.astype(np.float64) * np.longdouble(1e-18)
    exact = np.array([[float(sum(Fraction(*u.as_integer_ratio()) * Fraction(*v.as_integer_ratio()) for u, v in zip(row, column)) * 2**60) for column in b.T] for row in a])
    got = np.array([[float(Fraction(*v.as_integer_ratio()) * 2**60) for v in row] for row in product(a, b)])
    assert np.abs(got - exact).max() <= 2.0 ** 60 * 1e-15


def test_clusters():
    assert [sorted(g.tolist()) for g in clusters(np.array([1.0, 5.0, 1.1, 9.0, 5.05, 1.2]), 0.15)] == [[0, 2, 5], [1, 4]]
    assert clusters(np.array([1.0, 2.0]), 0.5) == []
    values, x = refined_eigenvectors(np.zeros((3, 3)))
    assert values.tolist() == [0, 0, 0] and (x == np.eye(3)).all()


def test_registered_columns(spark, small):
    df = queries.QUERIES["op12_embedding_whitening"](spark, small)
    assert [f"{n} {t}" for n, t in df.dtypes] == ["vec_id bigint", "component int", "n bigint", "deviation bigint", "whitened double", "explained double",
                                                 "identity_error double"]
    assert whitening.COMPONENTS == 16
