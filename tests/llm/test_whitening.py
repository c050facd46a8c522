"""Whitening against plain numpy on the same whole numbers."""

from fractions import Fraction

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from stridebase.llm import queries, whitening
from stridebase.llm.tables import table
from tests.conftest import SF_DIR

SCHEMA = "vec_id long, embedding array<float>"


def rows_of(df):
    return [tuple(r) for r in df.orderBy("vec_id", "component").collect()]


def plain(vectors):
    """Covariance, mean and whole numbers of a list of vectors, by definition."""
    x = np.floor(1024 * np.array(vectors, np.float32).astype(np.float64)).astype(np.int64) + 100_000
    centre = x - x.sum(axis=0) / len(x)
    return x, centre, centre.T @ centre / len(x)


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 200), st.integers(1, 5), st.integers(0, 60), st.integers(0, 2**32))
def test_planes_give_exact_products(n, d, bits, seed):
    x = np.random.default_rng(seed).integers(-(1 << bits), 1 << bits, (n, d))
    sums, products = whitening.cross_products(x)
    big = x.astype(object)
    assert list(sums) == list(big.sum(axis=0))
    assert (products == np.triu(big.T @ big)).all()


@given(st.integers(-(2**200), 2**200))
def test_limbs(value):
    parts = list(whitening._limbs(value))
    assert sum(v << (whitening.LIMB * at) for at, v in parts) == value
    assert all(abs(v) < 1 << whitening.LIMB for _, v in parts)


def test_whole_table_against_numpy(spark):
    df = table(spark, SF_DIR, "embeddings")
    kept = [r for r in df.select("vec_id", "embedding").collect() if r[1]]
    x, centre, v = plain([r[1] for r in kept])
    values, vectors = np.linalg.eigh(v)
    values, vectors = values[::-1][:8], vectors[:, ::-1][:, :8]
    want = centre @ vectors / np.sqrt(values)
    got = queries.op12_whitening(spark, SF_DIR).collect()
    assert len(got) == 8 * len(kept)
    at = {r[0]: i for i, r in enumerate(kept)}
    sums, n = x.sum(axis=0), len(x)
    for r in got:
        i, c = at[r["vec_id"]], r["component"] - 1
        assert abs(r["whitened"]) == pytest.approx(abs(want[i, c]), abs=1e-9)
        assert r["explained"] == pytest.approx(values[c] / np.trace(v), rel=1e-9)
        assert r["n"] == n and r["deviation"] == int(((n * x[i] - sums) ** 2).sum())
        assert r["identity_error"] < 1e-9
    signs = {(r["component"], np.sign(r["whitened"] * want[at[r["vec_id"]], r["component"] - 1])) for r in got if abs(r["whitened"]) > 1e-6}
    assert len(signs) == 8  # one sign per component


def test_odd_vectors_take_no_part(spark):
    good = [(1, [0.5, 1.0]), (2, [1.5, -1.0]), (None, [2.0, 0.0]), (2, [1.5, -1.0])]
    nan, inf = float("nan"), float("inf")
    bad = [(5, None), (6, []), (7, [nan, 1.0]), (8, [None, 1.0]), (9, [inf, 1.0]), (10, [1e30, 0.0])]
    alone = whitening.whiten(spark.createDataFrame(good, SCHEMA).repartition(3))
    mixed = whitening.whiten(spark.createDataFrame(bad + good, SCHEMA))
    assert len(rows_of(alone)) == 8
    for a, b in zip(rows_of(alone), rows_of(mixed)):
        assert a[:4] == b[:4] and a[4:] == pytest.approx(b[4:], abs=1e-9)
    assert {r["n"] for r in mixed.collect()} == {4}


def test_each_length_is_a_fit(spark):
    rows = [(i, [float(i), float(i * i)]) for i in range(5)] + [(9, [1.0]), (10, [3.0])]
    got = whitening.whiten(spark.createDataFrame(rows, SCHEMA)).collect()
    assert {r["vec_id"]: r["n"] for r in got} == {**dict.fromkeys(range(5), 5), 9: 2, 10: 2}
    assert sorted(abs(r["whitened"]) for r in got if r["n"] == 2) == pytest.approx([1, 1])


def test_without_variance(spark):
    for rows in ([(1, [1.0, 2.0])], [(1, [1.0, 2.0]), (2, [1.0, 2.0])]):
        got = whitening.whiten(spark.createDataFrame(rows, SCHEMA)).collect()
        assert {(r["whitened"], r["explained"], r["identity_error"], int(r["deviation"])) for r in got} == {(0.0, 0.0, 0.0, 0)}
    line = [(i, [float(i), 2.0 * i]) for i in range(7)]  # one direction varies
    got = whitening.whiten(spark.createDataFrame(line, SCHEMA)).collect()
    assert all(r["whitened"] == 0 for r in got if r["component"] == 2)
    assert all(r["identity_error"] < 1e-9 for r in got)


def test_empty_and_clashing_columns(spark):
    assert whitening.whiten(spark.createDataFrame([], SCHEMA)).collect() == []
    wide = spark.createDataFrame([(1, [1.0], 7, 8), (2, [2.0], 7, 8)], SCHEMA + ", n int, component int")
    assert whitening.whiten(wide).columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]


def test_large_entries_stay_exact(spark):
    rows = [(1, [2.0**50]), (2, [-(2.0**50)]), (3, [0.0])]
    got = {r["vec_id"]: r for r in whitening.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()}
    x = [1024 * 2**50, -1024 * 2**50, 0]
    for i, v in enumerate(x, 1):
        assert int(got[i]["deviation"]) == (3 * v) ** 2
        assert got[i]["whitened"] ** 2 == pytest.approx(float(Fraction(v * v, 2 * (1024 * 2**50) ** 2 // 3)), rel=1e-12)
