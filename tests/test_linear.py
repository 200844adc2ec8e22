import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from plumbline.operators import linear
from plumbline.operators.linear import LinearFit, LinearSpec, fit_linear, score_linear

RNG = np.random.default_rng(3)
N = 1200
X = np.column_stack([RNG.normal(size=N), RNG.normal(size=N) * 1000, RNG.integers(0, 5, N)])
Y = (X[:, 0] + X[:, 1] / 800 - X[:, 2] / 3 + RNG.normal(size=N) > -0.5).astype(int)
FOLD = np.arange(N) % 5
NAMES = ["a", "b", "c"]


@pytest.fixture(scope="module")
def table(spark):
    data = pd.DataFrame(X, columns=NAMES).assign(y=Y, fold=FOLD)
    return spark.createDataFrame(data).repartition(5).cache()


def solve(x, y, C):
    """Plain Newton on the library objective."""
    A = np.column_stack([np.ones(len(x)), x])
    w, ridge = np.zeros(A.shape[1]), np.diag([0.0] + [1.0] * x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-A @ w))
        w -= np.linalg.solve(C * (A.T * (p * (1 - p))) @ A + ridge, C * A.T @ (p - y) + ridge @ w)
    return w


@pytest.mark.parametrize("C", [0.01, 1.0, 100.0])
def test_optimum(table, C):
    fit = fit_linear(table, NAMES, "y", F.col("fold"), [LinearSpec(C)])[0]
    np.testing.assert_allclose([fit.intercept, *fit.coefficients], solve(X, Y, C), rtol=1e-8)
    assert fit.converged


def test_many_fits_share_passes(table, monkeypatch):
    specs = [LinearSpec(C, 100, k) for C in (0.1, 10.0) for k in (None, 0, 3)]
    together = fit_linear(table, NAMES, "y", F.col("fold"), specs)
    monkeypatch.setattr(linear, "SUMS_PER_PASS", 50)
    apart = fit_linear(table, NAMES, "y", F.col("fold"), specs)
    for s, f, g in zip(specs, together, apart):
        rows = slice(None) if s.without_fold is None else FOLD != s.without_fold
        np.testing.assert_allclose([f.intercept, *f.coefficients], solve(X[rows], Y[rows], s.C), rtol=1e-8)
        np.testing.assert_allclose(f.coefficients, g.coefficients, rtol=1e-9)


@pytest.mark.parametrize("C", [0.01, 1.0, 100.0])
def test_gradient_steps_reach_the_same_optimum(table, monkeypatch, C):
    monkeypatch.setattr(linear, "SUMS_PER_PASS", 14)
    specs = [LinearSpec(C, 200, k) for k in (None, 2)]
    for s, fit in zip(specs, fit_linear(table, NAMES, "y", F.col("fold"), specs)):
        rows = slice(None) if s.without_fold is None else FOLD != s.without_fold
        np.testing.assert_allclose([fit.intercept, *fit.coefficients], solve(X[rows], Y[rows], C), rtol=1e-4)
        assert fit.converged


def test_thousands_of_features(spark):
    """Trained and scored end to end."""
    n, names = 300, [f"f{i}" for i in range(3000)]
    x = np.random.default_rng(1).normal(size=(n, len(names)))
    y = (x[:, :5].sum(axis=1) > 0).astype(int)
    wide = spark.createDataFrame([(v.tolist(), int(t)) for v, t in zip(x, y)], "x array<double>, y int")
    df = wide.select("y", *[F.col("x")[i].alias(c) for i, c in enumerate(names)])
    fit = fit_linear(df, names, "y", F.lit(0), [LinearSpec(1.0, 100)])[0]
    w = np.array([fit.intercept, *fit.coefficients])
    a = np.column_stack([np.ones(n), x])
    p = 1 / (1 + np.exp(-a @ w))
    gradient = a.T @ (p - y) + np.array([0.0, *fit.coefficients])
    assert fit.converged and np.abs(gradient).max() < 1e-3
    scored = fit.predict(df).select("y", "prediction").collect()
    assert sum(r["prediction"] == r["y"] for r in scored) > 0.99 * n


def test_separable_rows_converge(spark):
    df = spark.createDataFrame([(float(i), int(i > 50)) for i in range(100)], "a double, y int")
    fit = fit_linear(df, ["a"], "y", F.lit(0), [LinearSpec(1e6, 500)])[0]
    assert fit.converged
    assert all(r["prediction"] == r["y"] for r in fit.predict(df).collect())


def test_iteration_limit(table):
    fit = fit_linear(table, NAMES, "y", F.col("fold"), [LinearSpec(1.0, 1)])[0]
    assert not fit.converged and fit.iterations == 1


def test_scores_are_counts_on_the_left_out_fold(table):
    specs = [LinearSpec(1.0, 100, k) for k in range(5)]
    fits = fit_linear(table, NAMES, "y", F.col("fold"), specs)
    counts = score_linear(table, NAMES, "y", F.col("fold"), specs, fits)
    for k, f in enumerate(fits):
        mine = f.predict(table.where(F.col("fold") == k)).groupBy("y", "prediction").count().collect()
        got = {(r.label, r.prediction): r.n for r in counts[counts.fit == k].itertuples() if r.n}
        assert got == {(r["y"], int(r["prediction"])): r["count"] for r in mine}


def test_save_and_load(spark, table, tmp_path):
    fit = fit_linear(table, NAMES, "y", F.col("fold"), [LinearSpec()])[0]
    fit.save(str(tmp_path))
    again = LinearFit.load(spark, str(tmp_path))
    assert (again.features, again.coefficients, again.intercept) == (fit.features, fit.coefficients, fit.intercept)


def test_missing_feature_stops_the_job(spark, table):
    fit = LinearFit(["a"], [1.0], 0.0)
    for bad in (None, float("nan")):
        df = spark.createDataFrame([(bad, 1)], "a double, y int")
        with pytest.raises(Exception, match="missing value"):
            fit.predict(df).collect()
        with pytest.raises(Exception, match="missing value"):
            fit_linear(df, ["a"], "y", F.lit(0), [LinearSpec()])
