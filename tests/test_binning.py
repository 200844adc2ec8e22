import numpy as np
import pytest

from plumbline.operators.binning import exact_bins

RNG = np.random.default_rng(5)
N = 5000
COLUMNS = {
    "uniform": RNG.random(N),
    "few": RNG.integers(0, 9, N).astype(float),
    "fifty": RNG.integers(1, 51, N).astype(float),
    "heavy": np.concatenate([RNG.random(N - 1), [1e300]]),
    "powers": 2.0 ** RNG.integers(-500, 500, N),
    "near": np.where(RNG.random(N) < 0.5, 1.0, np.where(RNG.random(N) < 0.5, 1.0 + 1e-12, 1e6)),
    "skewed": np.where(RNG.random(N) < 0.7, 0.0, RNG.normal(size=N)),
    "constant": np.full(N, 3.0),
    "binary": RNG.integers(0, 2, N).astype(float),
    "signed": np.concatenate([[-1.7e308, 1.7e308], RNG.normal(size=N - 2)]),
}


def by_sorting(v, max_bins):
    distinct = np.unique(v)
    if len(distinct) == 1:
        return [distinct[0]]
    if len(distinct) <= max_bins:
        return list(distinct[1:])
    s = np.sort(v)
    cuts = {s[len(s) * j // max_bins] for j in range(1, max_bins)} - {s[0]}
    return sorted(cuts) or [s[-1]]


@pytest.fixture(scope="module")
def table(spark):
    import pandas as pd

    df = spark.createDataFrame(pd.DataFrame(COLUMNS)).repartition(6).cache()
    yield df
    df.unpersist()


@pytest.mark.parametrize("max_bins", [32, 5])
def test_edges_are_order_statistics(table, max_bins):
    bins = exact_bins(table, list(COLUMNS), max_bins)
    for name, edges in zip(bins.features, bins.edges):
        assert edges == by_sorting(COLUMNS[name], max_bins), name


def test_bins_count_the_edges_reached(table):
    bins = exact_bins(table, ["uniform", "few"])
    rows = bins.apply(table.select("uniform", "few")).collect()
    for r in rows[:500]:
        for i, f in enumerate(("uniform", "few")):
            assert r["bins"][i] == sum(e <= r[f] for e in bins.edges[i])


@pytest.mark.parametrize("bad", [None, float("nan"), float("inf")])
def test_unusable_values_are_refused(spark, bad):
    df = spark.createDataFrame([(1.0,), (bad,), (2.0,)], "a double")
    with pytest.raises(ValueError, match="missing or infinite"):
        exact_bins(df, ["a"])


def test_no_rows(spark):
    with pytest.raises(ValueError, match="no rows"):
        exact_bins(spark.createDataFrame([], "a double"), ["a"])
