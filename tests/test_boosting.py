import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from plumbline.operators import boosting
from plumbline.operators.boosting import BoostFit, BoostSpec, fit_boosted
from plumbline.operators.trees import cells

RNG = np.random.default_rng(2)
N = 400
DATA = pd.DataFrame({"k": np.arange(N), "a": RNG.integers(0, 8, N) * 1.0, "b": RNG.integers(0, 5, N) * 1.0, "c": RNG.integers(0, 3, N) * 1.0})
DATA["y"] = (((DATA.a > 3) ^ (DATA.b > 2)) ^ (RNG.random(N) < 0.1)).astype(int)
DATA["fold"] = np.where(np.arange(N) % 6 == 5, -1, np.arange(N) % 6)
NAMES = ["a", "b", "c"]


@pytest.fixture(scope="module")
def table(spark):
    return spark.createDataFrame(DATA).repartition(4, "k").cache()


@pytest.fixture(scope="module")
def weighted_cells(table):
    return cells(table, NAMES, "y", F.col("fold")).cache()


def edges():
    """Coarse slices; any will do."""
    return [[2.0, 5.0], [], [1.0]]


def fitted(rows, specs, score_at=(), features=NAMES, slices=edges, **way):
    return fit_boosted(rows, features, specs, slices, score_at, **way)


def mixed(w, y):
    t, one = w.sum(), w[y == 1].sum()
    return t - (one**2 + (t - one) ** 2) / t if t else 0.0


def grow(x, y, w, depth):
    """One greedy weighted tree, row by row; returns a function from rows to votes."""
    vote = int(w[y == 1].sum() - w[y == 0].sum() > 1e-12 * w.sum())
    if depth == 0 or len(set(y)) < 2:
        return lambda z: np.full(len(z), vote)
    best = None
    for f in range(x.shape[1]):
        seen = sorted(set(x[:, f].tolist()))
        for b, following in zip(seen, seen[1:]):
            left = x[:, f] <= b
            score = round((mixed(w[left], y[left]) + mixed(w[~left], y[~left])) / w.sum(), 9)
            if best is None or score < best[0]:
                best = (score, f, (b + following) / 2)
    if best is None:
        return lambda z: np.full(len(z), vote)
    _, f, b = best
    left = x[:, f] <= b
    low, high = grow(x[left], y[left], w[left], depth - 1), grow(x[~left], y[~left], w[~left], depth - 1)
    return lambda z: np.where(z[:, f] <= b, low(z), high(z))


def samme(x, y, rounds, rate, depth):
    w, trees, alphas, errors = np.full(len(x), 1 / len(x)), [], [], []
    for _ in range(rounds):
        tree = grow(x, y, w, depth)
        wrong = tree(x) != y
        error = w[wrong].sum() / w.sum()
        if error >= 0.5:
            break
        alpha = 1.0 if error <= 0 else rate * math.log((1 - error) / error)
        trees.append(tree)
        alphas.append(alpha)
        errors.append(error)
        if error <= 0:
            break
        w = w * np.exp(alpha * wrong)
        w /= w.sum()
    return lambda z: (sum(a * (2 * t(z) - 1) for a, t in zip(alphas, trees)) > 1e-9).astype(int), alphas, errors


def arrays(rows):
    return rows[NAMES].to_numpy(), rows["y"].to_numpy()


def answers(fit, table):
    return {r["k"]: int(r["prediction"]) for r in fit.predict(table).select("k", "prediction").collect()}


@pytest.mark.parametrize("way", [{}, {"local_bytes": 0}])
@pytest.mark.parametrize("depth,rounds,rate", [(1, 8, 1.0), (2, 5, 0.5), (3, 4, 1.0)])
def test_step_by_step(table, weighted_cells, depth, rounds, rate, way):
    specs = [BoostSpec(rounds, rate, depth, k) for k in (None, 0, 3)]
    fits, counts = fitted(weighted_cells, specs, [2, rounds], **way)
    for j, (spec, fit) in enumerate(zip(specs, fits)):
        rows = DATA[(DATA.fold >= 0) & (DATA.fold != (-9 if spec.without_fold is None else spec.without_fold))]
        predict, alphas, errors = samme(*arrays(rows), rounds, rate, depth)
        np.testing.assert_allclose(fit.errors, errors, rtol=1e-7)
        np.testing.assert_allclose(fit.alphas, alphas, rtol=1e-7)
        x, y = arrays(DATA)
        assert answers(fit, table) == dict(zip(DATA.k, predict(x)))
        held = DATA[DATA.fold == (-1 if spec.without_fold is None else spec.without_fold)]
        for size in (2, rounds):
            predict, _, _ = samme(*arrays(rows), size, rate, depth)
            votes = predict(held[NAMES].to_numpy())
            mine = counts[(counts.fit == j) & (counts.n_trees == size)]
            for r in mine.itertuples():
                assert r.n == ((held.y == r.label) & (votes == r.prediction)).sum()


def test_half_of_the_new_weight_is_wrong(weighted_cells):
    """With learning rate 1 the last learner errs on exactly half of the next round's weight."""
    fit = fitted(weighted_cells, [BoostSpec(4)])[0][0]
    rows = DATA[DATA.fold >= 0]
    x, y = arrays(rows)
    w = np.ones(len(x))
    for tree, alpha in zip(fit.trees, fit.alphas):
        wrong = tree.predict(x) != y
        w = w * np.exp(alpha * wrong)
        assert w[wrong].sum() / w.sum() == pytest.approx(0.5)


def test_prefix_is_the_shorter_fit(table, weighted_cells):
    long, short = fitted(weighted_cells, [BoostSpec(7), BoostSpec(3)])[0]
    assert long.prefix(3).alphas == pytest.approx(short.alphas)
    assert answers(long.prefix(3), table) == answers(short, table)


def test_chunks_and_checkpoints_change_nothing(weighted_cells, monkeypatch):
    specs = [BoostSpec(5, 1.0, d, k) for d in (1, 2) for k in (None, 1)]
    want = fitted(weighted_cells, specs)
    monkeypatch.setattr(boosting, "FITS_PER_PASS", 3)
    monkeypatch.setattr(boosting, "PASSES_PER_CHECKPOINT", 1)
    got = fitted(weighted_cells, specs, local_bytes=0)
    for f, g in zip(want[0], got[0]):
        assert f.alphas == pytest.approx(g.alphas)
        assert f.importances() == pytest.approx(g.importances())
    key = ["fit", "n_trees", "label", "prediction"]
    assert want[1].sort_values(key)[key + ["n"]].values.tolist() == got[1].sort_values(key)[key + ["n"]].values.tolist()


def test_layout_changes_nothing(table):
    fits = [fitted(cells(table.repartition(p), NAMES, "y", F.lit(0)), [BoostSpec(4)])[0][0] for p in (1, 9)]
    assert fits[0].alphas == pytest.approx(fits[1].alphas)
    assert answers(fits[0], table) == answers(fits[1], table)


@pytest.mark.parametrize("way", [{}, {"local_bytes": 0}])
def test_perfect_first_learner_ends_the_fit(spark, way):
    df = spark.createDataFrame([(float(i % 10), int(i % 10 > 4)) for i in range(100)], "a double, y int")
    fit = fitted(cells(df, ["a"], "y", F.lit(0)), [BoostSpec(20)], features=["a"], slices=lambda: [[]], **way)[0][0]
    assert (fit.alphas, fit.errors) == ([1.0], [0.0])
    assert all(r["prediction"] == r["y"] for r in fit.predict(df).collect())


@pytest.mark.parametrize("way", [{}, {"local_bytes": 0}])
def test_coin_flips_cannot_start(spark, way):
    """Such a fit has no learners and no scores; the others go on."""
    rows = [(float(a), y, 0) for a in range(4) for y in (0, 1) for _ in range(5)] + [(9.0, 1, 1)] * 3
    df = spark.createDataFrame(rows, "a double, y int, fold int")
    specs = [BoostSpec(3, without_fold=1), BoostSpec(3, without_fold=0)]
    fits, counts = fitted(cells(df, ["a"], "y", F.col("fold")), specs, features=["a"], slices=lambda: [[]], **way)
    assert not fits[0].trees and set(counts["fit"]) <= {1}
    with pytest.raises(ValueError, match="first learner"):
        fits[0].predict(df)


def test_deep_boosted_trees_are_refused(weighted_cells):
    with pytest.raises(ValueError, match="depth"):
        fitted(weighted_cells, [BoostSpec(3, base_max_depth=25)])


def test_copies_count(spark):
    """A third of all rows in one cell weighs as much as those rows one by one."""
    rows = DATA[["a", "b", "c", "y"]].values.tolist() + [[1.0, 1.0, 1.0, 1.0]] * 200
    pdf = pd.DataFrame(rows, columns=["a", "b", "c", "y"])
    df = spark.createDataFrame(pdf)
    fit = fitted(cells(df, NAMES, "y", F.lit(0)), [BoostSpec(5)])[0][0]
    _, alphas, _ = samme(pdf[NAMES].to_numpy(), pdf["y"].to_numpy().astype(int), 5, 1.0, 1)
    np.testing.assert_allclose(fit.alphas, alphas, rtol=1e-7)


def test_importances(weighted_cells):
    fit = fitted(weighted_cells, [BoostSpec(6, 1.0, 2)])[0][0]
    assert sum(fit.importances().values()) == pytest.approx(1)


def test_save_and_load(spark, table, weighted_cells, tmp_path):
    fit = fitted(weighted_cells, [BoostSpec(4, 0.5, 3)])[0][0]
    fit.save(str(tmp_path))
    again = BoostFit.load(spark, str(tmp_path))
    assert answers(again, table) == answers(fit, table)
    assert again.importances() == pytest.approx(fit.importances())


def test_missing_feature_stops_scoring(spark, weighted_cells):
    fit = fitted(weighted_cells, [BoostSpec(2)])[0][0]
    df = spark.createDataFrame([(0.5, None, 1.0)], "a double, b double, c double")
    with pytest.raises(Exception, match="missing value"):
        fit.predict(df).collect()


@pytest.mark.parametrize("depth", [1, 3])
def test_both_ways_agree_on_continuous_values(spark, depth):
    rng = np.random.default_rng(9)
    pdf = pd.DataFrame({"a": rng.normal(size=3000), "b": rng.random(3000) * 1e6, "c": rng.integers(0, 4, 3000) * 1.0})
    pdf["y"] = ((pdf.a + pdf.b / 1e6 > 0.6) ^ (rng.random(3000) < 0.1)).astype(int)
    df = spark.createDataFrame(pdf)
    rows = cells(df, NAMES, "y", F.lit(0)).cache()
    near, far = (fitted(rows, [BoostSpec(4, 1.0, depth)], slices=lambda: [[0.0], [5e5], []], **way)[0][0] for way in ({}, {"local_bytes": 0}))
    assert [t.cut.tolist() for t in near.trees] == [t.cut.tolist() for t in far.trees]
    np.testing.assert_allclose(near.alphas, far.alphas, rtol=1e-9)
    if depth == 1:
        _, alphas, _ = samme(pdf[NAMES].to_numpy(), pdf["y"].to_numpy(), 2, 1.0, 1)
        np.testing.assert_allclose(near.alphas[:2], alphas, rtol=1e-9)


def samme_r(x, y, rounds, rate, depth):
    """The real-valued algorithm row by row: shares of the classes in each leaf, no weights of learners."""
    w, odds_of, errors = np.full(len(x), 1 / len(x)), [], []
    for _ in range(rounds):
        tree = grow_shares(x, y, w, depth)
        share = tree(x)
        errors.append(w[(share > 0.5) != y].sum() / w.sum())
        odds_of.append(lambda z, tree=tree: log_odds(tree(z)))
        if errors[-1] <= 0:
            break
        w = w * np.exp(-0.5 * rate * (2 * y - 1) * log_odds(share))
        w /= w.sum()
    return lambda z: (sum(o(z) for o in odds_of) > 1e-9).astype(int), errors


def log_odds(share):
    eps = np.finfo(float).eps
    return np.log(np.maximum(share, eps)) - np.log(np.maximum(1 - share, eps))


def grow_shares(x, y, w, depth):
    share = w[y == 1].sum() / w.sum()
    if depth == 0 or len(set(y)) < 2:
        return lambda z: np.full(len(z), share)
    best = None
    for f in range(x.shape[1]):
        seen = sorted(set(x[:, f].tolist()))
        for b, following in zip(seen, seen[1:]):
            left = x[:, f] <= b
            score = round((mixed(w[left], y[left]) + mixed(w[~left], y[~left])) / w.sum(), 9)
            if best is None or score < best[0]:
                best = (score, f, (b + following) / 2)
    if best is None:
        return lambda z: np.full(len(z), share)
    _, f, cut = best
    left = x[:, f] <= cut
    low, high = grow_shares(x[left], y[left], w[left], depth - 1), grow_shares(x[~left], y[~left], w[~left], depth - 1)
    return lambda z: np.where(z[:, f] <= cut, low(z), high(z))


@pytest.mark.parametrize("way", [{}, {"local_bytes": 0}])
@pytest.mark.parametrize("depth,rounds,rate", [(1, 6, 1.0), (2, 4, 0.3)])
def test_real_valued_step_by_step(table, weighted_cells, depth, rounds, rate, way):
    specs = [BoostSpec(rounds, rate, depth, k, "SAMME.R") for k in (None, 3)]
    fits, counts = fitted(weighted_cells, specs, [2, rounds], **way)
    for j, (spec, fit) in enumerate(zip(specs, fits)):
        rows = DATA[(DATA.fold >= 0) & (DATA.fold != (-9 if spec.without_fold is None else spec.without_fold))]
        predict, errors = samme_r(*arrays(rows), rounds, rate, depth)
        np.testing.assert_allclose(fit.errors, errors, rtol=1e-7)
        assert fit.alphas == [1.0] * rounds
        assert answers(fit, table) == dict(zip(DATA.k, predict(arrays(DATA)[0])))
        held = DATA[DATA.fold == (-1 if spec.without_fold is None else spec.without_fold)]
        for size in (2, rounds):
            votes = samme_r(*arrays(rows), size, rate, depth)[0](held[NAMES].to_numpy())
            for r in counts[(counts.fit == j) & (counts.n_trees == size)].itertuples():
                assert r.n == ((held.y == r.label) & (votes == r.prediction)).sum()


def test_real_valued_fits_are_saved(spark, table, weighted_cells, tmp_path):
    fit = fitted(weighted_cells, [BoostSpec(3, 0.5, 2, None, "SAMME.R")])[0][0]
    fit.save(str(tmp_path))
    again = BoostFit.load(spark, str(tmp_path))
    assert again.spec.algorithm == "SAMME.R" and answers(again, table) == answers(fit, table)
    assert answers(again.prefix(2), table) == answers(fit.prefix(2), table)
    with pytest.raises(ValueError, match="algorithm"):
        BoostSpec(algorithm="SAMME.X")


@pytest.mark.parametrize("algorithm", ["SAMME", "SAMME.R"])
def test_stumps_are_looked_up_and_not_written(weighted_cells, monkeypatch, algorithm):
    """On a large table stumps' log weights are told by the slices, so no state is written round after round."""

    def written(*_):
        raise AssertionError("log weights of stumps were written")

    monkeypatch.setattr(boosting, "scratch_path", written)
    specs = [BoostSpec(9, 0.5, 1, k, algorithm) for k in (None, 0, 3)]
    near, counted = fitted(weighted_cells, specs)
    far, again = fitted(weighted_cells, specs, local_bytes=0)
    for f, g in zip(near, far):
        assert [(int(t.feature[0]), float(t.cut[0])) for t in f.trees] == [(int(t.feature[0]), float(t.cut[0])) for t in g.trees]
        assert f.alphas == pytest.approx(g.alphas) and f.errors == pytest.approx(g.errors)
    order = ["fit", "n_trees", "label", "prediction", "n"]
    assert sorted(counted[order].itertuples(index=False)) == sorted(again[order].itertuples(index=False))
