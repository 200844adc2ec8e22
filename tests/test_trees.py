import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from plumbline.functions.metrics import evaluate
from plumbline.operators import cuts, growth, trees
from plumbline.operators.growth import Coded, GrowSpec, TreeNodes, draws, feature_ranks, grow, grow_variants, middle
from plumbline.operators.trees import Grower, Pruning, TreeFit, cells, forest_spec, tree_spec, values

RNG = np.random.default_rng(11)
N = 1500
DATA = pd.DataFrame({"k": np.arange(N), "a": RNG.integers(0, 40, N) / 40, "b": RNG.integers(0, 6, N).astype(float), "c": RNG.integers(0, 9, N) * 1.0})
DATA["y"] = (((DATA.a > 0.4) & (DATA.b != 2)) ^ (RNG.random(N) < 0.15)).astype(int)
DATA["fold"] = np.where(np.arange(N) % 6 == 5, -1, np.arange(N) % 6)
NAMES = ["a", "b", "c"]
X, Y = DATA[NAMES].to_numpy(), DATA.y.to_numpy()
EDGES = [[0.2, 0.4, 0.9], [3.0], []]  # coarse slices; any will do
TRAINED = DATA.fold.to_numpy() >= 0


@pytest.fixture(scope="module")
def table(spark):
    return spark.createDataFrame(DATA).repartition(5, "k").cache()


def keyed(table):
    return table.select(values(NAMES).alias("x"), F.col("y").alias("label"), "fold", F.lit(1).cast("bigint").alias("n"), F.col("k").cast("string").alias("key"))


def grower(rows, **options):
    return Grower(rows, 3, lambda: EDGES, **options)


@pytest.fixture(scope="module")
def growers(table):
    """The same rows in both ways: on the executors whole, and left distributed with small tasks."""
    counted = cells(table, NAMES, "y", F.col("fold")).withColumn("key", F.lit(""))
    made = {
        ("dt", "local"): grower(counted),
        ("dt", "large"): grower(counted, local_bytes=0, local_rows=100),
        ("rf", "local"): grower(keyed(table)),
        ("rf", "large"): grower(keyed(table), local_bytes=0, local_rows=200),
    }
    yield made
    for g in made.values():
        g.release()


def weight_of(impurity, criterion):
    zero, one = impurity
    t = zero + one
    if not t:
        return 0.0
    if criterion == "gini":
        return t - (zero * zero + one * one) / t
    return -sum(w * math.log2(w / t) for w in (zero, one) if w)


def tree_by_hand(x, y, w, spec, tree=0, path=""):
    """One greedy tree, row by row; a dict of nodes by path."""
    zero, one = w[y == 0].sum(), w[y == 1].sum()
    nodes = {path: (None, None, zero, one, len(y))}
    limit = max(spec.min_samples_split, 2 * spec.min_samples_leaf)
    if min(zero, one) == 0 or len(y) < limit or (spec.max_depth is not None and len(path) >= spec.max_depth):
        return nodes
    look = list(range(x.shape[1]))
    if spec.max_features is not None:
        rank = feature_ranks(spec.seed, tree, [path], x.shape[1], spec.max_features)[0]
        look = [f for f in look if rank[f] < 0]
        several = [f for f in range(x.shape[1]) if len(set(x[:, f])) > 1]
        if not set(look) & set(several):
            look = sorted(several, key=lambda f: rank[f])[:1]
    best = None
    for f in sorted(look):
        seen = sorted(set(x[:, f].tolist()))
        for b, following in zip(seen, seen[1:]):
            left = x[:, f] <= b
            if min(left.sum(), (~left).sum()) < spec.min_samples_leaf:
                continue
            sides = [(w[s & (y == 0)].sum(), w[s & (y == 1)].sum()) for s in (left, ~left)]
            score = round(sum(weight_of(s, spec.criterion) for s in sides) / (zero + one), 9)
            if best is None or score < best[0]:
                best = (score, f, b / 2 + following / 2)
    if best is None:
        return nodes
    _, f, cut = best
    nodes[path] = (f, cut, zero, one, len(y))
    left = x[:, f] <= cut
    nodes |= tree_by_hand(x[left], y[left], w[left], spec, tree, path + "L")
    return nodes | tree_by_hand(x[~left], y[~left], w[~left], spec, tree, path + "R")


def by_path(t: TreeNodes):
    out, stack = {}, [(0, "")]
    while stack:
        i, path = stack.pop()
        inner = t.feature[i] >= 0
        out[path] = (int(t.feature[i]) if inner else None, float(t.cut[i]) if inner else None, t.w0[i], t.w1[i], int(t.n[i]))
        if inner:
            stack += [(int(t.left[i]), path + "L"), (int(t.right[i]), path + "R")]
    return out


SPECS = [
    tree_spec(),
    tree_spec(max_depth=3),
    tree_spec(criterion="entropy", min_samples_leaf=7),
    tree_spec(min_samples_split=90, min_samples_leaf=4),
    GrowSpec(min_samples_leaf=2, without_fold=2),
]


@pytest.mark.parametrize("way", ["local", "large"])
def test_trees_by_hand(growers, way):
    for spec, grown in zip(SPECS, growers["dt", way].fits(SPECS)):
        mine = TRAINED & (DATA.fold.to_numpy() != (-9 if spec.without_fold is None else spec.without_fold))
        assert by_path(grown[0]) == tree_by_hand(X[mine], Y[mine], np.ones(mine.sum()), spec)


@pytest.mark.parametrize("way", ["local", "large"])
def test_forests_by_hand(growers, way):
    spec = forest_spec(3, 11, max_depth=6, min_samples_leaf=2, seed=5)
    assert spec.max_features == 1 and spec.bootstrap
    grown = growers["rf", way].fits([spec])[0]
    drawn = draws(5, range(11), [str(k) for k in DATA.k])
    for t, tree in enumerate(grown):
        some = TRAINED & (drawn[:, t] > 0)
        assert by_path(tree) == tree_by_hand(X[some], Y[some], drawn[some, t].astype(float), spec, t)


@pytest.mark.parametrize("criterion, looked_at, path", [("gini", 1, ""), ("gini", 2, "LR"), ("entropy", None, "")])
def test_trees_of_several_leaf_limits_grow_as_one(monkeypatch, criterion, looked_at, path):
    """They are the trees by hand, and what they have in common is cut once."""
    cut, rows = growth.best_cuts, []
    monkeypatch.setattr(growth, "best_cuts", lambda level, *rest: rows.append(len(level.weight)) or cut(level, *rest))
    rng = np.random.default_rng(5)
    w, leaves = rng.integers(1, 4, N).astype(float), [1, 2, 4]
    spec = GrowSpec(criterion, 14, 5, max_features=looked_at, seed=3)
    together = grow_variants(Coded.of(X), Y, w, np.ones(N, int), spec, leaves, 2, path)
    shared = sum(rows)
    for leaf, tree in zip(leaves, together):
        own = trees.replace(spec, min_samples_leaf=leaf)
        want = tree_by_hand(X, Y, w, own, 2, path)
        assert {path + p: v for p, v in by_path(tree).items()} == {p: (f, c, a, b, n) for p, (f, c, a, b, n) in want.items()}
        assert by_path(grow(Coded.of(X), Y, w, np.ones(N, int), own, 2, path)) == by_path(tree)
    assert shared < 0.8 * (sum(rows) - shared)


def test_rows_of_any_order_grow_the_same_tree():
    """Also rows that count more than once and weights that are not whole."""
    rng = np.random.default_rng(6)
    w, n, order = rng.random(N) + 0.1, rng.integers(1, 5, N), rng.permutation(N)
    spec = GrowSpec(max_depth=5, min_samples_leaf=3)
    one, other = grow(Coded.of(X), Y, w, n, spec), grow(Coded.of(X[order]), Y[order], w[order], n[order], spec)
    for field in ("feature", "cut", "left", "right", "n", "depth"):
        assert (getattr(one, field) == getattr(other, field)).all()
    assert np.allclose(one.w1, other.w1) and np.allclose(one.gain, other.gain)


def test_draws_are_poisson_and_belong_to_the_row():
    keys = [str(i) for i in range(4000)]
    drawn = draws(1, range(16), keys)
    assert abs(drawn.mean() - 1) < 0.02 and abs((drawn == 0).mean() - math.exp(-1)) < 0.02
    assert (draws(1, range(9, 13), keys[::-1])[::-1] == drawn[:, 9:13]).all()


def shares_by_hand(nodes, row, pruning):
    path = ""
    while True:
        f, b, zero, one, n = nodes[path]
        if f is None or n < pruning.min_samples_split or (pruning.max_depth is not None and len(path) >= pruning.max_depth):
            return one / (zero + one)
        path += "R" if row[f] > b else "L"


@pytest.mark.parametrize("way", ["local", "large"])
@pytest.mark.parametrize("kind", ["dt", "rf"])
def test_scores_of_prunings_and_sizes(growers, kind, way):
    prunings, sizes = [Pruning(), Pruning(3), Pruning(None, 60)], [1] if kind == "dt" else [2, 9]
    base = tree_spec() if kind == "dt" else forest_spec(3, 9, seed=2)
    specs = [base, GrowSpec(**{**base.__dict__, "without_fold": 1})]
    g = growers[kind, way]
    counts = g.scores(specs, [prunings] * 2, [sizes] * 2)
    for j, (spec, grown) in enumerate(zip(specs, g.fits(specs))):
        out = DATA.fold.to_numpy() == (-1 if spec.without_fold is None else 1)
        nodes = [by_path(t) for t in grown]
        for v, pruning in enumerate(prunings):
            for size in sizes:
                votes = [sum(shares_by_hand(t, row, pruning) for t in nodes[:size]) > size / 2 + 1e-9 for row in X[out]]
                part = counts[(counts.fit == j) & (counts.variant == v) & (counts.n_trees == size)]
                got = {(r.label, r.prediction): r.n for r in part.itertuples() if r.n}
                assert got == {(a, b): n for a in (0, 1) for b in (0, 1) if (n := sum((y, int(p)) == (a, b) for y, p in zip(Y[out], votes)))}


@pytest.fixture(scope="module")
def deep(growers):
    return TreeFit(NAMES, growers["dt", "local"].fits([tree_spec()])[0])


@pytest.fixture(scope="module")
def forest(growers):
    return TreeFit(NAMES, growers["rf", "local"].fits([forest_spec(3, 6, max_depth=7)])[0])


def answers(fit, table):
    return {r["k"]: r["prediction"] for r in fit.predict(table).select("k", "prediction").collect()}


@pytest.mark.parametrize("pruning", [Pruning(), Pruning(2), Pruning(None, 150)])
def test_predictions(table, deep, forest, pruning, monkeypatch):
    for fit in (deep, forest):
        nodes = [by_path(t) for t in fit.trees]
        want = {k: float(sum(shares_by_hand(t, row, pruning) for t in nodes) > len(nodes) / 2 + 1e-9) for k, row in zip(DATA.k, X)}
        assert answers(fit.with_pruning(pruning), table) == want
        with monkeypatch.context() as m:
            m.setattr(trees, "MODEL_BYTES", 1)  # a broadcast for each tree
            assert answers(fit.with_pruning(pruning), table) == want


@pytest.mark.parametrize("depth", [1, 4])
def test_a_smaller_depth_is_a_pruning(table, growers, deep, depth):
    small = TreeFit(NAMES, growers["dt", "local"].fits([tree_spec(max_depth=depth)])[0])
    assert answers(deep.with_pruning(Pruning(depth)), table) == answers(small, table)
    assert deep.with_pruning(Pruning(depth)).importances() == pytest.approx(small.importances())


def test_scoring_is_a_projection(table):
    """No exchange and no join, however many leaves there are."""
    many = 100_000
    left = np.concatenate([np.arange(1, 2 * many, 2), np.full(many + 1, -1)])
    n = len(left)
    wide = TreeNodes(np.where(left > 0, 0, -1), np.zeros(n, int), left, np.where(left > 0, left + 1, -1), np.ones(n), np.ones(n), np.ones(n, int), np.zeros(n, int), np.zeros(n))
    scored = TreeFit(NAMES, [wide], Pruning(None, 500)).predict(table.select(*NAMES, "k"))
    plan = scored._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan and "Repartition" not in plan and "Aggregate" not in plan


def test_importances(deep, forest):
    for fit in (deep, forest):
        want = np.zeros(3)
        for t in fit.trees:
            own = np.zeros(3)
            nodes = by_path(t)
            for path, (f, _, zero, one, _) in nodes.items():
                if f is not None:
                    own[f] += weight_of((zero, one), "gini") - sum(weight_of(nodes[path + s][2:4], "gini") for s in "LR")
            want += own / own.sum()
        np.testing.assert_allclose(list(fit.importances().values()), want / want.sum(), rtol=1e-9)


def test_layout_changes_nothing(table):
    grown = []
    for parts in (1, 7):
        g = grower(keyed(table.repartition(parts)))
        grown.append([by_path(t) for t in g.fits([forest_spec(3, 3)])[0]])
        g.release()
    assert grown[0] == grown[1]


@pytest.mark.parametrize("way", [{}, {"local_bytes": 0, "local_rows": 15}])
def test_deep_trees_heavy_weights_and_rare_values(spark, way):
    """Far more than 2^24 rows' worth of weight, a tree deeper than 30, and a rare value that decides."""
    rows = [(float(i), 0.0, i % 2, 2**i) for i in range(40)] + [(0.0, 1.0, 1, 3)]
    df = spark.createDataFrame(rows, "a double, rare double, y int, n bigint")
    table = df.select(values(["a", "rare"]).alias("x"), F.col("y").alias("label"), F.lit(0).alias("fold"), "n", F.lit("").alias("key"))
    g = Grower(table, 2, lambda: [[], []], **way)
    fit = TreeFit(["a", "rare"], g.fits([tree_spec()])[0])
    g.release()
    assert fit.trees[0].depth.max() > 30
    assert all(r["prediction"] == r["y"] for r in fit.predict(df).collect())


def test_cuts_lie_between_the_neighbours_in_the_node(spark):
    """Values 1 and 9 in the node: 4.9 is nearer to 1, 5.1 to 9, whatever other rows have between them."""
    rows = [(1.0, 0.0, 0)] * 30 + [(9.0, 0.0, 1)] * 3 + [(v, 5.0, 1) for v in (0.5, 1.0, 2.0, 3.0, 4.0, 6.0)] * 9
    df = spark.createDataFrame(rows, "a double, b double, y int")
    for way in ({}, {"local_bytes": 0, "local_rows": 2}):
        g = Grower(cells(df, ["a", "b"], "y", F.lit(0)).withColumn("key", F.lit("")), 2, lambda: [[3.0], [1.0]], **way)
        fit = TreeFit(["a", "b"], g.fits([tree_spec()])[0])
        g.release()
        asked = spark.createDataFrame([(4.9, 0.0), (5.1, 0.0), (5.0, 0.0), (8.9, 0.0)], "a double, b double")
        assert [r["prediction"] for r in fit.predict(asked).collect()] == [0.0, 1.0, 0.0, 1.0]


def test_middle():
    assert middle(1.0, 9.0) == 5.0 and middle(-1.7e308, 1.7e308) == 0.0 and 1.6e308 < middle(1.6e308, 1.7e308) < 1.7e308
    near = np.nextafter(1.0, 2.0)
    assert middle(1.0, near) == 1.0 and middle(0.0, 5e-324) == 0.0  # no number between: the lower one


def odd_columns(rng, n):
    """Columns with as many values as rows, with outliers, of many orders of magnitude, with few values."""
    return np.column_stack([
        rng.normal(size=n), np.where(rng.random(n) < 0.001, 1e300, rng.random(n)), 2.0 ** rng.integers(-900, 900, n) * rng.choice([-1, 1], n),
        1 + rng.integers(0, n, n) * 1e-13, rng.integers(0, 5, n) * 1.0,
    ])


def cut_by_sorting(x, y, w, criterion, min_leaf):
    """The best cut of all rows: (score, feature, threshold)."""
    best = None
    for f in range(x.shape[1]):
        v, at = np.unique(x[:, f], return_inverse=True)
        l0, l1, n = (np.cumsum(np.bincount(at, c))[:-1] for c in (w * (y == 0), w * (y == 1), np.ones(len(y))))
        sides = [np.array([weight_of((a, b), criterion) + weight_of((p, q), criterion) for a, b, p, q in zip(l0, l1, w[y == 0].sum() - l0, w[y == 1].sum() - l1)])]
        score = np.round(sides[0] / w.sum(), 9)
        score[(n < min_leaf) | (len(y) - n < min_leaf)] = np.inf
        i = int(score.argmin())
        if np.isfinite(score[i]) and (best is None or score[i] < best[0]):
            best = (score[i], f, float(middle(v[i], v[i + 1])))
    return best


@pytest.mark.parametrize("exact, cells_per_pass", [(0, 4000), (0, 10**6), (3000, 10**6), (10**6, 10**6)])
@pytest.mark.parametrize("criterion, min_leaf, noise", [("gini", 1, 0.1), ("entropy", 5, 0.5)])
def test_distributed_cuts_by_sorting(spark, monkeypatch, exact, cells_per_pass, criterion, min_leaf, noise):
    """Whatever the slices and passes, the cut is the best of all, also where hardly anything is to be learned."""
    monkeypatch.setattr(cuts, "EXACT_ROWS", exact)
    monkeypatch.setattr(cuts, "CELLS_PER_PASS", cells_per_pass)
    rng = np.random.default_rng(exact + min_leaf)
    x = odd_columns(rng, 4000)
    y = ((x[:, 0] > 0.3) ^ (rng.random(4000) < noise)).astype(int)
    df = spark.createDataFrame(pd.DataFrame({"x": x.tolist(), "y": y, "g": np.arange(4000) % 3})).repartition(3)
    rows = df.select("x", F.col("y").alias("label"), F.col("g").cast("int").alias("g"))

    def views(batch):
        group = batch.column("g").to_numpy()
        every = np.arange(len(group))
        yield every, np.where(group < 2, group, -1), np.ones(len(group)), np.ones(len(group))
        yield every, np.full(len(group), 2), np.ones(len(group)), np.ones(len(group))

    edges = [np.quantile(x[:, f], np.arange(1, 8) / 8).tolist() for f in range(5)]
    found, totals = cuts.search(rows, views, [cuts.Rule(criterion, min_leaf)] * 3, edges)
    for k, mine in enumerate((np.arange(4000) % 3 == 0, np.arange(4000) % 3 == 1, np.ones(4000, bool))):
        want = cut_by_sorting(x[mine], y[mine], np.ones(mine.sum()), criterion, min_leaf)
        assert (found[k].score, found[k].feature, found[k].threshold) == want
        assert (totals[k].w0, totals[k].w1, totals[k].n) == ((y[mine] == 0).sum(), (y[mine] == 1).sum(), mine.sum())


def test_cuts_of_a_hundred_thousand_values(spark):
    """In memory and distributed, against sorting; the features have as many values as rows."""
    rng = np.random.default_rng(4)
    n = 100_000
    x = np.column_stack([rng.random(n), rng.normal(size=n)])
    y = ((x[:, 0] + 0.1 * x[:, 1] > 0.55) ^ (rng.random(n) < 0.2)).astype(int)
    want = cut_by_sorting(x, y, np.ones(n), "gini", 1)
    near = grow(Coded.of(x), y, np.ones(n), np.ones(n, int), GrowSpec(max_depth=1))
    assert (int(near.feature[0]), float(near.cut[0])) == want[1:]
    df = spark.createDataFrame(pd.DataFrame({"a": x[:, 0], "b": x[:, 1], "y": y}))
    g = Grower(cells(df, ["a", "b"], "y", F.lit(0)).withColumn("key", F.lit("")), 2, lambda: [[0.5], [0.0]], local_bytes=0, local_rows=60_000)
    far = g.fits([GrowSpec(max_depth=3)])[0][0]
    g.release()
    assert by_path(far) == by_path(grow(Coded.of(x), y, np.ones(n), np.ones(n, int), GrowSpec(max_depth=3)))


@pytest.mark.parametrize("kind", ["dt", "rf"])
@pytest.mark.parametrize("way", ["local", "large"])
def test_left_out_rows_have_no_influence(table, growers, kind, way):
    """Other feature values in the fold that a fit leaves out: the same trees."""
    spec = GrowSpec(without_fold=2) if kind == "dt" else GrowSpec(**{**forest_spec(3, 3).__dict__, "without_fold": 2})
    odd = table.withColumn("a", F.when(F.col("fold") == 2, F.rand(3) * 7 - 3).otherwise(F.col("a")))
    rows = cells(odd, NAMES, "y", F.col("fold")).withColumn("key", F.lit("")) if kind == "dt" else keyed(odd)
    g = grower(rows, **({} if way == "local" else {"local_bytes": 0, "local_rows": 150}))
    assert [by_path(t) for t in g.fits([spec])[0]] == [by_path(t) for t in growers[kind, way].fits([spec])[0]]
    g.release()


def test_blocks_of_votes_change_nothing(growers, monkeypatch):
    key = ["fit", "variant", "n_trees", "label", "prediction"]
    spec = forest_spec(3, 9, seed=2)
    want = growers["rf", "local"].scores([spec], [[Pruning(), Pruning(3)]], [[2, 9]]).sort_values(key)
    monkeypatch.setattr(trees, "BLOCK_ROWS", 17)
    got = growers["rf", "local"].scores([spec], [[Pruning(), Pruning(3)]], [[2, 9]]).sort_values(key)
    assert got[key + ["n"]].values.tolist() == want[key + ["n"]].values.tolist()


def test_forest_is_better_than_a_guess(table, forest):
    assert evaluate(forest.predict(table), "y").first()["accuracy"] > 0.8


@pytest.mark.parametrize("pruning", [Pruning(), Pruning(2, 10)])
def test_save_and_load(spark, table, deep, forest, tmp_path, pruning):
    for name, fit in (("deep", deep), ("forest", forest)):
        fit = fit.with_pruning(pruning)
        fit.save(str(tmp_path / name))
        again = TreeFit.load(spark, str(tmp_path / name))
        assert again.pruning == pruning
        assert answers(again, table) == answers(fit, table)
        assert again.importances() == pytest.approx(fit.importances())


def test_unknown_settings():
    with pytest.raises(ValueError):
        forest_spec(3, max_features="log2")
    with pytest.raises(ValueError):
        tree_spec(criterion="error")


def test_missing_feature_stops_scoring(spark, deep):
    df = spark.createDataFrame([(0.5, None, 1.0)], "a double, b double, c double")
    with pytest.raises(Exception):
        deep.predict(df).collect()


def test_results_are_fetched_with_all_tasks_at_once(spark):
    """Nodes of a large table are finished side by side, not one task after the other."""
    import time

    from plumbline.session import fetched

    def slow(batches):
        for batch in batches:
            time.sleep(1)
            yield batch

    tasks = spark.range(0, 8, 1, 8).mapInArrow(slow, "id bigint")
    assert sorted(r["id"] for r in fetched(tasks)) == list(range(8))
    start = time.time()
    list(fetched(tasks))
    assert time.time() - start < 6


@pytest.mark.parametrize("limits", [(None, 2), (3, 2), (None, 40), (0, 2)])
def test_router_answers_like_the_tree(limits):
    from plumbline.operators.growth import Coded, GrowSpec, grow

    rng = np.random.default_rng(5)
    x = np.round(rng.normal(size=(400, 3)), 1)
    y = (x[:, 0] * x[:, 1] + rng.normal(size=400) > 0).astype(np.int64)
    tree = grow(Coded.of(x), y, np.ones(400), np.ones(400, np.int64), GrowSpec())
    swapped = type(tree)(tree.feature, tree.cut, tree.right, tree.left, tree.w0, tree.w1, tree.n, tree.depth, tree.gain)
    for t in (tree, swapped):
        assert (t.router(*limits).answers(x) == t.answers(*limits)[t.leaf_of(x)]).all()


def test_rows_of_a_large_table_travel_small(spark):
    """A pass over a large table reads a few bytes of a row, not its values, key and fold one by one."""
    rng, n = np.random.default_rng(6), 20_000
    x = np.column_stack([rng.integers(0, 50, n) * 1.0, rng.random(n), rng.integers(0, 9, n) / 100])
    df = spark.createDataFrame(pd.DataFrame({"x": x.tolist(), "label": rng.integers(0, 2, n), "fold": rng.integers(0, 5, n), "n": 1, "key": ""})).repartition(2)
    blocks = cuts.Blocks.of(df, [list(range(1, 50)), [k / 256 for k in range(1, 256)], [k / 100 for k in range(1, 9)]])
    sizes = blocks.rdd.map(len).collect()
    whole = blocks.each(lambda some: [(b.x, b.vector("label")) for b in some]).collect()
    blocks.release()
    assert sum(sizes) < 16 * n
    got = np.concatenate([np.column_stack(b) for b in whole])
    want = np.array([(*r["x"], r["label"]) for r in df.collect()])
    assert np.array_equal(got[np.lexsort(got.T)], want[np.lexsort(want.T)])


def test_a_slice_with_several_values_may_hold_one_in_a_node(spark):
    """All values lie in one slice; a node looks at further features where its own has one value in it."""
    rng, n = np.random.default_rng(7), 400
    a = rng.integers(0, 2, n) * 1.0
    x = np.column_stack([a, 0.5 * a, rng.integers(0, 6, n)])
    df = pd.DataFrame({"x": x.tolist(), "label": (rng.random(n) < 0.2 + 0.5 * a).astype(int)})
    df["fold"], df["n"], df["key"] = 0, 1, [str(i) for i in range(n)]
    table, grown = spark.createDataFrame(df).repartition(3), []
    for way in ({}, {"local_bytes": 0, "local_rows": 10}):
        g = Grower(table, 3, lambda: [[], [], []], **way)
        grown.append([by_path(t) for t in g.fits([GrowSpec(max_depth=4, max_features=1, n_trees=5, bootstrap=True, seed=3)])[0]])
        g.release()
    assert grown[0] == grown[1]
