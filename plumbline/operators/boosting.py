"""AdaBoost (two classes) over small weighted trees, many fits side by side: the discrete algorithm SAMME
and the real-valued SAMME.R, whose learners vote with half the log-odds of their leaves.

One fit is one setting on one set of training rows. All fits share every pass over the data: a row
has its log weight per fit. With SAMME that is the summed weights ``alpha`` of the learners that got
it wrong, with SAMME.R the summed log-odds against its class, times half the learning rate. Either way the
number also tells how all learners together vote on the row. The cuts of a level's nodes, of all fits together, are found by
branch and bound over the distributed rows (``cuts``); only the chosen cuts come back. A tree of
depth d takes d such searches whatever the number of fits. What stumps add to a row's log weight is a
function of one value each, so their sum is looked up per feature by the slice of the value; where trees
are deeper, rows carry the log weights.
"""

from __future__ import annotations

import math
import pickle
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, field, replace

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.operators.cuts import Block, Blocks, Rule, matrix, search, trained_rows
from plumbline.operators.growth import Coded, GrowSpec, TreeNodes, grow
from plumbline.operators.trees import HELD_OUT, values
from plumbline.session import drop_path, keep, scratch_path, share

PASSES_PER_CHECKPOINT = 6
FITS_PER_PASS = 64  # bounds what a row carries
NODES_PER_PASS = 4_096  # bounds what a search returns
NO_CUT = math.inf  # above every value
DEEPEST = 12  # of a boosted tree, which is stored with all 2^depth places
LOCAL_BYTES = 384 << 20  # of a cell table that is broadcast, as codes


@dataclass
class SmallTree:
    """A full binary tree of fixed depth; a node that does not split sends every row left."""

    depth: int
    feature: np.ndarray = field(init=False)
    cut: np.ndarray = field(init=False)  # rows with a value over it go right
    vote: np.ndarray = field(init=False)
    odds: np.ndarray = field(init=False)  # log of the weight of class 1 over that of class 0
    gain: np.ndarray = field(init=False)  # impurity decrease times the node's share of the weight

    def __post_init__(self):
        inner = 2**self.depth - 1
        self.feature = np.zeros(inner, dtype=np.int32)
        self.cut = np.full(inner, NO_CUT)
        self.gain = np.zeros(inner)
        self.vote = np.zeros(2 * inner + 1, dtype=np.int32)
        self.odds = np.zeros(2 * inner + 1)

    def nodes_of(self, x: np.ndarray, levels: int) -> np.ndarray:
        """Node reached after ``levels`` steps, numbered from 0 on that level."""
        node = np.zeros(len(x), dtype=np.int64)
        begin, flat = np.arange(len(x)) * x.shape[1], np.ascontiguousarray(x).ravel()
        for level in range(levels):
            at = node + (2**level - 1)
            node = 2 * node + (flat.take(begin + self.feature.take(at)) > self.cut.take(at))
        return node

    def leaf_of(self, x: np.ndarray) -> np.ndarray:
        return self.nodes_of(x, self.depth) + 2**self.depth - 1

    def predict(self, x: np.ndarray) -> np.ndarray:
        return self.vote[self.leaf_of(x)]

    def log_odds(self, x: np.ndarray) -> np.ndarray:
        return self.odds[self.leaf_of(x)]

    def say(self, at: int, w0: float, w1: float) -> None:
        """What a node with these class weights answers."""
        self.vote[at], self.odds[at] = _vote(w0, w1), _odds(w0, w1)

    def hand_down(self, at: int, to: int) -> None:
        self.vote[to], self.odds[to] = self.vote[at], self.odds[at]

    @staticmethod
    def of(nodes: TreeNodes, depth: int) -> "SmallTree":
        """The same tree with all its places; a leaf hands its rows down the left side."""
        tree, root = SmallTree(depth), nodes.w0[0] + nodes.w1[0]
        place = np.zeros(len(nodes.feature), np.int64)
        for i, f in enumerate(nodes.feature.tolist()):
            at = int(place[i])
            tree.say(at, float(nodes.w0[i]), float(nodes.w1[i]))
            if f >= 0:
                tree.feature[at], tree.cut[at] = f, nodes.cut[i]
                tree.gain[at] = nodes.gain[i] * (nodes.w0[i] + nodes.w1[i]) / root
                place[nodes.left[i]], place[nodes.right[i]] = 2 * at + 1, 2 * at + 2
                continue
            while 2 * at + 1 < len(tree.vote):
                tree.hand_down(at, 2 * at + 1)
                at = 2 * at + 1
        return tree

    def importances(self, n_features: int) -> np.ndarray:
        table = np.bincount(self.feature, weights=self.gain, minlength=n_features)
        return table / table.sum() if table.sum() > 0 else table


@dataclass
class BoostSpec:
    """One fit: its setting and the fold it leaves out (None trains on all training rows)."""

    n_estimators: int = 50
    learning_rate: float = 1.0
    base_max_depth: int = 1
    without_fold: int | None = None
    algorithm: str = "SAMME"

    def __post_init__(self):
        if self.algorithm not in ("SAMME", "SAMME.R"):
            raise ValueError(f"algorithm must be 'SAMME' or 'SAMME.R', not {self.algorithm!r}")

    @property
    def real(self) -> bool:
        return self.algorithm == "SAMME.R"

    def log_weight(self, tree: SmallTree, alpha: float, x: np.ndarray, label: np.ndarray) -> np.ndarray:
        """What a learner adds to the log weight of each row."""
        return self.leaf_weight(tree, alpha, tree.leaf_of(x), label)

    def leaf_weight(self, tree: SmallTree, alpha: float, leaf: np.ndarray, label: np.ndarray) -> np.ndarray:
        if self.real:
            return (0.5 - label) * self.learning_rate * tree.odds[leaf]
        return alpha * (tree.vote[leaf] != label)

    def margin(self, tree: SmallTree, alpha: float, x: np.ndarray) -> np.ndarray:
        """What a learner adds to the vote for class 1."""
        return tree.log_odds(x) if self.real else alpha * (2 * tree.predict(x) - 1)


@dataclass
class BoostFit:
    """The learners of one fit, in order, with their weights and weighted errors."""

    features: list[str]
    spec: BoostSpec
    trees: list[SmallTree] = field(default_factory=list)
    alphas: list[float] = field(default_factory=list)
    errors: list[float] = field(default_factory=list)
    stopped: bool = False

    def prefix(self, n_estimators: int) -> "BoostFit":
        """The fit that stops after ``n_estimators`` rounds."""
        spec, k = replace(self.spec, n_estimators=n_estimators), n_estimators
        return BoostFit(self.features, spec, self.trees[:k], self.alphas[:k], self.errors[:k], self.stopped)

    def importances(self) -> dict[str, float]:
        """Mean of the learners' importances weighted by alpha."""
        total = sum(self.alphas)
        table = sum(a * t.importances(len(self.features)) for a, t in zip(self.alphas, self.trees)) / total
        return dict(zip(self.features, map(float, table)))

    def predict(self, df: DataFrame) -> DataFrame:
        """Add ``prediction``: 1 where the learners voting 1 outweigh the others."""
        if not self.trees:
            raise ValueError("boosting could not start: its first learner is no better than a coin")
        learners, spec = list(zip(self.trees, self.alphas)), self.spec  # a few nodes per round, sent with the job

        @F.arrow_udf("double")
        def vote(rows: pa.Array) -> pa.Array:
            x = matrix(rows)
            margin = np.zeros(len(x))
            for tree, alpha in learners:
                margin += spec.margin(tree, alpha, x)
            return pa.array((margin > 1e-9).astype("float64"))

        return df.withColumn("prediction", vote(values(self.features)))

    def learners(self, spark: SparkSession) -> DataFrame:
        """(round, alpha, error, node, feature, cut, gain, vote, odds): one row per node."""
        rows = []
        for r, (tree, alpha, error) in enumerate(zip(self.trees, self.alphas, self.errors), start=1):
            inner = len(tree.feature)
            for i, v in enumerate(tree.vote):
                own = (int(tree.feature[i]), float(tree.cut[i]), float(tree.gain[i])) if i < inner else (None, None, None)
                rows.append((r, float(alpha), float(error), i, own[0], own[1], own[2], int(v), float(tree.odds[i])))
        schema = "round int, alpha double, error double, node int, feature int, cut double, gain double, vote int, odds double"
        return spark.createDataFrame(rows, schema)

    def save(self, path: str) -> None:
        spark = SparkSession.active()
        self.learners(spark).coalesce(1).write.mode("overwrite").parquet(f"{path}/learners")
        names = spark.createDataFrame(list(enumerate(self.features)), "position int, feature string")
        names.coalesce(1).write.mode("overwrite").parquet(f"{path}/features")
        spec = [(self.spec.n_estimators, self.spec.learning_rate, self.spec.base_max_depth, self.spec.algorithm)]
        settings = spark.createDataFrame(spec, "n_estimators int, learning_rate double, base_max_depth int, algorithm string")
        settings.coalesce(1).write.mode("overwrite").parquet(f"{path}/spec")

    @staticmethod
    def load(spark: SparkSession, path: str) -> "BoostFit":
        names = [r["feature"] for r in spark.read.parquet(f"{path}/features").orderBy("position").collect()]
        s = spark.read.parquet(f"{path}/spec").first()
        fit = BoostFit(names, BoostSpec(s["n_estimators"], s["learning_rate"], s["base_max_depth"], None, s["algorithm"]))
        for r in spark.read.parquet(f"{path}/learners").orderBy("round", "node").collect():
            if r["node"] == 0:
                fit.trees.append(SmallTree(s["base_max_depth"]))
                fit.alphas.append(r["alpha"])
                fit.errors.append(r["error"])
            tree = fit.trees[-1]
            tree.vote[r["node"]], tree.odds[r["node"]] = r["vote"], r["odds"]
            if r["feature"] is not None:
                tree.feature[r["node"]], tree.cut[r["node"]], tree.gain[r["node"]] = r["feature"], r["cut"], r["gain"]
        return fit


def fit_boosted(
    cell_table: DataFrame,
    features: Sequence[str],
    specs: Sequence[BoostSpec],
    edges: Callable[[], list],
    score_at: Sequence[int] = (),
    local_bytes: int = LOCAL_BYTES,
) -> tuple[list[BoostFit], pd.DataFrame]:
    """Fit all specs on one table of ``trees.cells``.

    Also returns (fit, n_trees, label, prediction, n) on the rows each fit left out, after every
    number of rounds in ``score_at`` and after the last: its own fold, or the held-out rows for a
    fit on all training rows. A fit whose first learner is no better than a coin has no learners and
    no scores.

    A cell table of at most ``local_bytes`` goes to the executors whole, and the fits run side by side,
    a task each; on a larger one all fits share the passes over the distributed cells. ``edges`` gives
    some values per feature that cut these into slices of like size, without influence on the result.
    """
    if max(s.base_max_depth for s in specs) > DEEPEST:
        raise ValueError(f"a boosted tree has at most depth {DEEPEST}")
    kept = keep(cell_table.select("x", "label", "fold", "n"))
    try:
        if kept.count() * (4 * len(features) + 13) <= local_bytes:
            return _fit_local(kept, list(features), specs, score_at)
        blocks = Blocks.of(kept, edges())
    finally:
        kept.unpersist()
    fits, scores = [], []
    widest = 2 ** (max(s.base_max_depth for s in specs) - 1)
    together = max(1, min(FITS_PER_PASS, NODES_PER_PASS // widest))
    try:
        for start in range(0, len(specs), together):
            some, counted = _fit_together(cell_table.sparkSession, blocks, list(features), list(specs[start : start + together]), score_at)
            counted["fit"] += start
            fits += some
            scores.append(counted)
    finally:
        blocks.release()
    return fits, pd.concat(scores, ignore_index=True)


def _fit_local(cell_table: DataFrame, features: list[str], specs: Sequence[BoostSpec], score_at: Sequence[int]):
    spark = cell_table.sparkSession
    table = cell_table.select("x", "label", "fold", "n").toArrow()
    label, fold, n = (table.column(c).to_numpy() for c in ("label", "fold", "n"))
    coded = Coded.of(matrix(table.column("x").combine_chunks()))
    order = coded.order()  # in which trees grow
    shared = share(spark, (coded.rows(order), label[order].astype(np.int8), fold[order], n[order]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in map(longest_first.__getitem__, batch.column(0).to_pylist()):
                made = pickle.dumps(_boosted(*shared.value, specs[i], score_at))
                yield pa.RecordBatch.from_pydict({"i": pa.array([i], pa.int32()), "made": pa.array([made], pa.binary())})

    longest_first = sorted(range(len(specs)), key=lambda i: -specs[i].base_max_depth * specs[i].n_estimators)
    tasks = spark.range(0, len(specs), 1, len(specs))  # a partition each, as they take unequally long
    rows = {r["i"]: pickle.loads(r["made"]) for r in tasks.mapInArrow(run, "i int, made binary").collect()}
    shared.destroy()
    fits, scores = [], []
    last = max(s.n_estimators for s in specs)
    for i, spec in enumerate(specs):
        trees, alphas, errors, stopped, scored = rows[i]
        learners = [SmallTree(spec.base_max_depth) for _ in trees]
        for tree, (tree.feature, tree.cut, tree.vote, tree.odds, tree.gain) in zip(learners, trees):
            pass
        fits.append(BoostFit(features, spec, learners, alphas, errors, stopped))
        for p in sorted({*score_at, last}):
            if p <= last and scored:
                cells_at = scored[max(k for k in scored if k <= p)]
                scores += [(i, label, vote, int(cells_at[label, vote]), p) for label in (0, 1) for vote in (0, 1)]
    return fits, pd.DataFrame(scores, columns=["fit", "label", "prediction", "n", "n_trees"])


def _boosted(table: Coded, label, fold, n, spec: BoostSpec, score_at):
    """One fit on cells in memory: learners, alphas, errors, whether it stopped, and the confusion cells
    of the left-out rows after the rounds in ``score_at`` and the last."""
    mine = (fold > HELD_OUT) & (fold != (HELD_OUT if spec.without_fold is None else spec.without_fold))
    out = fold == (HELD_OUT if spec.without_fold is None else spec.without_fold)
    coded, y, times, label_out = table.rows(np.flatnonzero(mine)), label[mine].astype(np.int64), n[mine], label[out].astype(np.int64)
    own, left_out = table.matrix(np.flatnonzero(mine)), table.matrix(np.flatnonzero(out))
    missed, votes, shift = np.zeros(len(y)), np.zeros(int(out.sum())), 0.0
    fit, scored = BoostFit([], spec), {}
    how = GrowSpec(max_depth=spec.base_max_depth)
    for round_no in range(1, spec.n_estimators + 1):
        weight = times * np.exp(missed - shift)
        root = weight.sum()
        tree = SmallTree.of(grow(coded, y, weight, times, how), spec.base_max_depth)
        leaf = tree.leaf_of(own)
        wrong = tree.vote[leaf] != y
        if (learner := _accept(fit, tree, float(weight[wrong].sum() / root))) is None:
            break
        shift += math.log(float(root))
        missed += spec.leaf_weight(*learner, leaf, y)
        votes += spec.margin(*learner, left_out)
        if round_no in score_at or round_no == spec.n_estimators or fit.stopped:
            cell = label_out * 2 + (votes > 1e-9)
            scored[round_no] = np.bincount(cell, weights=n[out], minlength=4).astype(np.int64).reshape(2, 2)
        if fit.stopped:
            break
    if fit.trees:
        scored.setdefault(len(fit.trees), np.bincount(label_out * 2 + (votes > 1e-9), weights=n[out], minlength=4).astype(np.int64).reshape(2, 2))
    return [(t.feature, t.cut, t.vote, t.odds, t.gain) for t in fit.trees], fit.alphas, fit.errors, fit.stopped, scored


def _fit_together(spark, blocks, features, specs, score_at):
    fits = [BoostFit(features, s) for s in specs]
    shift = np.zeros(len(fits))  # log of the current weight total per fit, which normalises the weights
    last = max(s.n_estimators for s in specs)
    scores: dict[int, pd.DataFrame] = {}
    state = _State(spark, blocks, specs)
    try:
        for round_no in range(1, last + 1):
            growing = [j for j, f in enumerate(fits) if not f.stopped and len(f.trees) < f.spec.n_estimators]
            if not growing:
                break
            state.settle()
            grown = _grow(state, fits, growing, shift)
            for j in growing:
                if (learner := _accept(fits[j], *grown[j])) is not None:
                    state.pending.setdefault(j, []).append((fits[j].spec, *learner))
            if round_no in score_at and round_no < last:
                scores[round_no] = _score(state, fits)
        final = _score(state, fits)
    finally:
        state.release()
    parts = [scores.get(p, final).assign(n_trees=p) for p in sorted({*score_at, last}) if p <= last]
    scored = pd.concat(parts, ignore_index=True)
    return fits, scored[scored["fit"].isin([j for j, f in enumerate(fits) if f.trees])]


class _State:
    """The cells in blocks. Learners wait in ``pending``, applied by every pass. With deep trees blocks carry
    log weights, and when enough passes have gone by they are written anew to the shared folder."""

    def __init__(self, spark: SparkSession, blocks: Blocks, specs: Sequence[BoostSpec]):
        self.spark, self.source, self.blocks, self.n_fits = spark, blocks, blocks, len(specs)
        self.flat = all(s.base_max_depth == 1 for s in specs)
        self.pending: dict[int, list] = {}
        self.passes = 0
        self.path: str | None = None

    def missed(self) -> "_Missed":
        """What tells the log weights of a block's rows."""
        return _Missed(self.n_fits, self.pending, self.blocks if self.flat else None)

    def settle(self) -> None:
        if self.flat or self.passes < PASSES_PER_CHECKPOINT:
            return
        missed, path = self.missed(), scratch_path(self.spark, "boost")

        def carry(block: Block) -> Block:
            return replace(block, extra=np.stack([missed.of(block, j, slice(0, block.num_rows)) for j in range(missed.n_fits)], axis=1))

        self.blocks.changed(carry).saveAsPickleFile(path, 1)
        self.release()
        rdd: RDD = self.spark.sparkContext.pickleFile(path)
        self.path, self.blocks = path, self.source.with_rdd(rdd.persist(StorageLevel.MEMORY_AND_DISK))
        self.pending, self.passes = {}, 0

    def release(self) -> None:
        if self.path:
            self.blocks.release()
            drop_path(self.spark, self.path)


class _Missed:
    """Task side: log weights per fit. Those of stumps are sums over the features of what is looked up by the
    slice of a value and the label; only values in slices with a cut inside are compared with the cuts."""

    def __init__(self, n_fits: int, pending: dict[int, list], blocks: Blocks | None):
        self.n_fits, self.pending, self.flat = n_fits, pending, blocks is not None
        self.tables = {j: _tables(learners, blocks) for j, learners in pending.items()} if self.flat else {}

    def of(self, block: Block, j: int, rows: slice) -> np.ndarray:
        if not self.flat:
            out = np.zeros(block.num_rows) if block.extra is None else block.extra[:, j].copy()
            for spec, tree, alpha in self.pending.get(j, ()):
                out += spec.log_weight(tree, alpha, block.x, block.vector("label"))
            return out[rows]
        out = None
        for f, cuts, steps, table, cut_inside in self.tables.get(j, ()):
            code = block.codes[f][rows]
            own = table.take(code)
            if cut_inside is not None:
                some = np.flatnonzero(cut_inside.take(code))
                own[some] = steps[np.searchsorted(cuts, block.values(f, some + rows.start)), code[some] & 1]
            out = own if out is None else out + own
        return np.zeros(len(block.codes[0][rows])) if out is None else out


def _tables(learners: list, blocks: Blocks) -> list[tuple]:
    """Per feature of the stumps: its cuts, what values behind so many of them add per label, that by the
    code of a slice, and which codes have a cut inside (None: no one)."""
    out = []
    for f in sorted({int(tree.feature[0]) for _, tree, _ in learners}):
        own = sorted(((float(tree.cut[0]), spec, tree, alpha) for spec, tree, alpha in learners if tree.feature[0] == f), key=lambda x: x[0])
        cuts, label = np.array([c for c, *_ in own]), np.array([0, 1])
        left, right = (np.array([spec.leaf_weight(tree, alpha, np.array([at, at]), label) for _, spec, tree, alpha in own]) for at in (1, 2))
        steps = np.zeros((len(own) + 1, 2))
        steps[1:] += np.cumsum(right, axis=0)
        steps[:-1] += np.cumsum(left[::-1], axis=0)[::-1]
        low, high = np.searchsorted(cuts, blocks.low[f]), np.searchsorted(cuts, blocks.high[f])
        filled = blocks.low[f] <= blocks.high[f]
        inside = np.repeat((low < high) & filled, 2)
        out.append((f, cuts, steps, np.where(filled[:, None], steps[low], 0.0).ravel(), inside if inside.any() else None))
    return out


def _accept(fit: BoostFit, tree: SmallTree, error: float) -> tuple[SmallTree, float] | None:
    """Add the learner; a perfect one ends the fit, with SAMME also one that is no better than a coin,
    which is not added."""
    if error >= 0.5 and not fit.spec.real:
        fit.stopped = True
        return None
    if error <= 0 or fit.spec.real:
        fit.stopped, alpha = error <= 0, 1.0
    else:
        alpha = fit.spec.learning_rate * math.log((1 - error) / error)
    fit.trees.append(tree)
    fit.alphas.append(alpha)
    fit.errors.append(error)
    return tree, alpha


def _grow(state, fits, growing, shift) -> dict[int, tuple[SmallTree, float]]:
    """One weighted tree per growing fit, level by level; moves ``shift`` to the new totals."""
    trees = {j: SmallTree(fits[j].spec.base_max_depth) for j in growing}
    weights: dict[int, dict[int, tuple[float, float]]] = {j: {} for j in growing}
    root: dict[int, float] = {}
    open_nodes = {j: [0] for j in growing}
    missed = state.missed()
    for level in range(max(t.depth for t in trees.values())):
        places = [(j, node) for j, nodes in open_nodes.items() for node in nodes]
        counted = []
        for j, nodes in open_nodes.items():
            numbers = np.full(2**level, -1)
            numbers[nodes] = [places.index((j, node)) for node in nodes]
            counted.append((j, trees[j], fits[j].spec.without_fold, float(shift[j]), numbers))
        cuts, totals = search(state.blocks, _views(counted, missed, level), [Rule()] * len(places))
        state.passes += 1
        found = dict(zip(places, zip(cuts, totals)))
        following: dict[int, list[int]] = {}
        for j, tree in trees.items():
            if level >= tree.depth:
                continue
            offset, below = 2**level - 1, 2 ** (level + 1) - 1
            if level == 0:
                whole = found[j, 0][1]
                weights[j][0] = (whole.w0, whole.w1)
                root[j] = whole.w0 + whole.w1
                tree.say(0, whole.w0, whole.w1)
            for node in range(2**level):
                at, left = node + offset, 2 * node + below
                if at not in weights[j]:
                    continue
                cut, total = found.get((j, node), (None, None))
                if cut is None or min(weights[j][at]) <= 0:
                    weights[j][left] = weights[j][at]
                    tree.hand_down(at, left)
                    continue
                rest = total - cut.left
                tree.feature[at], tree.cut[at] = cut.feature, cut.threshold
                sides = ((cut.left.w0, cut.left.w1), (max(rest.w0, 0.0), max(rest.w1, 0.0)))
                tree.gain[at] = max(0.0, _mixed(total.w0, total.w1) - sum(_mixed(*s) for s in sides)) / root[j]
                for child, pair in zip((left, left + 1), sides):
                    weights[j][child] = pair
                    tree.say(child, *pair)
                    if min(pair) > 0 and level + 1 < tree.depth:
                        following.setdefault(j, []).append(child - below)
        open_nodes = following
        if not open_nodes:
            _close(trees, weights, level + 1)
            break
    out = {}
    for j, tree in trees.items():
        first = 2**tree.depth - 1
        wrong = sum(w[1 - tree.vote[at]] for at, w in weights[j].items() if at >= first)
        out[j] = (tree, wrong / root[j])
        shift[j] += math.log(root[j])
    return out


def _views(counted: list[tuple], missed: _Missed, level: int):
    """Task side: the rows each fit trains on, the number of the open node they are in, and their weights."""

    def of(block: Block):
        fold, n = block.vector("fold"), block.vector("n")
        for j, tree, without, shift, numbers in counted:
            for rows in trained_rows(fold, without):
                weight = n[rows] * np.exp(missed.of(block, j, rows) - shift)
                node = numbers[tree.nodes_of(block.x[rows], level)] if level else int(numbers[0])
                yield rows, node, weight, n[rows]

    return of


def _close(trees, weights, level: int) -> None:
    """No node is left to split: let every node hand its rows down the left side to the last level."""
    for j, tree in trees.items():
        for lower in range(level, tree.depth):
            offset, below = 2**lower - 1, 2 ** (lower + 1) - 1
            for node in range(2**lower):
                if node + offset in weights[j]:
                    left = 2 * node + below
                    weights[j][left] = weights[j][node + offset]
                    tree.hand_down(node + offset, left)


def _score(state: _State, fits: list[BoostFit]) -> pd.DataFrame:
    """Confusion cells per fit on the rows it left out, read off the summed weights."""
    totals = [(sum(f.alphas), HELD_OUT if f.spec.without_fold is None else f.spec.without_fold, f.spec) for f in fits]
    missed = state.missed()

    def score(blocks: Iterator[Block]) -> Iterator[np.ndarray]:
        counts = np.zeros((len(totals), 2, 2), dtype=np.int64)
        for block in blocks:
            label, fold, n = block.vector("label"), block.vector("fold"), block.vector("n")
            for j, (total, left_out, spec) in enumerate(totals):
                mine = slice(*np.searchsorted(fold, [left_out, left_out + 1]).tolist())
                own, y = missed.of(block, j, mine), label[mine]
                if spec.real:
                    margin = own / ((0.5 - y) * spec.learning_rate)
                else:
                    margin = 2 * np.where(y == 1, total - own, own) - total
                vote = (margin > 1e-9).astype(np.int64)
                counts[j] += np.bincount(y * 2 + vote, weights=n[mine], minlength=4).astype(np.int64).reshape(2, 2)
        yield counts

    counts = sum(state.blocks.each(score).collect(), np.zeros((len(totals), 2, 2), np.int64))
    rows = [(j, label, vote, int(counts[j, label, vote])) for j in range(len(totals)) for label in (0, 1) for vote in (0, 1)]
    return pd.DataFrame(rows, columns=["fit", "label", "prediction", "n"])


def _vote(w0: float, w1: float) -> int:
    """Class with more weight; what only differs by rounding is a draw and goes to 0."""
    return int(w1 - w0 > 1e-12 * (w0 + w1))


def _odds(w0: float, w1: float) -> float:
    """log of the share of class 1 over that of class 0, shares no smaller than a rounding error."""
    least, total = np.finfo(float).eps, w0 + w1
    return math.log(max(w1 / total, least)) - math.log(max(w0 / total, least)) if total > 0 else 0.0


def _mixed(w0: float, w1: float) -> float:
    """Weight times Gini impurity."""
    total = w0 + w1
    return total - (w0 * w0 + w1 * w1) / total if total > 0 else 0.0
