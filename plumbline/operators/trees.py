"""Decision trees and forests, and every smaller tree they contain.

A greedy tree never looks below a node before splitting it, so the tree for a smaller depth or a
larger ``min_samples_split`` is the big tree with some nodes closed. Closing nodes only changes what a
leaf of the big tree answers: one tree serves all of these settings.

Training rows come as cells (equal values, label and fold, counted) or, for forests, as rows with their
key, from which each tree's bootstrap draws are read. A table of at most LOCAL_BYTES goes, as codes, to
the executors whole and the trees of all fits are grown side by side, a task for a few trees. A larger
table is kept in blocks, and the trees of all fits grow in the same passes: the cuts of their large nodes
are found by branch and bound (``cuts``), and a node of at most LOCAL_ROWS rows is finished by one task.
A forest's draws are read once for the trees that grow together.
Both ways give the same trees.
"""

from __future__ import annotations

import math
import pickle
from collections.abc import Callable, Iterable, Iterator, Sequence
from dataclasses import dataclass, field, replace

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.operators.cuts import Block, Blocks, Cut, Rule, Side, matrix, search, trained_rows
from plumbline.operators.growth import Coded, GrowSpec, Router, TreeNodes, draws, feature_ranks, grow, grow_variants, impurity
from plumbline.session import SEED, fetched, keep, share

LOCAL_BYTES = 384 << 20  # of a training table that is broadcast, as codes
LOCAL_ROWS = 1_000_000  # rows of a node that one task finishes
DRAWN_ROWS = 262_144  # rows whose draws are read together
MODEL_BYTES = 64 << 20  # of the trees in one broadcast
TREES_PER_TASK = 8
TREES_TOGETHER = 40  # of all fits on a large table
FINISHING_TASKS = 512  # that small nodes of a large table are dealt to
BLOCK_ROWS = 16_384  # left-out rows whose votes are added up together
HELD_OUT = -1

_ROW = "x array<double>, label int, fold int, n bigint, key string"


def values(features: Sequence[str]) -> Column:
    """The features of a row as array<double>; a missing or infinite one is an error."""
    bad = F.raise_error(F.lit("missing value in a feature, or one that is not finite")).cast("double")
    numbers = [F.col(f"`{f}`").cast("double") for f in features]
    return F.array(*[F.when(v.isNotNull() & ~F.isnan(v) & (F.abs(v) < math.inf), v).otherwise(bad) for v in numbers])


def cells(df: DataFrame, features: Sequence[str], label: str, fold: Column) -> DataFrame:
    """Rows with equal values, label and fold always share one weight: count them once.

    The partial count runs before the shuffle, so a cell with very many rows is no hot spot.
    """
    rows = df.select(values(features).alias("x"), F.col(label).cast("int").alias("label"), fold.cast("int").alias("fold"))
    return rows.groupBy("x", "label", "fold").agg(F.count(F.lit(1)).alias("n"))


@dataclass(frozen=True)
class Pruning:
    """A smaller tree inside a fitted one; ``max_depth`` None means as deep as fitted."""

    max_depth: int | None = None
    min_samples_split: int = 2


@dataclass(frozen=True)
class TreeFit:
    """A fitted tree or forest together with its features and the pruning in force."""

    features: list[str]
    trees: list[TreeNodes] = field(repr=False)
    pruning: Pruning = Pruning()

    @property
    def n_trees(self) -> int:
        return len(self.trees)

    def with_pruning(self, pruning: Pruning) -> "TreeFit":
        return TreeFit(self.features, self.trees, pruning)

    def first(self, n_trees: int) -> "TreeFit":
        """The forest of the first trees."""
        return TreeFit(self.features, self.trees[:n_trees], self.pruning)

    def importances(self) -> dict[str, float]:
        """Impurity decrease per feature, per tree summing to 1, averaged over the trees."""
        limits = (self.pruning.max_depth, self.pruning.min_samples_split)
        table = sum(t.importances(len(self.features), *limits) for t in self.trees)
        total = table.sum()
        return dict(zip(self.features, map(float, table / total if total > 0 else table)))

    def predict(self, df: DataFrame) -> DataFrame:
        """Add ``prediction``: 1 where the mean share of class 1 over the trees is above one half.

        A projection: the trees go to the executors in sets of at most MODEL_BYTES, whose sums are
        added up row by row.
        """
        total = F.lit(0.0)
        limits = (self.pruning.max_depth, self.pruning.min_samples_split)
        for part in _sets(t.router(*limits) for t in self.trees):
            total = total + _summed(share(df.sparkSession, part))(values(self.features))
        return df.withColumn("prediction", (total > self.n_trees / 2 + 1e-9).cast("double"))

    def nodes(self, spark: SparkSession) -> DataFrame:
        """(tree, node, feature, cut, left, right, w0, w1, n, depth, gain): one row per node."""
        return _node_rows(spark, self.trees, 0)

    def save(self, path: str) -> None:
        """Trees are written in sets, so that what goes to Spark at once is bounded."""
        spark, start = SparkSession.active(), 0
        for part in _sets(self.trees):
            _node_rows(spark, part, start).write.mode("append" if start else "overwrite").parquet(f"{path}/nodes")
            start += len(part)
        row = [(self.pruning.max_depth, self.pruning.min_samples_split)]
        spark.createDataFrame(row, "max_depth int, min_samples_split int").coalesce(1).write.mode("overwrite").parquet(f"{path}/pruning")
        names = spark.createDataFrame(list(enumerate(self.features)), "position int, feature string")
        names.coalesce(1).write.mode("overwrite").parquet(f"{path}/features")

    @staticmethod
    def load(spark: SparkSession, path: str) -> "TreeFit":
        p = spark.read.parquet(f"{path}/pruning").first()
        names = [r["feature"] for r in spark.read.parquet(f"{path}/features").orderBy("position").collect()]

        def pack(table: pa.Table) -> pa.Table:
            nodes = TreeNodes(*[table.column(k).to_numpy() for k in _NODE_COLUMNS])
            order = np.argsort(table.column("node").to_numpy())
            return pa.table({"tree": table.column("tree")[:1], "nodes": pa.array([nodes.packed(order)], pa.binary())})

        packed = spark.read.parquet(f"{path}/nodes").groupBy("tree").applyInArrow(pack, "tree int, nodes binary")
        trees = {r["tree"]: TreeNodes.unpacked(bytes(r["nodes"])) for r in fetched(packed)}
        return TreeFit(names, [trees[i] for i in sorted(trees)], Pruning(None if pd.isna(p["max_depth"]) else int(p["max_depth"]), p["min_samples_split"]))


def _node_rows(spark: SparkSession, trees: Sequence[TreeNodes], start: int) -> DataFrame:
    return spark.createDataFrame(pa.concat_tables([t.table(i) for i, t in enumerate(trees, start)]))


_NODE_COLUMNS = ("feature", "cut", "left", "right", "w0", "w1", "n", "depth", "gain")


def tree_spec(
    max_depth: int | None = None, min_samples_split: int = 2, min_samples_leaf: int = 1, criterion: str = "gini", seed: int = SEED
) -> GrowSpec:
    return GrowSpec(criterion, max_depth, min_samples_split, min_samples_leaf, seed=seed)


def forest_spec(
    n_features: int,
    n_estimators: int = 100,
    max_depth: int | None = None,
    min_samples_split: int = 2,
    min_samples_leaf: int = 1,
    max_features: str | None = "sqrt",
    seed: int = SEED,
) -> GrowSpec:
    """Every tree on its own bootstrap; a node looks at the root of the number of features."""
    if max_features not in ("sqrt", None):
        raise ValueError(f"max_features must be 'sqrt' or None, not {max_features!r}")
    looked_at = None if max_features is None else max(1, math.isqrt(n_features))
    return GrowSpec("gini", max_depth, min_samples_split, min_samples_leaf, looked_at, n_estimators, True, seed)


class Grower:
    """A table of training rows (x, label, fold, n, key) on which trees are grown.

    ``fold`` is HELD_OUT for rows no fit trains on; a fit also leaves out its own fold. ``key`` decides
    the bootstrap draws of a row (n is 1 then); cells need none. ``edges`` gives some values per feature
    that cut a large table's rows into slices of like size; they have no influence on the trees.
    """

    def __init__(self, table: DataFrame, n_features: int, edges: Callable[[], list], local_bytes: int = LOCAL_BYTES, local_rows: int = LOCAL_ROWS):
        self.n_features, self.edges, self.local_rows = n_features, edges, local_rows
        kinds = {"label": "int", "fold": "int", "n": "bigint", "key": "string"}
        self.table = keep(table.select("x", *[F.col(c).cast(k).alias(c) for c, k in kinds.items()]))
        size = self.table.agg(F.count(F.lit(1)).alias("n"), F.sum(F.length("key")).alias("k")).first()
        self.rows = size["n"]
        self.local = (4 * n_features + 13) * size["n"] + (size["k"] or 0) <= local_bytes
        if self.local:
            self.shared = share(self.spark, _Rows.of(self.table.toArrow()))
        else:
            self.blocks = Blocks.of(self.table, edges())
            self.table.unpersist()

    @property
    def spark(self) -> SparkSession:
        return self.table.sparkSession

    def release(self) -> None:
        if self.local:
            self.table.unpersist()
            self.shared.destroy()
        else:
            self.blocks.release()

    def fits(self, specs: Sequence[GrowSpec]) -> list[list[TreeNodes]]:
        """The trees of each spec."""
        if not self.local:
            jobs = sorted(((j, t) for j, s in enumerate(specs) for t in range(s.n_trees)), key=lambda x: (x[1] // 8, x))  # by draws
            grown = {}
            for start in range(0, len(jobs), TREES_TOGETHER):
                some = jobs[start : start + TREES_TOGETHER]
                grown |= zip(some, _Frontier(self, specs, some).run())
            return [[grown[j, t] for t in range(s.n_trees)] for j, s in enumerate(specs)]
        tasks = [(j, trees) for j, s in enumerate(specs) for trees in _chunks(s.n_trees, [s.n_trees])]
        shared = self.shared

        def run(batches):
            for batch in batches:
                for i in batch.column(0).to_pylist():
                    j, trees = tasks[i]
                    for t, tree in zip(trees, shared.value.grow(specs[j], trees)):
                        yield pa.RecordBatch.from_pydict({"i": pa.array([i], pa.int32()), "tree": pa.array([t], pa.int32()), "nodes": pa.array([tree.packed()], pa.binary())})

        made: dict[int, dict] = {}
        for r in fetched(self._tasks(len(tasks)).mapInArrow(run, "i int, tree int, nodes binary")):
            made.setdefault(r["i"], {})[r["tree"]] = TreeNodes.unpacked(bytes(r["nodes"]))
        out = [[] for _ in specs]
        for i, (j, _) in enumerate(tasks):
            out[j] += [made[i][t] for t in sorted(made[i])]
        return out

    def scores(self, specs: Sequence[GrowSpec], prunings: Sequence[Sequence[Pruning]], sizes: Sequence[Sequence[int]]) -> pd.DataFrame:
        """(fit, variant, n_trees, label, prediction, n) on the rows each fit left out: for every one of
        its prunings, and for every size of a forest, of which the first trees are taken.

        Trees' shares are added up per block of left-out rows, so no group is larger than a block. Fits that
        differ in ``min_samples_leaf`` only grow together."""
        if not self.local:
            parts = [_large_scores(self.spark, self.blocks, s, t, p, z).assign(fit=j) for j, (s, t, p, z) in enumerate(zip(specs, self.fits(specs), prunings, sizes))]
            return pd.concat(parts, ignore_index=True)
        alike: dict[tuple, list[int]] = {}
        for j, (s, z) in enumerate(zip(specs, sizes)):
            alike.setdefault((replace(s, min_samples_leaf=1), tuple(z)), []).append(j)
        tasks = [(js, trees) for (_, z), js in alike.items() for trees in _chunks(max(z), z)]
        shared = self.shared

        def run(batches):
            for batch in batches:
                for i in batch.column(0).to_pylist():
                    js, trees = tasks[i]
                    for j, sums in zip(js, shared.value.sums([specs[j] for j in js], trees, [prunings[j] for j in js])):
                        for block, start in enumerate(range(0, sums.shape[1], BLOCK_ROWS)):
                            part = np.ascontiguousarray(sums[:, start : start + BLOCK_ROWS])
                            yield pa.RecordBatch.from_pydict(
                                {"fit": pa.array([j], pa.int32()), "block": pa.array([block], pa.int32()), "upto": pa.array([trees.stop], pa.int32()), "sums": pa.array([part.tobytes()], pa.binary())}
                            )

        def vote(part: pd.DataFrame) -> pd.DataFrame:
            j, start, rows = int(part["fit"].iloc[0]), int(part["block"].iloc[0]) * BLOCK_ROWS, []
            label, n = (x[start : start + BLOCK_ROWS] for x in shared.value.left_out(specs[j]))
            part = part.sort_values("upto")
            arrays = [np.frombuffer(s).reshape(len(prunings[j]), -1) for s in part["sums"]]
            for size in sizes[j]:
                total = sum(a for a, upto in zip(arrays, part["upto"]) if upto <= size)
                for v in range(len(prunings[j])):
                    votes = (total[v] > size / 2 + 1e-9).astype(int)
                    counted = np.bincount(label * 2 + votes, weights=n, minlength=4)
                    rows += [(j, v, size, c // 2, c % 2, int(counted[c])) for c in range(4)]
            return pd.DataFrame(rows, columns=["fit", "variant", "n_trees", "label", "prediction", "n"])

        sums = self._tasks(len(tasks)).mapInArrow(run, "fit int, block int, upto int, sums binary")
        key = ["fit", "variant", "n_trees", "label", "prediction"]
        voted = sums.groupBy("fit", "block").applyInPandas(vote, "fit int, variant int, n_trees int, label int, prediction int, n bigint")
        return voted.groupBy(*key).agg(F.sum("n").alias("n")).toPandas()

    def _tasks(self, n: int) -> DataFrame:
        return self.spark.range(0, n, 1, max(1, n))  # a partition each, as they take unequally long


class _Rows:
    """A training table in memory: values as codes, keys as one Arrow array. Rows are in the order of the
    feature with the most values, in which trees grow."""

    def __init__(self, data, label, fold, n, key):
        self.data, self.label, self.fold, self.n, self.key = data, label, fold, n, key

    @staticmethod
    def of(table: pa.Table) -> "_Rows":
        columns = [table.column(c).to_numpy() for c in ("label", "fold", "n")]
        data = Coded.of(matrix(table.column("x").combine_chunks()))
        order = data.order()
        label, fold, n = (c[order] for c in columns)
        return _Rows(data.rows(order), label.astype(np.int8), fold, n, table.column("key").combine_chunks().take(pa.array(order)))

    def grow(self, spec: GrowSpec, trees: range) -> Iterator[TreeNodes]:
        return (grown for (grown,) in self.grow_variants(spec, [spec.min_samples_leaf], trees))

    def grow_variants(self, spec: GrowSpec, leaves: Sequence[int], trees: range) -> Iterator[list[TreeNodes]]:
        """Per tree, one for each of the ascending ``leaves``."""
        mine = np.flatnonzero((self.fold > HELD_OUT) & (self.fold != _own_fold(spec)))
        if not spec.bootstrap:
            data, label, n = self.data.rows(mine), self.label[mine], self.n[mine]
            yield from (grow_variants(data, label, n.astype(float), n, spec, leaves, t) for t in trees)
            return
        drawn = np.zeros((len(trees), len(mine)), np.int8)
        for a in range(0, len(mine), DRAWN_ROWS):
            drawn[:, a : a + DRAWN_ROWS] = draws(spec.seed, trees, self.key.take(pa.array(mine[a : a + DRAWN_ROWS])).to_numpy(zero_copy_only=False)).T
        for t, times in zip(trees, drawn):
            some = np.flatnonzero(times)
            rows = mine[some]
            yield grow_variants(self.data.rows(rows), self.label[rows], times[some].astype(float), self.n[rows], spec, leaves, t)

    def left_out(self, spec: GrowSpec) -> tuple[np.ndarray, np.ndarray]:
        mine = self.fold == _own_fold(spec)
        return self.label[mine].astype(np.int64), self.n[mine]

    def sums(self, specs: Sequence[GrowSpec], trees: range, prunings: Sequence[Sequence[Pruning]]) -> list[np.ndarray]:
        """Summed shares of class 1, [pruning, left-out row], of fits that differ in ``min_samples_leaf`` only."""
        x = self.data.matrix(np.flatnonzero(self.fold == _own_fold(specs[0])))
        out = [np.zeros((len(p), len(x))) for p in prunings]
        leaves = sorted({s.min_samples_leaf for s in specs})
        for grown in self.grow_variants(specs[0], leaves, trees):
            for spec, sums, limits in zip(specs, out, prunings):
                tree = grown[leaves.index(spec.min_samples_leaf)]
                leaf = tree.leaf_of(x)
                for v, answer in enumerate(tree.answers_of([(p.max_depth, p.min_samples_split) for p in limits])):
                    sums[v] += answer[leaf]
        return out


def _own_fold(spec: GrowSpec) -> int:
    return HELD_OUT if spec.without_fold is None else spec.without_fold


class _Top:
    """The large nodes of a tree while it grows: where rows go, and which node they are in."""

    def __init__(self):
        self.feature, self.cut, self.left, self.right = [-1], [0.0], [-1], [-1]

    def split(self, node: int, feature: int, cut: float) -> tuple[int, int]:
        at = len(self.feature)
        self.feature[node], self.cut[node], self.left[node], self.right[node] = feature, cut, at, at + 1
        for column, value in ((self.feature, -1), (self.cut, 0.0), (self.left, -1), (self.right, -1)):
            column += [value, value]
        return at, at + 1

    def routes(self) -> TreeNodes:
        none = np.zeros(0)
        return TreeNodes(np.array(self.feature), np.array(self.cut), np.array(self.left), np.array(self.right), none, none, none, none, none)


class _Frontier:
    """Trees of any fits on a table that stays distributed, grown level by level in the same passes.

    Rows do not move: every pass sends them down the trees as far as these have grown. What the driver
    holds is one record per large node, the open ranges of its search and, in the end, the trees.
    """

    def __init__(self, grower: Grower, specs: Sequence[GrowSpec], jobs: Sequence[tuple[int, int]]):
        self.grower, self.jobs = grower, list(jobs)
        self.specs = [specs[j] for j, _ in jobs]
        self.tops = [_Top() for _ in jobs]
        self.paths = [[""] for _ in jobs]
        self.sides: list[dict[int, Side]] = [{} for _ in jobs]
        self.gains: list[dict[int, float]] = [{} for _ in jobs]

    def run(self) -> list[TreeNodes]:
        every = [(i, 0) for i in range(len(self.jobs))]
        small, open_ = (every, []) if self.grower.rows <= self.grower.local_rows else ([], every)
        self.drawn = sorted({(s.seed, t // 8) for s, (_, t) in zip(self.specs, self.jobs) if s.bootstrap})
        self.blocks = self.grower.blocks
        if self.drawn:
            drawn = self.blocks.changed(_drawer(self.drawn))
            self.blocks = self.blocks.with_rdd(drawn.persist(StorageLevel.MEMORY_AND_DISK))
        try:
            return self._grown(small, open_)
        finally:
            if self.drawn:
                self.blocks.release()

    def _grown(self, small: list[tuple[int, int]], open_: list[tuple[int, int]]) -> list[TreeNodes]:
        while open_:
            following = []
            cuts, totals = search(self.blocks, self._views(open_), [self._rule(*at) for at in open_])
            for (i, node), cut, total in zip(open_, cuts, totals):
                self.sides[i].setdefault(node, total or Side(0.0, 0.0, 0, 0))
                if cut is None or not self._splits(i, node):
                    continue  # of a root only the search knows what is in it
                for child, side in zip(self._split(i, node, cut), (cut.left, total - cut.left)):
                    self.sides[i][child] = side
                    if side.size <= self.grower.local_rows:
                        small.append((i, child))
                    elif self._splits(i, child):
                        following.append((i, child))
            open_ = following
        return self._assembled(self._finished(small))

    def _splits(self, i: int, node: int) -> bool:
        spec, side = self.specs[i], self.sides[i][node]
        deep = spec.max_depth is not None and len(self.paths[i][node]) >= spec.max_depth
        return min(side.w0, side.w1) > 0 and side.n >= spec.least_rows and not deep

    def _split(self, i: int, node: int, cut: Cut) -> tuple[int, int]:
        spec, whole = self.specs[i], self.sides[i][node]
        left, right = cut.left, whole - cut.left
        sides = impurity(np.array([left.w0, right.w0]), np.array([left.w1, right.w1]), spec.criterion).sum()
        before = impurity(np.array([whole.w0]), np.array([whole.w1]), spec.criterion)[0]
        self.gains[i][node] = max(0.0, float(before - sides)) / (whole.w0 + whole.w1)
        self.paths[i] += [self.paths[i][node] + "L", self.paths[i][node] + "R"]
        return self.tops[i].split(node, cut.feature, cut.threshold)

    def _rule(self, i: int, node: int) -> Rule:
        spec, wanted = self.specs[i], None
        if spec.subset(self.grower.n_features):
            wanted = feature_ranks(spec.seed, self.jobs[i][1], [self.paths[i][node]], self.grower.n_features, spec.max_features)[0]
        return Rule(spec.criterion, spec.min_samples_leaf, wanted)

    def _views(self, nodes: list[tuple[int, int]]):
        """Each tree's rows and which of ``nodes`` they are in."""
        return _views([(self.specs[i], self._draws(i), self.tops[i].routes(), self._numbers(i, nodes)) for i in sorted({i for i, _ in nodes})])

    def _draws(self, i: int) -> int:
        """The place of a tree's draws in the blocks."""
        spec, tree = self.specs[i], self.jobs[i][1]
        return 8 * self.drawn.index((spec.seed, tree // 8)) + tree % 8 if spec.bootstrap else 0

    def _numbers(self, i: int, nodes: list[tuple[int, int]]) -> np.ndarray:
        out = np.full(len(self.tops[i].feature), -1)
        for k, (own, node) in enumerate(nodes):
            if own == i:
                out[node] = k
        return out

    def _finished(self, small: list[tuple[int, int]]) -> dict[tuple[int, int], TreeNodes]:
        """The trees below the small nodes, a task for each."""
        if not small:
            return {}
        views = self._views(small)
        what = [(self.specs[i], self.jobs[i][1], self.paths[i][node]) for i, node in small]
        tasks = min(len(small), FINISHING_TASKS)

        def place(blocks: Iterator[Block]):
            for block in blocks:
                for rows, node, w, n in views(block):
                    if np.ndim(node) == 0:
                        if node >= 0 and len(w):
                            yield int(node), _piece(block, rows, w, n)
                        continue
                    order = np.argsort(node, kind="stable")
                    own = np.flatnonzero(np.diff(node[order])) + 1
                    for some in np.split(order, own):
                        if len(some) and node[some[0]] >= 0:
                            mine = rows.start + some if isinstance(rows, slice) else rows[some]
                            yield int(node[some[0]]), _piece(block, mine, w[some], n[some])

        def finish(pieces: Iterator[tuple[int, bytes]]):
            held: dict[int, list] = {}
            for at, piece in pieces:
                held.setdefault(at, []).append(piece)
            for at in sorted(held):
                spec, tree, path = what[at]
                yield at, grow(*_joined(held.pop(at)), spec, tree, path).packed()

        done = self.blocks.each(place).partitionBy(tasks, lambda at: at).mapPartitions(finish)
        return {small[at]: TreeNodes.unpacked(nodes) for at, nodes in _fetched(done)}

    def _assembled(self, finished: dict[tuple[int, int], TreeNodes]) -> list[TreeNodes]:
        return [self._tree(i, {node: t for (j, node), t in finished.items() if j == i}) for i in range(len(self.jobs))]

    def _tree(self, i: int, finished: dict[int, TreeNodes]) -> TreeNodes:
        """The large nodes with the finished ones grafted on."""
        if 0 in finished:
            return finished[0]
        top, sides = self.tops[i], self.sides[i]
        kept = [k for k in range(len(top.feature)) if k not in finished]
        place, made, grafts = {k: at for at, k in enumerate(kept)}, len(kept), []
        for k, graft in finished.items():
            place[k] = made
            grafts.append(replace(graft, left=np.where(graft.left < 0, -1, graft.left + made), right=np.where(graft.right < 0, -1, graft.right + made)))
            made += len(graft.feature)
        own = TreeNodes(
            np.array([top.feature[k] for k in kept], np.int64),
            np.array([top.cut[k] for k in kept]),
            np.array([place.get(top.left[k], -1) for k in kept], np.int64),
            np.array([place.get(top.right[k], -1) for k in kept], np.int64),
            *[np.array([getattr(sides[k], c) for k in kept]) for c in ("w0", "w1", "n")],
            np.array([len(self.paths[i][k]) for k in kept]),
            np.array([self.gains[i].get(k, 0.0) for k in kept]),
        )
        return TreeNodes(*[np.concatenate([getattr(t, k) for t in (own, *grafts)]) for k in _NODE_COLUMNS])


def _views(trees: list[tuple[GrowSpec, int, TreeNodes, np.ndarray]]):
    """Task side: the rows that each tree trains on, the number of the node they are in (negative: none),
    their weights and counts."""

    def of(block: Block):
        fold, n = block.vector("fold"), block.vector("n").astype(float)
        x = block.x if any(len(routes.feature) > 1 for _, _, routes, _ in trees) else None
        for spec, drawn, routes, numbers in trees:
            for rows in trained_rows(fold, _own_fold(spec)):
                weight = counts = n[rows]
                if spec.bootstrap:
                    times = block.extra[rows, drawn]
                    some = np.flatnonzero(times)
                    weight, counts, rows = times[some].astype(float), counts[some], rows.start + some
                yield rows, int(numbers[0]) if len(routes.feature) == 1 else numbers[routes.reached(x[rows])], weight, counts

    return of


def _drawer(blocks_of_trees: list[tuple[int, int]]):
    """Task side: the same rows with the draws of some blocks of eight trees, which their keys tell."""

    def draw(block: Block) -> Block:
        keys = block.column("key").to_pylist() if "key" in block.columns else [""] * block.num_rows
        drawn = [draws(seed, range(8 * k, 8 * k + 8), keys).astype(np.uint8) for seed, k in blocks_of_trees]
        columns = {c: v for c, v in block.columns.items() if c != "key"}
        return replace(block, columns=columns, extra=np.asfortranarray(np.concatenate(drawn, axis=1)))

    return draw


def _piece(block: Block, rows: np.ndarray | slice, w: np.ndarray, n: np.ndarray) -> bytes:
    """Rows of a node as they travel: numbers of slices and what they stand for, or values."""
    codes = [c[rows] for c in block.codes]
    label = (codes[0] & 1).astype(np.int8)
    kinds = [(numbers, (c >> 1)) if of_slices else (numbers[rows], None) for c, (numbers, of_slices) in zip(codes, block.kinds)]
    small = w.astype(np.uint8)
    count = None if (n == 1).all() else n
    return pickle.dumps((kinds, label, small if (small == w).all() else w, count), protocol=5)


def _joined(pieces: list[bytes]) -> tuple[Coded, np.ndarray, np.ndarray, np.ndarray]:
    """A node's rows in the order of the feature with the most values: values as codes, label, weight, count."""
    parts = [pickle.loads(p) for p in pieces]
    label, w = (np.concatenate([p[i] for p in parts]) for i in (1, 2))
    n = np.concatenate([np.ones(len(p[1]), np.int64) if p[3] is None else p[3].astype(np.int64) for p in parts])
    codes, values = [], []
    for kinds in zip(*(p[0] for p in parts)):
        if all(at is not None for _, at in kinds):
            used = [np.flatnonzero(np.bincount(at, minlength=len(numbers))) for numbers, at in kinds]
            found = np.unique(np.concatenate([numbers[u] for (numbers, _), u in zip(kinds, used)]))
            own = []
            for (numbers, at), u in zip(kinds, used):
                table = np.zeros(len(numbers), np.int32)
                table[u] = np.searchsorted(found, numbers[u])
                own.append(table.take(at))
            code = np.concatenate(own)
        else:
            v = np.concatenate([numbers if at is None else numbers.take(at) for numbers, at in kinds])
            order = np.argsort(v)
            begins = np.append(True, v[order][1:] != v[order][:-1])
            found, code = v[order][begins], np.empty(len(v), np.int32)
            code[order] = np.cumsum(begins) - 1
        codes.append(code)
        values.append(found)
    return Coded(codes, values), label.astype(np.int64), w.astype(float), n


def _fetched(rdd: RDD) -> Iterator:
    """What ``fetched`` does for rows: all tasks compute before the driver reads part by part."""
    done = rdd.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        done.count()
        yield from done.toLocalIterator()
    finally:
        done.unpersist()


def _summed(shared):
    """Column function: the sum over the broadcast trees of the share of class 1 where a row ends."""

    @F.arrow_udf("double")
    def shares(rows: pa.Array) -> pa.Array:
        x = matrix(rows)
        return pa.array(sum((tree.answers(x) for tree in shared.value), np.zeros(len(x))))

    return shares


def _large_scores(spark: SparkSession, blocks: Blocks, spec: GrowSpec, trees: list[TreeNodes], prunings: Sequence[Pruning], sizes: Sequence[int]) -> pd.DataFrame:
    """Votes on the left-out rows; the trees visit them in sets, sums travel with the rows."""
    left_out, width, half = _own_fold(spec), len(sizes), np.array([s / 2 + 1e-9 for s in sizes])

    def begin(some: Iterator[Block]):
        for block in some:
            rows = np.arange(*np.searchsorted(block.vector("fold"), [left_out, left_out + 1]))
            if len(rows):
                mine = block.take(rows)
                yield mine.x, mine.vector("label"), mine.vector("n"), np.zeros((len(prunings) * width, len(rows)))

    rows, start, sent = blocks.each(begin), 0, []
    for part in _sets(trees):
        shared = share(spark, [(i, t, [t.answers(p.max_depth, p.min_samples_split) for p in prunings]) for i, t in enumerate(part, start)])
        start += len(part)
        sent.append(shared)

        def add(row, shared=shared):
            x, label, n, sums = row
            for i, tree, answers in shared.value:
                leaf = tree.leaf_of(x)
                for v, answer in enumerate(answers):
                    votes = answer.take(leaf)
                    for k, size in enumerate(sizes):
                        if i < size:
                            sums[v * width + k] += votes
            return x, label, n, sums

        rows = rows.map(add)

    def count(some):
        out = np.zeros((len(prunings) * width, 4))
        for _, label, n, sums in some:
            for at, total in enumerate(sums):
                out[at] += np.bincount(2 * label + (total > half[at % width]), weights=n, minlength=4)
        yield out

    counted = sum(rows.mapPartitions(count).collect(), np.zeros((len(prunings) * width, 4)))
    for shared in sent:
        shared.destroy()
    found = [(at // width, sizes[at % width], c // 2, c % 2, int(n)) for at, own in enumerate(counted) for c, n in enumerate(own)]
    return pd.DataFrame(found, columns=["variant", "n_trees", "label", "prediction", "n"])


def _chunks(n_trees: int, sizes: Sequence[int]) -> list[range]:
    """Ranges of trees, none across a forest size that is asked for."""
    ends = sorted({*sizes, n_trees, *range(TREES_PER_TASK, n_trees, TREES_PER_TASK)})
    ends = [e for e in ends if e <= n_trees]
    return [range(a, b) for a, b in zip([0, *ends], ends)]


def _sets(trees: Iterable[TreeNodes | Router]) -> list[list]:
    """The trees in order, in sets of at most MODEL_BYTES or one tree."""
    out, size = [[]], 0
    for t in trees:
        if out[-1] and size + t.nbytes > MODEL_BYTES:
            out.append([])
            size = 0
        out[-1].append(t)
        size += t.nbytes
    return out
