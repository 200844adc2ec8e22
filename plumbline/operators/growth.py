"""Growing exact trees: the cut rule, trees as arrays, and growth of one tree in memory.

A cut lies in the middle between two neighbouring values that rows of the node have. The best cut of a
node is the one whose sides have the least weighted impurity, rounded at the ninth digit; ties go to the
first feature and then to the smallest value. A node is split while it holds both classes and its limits
allow it, whether or not the cut lowers the impurity. Values are handled as their ranks (codes), so
nothing is lost however many different values a feature has.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, fields

import numpy as np
import pyarrow as pa

DIGITS = 9


@dataclass(frozen=True)
class GrowSpec:
    """What a tree or forest is grown with; ``max_features`` None looks at all features of a node."""

    criterion: str = "gini"
    max_depth: int | None = None
    min_samples_split: int = 2
    min_samples_leaf: int = 1
    max_features: int | None = None
    n_trees: int = 1
    bootstrap: bool = False
    seed: int = 0
    without_fold: int | None = None

    def __post_init__(self):
        if self.criterion not in ("gini", "entropy"):
            raise ValueError(f"criterion must be 'gini' or 'entropy', not {self.criterion!r}")

    @property
    def least_rows(self) -> int:
        """Rows that a node must have to be split."""
        return max(self.min_samples_split, 2 * self.min_samples_leaf)

    def subset(self, n_features: int) -> bool:
        return self.max_features is not None and self.max_features < n_features


@dataclass
class TreeNodes:
    """The nodes of one tree, parents before children; ``feature`` and the children are -1 at a leaf.
    Rows whose value is over ``cut`` go right."""

    feature: np.ndarray
    cut: np.ndarray
    left: np.ndarray
    right: np.ndarray
    w0: np.ndarray
    w1: np.ndarray
    n: np.ndarray  # rows, however often a bootstrap drew them
    depth: np.ndarray
    gain: np.ndarray  # fall of the impurity per weight

    @property
    def share(self) -> np.ndarray:
        return self.w1 / (self.w0 + self.w1)

    @property
    def nbytes(self) -> int:
        return sum(getattr(self, f.name).nbytes for f in fields(self))

    def closed(self, max_depth: int | None, min_samples_split: int, levels: list[np.ndarray] | None = None) -> np.ndarray:
        """Nodes at which the tree ends under smaller limits, and all below them."""
        out = (self.feature < 0) | (self.n < min_samples_split)
        if max_depth is not None:
            out |= self.depth >= max_depth
        for parents in self._levels() if levels is None else levels:
            stop = parents[out[parents]]
            out[self.left[stop]] = out[self.right[stop]] = True
        return out

    def answers(self, max_depth: int | None, min_samples_split: int) -> np.ndarray:
        """Share of class 1 that a row ending at each node gets under smaller limits."""
        return next(self.answers_of([(max_depth, min_samples_split)]))

    def answers_of(self, limits: Sequence[tuple[int | None, int]]) -> Iterator[np.ndarray]:
        """The answers under each of some smaller limits."""
        levels, share = self._levels(), self.share
        for max_depth, min_samples_split in limits:
            closed, out = self.closed(max_depth, min_samples_split, levels), share.copy()
            for parents in levels:
                stop = parents[closed[parents]]
                out[self.left[stop]] = out[self.right[stop]] = out[stop]
            yield out

    def leaf_of(self, x: np.ndarray) -> np.ndarray:
        out = np.zeros(len(x), np.int64)
        rows = np.arange(len(x)) if self.feature[0] >= 0 else np.zeros(0, np.int64)
        node, flat, width = out[: len(rows)], np.ascontiguousarray(x).ravel(), x.shape[1]
        while len(rows):
            right = flat.take(rows * width + self.feature.take(node)) > self.cut.take(node)
            node = np.where(right, self.right.take(node), self.left.take(node))
            inner = self.feature.take(node) >= 0
            if not inner.all():
                out[rows[~inner]] = node[~inner]
                rows, node = rows[inner], node[inner]
        return out

    def reached(self, x: np.ndarray) -> np.ndarray:
        """``leaf_of`` for a small tree: every row goes as many steps as the tree is deep, and stays at a leaf."""
        leaf, node, deep = self.feature < 0, np.arange(len(self.feature)), 0
        child = np.stack([np.where(leaf, node, self.left), np.where(leaf, node, self.right)], axis=1).ravel()
        at = np.zeros(1, np.int64)
        while not leaf[at].all():
            at, deep = np.unique(child.reshape(-1, 2)[at]), deep + 1
        feature, flat, begin, out = np.where(leaf, 0, self.feature), np.ascontiguousarray(x).ravel(), np.arange(len(x)) * x.shape[1], np.zeros(len(x), np.int64)
        for _ in range(deep):
            out = child.take(2 * out + (flat.take(begin + feature.take(out)) > self.cut.take(out)))
        return out

    def router(self, max_depth: int | None, min_samples_split: int) -> "Router":
        closed = self.closed(max_depth, min_samples_split)
        right = None if (self.right[~closed] == self.left[~closed] + 1).all() else self.right.astype(np.int32)
        value = np.where(closed, self.share, self.cut)
        return Router(np.where(closed, -1, self.feature).astype(np.int32), value, self.left.astype(np.int32), right)

    def importances(self, n_features: int, max_depth: int | None, min_samples_split: int) -> np.ndarray:
        """Fall of the impurity per feature, summing to 1 (or all 0)."""
        inner = ~self.closed(max_depth, min_samples_split)
        fall = self.gain[inner] * (self.w0 + self.w1)[inner]
        table = np.bincount(self.feature[inner], weights=fall, minlength=n_features)
        return table / table.sum() if table.sum() > 0 else table

    def _levels(self):
        inner = np.flatnonzero(self.feature >= 0)
        depth = self.depth[inner]
        if (depth[1:] < depth[:-1]).any():
            order = np.argsort(depth, kind="stable")
            inner, depth = inner[order], depth[order]
        return np.split(inner, np.flatnonzero(np.diff(depth)) + 1) if len(inner) else []

    def packed(self, order: np.ndarray | slice = slice(None)) -> bytes:
        return b"".join(getattr(self, f.name)[order].astype(t).tobytes() for f, t in zip(fields(self), _KINDS))

    def table(self, tree: int) -> pa.Table:
        """One row per node."""
        n = len(self.feature)
        numbers = {"tree": pa.array(np.full(n, tree, np.int32)), "node": pa.array(np.arange(n, dtype=np.int32))}
        return pa.table(numbers | {f.name: pa.array(getattr(self, f.name).astype(t)) for f, t in zip(fields(self), _KINDS)})

    @staticmethod
    def unpacked(data: bytes) -> "TreeNodes":
        sizes = [np.dtype(t).itemsize for t in _KINDS]
        n, at, columns = len(data) // sum(sizes), 0, []
        for size, kind in zip(sizes, _KINDS):
            columns.append(np.frombuffer(data, kind, n, at))
            at += n * size
        return TreeNodes(*columns)


_KINDS = ("<i4", "<f8", "<i4", "<i4", "<f8", "<f8", "<i8", "<i4", "<f8")


@dataclass
class Router:
    """What answers rows: ``value`` is the cut of a node, or at a leaf (``feature`` -1) the share of class 1;
    without ``right``, the right child follows the left one."""

    feature: np.ndarray
    value: np.ndarray
    left: np.ndarray
    right: np.ndarray | None

    @property
    def nbytes(self) -> int:
        return sum(x.nbytes for x in (self.feature, self.value, self.left, self.right) if x is not None)

    def answers(self, x: np.ndarray) -> np.ndarray:
        out, node = np.full(len(x), self.value[0]), np.zeros(len(x), np.int64)
        rows = np.arange(len(x)) if self.feature[0] >= 0 else np.zeros(0, np.int64)
        node = node[rows]
        while len(rows):
            to_right = x[rows, self.feature[node]] > self.value[node]
            node = self.left[node] + to_right if self.right is None else np.where(to_right, self.right[node], self.left[node])
            inner = self.feature[node] >= 0
            out[rows[~inner]] = self.value[node[~inner]]
            rows, node = rows[inner], node[inner]
        return out


class Coded:
    """Columns of values as ranks among the column's different values."""

    def __init__(self, codes: list[np.ndarray], values: list[np.ndarray]):
        self.codes, self.values = codes, values

    @staticmethod
    def of(x: np.ndarray) -> "Coded":
        codes, values = [], []
        for f in range(x.shape[1]):
            found, code = np.unique(x[:, f], return_inverse=True)
            codes.append(code.ravel().astype(np.int32))
            values.append(found)
        return Coded(codes, values)

    def matrix(self, some: np.ndarray) -> np.ndarray:
        """The values of these rows, [row, feature]."""
        return np.stack([v[c[some]] for c, v in zip(self.codes, self.values)], axis=1)

    def rows(self, some: np.ndarray) -> "Coded":
        return Coded([c[some] for c in self.codes], self.values)

    @property
    def lead(self) -> int:
        """The feature with the most values."""
        return int(np.argmax(self.sizes))

    def order(self) -> np.ndarray:
        """The rows in the order of ``lead``."""
        return np.argsort(self.codes[self.lead], kind="stable")

    @property
    def sizes(self) -> list[int]:
        return [len(v) for v in self.values]


def middle(low, high):
    """The cut between two neighbouring values; the lower one where no number fits between them."""
    half = np.asarray(low) / 2 + np.asarray(high) / 2
    return np.where((half >= high) | (half < low) | ~np.isfinite(half), low, half)


def impurity(w0, w1, criterion: str):
    """Weight times impurity of nodes with these class weights."""
    total = w0 + w1
    safe = np.where(total > 0, total, 1.0)
    if criterion == "gini":
        return total - (w0 * w0 + w1 * w1) / safe
    p, q = w0 / safe, w1 / safe
    return -total * (p * np.log2(np.where(p > 0, p, 1.0)) + q * np.log2(np.where(q > 0, q, 1.0)))


def running(x: np.ndarray, first: np.ndarray, sizes: np.ndarray, whole: bool) -> np.ndarray:
    """Running sums inside segments; numbers that are not whole are added up segment by segment, so that a
    heavy segment leaves no rounding error in a light one."""
    if whole or len(first) == 1:
        upto = np.cumsum(x)
        return upto - np.repeat(upto[first] - x[first], sizes)
    out = np.empty(len(x))
    for start, size in zip(first.tolist(), sizes.tolist()):
        np.cumsum(x[start : start + size], out=out[start : start + size])
    return out


def cut_scores(first: np.ndarray, w0, w1, n, criterion: str, min_leaf: np.ndarray, whole: bool) -> tuple[np.ndarray, np.ndarray]:
    """Impurity of the two sides of a cut behind each cell of ascending values, per segment that begins at
    ``first``; infinite where a side has too few rows. Also the rows of the smaller side."""
    sizes = np.diff(np.append(first, len(n)))
    last = first + sizes - 1
    l0, l1, ln = (running(x, first, sizes, w) for x, w in ((w0, whole), (w1, whole), (n, True)))
    t0, t1, tn = (np.repeat(x[last], sizes) for x in (l0, l1, ln))
    sides = impurity(l0, l1, criterion) + impurity(np.maximum(t0 - l0, 0), np.maximum(t1 - l1, 0), criterion)
    total = t0 + t1
    score = np.round(sides / np.where(total > 0, total, 1.0), DIGITS)
    fewer = np.minimum(ln, tn - ln)
    return np.where(fewer >= np.repeat(np.maximum(1, min_leaf), sizes), score, np.inf), fewer


@dataclass
class Level:
    """The rows of the nodes (slots) that are split together: slot by slot, and inside a slot in the order of
    the feature ``lead``, whose cells then need no sorting."""

    values: list[np.ndarray]
    codes: list[np.ndarray]  # twice the rank of the value, plus the label
    weight: np.ndarray
    count: np.ndarray | None  # None: every row counts once
    sizes: np.ndarray  # rows per slot
    lead: int
    whole: bool  # are all weights whole numbers?

    @staticmethod
    def of(data: Coded, label: np.ndarray, weight: np.ndarray, count: np.ndarray) -> "Level":
        codes, rank = [2 * c + label.astype(c.dtype) for c in data.codes], data.codes[data.lead]
        weight, count = np.asarray(weight, float), None if (count == 1).all() else count.astype(float)
        level = Level(data.values, codes, weight, count, np.array([len(label)]), data.lead, bool((weight == np.rint(weight)).all()))
        return level if (rank[1:] >= rank[:-1]).all() else level.rows(data.order(), level.sizes)

    def rows(self, some: np.ndarray, sizes: np.ndarray) -> "Level":
        count = None if self.count is None else self.count[some]
        return Level(self.values, [c[some] for c in self.codes], self.weight[some], count, sizes, self.lead, self.whole)

    def slots(self, look: np.ndarray) -> "Level":
        """The rows of some slots only."""
        return self if look.all() else self.rows(np.flatnonzero(np.repeat(look, self.sizes)), self.sizes[look])

    def sums(self, at: np.ndarray, some: np.ndarray | slice, groups: int) -> list[np.ndarray]:
        """(w0, w1, n) of groups of rows."""
        both = np.bincount(2 * at + (self.codes[0][some] & 1), weights=self.weight[some], minlength=2 * groups)
        n = np.bincount(at, weights=None if self.count is None else self.count[some], minlength=groups)
        return [both[0::2], both[1::2], n.astype(np.int64)]

    def cells(self, f: int, look: np.ndarray | None):
        """(slot, rank, w0, w1, n) of the different values per slot that looks at the feature, in order."""
        size, code, w, n, sizes = len(self.values[f]), self.codes[f], self.weight, self.count, self.sizes
        if look is not None and not look.all():
            mine = np.flatnonzero(np.repeat(look, sizes))
            code, w, n, sizes = code[mine], w[mine], None if n is None else n[mine], np.where(look, sizes, 0)
        slots = len(sizes)
        slot = np.repeat(np.arange(slots), sizes)
        if f != self.lead and slots * size <= 4 * len(code) + 1024:
            at = slot * (2 * size) + code
            both = np.bincount(at, weights=w, minlength=2 * slots * size)
            counts = np.bincount(at, weights=n, minlength=2 * slots * size)
            counts = counts[0::2] + counts[1::2]
            found = np.flatnonzero(counts)
            return found // size, found % size, both[0::2][found], both[1::2][found], counts[found].astype(float)
        if f != self.lead:
            order = np.argsort(slot * size + (code >> 1), kind=None if self.whole else "stable")
            code, w, n, slot = code[order], w[order], None if n is None else n[order], slot[order]
        rank = code >> 1
        begins = np.ones(len(code), bool)
        np.not_equal(rank[1:], rank[:-1], out=begins[1:])
        begins[(np.cumsum(sizes) - sizes)[sizes > 0]] = True
        start = np.flatnonzero(begins)
        if not len(start):
            return slot, rank, w, w, w
        ones = w * (code & 1)
        rows = np.diff(start, append=len(code)).astype(float) if n is None else np.add.reduceat(n, start)
        return slot[start], rank[start], np.add.reduceat(w - ones, start), np.add.reduceat(ones, start), rows

    def best(self, f: int, look: np.ndarray | None, criterion: str, min_leaf: np.ndarray):
        """Per slot that looks at the feature: (score, rank on the left, rank on the right, rows of the smaller
        side, are there several values?)."""
        slots = len(self.sizes)
        score, low, high, fewer = np.full(slots, np.inf), np.zeros(slots, np.int64), np.zeros(slots, np.int64), np.zeros(slots)
        several = np.zeros(slots, bool)
        slot, code, w0, w1, n = self.cells(f, look)
        if len(slot):
            first = np.flatnonzero(np.concatenate([[True], slot[1:] != slot[:-1]]))
            own = slot[first]
            several[own] = np.diff(np.append(first, len(slot))) > 1
            found, smaller = cut_scores(first, w0, w1, n, criterion, min_leaf[own], self.whole)
            score[own] = np.minimum.reduceat(found, first)
            at = np.flatnonzero((found == score[slot]) & np.isfinite(found))[::-1]
            low[slot[at]] = code[at]  # the last one written is the first of the slot
            high[slot[at]] = code[np.minimum(at + 1, len(code) - 1)]
            fewer[slot[at]] = smaller[at]
        return score, low, high, fewer, several


def best_cuts(level: Level, criterion: str, min_leaf: np.ndarray, wanted: np.ndarray | None = None) -> tuple[np.ndarray, ...]:
    """(feature, cut, rank on the left, rows of the smaller side) per slot, feature -1 where none cuts.
    ``wanted`` ranks each slot's features, of which the negative ones are looked at (see ``allowed``)."""
    n_features, slots = len(level.codes), len(level.sizes)
    best, feature, cut = np.full(slots, np.inf), np.full(slots, -1), np.zeros(slots)
    left, smaller = np.zeros(slots, np.int64), np.zeros(slots)
    several = np.zeros((slots, n_features), bool)

    def look_at(f: int, look: np.ndarray | None) -> None:
        score, low, high, fewer, several[:, f] = level.best(f, look, criterion, min_leaf)
        better = (score < best) | ((score == best) & np.isfinite(score) & (f < feature))
        best[better], feature[better], left[better], smaller[better] = score[better], f, low[better], fewer[better]
        values = level.values[f]
        cut[better] = middle(values[low[better]], values[high[better]])

    for f in range(n_features):
        look = None if wanted is None else wanted[:, f] < 0
        if look is None or look.any():
            look_at(f, look)
    if wanted is not None and (none := ~(several & (wanted < 0)).any(axis=1)).any():
        for f in range(n_features):  # nodes whose features have one value each look at a further one
            if (rest := none & (wanted[:, f] >= 0)).any():
                several[rest, f] = level.best(f, rest, criterion, min_leaf)[4][rest]
        look = allowed(wanted, several) & (wanted >= 0)
        for f in range(n_features):
            if look[:, f].any():
                look_at(f, look[:, f])
    return feature, cut, left, smaller


def allowed(wanted: np.ndarray, several: np.ndarray) -> np.ndarray:
    """Features a node looks at: those with a negative rank, and if each of them has one value in the
    node, the next by rank that has more."""
    look = wanted < 0
    none = ~(look & several).any(axis=1)
    if none.any():
        rank = np.where(several & ~look, wanted, np.iinfo(wanted.dtype).max)
        following = rank.argmin(axis=1)
        rows = np.flatnonzero(none & several.any(axis=1))
        look[rows, following[rows]] = True
    return look


def feature_ranks(seed: int, tree: int, paths: Sequence[str], n_features: int, max_features: int) -> np.ndarray:
    """Rank of each feature at each node, from md5 of seed, tree and path; the first ``max_features``
    are below 0. Eight features share one md5, 16 bits each; equal ones go by number."""
    blocks = -(-n_features // 8)
    raw = b"".join(hashlib.md5(f"{seed}:{tree}:{p}:{k}".encode()).digest() for p in paths for k in range(blocks))
    drawn = np.frombuffer(raw, ">u2").reshape(len(paths), blocks * 8)[:, :n_features].astype(np.int64)
    order = np.argsort(drawn, axis=1, kind="stable")
    rank = np.empty_like(order)
    np.put_along_axis(rank, order, np.arange(n_features)[None, :] - max_features, axis=1)
    return rank


#: 16-bit thresholds of the Poisson distribution with mean 1: a draw is the number of them it reaches.
DRAW_STEPS = np.floor(65536 * np.cumsum([math.exp(-1) / math.factorial(k) for k in range(8)])).astype(np.int64)
_DRAWN = np.searchsorted(DRAW_STEPS, np.arange(65536), "right")


def draws(seed: int, trees: range, keys: Sequence[str]) -> np.ndarray:
    """How often each tree's bootstrap draws each row, [row, tree]: Poisson numbers from md5 of seed,
    block of eight trees and row key, 16 bits a tree."""
    out = []
    for block in range(trees.start // 8, -(-trees.stop // 8)):
        head = f"{seed}:boot:{block}:"
        raw = b"".join([hashlib.md5((head + k).encode()).digest() for k in keys])
        u = np.frombuffer(raw, ">u2").reshape(len(keys), 8)
        out.append(_DRAWN[u])
    first = trees.start // 8 * 8
    return np.concatenate(out, axis=1)[:, trees.start - first : trees.stop - first].astype(np.int64)


def grow(data: Coded, label: np.ndarray, weight: np.ndarray, count: np.ndarray, spec: GrowSpec, tree: int = 0, path: str = "") -> TreeNodes:
    """One tree on rows with positive weight, or the part of one that begins at ``path`` (L and R from
    the root)."""
    return grow_variants(data, label, weight, count, spec, [spec.min_samples_leaf], tree, path)[0]


def grow_variants(
    data: Coded, label: np.ndarray, weight: np.ndarray, count: np.ndarray, spec: GrowSpec, leaves: Sequence[int], tree: int = 0, path: str = ""
) -> list[TreeNodes]:
    """The trees of ``spec`` for each of some ascending ``min_samples_leaf``.

    They are one tree as far as they agree: a cut that leaves enough rows on both sides for a larger limit
    is the best one for it too. Where it does not, the node's rows go on in a copy for the larger limits.
    """
    limits = [max(spec.min_samples_split, 2 * leaf) for leaf in leaves]
    n_features, subset, depth = len(data.codes), spec.subset(len(data.codes)), len(path)
    level, paths = Level.of(data, label, weight, count), [path]
    w0, w1, n = level.sums(np.zeros(len(label), np.int64), slice(None), 1)
    has = np.ones((len(leaves), 1), bool)  # which of the trees a node belongs to
    made, parts = [1] * len(leaves), [[] for _ in leaves]

    def splits(w0, w1, n, has, depth) -> np.ndarray:
        """Which nodes may be split, per tree."""
        mixed = (w0 > 0) & (w1 > 0) & (spec.max_depth is None or depth < spec.max_depth)
        return np.stack([h & mixed & (n >= least) for h, least in zip(has, limits)])

    open_ = splits(w0, w1, n, has, depth)
    if not open_.any():
        level = level.rows(np.zeros(0, np.int64), np.zeros(0, np.int64))
    while len(n):
        nodes = np.flatnonzero(open_.any(axis=0))  # of which ``level`` has the rows
        wanted = feature_ranks(spec.seed, tree, paths, n_features, spec.max_features) if subset and len(nodes) else None
        feature, cut = np.full((len(leaves), len(n)), -1), np.zeros((len(leaves), len(n)))
        child, gain = np.zeros((len(leaves), len(n)), np.int64), np.zeros((len(leaves), len(n)))
        below, kept, sizes, following = [], [], [], []
        served = np.zeros((len(leaves), len(nodes)), bool)
        for v, leaf in enumerate(leaves if len(nodes) else []):
            need = open_[v, nodes] & ~served[v]
            if not need.any():
                continue
            own = level.slots(need)
            f, at, left, smaller = best_cuts(own, spec.criterion, np.full(len(own.sizes), leaf), None if wanted is None else wanted[need])
            some, split = np.flatnonzero(need), f >= 0
            also = [v] + [u for u in range(v + 1, len(leaves))]
            sharing = np.stack([open_[u, nodes[some]] & ~served[u, some] & ((smaller >= leaves[u]) | ~split) for u in also])
            first = sum(b[0].size for b in below)
            two, mine = np.flatnonzero(split), nodes[some]
            for u, shares in zip(also, sharing):
                served[u, some[shares]] = True
                to = shares & split
                feature[u, mine[to]], cut[u, mine[to]] = f[to], at[to]
                child[u, mine[to]] = first + 2 * (np.cumsum(split) - 1)[to]
            if not len(two):
                continue
            right = np.zeros(len(own.weight), bool)
            for k in range(n_features):
                if (f == k).any():
                    right |= own.codes[k] > np.repeat(np.where(f == k, 2 * left + 1, np.iinfo(np.int32).max).astype(np.int32), own.sizes)
            rows = slice(None) if split.all() else np.flatnonzero(np.repeat(split, own.sizes))
            right = right[rows]
            under = np.repeat(np.arange(0, 2 * len(two), 2), own.sizes[two]) + right
            c0, c1, cn = own.sums(under, rows, 2 * len(two))
            impure = impurity(c0, c1, spec.criterion).reshape(-1, 2).sum(axis=1)
            whole0, whole1 = w0[mine[two]], w1[mine[two]]
            fall = np.maximum(0.0, impurity(whole0, whole1, spec.criterion) - impure) / (whole0 + whole1)
            belongs = np.zeros((len(leaves), 2 * len(two)), bool)
            for u, shares in zip(also, sharing):
                belongs[u] = np.repeat(shares[two], 2)
                gain[u, mine[two[shares[two]]]] = fall[shares[two]]
            goes_on = splits(c0, c1, cn, belongs, depth + 1).any(axis=0)
            order, per_child = _dealt(under, right, goes_on, 2 * len(two))
            moved = order if split.all() else rows[order]
            kept.append(moved if need.all() else np.flatnonzero(np.repeat(need, level.sizes))[moved])
            sizes.append(per_child[goes_on])
            below.append((c0, c1, cn, belongs))
            if subset:
                names = [paths[i] for i in some[two]]
                following += [names[i >> 1] + "LR"[i & 1] for i in np.flatnonzero(goes_on)]
        numbers = [np.cumsum(np.concatenate([b[3][v] for b in below])) - 1 if below else np.zeros(0, np.int64) for v in range(len(leaves))]
        for v in range(len(leaves)):
            mine = np.flatnonzero(has[v])
            split = feature[v, mine] >= 0
            left = np.full(len(mine), -1)
            left[split] = made[v] + numbers[v][child[v, mine[split]]]
            parts[v].append((feature[v, mine], cut[v, mine], left, np.where(split, left + 1, -1), w0[mine], w1[mine], n[mine], np.full(len(mine), depth), gain[v, mine]))
            made[v] += 2 * int(split.sum())
        if not below:
            break
        w0, w1, n = (np.concatenate([b[i] for b in below]) for i in range(3))
        has, depth, paths = np.concatenate([b[3] for b in below], axis=1), depth + 1, following
        open_ = splits(w0, w1, n, has, depth)
        level = level.rows(np.concatenate(kept), np.concatenate(sizes))
    return [TreeNodes(*[np.concatenate(c) for c in zip(*p)]) for p in parts]


def _dealt(under: np.ndarray, right: np.ndarray, goes_on: np.ndarray, children: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows of the children that go on, child by child in the order they came, and the rows of every child.
    Rows come node by node, so that lefts and rights each are in place already but for the others between."""
    per_child = np.bincount(under, minlength=children)
    moved = np.where(goes_on, per_child, 0)
    begin = np.cumsum(moved) - moved
    out, on = np.empty(int(moved.sum()), np.int64), goes_on[under]
    for side, mine in ((0, on & ~right), (1, on & right)):
        found, each = np.flatnonzero(mine), moved[side::2]
        out[np.arange(len(found)) + np.repeat(begin[side::2] - (np.cumsum(each) - each), each)] = found
    return out, per_child
