"""Exact best cuts of nodes whose rows stay distributed: branch and bound on histograms.

The table is kept in blocks of rows, whose values are given as the numbers of coarse slices too. A pass
counts the rows of every node in these slices of every feature. A border between two slices is a real cut
between the largest value before and the least one behind it, which are looked up if it is the best. How
good a cut inside a slice can be is bounded from the class counts before and behind it: the impurity of two sides is a concave function
of what lies on the left, so over a slice it is least where all its rows of one class have moved and none
of the other. Only slices whose bound beats the best cut so far are counted again, more finely, until
none is left; few rows are counted value by value. Slices decide what is quick, never the result.
"""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, replace
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark import RDD, StorageLevel
from pyspark.sql import DataFrame

from plumbline.operators.growth import DIGITS, allowed, impurity, middle, running

SLICES = 64  # a range is counted in, if there is room
EXACT_ROWS = 1_000_000  # rows in open ranges that are counted value by value
CELLS_PER_PASS = 1_000_000  # slices that a task holds
FLUSH_ROWS = 200_000  # rows that a task holds before it counts them
BLOCK_ROWS = 131_072  # rows that are kept and counted together
SENT_BYTES = 64 << 20  # of all tasks' sums that the driver adds up itself

#: Task side: for a block of rows, (places of rows, their node numbers, weights, counts) of every fit or tree.
#: Places may be a slice, and one number may stand for all nodes.
Views = Callable[["Block"], Iterator[tuple[np.ndarray | slice, np.ndarray | int, np.ndarray, np.ndarray]]]


@dataclass(frozen=True)
class Side:
    """What lies on one side of a cut, or in a node; ``size`` counts table rows, ``n`` what they stand for."""

    w0: float
    w1: float
    n: int
    size: int

    def __sub__(self, other: "Side") -> "Side":
        return Side(self.w0 - other.w0, self.w1 - other.w1, self.n - other.n, self.size - other.size)


@dataclass(frozen=True)
class Cut:
    """Between the values ``low`` and ``high``, neighbours in the node."""

    score: float
    feature: int
    low: float
    high: float
    left: Side
    slices: tuple[int, int] | None = None  # between which it lies, while ``low`` and ``high`` are only bounds

    @property
    def rank(self) -> tuple:
        return self.score, self.feature, self.low

    @property
    def threshold(self) -> float:
        return float(middle(self.low, self.high))


@dataclass(frozen=True)
class Rule:
    """How a node is cut; ``wanted`` ranks its features (see ``growth.allowed``), None looks at all."""

    criterion: str = "gini"
    min_leaf: int = 1
    wanted: np.ndarray | None = None


@dataclass(frozen=True)
class Range:
    """Values of a feature in a node that are still open, what lies below them, and the least score that a
    cut inside can have."""

    node: int
    feature: int
    low: float
    high: float
    before: Side
    size: int
    bound: float
    slice: int  # the coarse slice it lies in

    @property
    def rank(self) -> tuple:
        return self.bound, self.feature, self.low


@dataclass
class _State:
    best: Cut | None = None
    total: Side | None = None
    look: np.ndarray | None = None

    def beaten_by(self, found: Cut | Range) -> bool:
        return self.best is None or found.rank < self.best.rank


@dataclass
class Block:
    """Task side: some rows of a table, in the order of their folds if it has any. What travels is small: a
    feature whose slices hold one value each is told by its slices, equal numbers in a row are told once."""

    num_rows: int
    codes: list[np.ndarray]  # per feature, twice the number of a row's slice, plus its label
    kinds: list[tuple[np.ndarray, bool]]  # per feature, the values of rows or (True) those of slices
    columns: dict[str, np.ndarray | pa.Array | tuple]
    extra: np.ndarray | None = None  # per row

    def column(self, name: str) -> pa.Array:
        own = self.columns[name]
        return own if isinstance(own, pa.Array) else pa.array(self.vector(name))

    def vector(self, name: str) -> np.ndarray:
        if name == "label":
            return (self.codes[0] & 1).astype(np.int64)
        own = self.columns[name]
        if isinstance(own, tuple):
            self.columns[name] = own = np.repeat(*own)
        return own

    def values(self, f: int, rows: np.ndarray | slice = slice(None)) -> np.ndarray:
        """The values of a feature."""
        numbers, of_slices = self.kinds[f]
        return numbers.take(self.codes[f][rows] >> 1) if of_slices else numbers[rows]

    @property
    def x(self) -> np.ndarray:
        return np.stack([self.values(f) for f in range(len(self.codes))], axis=1)

    def take(self, rows: np.ndarray) -> "Block":
        kinds = [(v if of_slices else v[rows], of_slices) for v, of_slices in self.kinds]
        columns = {c: v.take(pa.array(rows)) if isinstance(v, pa.Array) else self.vector(c)[rows] for c, v in self.columns.items()}
        return Block(len(rows), [c[rows] for c in self.codes], kinds, columns, None if self.extra is None else self.extra[rows])

    def packed(self) -> bytes:
        """The parts are plain arrays, so that workers need no copy of this class to read them."""
        columns = {c: _runs(v) if isinstance(v, np.ndarray) else v for c, v in self.columns.items()}
        return pickle.dumps((self.num_rows, self.codes, self.kinds, columns, self.extra), protocol=5)

    @staticmethod
    def unpacked(data: bytes) -> "Block":
        return Block(*pickle.loads(data))

    @staticmethod
    def of(batch: pa.RecordBatch, edges: list[np.ndarray]) -> "Block":
        if "fold" in batch.schema.names:
            fold = batch.column("fold").to_numpy()
            if (fold[1:] < fold[:-1]).any():
                batch = batch.take(pa.array(np.argsort(fold, kind="stable")))
        x, label, codes, kinds = matrix(batch.column("x")), batch.column("label").to_numpy(), [], []
        for f, e in enumerate(edges):
            at, size, v = np.searchsorted(e, x[:, f], "right"), len(e) + 1, np.ascontiguousarray(x[:, f])
            codes.append((2 * at + label).astype(np.uint8 if size <= 128 else np.uint16 if size <= 32_768 else np.int64))
            one = np.zeros(size)
            one[at] = v
            kinds.append((one, True) if (one[at] == v).all() else (v, False))
        columns = {}
        for c in batch.schema.names:
            if c not in ("x", "label"):
                text = pa.types.is_string(batch.column(c).type) or pa.types.is_large_string(batch.column(c).type)
                if not text:
                    columns[c] = batch.column(c).to_numpy(zero_copy_only=False)
                elif pa.compute.any(pa.compute.not_equal(batch.column(c), "")).as_py():
                    columns[c] = batch.column(c)
        return Block(len(x), codes, kinds, columns)


def _runs(v: np.ndarray) -> np.ndarray | tuple:
    """Numbers with their lengths, where many equal ones follow each other."""
    start = np.flatnonzero(np.append(True, v[1:] != v[:-1])) if v.ndim == 1 and len(v) else np.zeros(0, np.int64)
    return (v[start], np.diff(start, append=len(v))) if 0 < 8 * len(start) <= len(v) else v


def trained_rows(fold: np.ndarray, without: int | None) -> list[slice]:
    """The rows of a block (ordered by fold) that a fit trains on; those of folds below 0 are in none."""
    begin, end = int(np.searchsorted(fold, 0)), len(fold)
    if without is None or without < 0:
        parts = [slice(begin, end)]
    else:
        parts = [slice(begin, int(np.searchsorted(fold, without))), slice(int(np.searchsorted(fold, without, "right")), end)]
    return [p for p in parts if p.stop > p.start]


class Blocks:
    """A table in blocks. ``low`` and ``high`` are the least and largest value in each slice of a feature,
    over all rows."""

    def __init__(self, rdd: RDD, edges: list[np.ndarray], low: list[np.ndarray], high: list[np.ndarray]):
        self.rdd, self.edges, self.low, self.high = rdd, edges, low, high

    @staticmethod
    def of(rows: DataFrame, edges: Sequence[Sequence[float]]) -> "Blocks":
        """``rows`` has the columns x (array<double>) and label; ``edges`` cut each feature into slices."""
        edges = [np.array(e, float) for e in edges]
        packed = rows.mapInArrow(_packer(edges), "block binary").rdd.map(lambda r: bytes(r[0]))
        rdd = packed.persist(StorageLevel.MEMORY_AND_DISK)

        def extremes(blocks: Iterator[bytes]):
            low, high = ([np.full(len(e) + 1, v) for e in edges] for v in (np.inf, -np.inf))
            for block in map(Block.unpacked, blocks):
                for f, code in enumerate(block.codes):
                    order = np.argsort(code >> 1, kind="stable")
                    at, v = (code >> 1)[order], block.values(f, order)
                    start = np.flatnonzero(np.append(True, at[1:] != at[:-1]))
                    low[f][at[start]] = np.minimum(low[f][at[start]], np.minimum.reduceat(v, start))
                    high[f][at[start]] = np.maximum(high[f][at[start]], np.maximum.reduceat(v, start))
            yield low, high

        found = rdd.mapPartitions(extremes).collect()
        none = [[np.full(len(e) + 1, v) for e in edges] for v in (np.inf, -np.inf)]
        low, high = ([reduce(op, [r[i][f] for r in found], none[i][f]) for f in range(len(edges))] for i, op in ((0, np.minimum), (1, np.maximum)))
        return Blocks(rdd, edges, low, high)

    def with_rdd(self, rdd: RDD) -> "Blocks":
        return Blocks(rdd, self.edges, self.low, self.high)

    @property
    def slices(self) -> list[int]:
        return [len(e) + 1 for e in self.edges]

    def each(self, run) -> RDD:
        """What ``run`` makes of the blocks of each task."""
        return self.rdd.mapPartitions(lambda blocks: run(map(Block.unpacked, blocks)))

    def changed(self, run) -> RDD:
        """The blocks as ``run`` changes them."""
        return self.rdd.map(lambda block: run(Block.unpacked(block)).packed())

    def release(self) -> None:
        self.rdd.unpersist()


def _packer(edges: list[np.ndarray]):
    def block(batches: list[pa.RecordBatch]) -> pa.RecordBatch:
        batch = pa.Table.from_batches(batches).combine_chunks().to_batches()[0]
        return pa.RecordBatch.from_pydict({"block": pa.array([Block.of(batch, edges).packed()], pa.binary())})

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            if batch.num_rows:
                held.append(batch)
                size += batch.num_rows
            if size >= BLOCK_ROWS:
                yield block(held)
                held, size = [], 0
        if held:
            yield block(held)

    return pack


def search(rows: DataFrame | Blocks, views: Views, rules: Sequence[Rule], edges: Sequence[Sequence[float]] = ()) -> tuple[list[Cut | None], list[Side | None]]:
    """The best cut of every node (None where no feature tells its rows apart), and what is in it.

    ``rows`` has the columns x (array<double>) and label and whatever ``views`` reads; a view numbers the
    nodes of ``rules`` and is negative where a row is in none. Rows that are not in blocks yet are put
    into some, with the coarse slices that ``edges`` cut. Tasks send histograms, whose size is bounded by
    the nodes searched together; the driver judges them.
    """
    blocks = rows if isinstance(rows, Blocks) else Blocks.of(rows, edges)
    try:
        together = max(1, CELLS_PER_PASS // sum(blocks.slices))
        states: list[_State] = []
        for start in range(0, len(rules), together):
            states += _search(blocks, _shifted(views, start, together), rules[start : start + together])
    finally:
        if blocks is not rows:
            blocks.release()
    return [s.best for s in states], [s.total for s in states]


def _shifted(views: Views, start: int, size: int) -> Views:
    def own(block):
        for rows, node, w, n in views(block):
            if np.ndim(node) == 0:
                if start <= node < start + size:
                    yield rows, node - start, w, n
                continue
            if len(node) and node.min() >= start and node.max() < start + size:
                yield rows, node - start if start else node, w, n
                continue
            mine = np.flatnonzero((node >= start) & (node < start + size))
            if len(mine):
                weight = w[mine]
                yield _places(rows)[mine], node[mine] - start, weight, weight if n is w else n[mine]

    return own


def _places(rows: np.ndarray | slice) -> np.ndarray:
    return np.arange(rows.start, rows.stop) if isinstance(rows, slice) else rows


def _search(blocks: Blocks, views: Views, rules: Sequence[Rule]) -> list[_State]:
    states = [_State() for _ in rules]
    pending = _coarsely(blocks, views, rules, states)
    by_magnitude = True  # passes take turns, so neither outliers nor many orders of magnitude stall
    while pending := [r for r in pending if states[r.node].beaten_by(r)]:
        some, pending = pending[: CELLS_PER_PASS // 2], pending[CELLS_PER_PASS // 2 :]
        exact = sum(r.size for r in some) <= EXACT_ROWS
        slices = None if exact else max(2, min(SLICES, CELLS_PER_PASS // len(some)))
        counted = blocks.each(_fine(views, some, len(rules), blocks.slices, slices, by_magnitude))
        found = _added([x for x in counted.collect()] if exact else [counted.treeReduce(lambda a, b: _added([a, b]))])
        pending += _judged(found, rules, states, some)
        by_magnitude = not by_magnitude
    borders = [(k, s.best.feature, i) for k, s in enumerate(states) if s.best is not None and s.best.slices for i in s.best.slices]
    seen = _extremes(blocks, views, len(rules), borders)
    for k, s in enumerate(states):
        if s.best is not None and s.best.slices:
            low, high = s.best.slices
            s.best = replace(s.best, low=seen[k, s.best.feature, low][1], high=seen[k, s.best.feature, high][0], slices=None)
    return states


def _coarsely(blocks: Blocks, views: Views, rules: Sequence[Rule], states: list[_State]) -> list[Range]:
    """The first pass: all nodes in the coarse slices."""
    nodes, width = len(rules), sum(blocks.slices)
    counted = blocks.each(_coarse(views, nodes, blocks.slices))
    few = counted.getNumPartitions() * nodes * width * 40 <= SENT_BYTES
    parts = counted.collect() if few else [counted.treeReduce(lambda a, b: tuple(x + y for x, y in zip(a, b)))]
    if not parts:
        return []
    w, n, size = (sum(x) for x in zip(*parts))
    w, n, size = (x.reshape(nodes, width, -1) for x in (w, n, size))
    feature = np.repeat(np.arange(len(blocks.slices)), blocks.slices)
    number = np.concatenate([np.arange(s) for s in blocks.slices])
    low, high = np.concatenate(blocks.low), np.concatenate(blocks.high)
    filled = [np.flatnonzero(s[:, 0]) for s in size]
    unclear = []  # does the only slice hold several of the node's values?
    for k, (rule, own) in enumerate(zip(rules, filled)):
        if rule.wanted is not None:
            once = np.flatnonzero(np.bincount(feature[own], minlength=len(blocks.slices)) == 1)
            unclear += [(k, int(feature[i]), int(number[i])) for i in own if feature[i] in once and low[i] < high[i]]
    seen = _extremes(blocks, views, nodes, unclear)
    out = []
    for k, own in enumerate(filled):
        if len(own):
            least, most = low[own], high[own]
            if seen:
                exact = [seen.get((k, f, i)) for f, i in zip(feature[own].tolist(), number[own].tolist())]
                least, most = (np.array([e[j] if e else v for e, v in zip(exact, x)]) for j, x in ((0, least), (1, most)))
            cell = [w[k, own, 0], w[k, own, 1], n[k, own].sum(axis=1), size[k, own, 0]]
            out += _judge(k, feature[own], np.zeros(len(own), np.int64), cell, least, most, rules[k], states[k], {}, number[own])
    return out


def _added(parts: list[tuple[np.ndarray, ...]]) -> tuple[np.ndarray, ...]:
    """Sums of what was counted of the same range and slice."""
    place, slice_, *sums, low, high = (np.concatenate(c) for c in zip(*parts))
    order = np.lexsort((slice_, place))
    place, slice_ = place[order], slice_[order]
    start = np.flatnonzero(np.append(True, (place[1:] != place[:-1]) | (slice_[1:] != slice_[:-1]))) if len(place) else np.zeros(0, np.int64)
    if not len(start):
        return place, slice_, *sums, low, high
    added = [np.add.reduceat(c[order], start) for c in sums]
    return place[start], slice_[start], *added, np.minimum.reduceat(low[order], start), np.maximum.reduceat(high[order], start)


def _judged(found: tuple[np.ndarray, ...], rules: Sequence[Rule], states: list[_State], ranges: list[Range]) -> list[Range]:
    """Moves the states on and returns the ranges that may hold a better cut."""
    place, _, *cell, low, high = found
    node, feature, number = (np.array([getattr(r, c) for r in ranges])[place] for c in ("node", "feature", "slice"))
    before, out = {i: r.before for i, r in enumerate(ranges)}, []
    order = np.lexsort((low, feature, node))
    for own in np.split(order, np.flatnonzero(np.diff(node[order])) + 1):
        if len(own):
            k = int(node[own[0]])
            out += _judge(k, feature[own], place[own], [c[own] for c in cell], low[own], high[own], rules[k], states[k], before, number[own], False)
    return out


def _judge(
    node: int, feature: np.ndarray, place: np.ndarray, cell: list[np.ndarray], low: np.ndarray, high: np.ndarray,
    rule: Rule, state: _State, before: dict[int, Side], number: np.ndarray, coarse: bool = True,
) -> list[Range]:
    """The best border between the slices of one node, and the slices that may hold a better cut. Slices are
    ordered by feature and value; of coarse ones ``low`` and ``high`` may be those of all nodes."""
    cell = [np.asarray(c, float) for c in cell]
    turn = np.concatenate([[True], (feature[1:] != feature[:-1]) | (place[1:] != place[:-1])])
    first = np.flatnonzero(turn)
    sizes = np.diff(np.append(first, len(feature)))
    upto = [running(x, first, sizes, False) for x in cell]
    for i, start in enumerate(first.tolist()):
        if (side := before.get(int(place[start]))) is not None:
            for x, add in zip(upto, (side.w0, side.w1, side.n, side.size)):
                x[start : start + sizes[i]] += add
    if state.total is None:  # the coarse slices of a feature hold all rows of the node
        end = sizes[0] - 1
        state.total = Side(*[float(x[end]) for x in upto[:2]], *[int(x[end]) for x in upto[2:]])
        if rule.wanted is not None:
            several = np.zeros(len(rule.wanted), bool)
            own = feature[first]
            several[own] = (sizes > 1) | (low[first] < high[first])
            state.look = np.flatnonzero(allowed(rule.wanted[None], several[None])[0])
    total, look = state.total, state.look
    seen = np.ones(len(feature), bool) if look is None else np.isin(feature, look)
    least, whole = max(1, rule.min_leaf), total.w0 + total.w1

    def scores(l0, l1):
        sides = impurity(l0, l1, rule.criterion) + impurity(np.maximum(total.w0 - l0, 0), np.maximum(total.w1 - l1, 0), rule.criterion)
        return sides / (whole if whole > 0 else 1.0)

    border = seen & np.append(~turn[1:], False) & (upto[2] >= least) & (total.n - upto[2] >= least)
    found = np.where(border, np.round(scores(upto[0], upto[1]), DIGITS), np.inf)
    at = int(found.argmin())
    if np.isfinite(found[at]):
        open_ = coarse and (low[at] < high[at] or low[at + 1] < high[at + 1])
        left = Side(*[float(x[at]) for x in upto[:2]], *[int(x[at]) for x in upto[2:]])
        cut = Cut(float(found[at]), int(feature[at]), float(high[at]), float(low[at + 1]), left, (int(number[at]), int(number[at + 1])) if open_ else None)
        if state.beaten_by(cut):
            state.best = cut
    best = state.best
    start = [x - c for x, c in zip(upto, cell)]
    corners = [scores(a, b) for a in (start[0], upto[0]) for b in (start[1], upto[1])]
    bound = np.round(np.minimum.reduce(corners) - 1e-12, DIGITS)
    inside = seen & (low < high) & (upto[2] - 1 >= least) & (total.n - start[2] - 1 >= least)
    if best is not None:
        earlier = (feature < best.feature) | ((feature == best.feature) & (low < best.low))
        inside &= (bound < best.score) | ((bound == best.score) & earlier)
    out = []
    for i in np.flatnonzero(inside).tolist():
        side = Side(float(start[0][i]), float(start[1][i]), int(round(start[2][i])), int(round(start[3][i])))
        out.append(Range(node, int(feature[i]), float(low[i]), float(high[i]), side, int(cell[3][i]), float(bound[i]), int(number[i])))
    return out


def _extremes(blocks: Blocks, views: Views, nodes: int, wanted: Sequence[tuple[int, int, int]]) -> dict[tuple[int, int, int], tuple[float, float]]:
    """Least and largest value of nodes' rows in some coarse slices, by (node, feature, slice)."""
    if not wanted:
        return {}
    open_ = _open(blocks.slices, nodes, wanted)
    keys = {f: np.array(sorted({k * blocks.slices[f] + s for k, g, s in wanted if g == f})) for f in {f for _, f, _ in wanted}}
    slices = blocks.slices

    def run(some: Iterator[Block]):
        low, high = {f: np.full(len(k), np.inf) for f, k in keys.items()}, {f: np.full(len(k), -np.inf) for f, k in keys.items()}
        for x, _, node, _, _, codes in _gathered(some, views, open_):
            for f, key in keys.items():
                own = node * slices[f] + (codes[:, f] >> 1)  # which of the wanted slices, if any
                at = np.minimum(np.searchsorted(key, own), len(key) - 1)
                mine = np.flatnonzero(key[at] == own)
                np.minimum.at(low[f], at[mine], x[mine, f])
                np.maximum.at(high[f], at[mine], x[mine, f])
        yield low, high

    parts = blocks.each(run).collect()
    out = {}
    for f, key in keys.items():
        low, high = reduce(np.minimum, [p[0][f] for p in parts]), reduce(np.maximum, [p[1][f] for p in parts])
        for k, a, b in zip(key.tolist(), low.tolist(), high.tolist()):
            out[k // slices[f], f, k % slices[f]] = (a, b)
    return out


# ---- task side -------------------------------------------------------------------------------


def matrix(rows: pa.Array) -> np.ndarray:
    flat = rows.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(rows), -1) if len(rows) else flat.reshape(0, 1)


def _open(slices: list[int], nodes: int, some: Sequence[tuple[int, int, int]]) -> dict[int, np.ndarray]:
    """Per feature with any, which codes of a block lie in some (node, feature, slice), [node, code]."""
    out = {}
    for k, f, s in some:
        out.setdefault(f, np.zeros((nodes, 2 * slices[f]), bool))[k, 2 * s : 2 * s + 2] = True
    return out


def _gathered(blocks: Iterator[Block], views: Views, open_: dict[int, np.ndarray]):
    """(values, label, node, weight, count, codes) of the rows of all views in open slices, many at a time."""
    held, size, anywhere = [], 0, {f: table.any(axis=0) for f, table in open_.items()}
    for block in blocks:
        some = np.flatnonzero(reduce(np.logical_or, [codes.take(block.codes[f]) for f, codes in anywhere.items()]))
        if not len(some):
            continue
        if len(some) < block.num_rows:
            block = block.take(some)
        for rows, node, w, n in views(block):
            codes = [c[rows] for c in block.codes]
            if np.ndim(node) == 0:
                inside = [table[node].take(codes[f]) for f, table in open_.items()]
            else:
                inside = [table.ravel().take(node * table.shape[1] + codes[f]) for f, table in open_.items()]
            mine = np.flatnonzero(reduce(np.logical_or, inside))
            if len(mine):
                at = _places(rows)[mine]
                x = np.stack([block.values(f, at) for f in range(len(codes))], axis=1)
                codes = np.stack([c[mine] for c in codes], axis=1)
                held.append((x, (codes[:, 0] & 1).astype(np.int64), node[mine] if np.ndim(node) else np.full(len(mine), node), w[mine], n[mine], codes))
                size += len(mine)
        if size >= FLUSH_ROWS:
            yield tuple(np.concatenate(c) for c in zip(*held))
            held, size = [], 0
    if held:
        yield tuple(np.concatenate(c) for c in zip(*held))


class _Table:
    """Sums per cell."""

    def __init__(self, cells: int):
        self.w, self.n, self.size = np.zeros(2 * cells), np.zeros(cells), np.zeros(cells)
        self.low, self.high = np.full(cells, np.inf), np.full(cells, -np.inf)

    def add(self, at, x, y, w, n) -> None:
        self.w += np.bincount(2 * at + y, weights=w, minlength=len(self.w))
        self.n += np.bincount(at, weights=n, minlength=len(self.n))
        self.size += np.bincount(at, minlength=len(self.size))
        np.minimum.at(self.low, at, x)
        np.maximum.at(self.high, at, x)

    def used(self) -> tuple[np.ndarray, list[np.ndarray]]:
        at = np.flatnonzero(self.size)
        return at, [self.w[2 * at], self.w[2 * at + 1], self.n[at], self.size[at], self.low[at], self.high[at]]


def _coarse(views: Views, nodes: int, slices: list[int]):
    """Every feature of every node in coarse slices: weights and counts per (node, slice, label), rows per
    (node, slice)."""
    begin, width = np.cumsum([0, *slices]), sum(slices)

    def count(blocks: Iterator[Block]):
        w_sums, n_sums, sizes = np.zeros((nodes, 2 * width)), np.zeros((nodes, 2 * width)), np.zeros((nodes, width))
        for block in blocks:
            for rows, node, w, n in views(block):
                if not len(w):
                    continue
                one = np.ndim(node) == 0
                low, high = (int(node), int(node) + 1) if one else (int(node.min()), int(node.max()) + 1)
                own = None if one or high - low == 1 else (node - low).astype(np.int64)
                once = bool((n == 1).all())
                for f, s in enumerate(slices):
                    code = block.codes[f][rows]
                    at = code.astype(np.int64) if own is None else own * (2 * s) + code
                    cells = slice(2 * begin[f], 2 * begin[f + 1])
                    added = np.bincount(at, weights=w, minlength=2 * s * (high - low)).reshape(high - low, -1)
                    w_sums[low:high, cells] += added
                    if w is not n:
                        added = np.bincount(at, weights=None if once else n, minlength=2 * s * (high - low)).reshape(high - low, -1)
                    n_sums[low:high, cells] += added
                    if not once:
                        added = np.bincount(at, minlength=2 * s * (high - low)).reshape(high - low, -1)
                    sizes[low:high, begin[f] : begin[f + 1]] += added[:, 0::2] + added[:, 1::2]
        yield w_sums, n_sums, sizes

    return count


def _fine(views: Views, ranges: list[Range], nodes: int, coarse: list[int], slices: int | None, by_magnitude: bool):
    """The open ranges, in slices or value by value (``slices`` None)."""
    finders = [_Finder(ranges, f, nodes) for f in sorted({r.feature for r in ranges})]
    low, high = np.array([r.low for r in ranges]), np.array([r.high for r in ranges])
    open_ = _open(coarse, nodes, [(r.node, r.feature, r.slice) for r in ranges])

    def count(blocks: Iterator[Block]):
        table, found = _Table(len(ranges) * slices) if slices else None, []
        for x, y, node, w, n, _ in _gathered(blocks, views, open_):
            for finder in finders:
                v = x[:, finder.feature]
                at = finder.range_of(node, v)
                mine = np.flatnonzero(at >= 0)
                at, v = at[mine], v[mine]
                if slices:
                    table.add(at * slices + slice_of(v, low[at], high[at], slices, by_magnitude), v, y[mine], w[mine], n[mine])
                elif len(at):
                    ones = w[mine] * y[mine]
                    found.append(_added([(at, v, w[mine] - ones, ones, n[mine].astype(float), np.ones(len(at)), v, v)]))
        if slices:
            at, sums = table.used()
            found.append((at // slices, (at % slices).astype(float), *sums))
        yield _added(found) if found else (np.zeros(0, np.int64), *[np.zeros(0)] * 7)

    return count


class _Finder:
    """Finds the open range of a feature that a row's value lies in."""

    def __init__(self, ranges: list[Range], feature: int, nodes: int):
        own = sorted((r.node, r.low, r.high, i) for i, r in enumerate(ranges) if r.feature == feature)
        self.feature, self.ids = feature, np.array([i for *_, i in own])
        self.starts = np.unique([low for _, low, _, _ in own])
        self.node = np.array([node for node, *_ in own])
        self.low, self.high = np.array([low for _, low, _, _ in own]), np.array([high for _, _, high, _ in own])
        self.key = self.node * (len(self.starts) + 1) + np.searchsorted(self.starts, self.low, "right")

    def range_of(self, node: np.ndarray, v: np.ndarray) -> np.ndarray:
        key = node * (len(self.starts) + 1) + np.searchsorted(self.starts, v, "right")
        at = np.searchsorted(self.key, key, "right") - 1  # the last range of the node that begins at or below v
        held = np.maximum(at, 0)
        inside = (at >= 0) & (self.node[held] == node) & (v >= self.low[held]) & (v <= self.high[held])
        return np.where(inside, self.ids[held], -1)


def slice_of(v: np.ndarray, low: np.ndarray, high: np.ndarray, slices: int, by_magnitude: bool) -> np.ndarray:
    """Number of the slice of [low, high] that holds v; low is in the first, high in the last. Slices are
    equally wide in the value (halves keep the width finite) or in its magnitude."""
    given, given_low = v, low
    if by_magnitude:
        v, low, high = _magnitude(v), _magnitude(low), _magnitude(high)
    width = high / 2 - low / 2
    share = np.where(width > 0, (v / 2 - low / 2) / np.where(width > 0, width, 1.0), given > given_low)
    return np.clip(np.floor(share * slices), 0, slices - 1).astype(np.int64)


def _magnitude(v: np.ndarray) -> np.ndarray:
    """Ascending in v: the binary logarithm with the sign of v, lifted above that of any double."""
    size = np.abs(v)
    return np.sign(v) * np.where(size > 0, np.log2(np.where(size > 0, size, 1.0)) + 1100, 0.0)
