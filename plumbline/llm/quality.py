"""Quality classifier: a generalised additive model with pairwise interactions on features of the text.

Every feature is cut into quantile bins. Boosting goes round the features: in turn each gets a shallow
tree on the present gradients, whose leaves are added, slowed down, to the feature's look-up table. Then
the pairs of features whose joint tree lowers the loss most get two-dimensional tables in the same way.
A score is the sigmoid of the sum of table entries, so scoring is one addition per bin.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Sequence
from dataclasses import dataclass, field
from itertools import combinations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.llm.tables import fresh, map_pieces
from plumbline.session import share

SAMPLE_ROWS = 20_000  # labelled rows that the model is fitted on
BINS = 32
PAIR_BINS = 8
ROUNDS = 120  # times round the features
PAIR_ROUNDS = 60  # times round the pairs
PAIRS = 6
LEAVES = 3  # of a tree on one feature
RATE = 0.1
SMOOTHING = 1.0  # added to a leaf's curvature
GOOD = 0.7  # fixed value: from this score on a document counts as good

FEATURES = (
    "log_chars", "log_words", "word_length", "long_words", "upper_share", "digit_share", "sign_share", "space_share", "beyond_ascii_share",
    "byte_entropy", "distinct_words", "top_word_share", "distinct_pairs", "plain_words", "capital_words", "stops_per_word", "log_lines",
    "distinct_lines", "line_length", "repeated_signs",
)

_UPPER, _DIGIT, _SIGN, _SPACE = (np.zeros(256, bool) for _ in range(4))
_UPPER[65:91] = True
_DIGIT[48:58] = True
_SIGN[33:127] = True
_SIGN[[*range(48, 58), *range(65, 91), *range(97, 123)]] = False
_SPACE[[*range(9, 14), 32]] = True
_STOP = re.compile(r"[.!?](?=\s|$)")


def features(text: str | None) -> list[float]:
    """The FEATURES of a whole text; a NULL text is an empty one."""
    text = text or ""
    raw = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    n = max(1, len(raw))
    counts = np.bincount(raw, minlength=256)
    share = counts[counts > 0] / n
    signs = _SIGN[raw]
    words = text.split()
    n_words = max(1, len(words))
    seen = Counter(words)
    lines = [x for x in text.split("\n") if x.strip()]
    n_lines = max(1, len(lines))
    return [
        math.log1p(len(text)),
        math.log1p(len(words)),
        sum(map(len, words)) / n_words,
        sum(1 for w in words if len(w) > 15) / n_words,
        counts[_UPPER].sum() / n,
        counts[_DIGIT].sum() / n,
        counts[_SIGN].sum() / n,
        counts[_SPACE].sum() / n,
        counts[128:].sum() / n,
        float(-(share * np.log2(share)).sum()),
        len(seen) / n_words,
        max(seen.values(), default=0) / n_words,
        len(set(zip(words, words[1:]))) / max(1, len(words) - 1),
        sum(k for w, k in seen.items() if w.isalpha()) / n_words,
        sum(k for w, k in seen.items() if w[0].isupper()) / n_words,
        len(_STOP.findall(text)) / n_words,
        math.log1p(len(lines)),
        len(set(lines)) / n_lines,
        math.log1p(len(text) / n_lines),
        int((signs[1:] & (raw[1:] == raw[:-1])).sum()) / n,
    ]


@dataclass(frozen=True)
class Additive:
    """Look-up tables over bins: one per feature, and one per pair over coarser bins."""

    edges: list[np.ndarray] = field(repr=False)  # per feature; a value's bin is the number of edges it reaches
    coarse: list[np.ndarray] = field(repr=False)
    base: float = 0.0
    tables: list[np.ndarray] = field(default_factory=list, repr=False)
    pairs: list[tuple[int, int]] = field(default_factory=list)
    pair_tables: list[np.ndarray] = field(default_factory=list, repr=False)

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of label 1 of each row of features."""
        total = np.full(len(x), self.base)
        for f, table in enumerate(self.tables):
            total += table[np.searchsorted(self.edges[f], x[:, f], "right")]
        at = {f: np.searchsorted(self.coarse[f], x[:, f], "right") for pair in self.pairs for f in pair}
        for (f, g), table in zip(self.pairs, self.pair_tables):
            total += table[at[f], at[g]]
        return 1 / (1 + np.exp(-total))


def quantile_edges(values: np.ndarray, bins: int) -> np.ndarray:
    """At most ``bins`` - 1 different values that cut the column into bins of about equal size."""
    ordered = np.sort(values)
    at = np.unique(ordered[[len(ordered) * k // bins for k in range(1, bins)]]) if len(ordered) else ordered
    return at[at > ordered[0]] if len(ordered) else at


def fit_additive(x: np.ndarray, y: np.ndarray) -> Additive:
    """The model of some labelled rows. With labels of one kind, or none, all tables are empty and the
    score is the smoothed share of label 1."""
    width = x.shape[1]
    share = (y.sum() + 1) / (len(y) + 2)
    edges = [quantile_edges(x[:, f], BINS) for f in range(width)]
    coarse = [quantile_edges(x[:, f], PAIR_BINS) for f in range(width)]
    base = math.log(share / (1 - share))
    if len(np.unique(y)) < 2:
        return Additive(edges, coarse, base)
    bins = [np.searchsorted(e, x[:, f], "right") for f, e in enumerate(edges)]
    tables = [np.zeros(len(e) + 1) for e in edges]
    total = np.full(len(y), base)
    for _ in range(ROUNDS):
        for f in range(width):
            slope, curve = _sums(total, y, bins[f], len(tables[f]))
            step = RATE * shallow_tree(slope, curve)
            tables[f] += step
            total += step[bins[f]]
    rough = [np.searchsorted(e, x[:, f], "right") for f, e in enumerate(coarse)]
    shapes = {(f, g): (len(coarse[f]) + 1, len(coarse[g]) + 1) for f, g in combinations(range(width), 2)}
    joint = {(f, g): rough[f] * shape[1] + rough[g] for (f, g), shape in shapes.items()}
    found = []
    for pair, shape in shapes.items():
        sums = [s.reshape(shape) for s in _sums(total, y, joint[pair], shape[0] * shape[1])]
        gain, _ = cross_tree(*sums)
        found.append((-gain, pair))
    pairs = [pair for gain, pair in sorted(found)[:PAIRS] if gain < 0]
    pair_tables = [np.zeros(shapes[p]) for p in pairs]
    for _ in range(PAIR_ROUNDS):
        for pair, table in zip(pairs, pair_tables):
            sums = [s.reshape(table.shape) for s in _sums(total, y, joint[pair], table.size)]
            step = RATE * cross_tree(*sums)[1]
            table += step
            total += step.ravel()[joint[pair]]
    return Additive(edges, coarse, base, tables, pairs, pair_tables)


def _sums(total: np.ndarray, y: np.ndarray, at: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Slope and curvature of the logistic loss per bin."""
    p = 1 / (1 + np.exp(-total))
    return np.bincount(at, y - p, size), np.bincount(at, p * (1 - p), size)


def _value(slope, curve):
    return slope * slope / (curve + SMOOTHING)


def shallow_tree(slope: np.ndarray, curve: np.ndarray) -> np.ndarray:
    """Newton steps of a tree of at most LEAVES leaves over ordered bins, cut where the loss falls most."""
    left, below = np.concatenate([[0], np.cumsum(slope)]), np.concatenate([[0], np.cumsum(curve)])
    parts = [(0, len(slope))]
    while len(parts) < LEAVES:
        best = (1e-9, None, None)
        for k, (a, b) in enumerate(parts):
            if b - a < 2:
                continue
            cut = np.arange(a + 1, b)
            whole = _value(left[b] - left[a], below[b] - below[a])
            gain = _value(left[cut] - left[a], below[cut] - below[a]) + _value(left[b] - left[cut], below[b] - below[cut]) - whole
            if gain.max() > best[0]:
                best = (gain.max(), k, int(cut[gain.argmax()]))
        if best[1] is None:
            break
        a, b = parts.pop(best[1])
        parts += [(a, best[2]), (best[2], b)]
    step = np.zeros(len(slope))
    for a, b in parts:
        step[a:b] = (left[b] - left[a]) / (below[b] - below[a] + SMOOTHING)
    return step


def cross_tree(slope: np.ndarray, curve: np.ndarray) -> tuple[float, np.ndarray]:
    """(fall of the loss, Newton steps) of the best tree with one cut on either axis over joint bins."""
    if min(slope.shape) < 2:
        return 0.0, np.zeros(slope.shape)
    corner, under = slope.cumsum(0).cumsum(1), curve.cumsum(0).cumsum(1)
    i, j = np.meshgrid(np.arange(slope.shape[0] - 1), np.arange(slope.shape[1] - 1), indexing="ij")

    def quarters(c):
        return c[i, j], c[i, -1] - c[i, j], c[-1, j] - c[i, j], c[-1, -1] - c[i, -1] - c[-1, j] + c[i, j]

    s, h = quarters(corner), quarters(under)
    gain = sum(_value(a, b) for a, b in zip(s, h)) - _value(corner[-1, -1], under[-1, -1])
    at = np.unravel_index(gain.argmax(), gain.shape)
    step = np.zeros(slope.shape)
    rows, columns = np.arange(slope.shape[0]) > at[0], np.arange(slope.shape[1]) > at[1]
    for k, (r, c) in enumerate(((~rows, ~columns), (~rows, columns), (rows, ~columns), (rows, columns))):
        step[np.ix_(r, c)] = s[k][at] / (h[k][at] + SMOOTHING)
    return float(gain[at]), step


def fit(docs: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text", label: str = "quality", sample_rows: int = SAMPLE_ROWS) -> Additive:
    """A model of the documents that ``labels`` marks 0 or 1, of at most ``sample_rows`` of them, chosen by
    a hash of their ids; the documents' features alone come to the driver.

    - Labels that are NULL, or neither 0 nor 1, or whose id is NULL or no document's, are left out.
    - Repeated label rows count once; a document labelled both ways counts on both sides. Repeated
      documents count one by one, within the bound.
    - Without labels, or with labels of one kind, the score is the same for all texts.
    """
    spark_label = F.col(f"`{label}`").cast("int").alias("__y")
    known = labels.select(F.col(f"`{id}`").alias("__id"), spark_label).where(F.col("__id").isNotNull() & F.col("__y").isin(0, 1)).distinct()
    order = [F.xxhash64("__id"), F.col("__id"), F.col("__y")]
    chosen = known.orderBy(*order).limit(sample_rows)  # this bounds the broadcast
    own = docs.select(F.col(f"`{id}`").alias("__id"), F.col(f"`{text}`").alias("__text"))
    labelled = own.join(F.broadcast(chosen), "__id").select("__id", "__text", "__y")
    rows = with_features(labelled, text="__text", output="__x").select("__id", "__y", "__x")
    rows = rows.orderBy(*order, "__x").limit(sample_rows).select("__y", "__x").collect()
    x = np.array([r["__x"] for r in rows], float).reshape(len(rows), len(FEATURES))
    return fit_additive(x, np.array([r["__y"] for r in rows], float))


def with_features(docs: DataFrame, text: str = "text", output: str = "features") -> DataFrame:
    """``docs`` without the column ``text``, with its features (array<double>, in the order of FEATURES)."""
    keep = [c for c in docs.columns if c != text]
    return map_pieces(docs, lambda texts: ([features(t) for t in texts],), [text], {output: "array<double>"}, keep)


def with_scores(docs: DataFrame, model: Additive, text: str = "text", output: str | None = None) -> DataFrame:
    """``docs`` with the probability (double) that a text is labelled 1, from the whole text.

    - A NULL text is scored as the empty one. Texts may have any length; repeated rows score alike.
    - An empty table gives an empty table; other columns pass through, whatever their names. A column
      already named ``output`` is replaced.
    """
    shared = share(docs.sparkSession, model)
    name = output or fresh(docs, "score")[0]

    def score(texts: Sequence[str | None]):
        return (shared.value.score(np.array([features(t) for t in texts], float)),)

    return map_pieces(docs, score, [text], {name: "double"})
