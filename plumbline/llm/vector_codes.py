"""Vector code compression: product codes whose nearest entries are found in a GNAT over the entries.

A vector becomes integers, is cut into parts, and each part is replaced by the number of its nearest
entry in the codebook of its position. The entries of a codebook stand in a geometric near-neighbour
access tree: a node holds split points, every entry below goes to the child of its nearest split
point, and for every split point and child the node stores the range of distances from the split point
to the child's entries. A query that is strictly farther from such a range than its best entry so far
cannot have a nearer or equally near entry in that child, so the whole subtree is left out. Distances
are compared as rounded roots with room for their error; nearest entries and ties are decided on
exact integers.
"""

from __future__ import annotations

import hashlib
import math
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.llm.tables import written
from plumbline.session import share

PARTS = 16
ENTRIES = 64
ROUNDS = 2
SCALE = 256
SPLITS = 6  # split points of a GNAT node
BUCKET = 8  # entries that need no further node
ROUND_OFF = 1e-12  # far above the relative error of a root in double precision, far below any gap
ROWS = 4096  # vectors looked up side by side
BROADCAST_LABELS = 200_000  # label sums that are broadcast; more are joined


@dataclass
class Node:
    """``entries`` are a bucket, or the split points of an inner node with its distance ranges."""

    entries: np.ndarray
    children: list["Node | None"] = field(default_factory=list)
    low: np.ndarray | None = None  # [child, split point]
    high: np.ndarray | None = None


class Gnat:
    """Nearest entries of a codebook ([entry, position] integers), ties to the lower number."""

    def __init__(self, entries: np.ndarray):
        self.points = entries.astype(np.int64)
        self.root = self._node(np.arange(len(entries)))

    def _node(self, mine: np.ndarray) -> Node:
        if len(mine) <= BUCKET:
            return Node(mine)
        chosen = [0]  # the first entry, then always the one farthest from those chosen
        gap = _squared(self.points[mine], self.points[mine[:1]])[:, 0]
        while len(chosen) < SPLITS and gap.max() > 0:
            chosen.append(int(gap.argmax()))
            gap = np.minimum(gap, _squared(self.points[mine], self.points[mine[chosen[-1:]]])[:, 0])
        if len(chosen) == 1:
            return Node(mine)  # equal entries
        splits = mine[chosen]
        distance = np.sqrt(_squared(self.points[mine], self.points[splits]).astype(np.float64))
        owner = distance.argmin(axis=1)
        rest = np.ones(len(mine), bool)
        rest[chosen] = False
        low, high, children = np.full((len(splits),) * 2, np.inf), np.full((len(splits),) * 2, -np.inf), []
        for j in range(len(splits)):
            own = rest & (owner == j)
            children.append(self._node(mine[own]) if own.any() else None)
            if own.any():
                low[j], high[j] = distance[own].min(axis=0) * (1 - ROUND_OFF), distance[own].max(axis=0) * (1 + ROUND_OFF)
        return Node(splits, children, low, high)

    def nearest(self, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(entry, squared distance) of each query row."""
        best = np.full(len(queries), np.iinfo(np.int64).max)
        entry = np.full(len(queries), len(self.points))
        self._visit(self.root, np.arange(len(queries)), queries, best, entry)
        return entry, best

    def _visit(self, node: Node, rows: np.ndarray, queries: np.ndarray, best: np.ndarray, entry: np.ndarray) -> None:
        squared = _squared(queries[rows], self.points[node.entries])
        at = squared.argmin(axis=1)  # entries ascend in buckets; split points do not
        least = squared[np.arange(len(rows)), at]
        number = node.entries[at]
        if node.children:
            number = np.where(squared == least[:, None], node.entries, len(self.points)).min(axis=1)
        better = (least < best[rows]) | ((least == best[rows]) & (number < entry[rows]))
        best[rows[better]], entry[rows[better]] = least[better], number[better]
        if not node.children:
            return
        distance = np.sqrt(squared.astype(np.float64))
        for own in (True, False):  # first below the nearest split point, where the best shrinks fastest
            for j, child in enumerate(node.children):
                if child is None:
                    continue
                some = np.flatnonzero((at == j) == own)
                reach = np.sqrt(best[rows[some]].astype(np.float64)) * (1 + ROUND_OFF)
                near = distance[some] * (1 - ROUND_OFF) - reach[:, None] <= node.high[j]
                near &= distance[some] * (1 + ROUND_OFF) + reach[:, None] >= node.low[j]
                some = some[near.all(axis=1)]
                if len(some):
                    self._visit(child, rows[some], queries, best, entry)


def _squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    out = np.zeros((len(a), len(b)), np.int64)
    for k in range(a.shape[1]):
        gap = a[:, k, None] - b[None, :, k]
        out += gap * gap
    return out


@dataclass(frozen=True)
class Codebooks:
    """Entries per part position; positions of a part that the vector lacks do not exist."""

    entries: list[np.ndarray] = field(repr=False)

    @staticmethod
    def cuts(width: int, parts: int) -> list[int]:
        return [width * k // parts for k in range(parts + 1)]

    def sha256(self) -> str:
        numbers = ",".join(str(x) for part in self.entries for x in part.ravel().tolist())
        return hashlib.sha256(numbers.encode()).hexdigest()


def component_limit(width: int) -> int:
    """Components stop at this absolute value, so that no squared distance or sum of them leaves 64 bits."""
    return 1 << min(30, (62 - max(1, width).bit_length()) // 2 - 1)


def integers(vector: str, scale: int, limit: int) -> Column:
    """floor(scale * x) of every component; NULL if the vector or a component is none or not finite."""
    x = F.col(f"`{vector}`").cast("array<double>")
    bad = F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == math.inf))
    return F.when(~bad, F.transform(x, lambda v: F.floor(F.least(F.greatest(v * scale, F.lit(-float(limit))), F.lit(float(limit))))))


def encode(
    vectors: DataFrame,
    id: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    parts: int = PARTS,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
    scale: int = SCALE,
) -> tuple[DataFrame, Codebooks]:
    """((id, label, code, error, label_error), codebooks) of the rows whose vector is whole and finite.

    - Rows with a NULL vector, or a NULL or non-finite component, are dropped. So are vectors of another
      length than that of the smallest kept id (the shortest, where rows share it).
    - A codebook starts with the vectors of the ``entries`` smallest different ids, ascending, NULL ids
      last; of rows that share an id the least vector counts. With fewer ids it has fewer entries.
    - Ties go to the lower entry. Repeated rows are coded one by one, alike, and each counts in means.
    - A length that the number of parts does not divide is cut as evenly as whole numbers allow; parts
      without positions have code 00.
    - Components stop at ``component_limit`` (2^27 for 64 of them).
    - Rows with NULL labels share one sum. ``label_error`` is NULL where a sum exceeds 64 bits.
    - An empty table gives an empty one and no codebooks. Other columns do not come along.

    A pass over the table for each round and one for the codes; tasks send sums of their parts. What
    the driver holds is one set of codebooks, whatever the number of rows.
    """
    spark = vectors.sparkSession
    width = F.size(F.col(f"`{vector}`"))
    lengths = vectors.where(integers(vector, scale, 1).isNotNull()).select(F.col(f"`{id}`").alias("id"), width.alias("width"))
    if (first := lengths.orderBy(F.asc_nulls_last("id"), "width").first()) is None:
        empty = vectors.select(F.col(f"`{id}`").alias(id), F.col(f"`{label}`").alias(label)).where(F.lit(False))
        return empty.select("*", F.lit("").alias("code"), F.lit(0).cast("long").alias("error"), F.lit(0).cast("long").alias("label_error")), Codebooks([])
    size = first["width"]
    q = integers(vector, scale, component_limit(size))
    kept = vectors.select(F.col(f"`{id}`").alias("id"), F.col(f"`{label}`").alias("label"), q.alias("q")).where(q.isNotNull() & (width == size))
    cuts = Codebooks.cuts(size, parts)
    books = _cut(_starts(kept, entries), cuts)
    for _ in range(rounds):
        books = _improved(kept, books, cuts)
    coded = written(_coded(kept, books, cuts), "codes")
    errors = coded.groupBy("label").agg(F.try_sum("error").alias("label_error"))
    errors = written(errors.withColumnRenamed("label", "of_label"), "label-errors")
    if errors.count() <= BROADCAST_LABELS:
        errors = F.broadcast(errors)
    out = coded.join(errors, F.col("label").eqNullSafe(F.col("of_label")), "left")
    return out.select(F.col("id").alias(id), F.col("label").alias(label), "code", "error", "label_error"), Codebooks(books)


def _cut(whole: np.ndarray, cuts: list[int]) -> list[np.ndarray]:
    return [np.ascontiguousarray(whole[:, a:b]) for a, b in zip(cuts, cuts[1:])]


def _starts(kept: DataFrame, entries: int) -> np.ndarray:
    """The least vectors of the smallest ids: every task names its own, few enough to be sorted."""
    schema = kept.select("id", "q").schema

    def smallest(batches):
        found: dict = {}
        for batch in batches:
            ids = batch.column(0).to_pylist()
            known = sorted({_order(i) for i in [*ids, *found]})
            last = known[: entries][-1] if known else None
            mine = [i for i, x in enumerate(ids) if _order(x) <= last]
            for i, q in zip(mine, batch.column(1).take(pa.array(mine, pa.int64())).to_pylist()):
                if ids[i] not in found or q < found[ids[i]]:
                    found[ids[i]] = q
            found = {x: q for x, q in found.items() if _order(x) <= last}
        yield pa.RecordBatch.from_arrays([pa.array(list(found), to_arrow(0)), pa.array(list(found.values()), to_arrow(1))], names=["id", "q"])

    def to_arrow(i):
        from pyspark.sql.pandas.types import to_arrow_schema

        return to_arrow_schema(schema).types[i]

    named = kept.select("id", "q").mapInArrow(smallest, schema).groupBy("id").agg(F.min("q").alias("q"))
    rows = named.orderBy(F.asc_nulls_last("id")).limit(entries).collect()
    return np.array([r["q"] for r in rows], np.int64).reshape(len(rows), -1)


def _order(value) -> tuple:
    return value is None, value if value is not None else 0


def _nearest(trees: list[Gnat], vectors: np.ndarray, cuts: list[int]):
    """(entries, squared distances), [row, part]."""
    found = [t.nearest(vectors[:, a:b]) for t, a, b in zip(trees, cuts, cuts[1:])]
    return np.stack([f[0] for f in found], axis=1), np.stack([f[1] for f in found], axis=1)


def _vectors(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(column), -1)


def _blocks(batches):
    for batch in batches:
        for start in range(0, batch.num_rows, ROWS):
            yield batch.slice(start, ROWS)


def _improved(kept: DataFrame, books: list[np.ndarray], cuts: list[int]) -> list[np.ndarray]:
    """Each entry replaced by the rounded-down mean of its parts; unused entries stay."""
    n, size = len(books[0]), cuts[-1]
    shared = share(kept.sparkSession, books)

    def sums(batches):
        trees = [Gnat(b) for b in shared.value]
        total, count = np.zeros((n, size), np.int64), np.zeros((n, len(trees)), np.int64)
        for batch in _blocks(batches):
            vectors = _vectors(batch.column(0))
            entry, _ = _nearest(trees, vectors, cuts)
            for p, (a, b) in enumerate(zip(cuts, cuts[1:])):
                count[:, p] += np.bincount(entry[:, p], minlength=n)
                np.add.at(total[:, a:b], entry[:, p], vectors[:, a:b])
        flat = np.concatenate([total.ravel(), count.ravel()])
        used = np.flatnonzero(flat)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int64()), pa.array(flat[used], pa.int64())], names=["slot", "total"])

    added = kept.select("q").mapInArrow(sums, "slot bigint, total bigint").groupBy("slot").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total"))
    flat = [0] * (n * (size + len(books)))
    for r in added.collect():  # one number per component of the codebooks
        flat[r["slot"]] = int(r["total"])
    out = []
    for p, (a, b) in enumerate(zip(cuts, cuts[1:])):
        new = books[p].copy()
        for e in range(n):
            used = flat[n * size + e * len(books) + p]
            if used:
                new[e] = [flat[e * size + k] // used for k in range(a, b)]
        out.append(new)
    return out


def _coded(kept: DataFrame, books: list[np.ndarray], cuts: list[int]) -> DataFrame:
    shared = share(kept.sparkSession, books)
    width = max(2, -(-(len(books[0]) - 1).bit_length() // 4))  # hex digits of an entry

    def code(batches):
        trees = [Gnat(b) for b in shared.value]
        digits = [format(i, f"0{width}x") for i in range(len(trees[0].points))]
        for batch in _blocks(batches):
            entry, squared = _nearest(trees, _vectors(batch.column(2)), cuts)
            text = ["".join([digits[i] for i in row]) for row in entry.tolist()]
            columns = [batch.column(0), batch.column(1), pa.array(text, pa.string()), pa.array(squared.sum(axis=1), pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=["id", "label", "code", "error"])

    schema = kept.select("id", "label").schema.add("code", "string").add("error", "long")
    return kept.select("id", "label", "q").mapInArrow(code, schema)


def decode(codes: DataFrame, books: Codebooks, code: str = "code", output: str = "vector", scale: int = SCALE) -> DataFrame:
    """``codes`` with the vector that each code stands for: its entries side by side, divided by ``scale``.
    A NULL code has a NULL vector; other columns pass through, one named ``output`` is replaced."""
    width = max(2, -(-(len(books.entries[0]) - 1).bit_length() // 4)) if books.entries else 2
    text, out = F.col(f"`{code}`"), F.array().cast("array<double>")
    for p, part in enumerate(books.entries):
        rows = F.lit((part / scale).tolist()).cast("array<array<double>>") if part.size else F.lit([[] for _ in part]).cast("array<array<double>>")
        at = F.conv(F.substring(text, p * width + 1, width), 16, 10).cast("int")
        out = F.concat(out, F.element_at(rows, at + 1))
    return codes.withColumn(output, out)
