"""Document fingerprints by winnowing.

Every run of ``gram`` code points has a rolling hash; of every ``window`` consecutive hashes the
smallest is chosen, the rightmost of equal ones. Two texts that share ``gram + window - 1`` code
points in a row share a chosen hash, and the positions tell where.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.llm.tables import map_pieces, pieces

GRAM = 20
WINDOW = 45  # with GRAM: any 64 code points in a row that two texts share are found

_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_MIX = np.uint64(0xD6E8FEB86659FD93)
_LOW = np.uint64(0xFFFFFFFF)


class Winnower:
    """Chosen hashes of texts; keeps the powers of the rolling hash."""

    def __init__(self, gram: int = GRAM, window: int = WINDOW):
        self.gram, self.window = gram, window
        self.powers = self.inverses = np.ones(1, np.uint64)

    def __getstate__(self):
        return self.gram, self.window

    def __setstate__(self, state):
        self.__init__(*state)

    def _grow(self, n: int) -> None:
        if len(self.powers) < n:
            for name, base in (("powers", _BASE), ("inverses", _INVERSE)):
                steps = np.full(2 * n, base, np.uint64)
                steps[0] = 1
                setattr(self, name, np.multiply.accumulate(steps))

    def sums(self, symbols: np.ndarray) -> np.ndarray:
        """Running sums from which ``between`` reads the hash of any stretch."""
        n = len(symbols)
        self._grow(n + 1)
        out = np.zeros(n + 1, np.uint64)
        np.cumsum((symbols.astype(np.uint64) + np.uint64(1)) * self.powers[:n], out=out[1:])
        return out

    def between(self, sums: np.ndarray, start: np.ndarray | slice, end: np.ndarray | slice) -> np.ndarray:
        """64-bit hashes of the stretches from ``start`` to ``end``."""
        return (sums[end] - sums[start]) * self.inverses[start] * _MIX

    def minima(self, hashes: np.ndarray) -> np.ndarray:
        """Position of the smallest upper half of a hash in every window, the rightmost of equal ones;
        in all hashes if they are fewer than a window."""
        n, w = len(hashes), self.window
        keys = (hashes >> np.uint64(32)) << np.uint64(32) | (_LOW - np.arange(n, dtype=np.uint64))  # of equal hashes the last is smallest
        if n <= w:
            least = keys.min(keepdims=True)
        else:
            padded = np.full(-(-n // w) * w, np.iinfo(np.uint64).max, np.uint64)
            padded[:n] = keys
            rows = padded.reshape(-1, w)
            upto = np.minimum.accumulate(rows, axis=1).reshape(-1)
            onward = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].reshape(-1)
            least = np.minimum(onward[: n - w + 1], upto[w - 1 : n])
        return (_LOW - (least & _LOW)).astype(np.int64)

    def choose(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """(32-bit hashes, positions) chosen, in order of position. A text shorter than a gram is one."""
        codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
        n = len(codes)
        if not n:
            return np.zeros(0, np.uint32), np.zeros(0, np.int64)
        gram, sums = min(self.gram, n), self.sums(codes)
        hashes = self.between(sums, slice(0, n - gram + 1), slice(gram, n + 1))
        chosen = self.minima(hashes)
        chosen = chosen[np.concatenate([[True], chosen[1:] != chosen[:-1]])]
        return (hashes[chosen] >> np.uint64(32)).astype(np.uint32), chosen


class Chosen:
    """What winnowing keeps of a text: its different hashes, and where the first of each lies."""

    def __init__(self, winnower: Winnower, text: str):
        self.text, self.gram = text, winnower.gram
        self.values, self.positions = winnower.choose(text)
        self.different, first = np.unique(self.values, return_index=True)
        self.first = self.positions[first]


def likeness(a: Chosen, b: Chosen) -> float:
    """Jaccard likeness of the chosen grams; 1 if both texts have none. A hash that both have counts if the
    grams at its positions are equal."""
    if not len(a.different) and not len(b.different):
        return 1.0
    _, i, j = np.intersect1d(a.different, b.different, assume_unique=True, return_indices=True)
    places = zip(a.first[i].tolist(), b.first[j].tolist())
    both = sum(a.text[p : p + a.gram] == b.text[q : q + b.gram] for p, q in places)
    return both / (len(a.different) + len(b.different) - both)


def as_string(hashes: np.ndarray) -> str:
    """Eight hex digits per chosen hash, in order of position."""
    return hashes.astype(">u4").tobytes().hex()


def fingerprints(docs: DataFrame, text: str = "text", gram: int = GRAM, window: int = WINDOW) -> DataFrame:
    """``docs`` with ``hashes`` (array<bigint>) and ``positions`` (array<int>), chosen by winnowing.

    - A NULL or empty text has none; a text shorter than a gram has one, the hash of all of it.
    - Equal texts have equal fingerprints, however often a row is repeated. Texts may have any length.
    - An empty table gives an empty table; other columns pass through, and columns already named
      ``hashes`` or ``positions`` are replaced.
    """
    winnower = Winnower(gram, window)

    def run(texts):
        found = [winnower.choose(t or "") for t in texts]
        return [h.astype(np.int64) for h, _ in found], [p.astype(np.int32) for _, p in found]

    return map_pieces(docs, run, [text], {"hashes": "array<bigint>", "positions": "array<int>"})


def with_next(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(part, extra, doc_id, text), laid out so that every row's successor by id is the next row.

    Ids are cut into as many ranges as there are shuffle partitions, one range to a partition, sorted;
    each range ends with a copy (``extra``) of the first row of the next one, the last range with the
    very first row. NULL ids come first; rows of one id are ordered by their text's hash and text.
    """
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.col(f"`{id_col}`").cast("bigint").alias("doc_id"), F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("text"))
    cuts = rows.agg(F.percentile_approx("doc_id", [i / parts for i in range(1, parts)] or [1.0], 100 * parts)).first()[0] or []
    bounds = np.unique(np.array(cuts, np.int64))

    @F.pandas_udf("int")
    def part_of(ids: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(bounds, ids.to_numpy(np.int64), "right"))

    # a NULL id has the smallest key; an id of that very value comes after it by ``known``
    key = F.coalesce("doc_id", F.lit(-(1 << 63)))
    rows = rows.withColumns({"key": key, "known": F.col("doc_id").isNotNull(), "h": F.xxhash64("text")}).withColumn("part", part_of("key"))
    least = rows.groupBy("part").agg(F.min("key").alias("key"))  # a row per partition
    firsts = rows.join(F.broadcast(least), ["part", "key"]).groupBy("part").agg(F.min(F.struct("known", "h", "text", "doc_id")).alias("x"))
    present = sorted(r.part for r in least.collect())
    before = {p: present[i - 1] for i, p in enumerate(present)}  # the first range's first row closes the last
    moved = F.create_map(*[F.lit(x) for pair in before.items() for x in pair]) if before else F.create_map().cast("map<int,int>")
    closing = firsts.select(moved[F.col("part")].alias("part"), F.lit(True).alias("extra"), "x.doc_id", "x.text", F.lit(0).cast("bigint").alias("key"), "x.known", "x.h")
    every = rows.select("part", F.lit(False).alias("extra"), "doc_id", "text", "key", "known", "h").unionByName(closing)
    laid = every.repartitionById(parts, F.col("part")).sortWithinPartitions("part", "extra", "key", "known", "h", "text")
    return laid.select("part", "extra", "doc_id", "text")


def edited(text: str, following: str) -> str:
    """``text`` with its last half (rounded down) replaced by as much of the beginning of ``following``."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def edit_fingerprints(docs: DataFrame, id_col: str = "doc_id", text: str = "text", gram: int = GRAM, window: int = WINDOW) -> DataFrame:
    """Fingerprints of every text, of the text edited with its successor's beginning, and how alike they are.

    Returns doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next, and the
    positions (code points, ascending) of either fingerprint's grams: positions, edited_positions.
    The successor is the next row by id (see ``with_next`` for NULL and repeated ids); the last row's is
    the first, and a lone row's is itself. NULL and empty texts are empty: their fingerprint is an
    empty string, like another empty one to 1 and any other to 0. An empty table gives an empty table;
    other columns are not read.

    The texts are shuffled once, by id range. A task holds two texts at a time.
    """
    winnower = Winnower(gram, window)
    schema = "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double, "
    schema += "positions array<int>, edited_positions array<int>"

    def compared(batches) -> Iterator[tuple]:
        last = None
        for piece in pieces(batches, 3):
            for part, extra, doc_id, value in zip(*[piece.column(i).to_pylist() for i in range(4)]):
                found = Chosen(winnower, value)
                if last is not None and last[0] == part:
                    _, last_id, mine = last
                    new = Chosen(winnower, edited(mine.text, value))
                    yield (
                        last_id,
                        len(mine.text),
                        hashlib.sha256(new.text.encode("utf-8", "surrogatepass")).hexdigest(),
                        as_string(mine.values),
                        as_string(new.values),
                        likeness(mine, new),
                        likeness(mine, found),
                        mine.positions.astype(np.int32),
                        new.positions.astype(np.int32),
                    )
                last = None if extra else (part, doc_id, found)

    def run(batches):
        names = [x.split()[0] for x in schema.split(", ")]
        kinds = [{"bigint": pa.int64(), "string": pa.string(), "double": pa.float64(), "array<int>": pa.list_(pa.int32())}[x.split()[1]] for x in schema.split(", ")]
        rows, held = [], 0
        for row in compared(batches):
            rows.append(row)
            held += 2 * len(row[3]) + 2 * len(row[4]) + 200
            if held > 4 << 20:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)
                rows, held = [], 0
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)

    return with_next(docs, id_col, text).mapInArrow(run, schema)
