"""Suffix-array dedup: bytes of every string of ``depth`` bytes that also starts elsewhere.

Each string of ``depth`` bytes (a window) has an anchor, the smallest of its grams by hash, so equal
windows lie in one bucket, that of their anchor's gram. Buckets of one occurrence have no repeats; in
buckets whose occurrences all have the same surroundings every window repeats. The windows of the
other buckets are sorted as suffixes, one block of buckets at a time: by their first PERIOD bytes, and
those that agree in them (long ties) by the ranks of a difference cover sample of the block: for any
two suffixes there is a distance below PERIOD at which both stand on the sample, whose ranks have been
computed before. So a task holds a block of short surroundings, never texts or a whole suffix array.
A bucket of too many surroundings is divided by bytes that its equal windows share, until its parts can
be sorted.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.llm.fingerprints import Winnower
from plumbline.llm.tables import fresh, map_pieces, pieces, written

DEPTH = 200
GRAM = 50
PERIOD = 32
BLOCK_BYTES = 1 << 20  # of surroundings sorted together
BUCKET_ROWS = 2048  # different surroundings of a bucket that is sorted as it is; larger ones are divided
WAYS = 4  # ranges into which the windows of a large bucket are divided at a time


def difference_cover(period: int) -> list[int]:
    """Residues such that every residue is a difference of two of them; taken greedily."""
    cover, found = [0], {0}
    while len(found) < period:
        def gain(x):
            return len({(x - y) % period for y in cover} | {(y - x) % period for y in cover} | found)

        best = max(range(period), key=lambda x: (gain(x), -x))
        cover.append(best)
        found |= {(best - y) % period for y in cover} | {(y - best) % period for y in cover}
    return sorted(cover)


COVER = difference_cover(PERIOD)
_IN_COVER = np.isin(np.arange(PERIOD), COVER)
#: _SHIFT[a, b]: the least distance at which suffixes at residues a and b both stand on the cover.
_SHIFT = np.array([[next(d for d in range(PERIOD) if (a + d) % PERIOD in COVER and (b + d) % PERIOD in COVER) for b in range(PERIOD)] for a in range(PERIOD)])


class Anchors:
    """Anchors of the windows of byte strings."""

    def __init__(self, depth: int = DEPTH, gram: int = GRAM):
        self.depth, self.gram = depth, gram
        self.winnower = Winnower(gram, depth - gram + 1)

    def of(self, data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(bucket, surroundings, first window, windows, place) of every anchor: hashes of the anchor's gram
        and of all bytes its windows cover (and where in them the gram is), as signed numbers, and where in
        the surroundings the gram is."""
        n = len(data)
        if n < self.depth:
            none = np.zeros(0, np.int64)
            return none, none, none, none, none
        w = self.winnower
        sums = w.sums(data)
        grams = w.between(sums, slice(0, n - self.gram + 1), slice(self.gram, n + 1))
        anchor = w.minima(grams)
        first = np.flatnonzero(np.concatenate([[True], anchor[1:] != anchor[:-1]]))
        windows = np.diff(np.append(first, len(anchor)))
        at = anchor[first]
        place = ((at - first) << 16 | windows).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        around = w.between(sums, first, first + windows - 1 + self.depth) + place
        around = (around ^ (around >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
        return grams[at].view(np.int64), around.view(np.int64), first, windows, at - first


def big_endian_words(data: np.ndarray) -> np.ndarray:
    """The 8 bytes from each position as a number, so that numbers compare as the bytes do."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    out = np.zeros(len(data), np.uint64)
    for k in range(8):
        out = out << np.uint64(8) | padded[k : k + len(data)]
    return out


def dense_rank(keys: list[np.ndarray]) -> np.ndarray:
    """Rank of each row by the columns ``keys``, the first most important; equal rows have equal ranks."""
    order = np.lexsort(keys[::-1])
    step = np.zeros(len(order), bool)
    for k in keys:
        s = k[order]
        step[1:] |= s[1:] != s[:-1]
    out = np.empty(len(order), np.int64)
    out[order] = np.cumsum(step)
    return out


def window_classes(data: np.ndarray, starts: np.ndarray, depth: int) -> np.ndarray:
    """Numbers of the suffixes at ``starts`` such that those that agree in ``depth`` bytes, and only
    those, have the same. ``data`` has ``depth`` bytes from each start; depth is PERIOD * 5 at least.
    """
    words = big_endian_words(np.concatenate([data, np.zeros(depth + PERIOD * 8, np.uint8)]))
    # ranks of the cover sample by ever longer strings: PERIOD, 2 PERIOD, 4 PERIOD ... and depth - 32 at most
    sample = np.flatnonzero(_IN_COVER[np.arange(len(data) + PERIOD) % PERIOD])
    place = np.zeros(len(words), np.int64)
    place[sample] = np.arange(len(sample))
    rank0 = dense_rank([words[sample + 8 * k] for k in range(PERIOD // 8)])
    covered, rank = PERIOD, rank0
    wanted = (depth - PERIOD) // PERIOD * PERIOD

    def at(ranks, positions):  # beyond the sample there is nothing but padding
        return np.where(positions <= sample[-1], ranks[place[np.minimum(positions, sample[-1])]], -1)

    while covered < wanted:
        step = min(covered, wanted - covered)
        tail = rank if step == covered else rank0 if step == PERIOD else None
        if tail is None:  # the string of ``covered`` bytes that ends where wanted
            rank = dense_rank([rank, at(rank, sample + step)])
        else:
            rank = dense_rank([rank, at(tail, sample + covered)])
        covered += step
    # all suffixes by their first PERIOD bytes
    head = dense_rank([words[starts + 8 * k] for k in range(PERIOD // 8)])
    # the bytes that no rank at a distance below PERIOD covers, up to the last
    ends = [words[starts + k] for k in range(wanted, depth - 8, 8)] + [words[starts + depth - 8]]
    residue = starts % PERIOD
    out, fresh_class = np.full(len(starts), -1, np.int64), 0
    order = np.argsort(head, kind="stable")
    group = head[order]
    while len(order):
        begins = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]]))
        size = np.diff(np.append(begins, len(order)))
        number = np.repeat(np.arange(len(begins)), size)
        pivot = order[begins + size // 2][number]
        shift = _SHIFT[residue[order], residue[pivot]]
        mine, other = rank[place[starts[order] + shift]], rank[place[starts[pivot] + shift]]
        side = np.sign(mine - other)
        for e in ends:
            more = (e[order] > e[pivot]).astype(np.int64) - (e[order] < e[pivot])
            side = np.where(side == 0, more, side)
        same = side == 0
        out[order[same]] = fresh_class + number[same]
        fresh_class += len(begins)
        order, group = order[~same], (number * 2 + (side > 0))[~same]
        again = np.argsort(group, kind="stable")
        order, group = order[again], group[again]
    return out


def repeated_windows(surroundings: list[bytes], copies: np.ndarray, depth: int) -> list[np.ndarray]:
    """For each string the windows (by start) that occur twice or more, ``copies`` counting each string."""
    sizes = np.array([len(s) for s in surroundings], np.int64)
    windows = sizes - depth + 1
    data = np.frombuffer(b"".join(surroundings), np.uint8)
    owner = np.repeat(np.arange(len(sizes)), windows)
    first = np.cumsum(windows) - windows
    starts = (np.cumsum(sizes) - sizes)[owner] + np.arange(len(owner)) - first[owner]
    classes = window_classes(data, starts, depth)
    often = np.bincount(classes, copies[owner]) > 1.5
    return np.split(often[classes], first[1:])


def spans_of(repeated: np.ndarray, depth: int) -> np.ndarray:
    """(start, end) of the maximal runs of bytes that the windows starting at ``repeated`` cover."""
    if not len(repeated):
        return np.zeros((0, 2), np.int64)
    gap = np.flatnonzero(np.diff(repeated) > depth)
    return np.stack([repeated[np.append(0, gap + 1)], repeated[np.append(gap, len(repeated) - 1)] + depth], axis=1)


def without_repeats(
    docs: DataFrame,
    id_col: str = "doc_id",
    text: str = "text",
    depth: int = DEPTH,
    gram: int = GRAM,
    bucket_rows: int = BUCKET_ROWS,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """``docs`` with ``spans`` (array of start, end: maximal runs of repeated bytes) and ``kept`` (the
    UTF-8 bytes that are left, as binary), without the text.

    A byte is repeated if some string of ``depth`` bytes over it also starts anywhere else in the
    texts, the same one included; overlaps count, and no string goes from one text into another.

    - A NULL text is empty. A text shorter than ``depth`` bytes has no repeats.
    - Repeated rows are repeats of each other, rows with one id included; a NULL id is fine.
    - Whole texts of any length are read. An empty table gives an empty table. Other columns pass
      through; columns already named ``spans`` or ``kept`` are replaced.

    Shuffled are three numbers per anchor (about one per 75 bytes), the texts twice, and the
    surroundings of anchors whose buckets must be sorted, equal ones once. Buckets and surroundings
    are told apart by 64-bit hashes, windows by their bytes. A bucket of more than ``bucket_rows``
    different surroundings is divided into parts that can be sorted, so that none is more than a bounded
    group.
    """
    if depth < 5 * PERIOD or gram >= depth:
        raise ValueError(f"depth must be {5 * PERIOD} at least and more than gram")
    anchors = Anchors(depth, gram)
    key, marked = fresh(docs, "__key", "__marks")
    plain = docs.drop("spans", "kept").withColumn(text, F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")))
    keyed = plain.withColumn(key, F.xxhash64(F.col(f"`{text}`"), F.col(f"`{id_col}`")))
    texts = keyed.select(F.col(key).alias("key"), F.col(f"`{text}`").alias("text"))

    repeats = _repeated_anchors(texts, anchors)
    flags = _window_flags(texts, repeats, anchors, bucket_rows, block_bytes)
    several = repeats.where("mixed").join(flags, ["bucket", "around"]).select("key", "bucket", "around", "flags")
    whole = repeats.where("not mixed").select("key", "bucket", "around", F.lit(None).cast("binary").alias("flags"))
    marks = several.unionByName(whole).dropDuplicates(["key", "bucket", "around"])  # rows of one text and id share their marks
    marks = marks.groupBy("key").agg(F.collect_list(F.struct("bucket", "around", "flags")).alias(marked)).withColumnRenamed("key", key)

    def cut(values, marks):
        spans, kept = [], []
        for value, own in zip(values, marks):
            raw = value.encode("utf-8", "surrogatepass")
            found = np.zeros((0, 2), np.int64)
            if own:
                known = {(m["bucket"], m["around"]): m["flags"] for m in own}
                found = spans_of(_flagged(np.frombuffer(raw, np.uint8), known, anchors), depth)
            last, left = 0, []
            for start, end in found.tolist():
                left.append(raw[last:start])
                last = end
            spans.append([{"start": a, "end": b} for a, b in found.tolist()])
            kept.append(b"".join(left) + raw[last:])
        return spans, kept

    joined = keyed.join(marks, key, "left")
    keep = [c for c in plain.columns if c != text]
    return map_pieces(joined, cut, [text, marked], {"spans": "array<struct<start:bigint,end:bigint>>", "kept": "binary"}, keep)


def _flagged(data: np.ndarray, known: dict, anchors: Anchors) -> np.ndarray:
    """Starts of the repeated windows of a text; without flags, all windows of an anchor are."""
    out = [np.zeros(0, np.int64)]
    for bucket, around, first, windows, _ in zip(*[x.tolist() for x in anchors.of(data)]):
        flags = known.get((bucket, around), 0)
        if flags is None:
            out.append(np.arange(first, first + windows))
        elif flags:
            out.append(first + np.flatnonzero(np.unpackbits(np.frombuffer(flags, np.uint8), count=windows)))
    return np.concatenate(out)


def _repeated_anchors(texts: DataFrame, anchors: Anchors) -> DataFrame:
    """(key, bucket, around, mixed) of anchors whose bucket has two occurrences or more; mixed if
    their surroundings differ."""

    def find(batches) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches, 1):
            keys, buckets, arounds = [], [], []
            for key, text in zip(piece.column(0).to_pylist(), piece.column(1).to_pylist()):
                bucket, around, _, _, _ = anchors.of(np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8))
                keys.append(np.full(len(bucket), key, np.int64))
                buckets.append(bucket)
                arounds.append(around)
            yield pa.RecordBatch.from_pydict({"key": np.concatenate(keys), "bucket": np.concatenate(buckets), "around": np.concatenate(arounds)})

    rows = written(texts.mapInArrow(find, "key bigint, bucket bigint, around bigint"), "all-anchors")
    # counted within the tasks first; a hot bucket's rows are split by the join, whose other side has one row a bucket
    buckets = rows.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"), (F.min("around") != F.max("around")).alias("mixed")).where("n > 1")
    return written(rows.join(buckets.select("bucket", "mixed"), "bucket").select("key", "bucket", "around", "mixed"), "anchors")


def _window_flags(texts: DataFrame, repeats: DataFrame, anchors: Anchors, bucket_rows: int, block_bytes: int) -> DataFrame:
    """(bucket, around, flags) of the mixed buckets: a bit for each window, NULL if all are repeated."""
    different = repeats.where("mixed").groupBy("bucket", "around").agg(F.count(F.lit(1)).alias("copies"), F.min("key").alias("key"))
    sizes = different.groupBy("bucket").agg((F.count(F.lit(1)) > bucket_rows).alias("large"))
    wanted = different.join(sizes, "bucket").groupBy("key").agg(F.collect_list(F.struct("bucket", "around", "copies", "large")).alias("wanted"))

    def fetch(batches):
        names = ["bucket", "around", "copies", "large", "place", "surroundings"]
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.int32(), pa.binary()]
        for piece in pieces(batches, 0):
            out = [[] for _ in names]
            for text, want in zip(piece.column(0).to_pylist(), piece.column(1).to_pylist()):
                raw = text.encode("utf-8", "surrogatepass")
                open_ = {(x["bucket"], x["around"]): x for x in want}
                for bucket, around, first, windows, place in zip(*[x.tolist() for x in anchors.of(np.frombuffer(raw, np.uint8))]):
                    x = open_.pop((bucket, around), None)
                    if x is not None:
                        end = first + windows - 1 + anchors.depth
                        for column, value in zip(out, (bucket, around, x["copies"], x["large"], place, raw[first:end])):
                            column.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds)], names=names)

    schema = "bucket bigint, around bigint, copies bigint, large boolean, place int, surroundings binary"
    fetched = written(texts.join(wanted, "key").select("text", "wanted").mapInArrow(fetch, schema), "surroundings")
    whole = fetched.where("not large").select(F.col("bucket").alias("part"), "bucket", "around", F.lit(0).alias("skip"), "copies", "surroundings")
    flags = _sorted_parts(whole, anchors.depth, block_bytes).drop("skip")
    large = fetched.where("large").dropDuplicates(["bucket", "around"])  # a repeated row fetches the same bytes again
    if large.isEmpty():
        return flags
    return flags.unionByName(_joined_flags(_divided_flags(large, anchors, bucket_rows, block_bytes)))


def _sorted_parts(rows: DataFrame, depth: int, block_bytes: int) -> DataFrame:
    """(bucket, around, skip, flags) from rows (part, bucket, around, skip, copies, surroundings): which windows
    of the surroundings are repeated in the part, NULL if all are. Parts are sorted in blocks of whole ones."""

    def sort(batches):
        block: dict[tuple[int, int, int], tuple[int, int, bytes]] = {}

        def sorted_block():
            copies = [c for _, c, _ in block.values()]
            found = repeated_windows([s for _, _, s in block.values()], np.array(copies), depth)
            bits = [None if c > 1 else np.packbits(f).tobytes() for f, c in zip(found, copies)]
            columns = [[b for b, _, _ in block.values()], [a for _, a, _ in block], [k for _, _, k in block], bits]
            kinds = [pa.int64(), pa.int64(), pa.int32(), pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["bucket", "around", "skip", "flags"])

        held, last = 0, None
        for batch in batches:
            for part, bucket, around, skip, copies, surroundings in zip(*[c.to_pylist() for c in batch.columns]):
                if held > block_bytes and part != last:
                    yield sorted_block()
                    block, held = {}, 0
                if (part, around, skip) not in block:  # a repeated row fetches the same bytes again
                    block[part, around, skip] = bucket, copies, surroundings
                    held += len(surroundings)
                last = part
        if block:
            yield sorted_block()

    laid = rows.select("part", "bucket", "around", "skip", "copies", "surroundings").repartition("part").sortWithinPartitions("part")
    return laid.mapInArrow(sort, "bucket bigint, around bigint, skip int, flags binary")


def _divided_flags(large: DataFrame, anchors: Anchors, bucket_rows: int, block_bytes: int) -> DataFrame:
    """(bucket, around, skip, flags) of buckets with more surroundings than are sorted together.

    Windows are divided by how many bytes they have before the anchor's gram, into ranges. All windows with
    ``low`` to ``high`` bytes before it reach from ``low`` bytes before it to where the one with ``high`` ends.
    Equal windows agree in these bytes, so the windows of a range fall into parts by them. Parts of at most
    ``bucket_rows`` surroundings are sorted, larger ones divided again, now by more bytes. At last all windows
    of a part have one place and are counted by their bytes, within the tasks first.
    """
    width = anchors.depth - anchors.gram + 1
    whole = [F.lit(0).alias("skip"), F.lit(0).alias("low"), F.lit(width - 1).alias("high")]
    parts = large.select(F.col("bucket").alias("part"), "bucket", "around", "copies", "place", "surroundings", *whole)
    found = None
    while width > 1:
        width = -(-width // WAYS)
        divided = _divided(parts, width, anchors.depth)
        sizes = divided.groupBy("part").agg((F.count(F.lit(1)) > bucket_rows).alias("large"), F.sum("copies").alias("total"))
        held = written(divided.join(sizes.where("total > 1").drop("total"), "part"), "parts")
        done = _sorted_parts(held.where("not large"), anchors.depth, block_bytes)
        found = done if found is None else found.unionByName(done)
        parts = held.where("large").drop("large")
        if parts.isEmpty():
            return found
    often = parts.groupBy("part", "surroundings").agg(F.sum("copies").alias("total")).where("total > 1").drop("total")
    one = F.when(F.col("copies") == 1, F.lit(np.packbits([1]).tobytes()))
    return found.unionByName(parts.join(often, ["part", "surroundings"]).select("bucket", "around", "skip", one.alias("flags")))


def _divided(parts: DataFrame, width: int, depth: int) -> DataFrame:
    """Each row once per range of ``width`` places in which it has windows, cut to the bytes of these."""
    ranges = parts.withColumn("low", F.explode(F.expr(f"sequence(low, high, {width})"))).withColumn("high", F.expr(f"least(high, low + {width - 1})"))
    first, last = "greatest(place - high, 0)", f"least(place - low, octet_length(surroundings) - {depth})"
    mine = ranges.withColumns({"first": F.expr(first), "last": F.expr(last)}).where("first <= last")
    cut = mine.select(
        *["part", "bucket", "around", "copies", "low", "high"],
        F.expr("place - first").alias("place"),
        F.expr("skip + first").alias("skip"),
        F.expr(f"substring(surroundings, first + 1, last - first + {depth})").alias("surroundings"),
    )
    shared = F.expr(f"substring(surroundings, place - low + 1, {depth} - high + low)")
    return cut.withColumn("part", F.xxhash64("part", "low", shared))


def _joined_flags(rows: DataFrame) -> DataFrame:
    """(bucket, around, flags) from the flags of parts, each of which begins ``skip`` windows later."""

    def run(batches):
        for batch in batches:
            bits = []
            for parts in batch.column(2).to_pylist():
                at = [x["skip"] + np.flatnonzero(np.unpackbits(np.frombuffer(x["flags"], np.uint8))) for x in parts if x["flags"] is not None]
                if len(at) < len(parts):
                    bits.append(None)
                    continue
                at = np.concatenate(at)
                found = np.zeros(at.max(initial=-1) + 1, np.uint8)
                found[at] = 1
                bits.append(np.packbits(found).tobytes())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(bits, pa.binary())], names=["bucket", "around", "flags"])

    several = rows.groupBy("bucket", "around").agg(F.collect_list(F.struct("skip", "flags")).alias("parts"))
    return several.mapInArrow(run, "bucket bigint, around bigint, flags binary")
