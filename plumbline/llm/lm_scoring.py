"""LM scoring with a probabilistic suffix tree.

Symbols stand for the bytes of the words, a blank after each word but the last, and an end sign; bytes
beyond the most frequent ones take two symbols. The tree keeps contexts of up to ``depth`` symbols whose
next-symbol distribution diverges from that of the context without its oldest symbol. A symbol is scored
by the longest kept suffix of what stands before it, smoothed with shorter ones by absolute discounts that
are estimated by leaving one occurrence out. A text's score is the sum over its symbols.

Contexts are ordered by their symbols from the newest to the oldest. Ranges of that order hold whole
branches of the tree, so a range can be counted, judged and looked up on its own, and neither the tree nor
the corpus is ever in one place:

1. tasks cut the texts into chunks and write each chunk's texts beside its different strings (a context
   of full depth and the next symbol) with their training counts, packed by range;
2. the strings of a range are added up and its contexts judged;
3. the strings of a range meet the contexts of the range, and every chunk's strings get their logarithms;
4. these go back to their chunk, where texts are summed up.
"""

from __future__ import annotations

import uuid
from collections import Counter
from collections.abc import Iterator, Sequence
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from plumbline.llm.tables import brief_shuffles, bucketed, fresh, largest, pieces, written
from plumbline.session import drop_path, scratch_path, share

DEPTH = 7  # symbols of the longest context
MIN_COUNT = 16  # occurrences of a context that may be kept
MIN_GAIN = 10.0  # nats that a context must save over the shorter one in all its occurrences
MAX_WORDS = 200_000  # entries of the broadcast table of frequent words
WORD_BYTES = 64  # bytes of its longest word
TASK_WORDS = 200_000  # distinct words a task holds before it passes them on
CHUNK_SYMBOLS = 6_000_000  # of a chunk, or one text
MAX_BUCKETS = 50_000  # of the table of chunks, which Spark bounds; a bucket may hold several chunks
RANGE_SYMBOLS = 4_000_000  # training symbols in a range
HEAD = 3  # newest symbols by which ranges are cut, more where one head has over HEAD_SYMBOLS
HEAD_SYMBOLS = 64_000_000
TEXTS = 1 << 8  # texts whose logarithms are added up together: their numbers fill a byte
STEPS = 1 << 11  # a logarithm is kept in steps of 1 / STEPS on its way back to the chunk, in three bytes

END = 10  # a line feed: no word has one, so it can stand for the end and for what is before a text
BITS = 7
SIZE = 1 << BITS
LOW = SIZE - 1


def tokens(text: str | None) -> list[bytes]:
    """Words between ASCII white space, A-Z in lower case."""
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


# ---- words and symbols -----------------------------------------------------------------------


def count_words(docs: DataFrame) -> DataFrame:
    """(word, n) of the column ``text``, the end of every text as the word ``\\n``."""

    def run(batches):
        def rows(seen):
            return pa.RecordBatch.from_pydict({"word": pa.array(list(seen), pa.binary()), "n": pa.array(list(seen.values()), pa.int64())})

        seen: Counter = Counter()
        for piece in pieces(batches, 0):
            for text in piece.column(0).to_pylist():
                seen.update(tokens(text))
            seen[b"\n"] += piece.num_rows
            if len(seen) > TASK_WORDS:
                yield rows(seen)
                seen = Counter()
        if seen:
            yield rows(seen)

    return docs.select("text").mapInArrow(run, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))


class Alphabet:
    """Bytes to symbols: 1 the end, 2 the blank, then the most frequent bytes; every other byte is the
    symbol 0 and a second one."""

    def __init__(self, seen: np.ndarray):
        possible = [b for b in range(256) if not 65 <= b <= 90 and not 9 <= b <= 13 and b != 32]  # of a word
        order = sorted(possible, key=lambda b: (-seen[b], b))
        own, rest = order[: SIZE - 4], order[SIZE - 4 :]
        self.first, self.second = np.zeros(256, np.uint8), np.full(256, -1, np.int16)
        self.first[[END, 32, *own]] = np.arange(1, len(own) + 3)
        self.second[rest] = np.arange(len(rest))

    @staticmethod
    def of(counts: DataFrame) -> "Alphabet":
        """From a table of words, weighted by their occurrences."""

        def run(batches):
            seen = np.zeros(256)
            for batch in batches:
                words, n = batch.column(0).to_pylist(), batch.column(1).to_numpy()
                raw = np.frombuffer(b"".join(words), np.uint8)
                seen += np.bincount(raw, np.repeat(n, [len(w) for w in words]), 256)
            at = np.flatnonzero(seen)
            yield pa.RecordBatch.from_pydict({"byte": pa.array(at, pa.int32()), "n": pa.array(seen[at])})

        seen = np.zeros(256)
        for r in counts.select("word", "n").mapInArrow(run, "byte int, n double").groupBy("byte").agg(F.sum("n").alias("n")).collect():
            seen[r.byte] = r.n
        return Alphabet(seen)

    def spell(self, data: np.ndarray) -> tuple[np.ndarray, np.ndarray | None]:
        """Symbols of bytes, and how many each byte has (None: one each)."""
        symbols = self.first[data]
        rare = np.flatnonzero(symbols == 0)
        if not len(rare):
            return symbols, None
        size = np.ones(len(data), np.int64)
        size[rare] = 2
        out = np.repeat(symbols, size)
        out[np.cumsum(size)[rare] - 1] = self.second[data[rare]]
        return out, size

    def strings(self, texts: Sequence[list[bytes]], depth: int) -> tuple[np.ndarray, np.ndarray]:
        """``strings_of`` texts given as lists of words."""
        return self.strings_of([b" ".join(t) for t in texts], depth)

    def strings_of(self, lines: Sequence[bytes], depth: int) -> tuple[np.ndarray, np.ndarray]:
        """Every symbol of the texts in a row with the ``depth`` symbols before it, and the texts' symbols.

        A string is a number of 7-bit digits: the newest symbol before, then older ones, then the symbol.
        What stands before a text is ``depth`` ends."""
        raw = [b"\n" * depth + line + b"\n" for line in lines]
        data = np.frombuffer(b"".join(raw), np.uint8)
        symbols, size = self.spell(data)
        lengths = np.array([len(r) for r in raw], np.int64)
        if size is not None:
            lengths = np.add.reduceat(size, np.cumsum(lengths) - lengths)
        keys = symbols[depth:].astype(np.int64)
        for k in range(1, depth + 1):
            keys |= symbols[depth - k : len(symbols) - k].astype(np.int64) << BITS * (depth + 1 - k)
        own = np.ones(len(symbols), bool)  # not the ends before a text
        starts = np.cumsum(lengths) - lengths
        for k in range(depth):
            own[starts + k] = False
        return keys[own[depth:]], lengths - depth


# ---- packing ---------------------------------------------------------------------------------


def packed(numbers: np.ndarray, width: int = 8) -> bytes:
    """Numbers below 2^(8 * width), the bytes of one place together, which packs well."""
    planes = np.ascontiguousarray(numbers.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T)
    return pa.compress(planes.tobytes(), codec="zstd", asbytes=True)


def unpacked(data: bytes, n: int, width: int = 8) -> np.ndarray:
    out = np.zeros((n, 8), np.uint8)
    out[:, :width] = np.frombuffer(pa.decompress(data, decompressed_size=n * width, codec="zstd"), np.uint8).reshape(width, n).T
    return out.reshape(-1).view("<u8").astype(np.int64)


def packed_keys(keys: np.ndarray) -> bytes:
    """Ascending keys, by their differences."""
    return packed(np.diff(keys, prepend=0))


def unpacked_keys(data: bytes, n: int) -> np.ndarray:
    return np.cumsum(unpacked(data, n))


# ---- 1. chunks -------------------------------------------------------------------------------


def range_cuts(counts: DataFrame, alphabet: Alphabet, depth: int, total: int) -> tuple[np.ndarray, int]:
    """(places at which ranges begin, without the first; symbols of a head). Heads are weighed by the
    words' occurrences, what stands before a word taken at random: this only makes ranges alike."""
    ranges = max(1, total // RANGE_SYMBOLS)

    def heads(size: int) -> tuple[np.ndarray, np.ndarray]:
        def run(batches):
            for batch in batches:
                words, n = batch.column(0).to_pylist(), batch.column(1).to_numpy()
                keys, _ = alphabet.strings([words], depth)
                weight = np.repeat(n, [len(w) + 1 for w in words])[: len(keys)]
                weight = np.pad(weight, (0, len(keys) - len(weight)))
                found, which = np.unique(keys >> BITS * (depth + 1 - size), return_inverse=True)
                yield pa.RecordBatch.from_pydict({"head": pa.array(found), "n": pa.array(np.bincount(which, weight))})

        rows = counts.select("word", "n").where(F.col("word") != F.lit(b"\n")).mapInArrow(run, "head long, n double")
        table = rows.groupBy("head").agg(F.sum("n").alias("n")).orderBy("head").toArrow()
        return table.column("head").to_numpy(), table.column("n").to_numpy()

    if ranges == 1:
        return np.zeros(0, np.int64), min(HEAD, depth)
    for size in range(min(HEAD, depth - 1), depth):
        head, n = heads(size)
        if not len(n) or n.max() <= HEAD_SYMBOLS:
            break
    upto = np.cumsum(n) - n
    begins = np.searchsorted(upto, upto[-1] * np.arange(1, ranges) / ranges) if len(n) else np.zeros(0, int)
    return np.unique(head[begins][head[begins] > 0]) << BITS * (depth - size), size


def chunked(rows: DataFrame, alphabet: Alphabet, depth: int, cuts: np.ndarray, text: str, learn: str, scored: str) -> DataFrame:
    """``rows`` in chunks of about CHUNK_SYMBOLS symbols, each with a ``label``: rows packed a piece at a time
    (``rows``, the text as its words with a blank between), and the chunk's different strings by range ``g``: how many, the packed strings and their
    training counts. Rows that are not scored leave only their strings, without a label."""
    names = rows.columns
    at_text, at_learn, at_scored = (names.index(c) for c in (text, learn, scored))
    kept = [c for c in names if c not in (learn, scored)]
    edges = np.concatenate([[0], cuts]) << BITS

    def batch(rows_: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows_), _BLOB_TYPES)], names=_BLOB_NAMES)

    def strings(label, found):
        marked = np.concatenate(found)
        found.clear()
        keys, n = _counted(marked)
        stops, start, rows_ = [*np.searchsorted(keys, edges[1:]).tolist(), len(keys)], 0, []
        for g, stop in enumerate(stops):
            if stop > start:
                rows_.append((label, g, stop - start, packed_keys(keys[start:stop]), packed(n[start:stop]), None))
            start = stop
        return batch(rows_)

    def run(batches):
        open_ = {True: [_label(), [], 0], False: [None, [], 0]}
        for piece in pieces(batches, at_text):
            for shown, chunk in open_.items():
                mine = piece.filter(pc.equal(piece.column(at_scored), shown))
                if not mine.num_rows:
                    continue
                lines = [b" ".join(tokens(t)) for t in mine.column(at_text).to_pylist()]
                keys, lengths = alphabet.strings_of(lines, depth)
                learned = np.repeat(mine.column(at_learn).to_numpy(zero_copy_only=False).astype(bool), lengths)
                chunk[1].append(keys << 1 | learned)  # a string has 56 bits at most
                chunk[2] += len(keys)
                if shown:
                    told = mine.set_column(at_text, text, pa.array(lines, pa.binary())).select(kept)
                    yield batch([(chunk[0], None, None, None, None, _packed_rows(told))])
                if chunk[2] > CHUNK_SYMBOLS:
                    yield strings(chunk[0], chunk[1])
                    chunk[:] = [_label() if shown else None, [], 0]
        for label, found, _ in open_.values():
            if found:
                yield strings(label, found)

    return rows.mapInArrow(run, _BLOB)


_BLOB = "label long, g int, n_strings int, strings binary, counts binary, rows binary"
_BLOB_NAMES = [c.split()[0] for c in _BLOB.split(", ")]
_BLOB_TYPES = [pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary()]


def _packed_rows(batch: pa.RecordBatch) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_batch(batch)
    return sink.getvalue().to_pybytes()


def _label() -> int:
    return uuid.uuid4().int >> 65


def _counted(marked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Different strings, ascending, and how often each was learned from (0 too); the last bit marks what is."""
    marked.sort()
    first = _firsts(marked >> 1)
    return marked[first] >> 1, np.add.reduceat(marked & 1, first) if len(marked) else marked


def _summed(keys: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys)
    keys, n = keys[order], n[order]
    first = _firsts(keys)
    return keys[first], np.add.reduceat(n, first) if len(n) else n


def _firsts(x: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.concatenate([[True], x[1:] != x[:-1]])) if len(x) else np.zeros(0, np.int64)


# ---- 2. contexts -----------------------------------------------------------------------------

_CONTEXT = "g int, d int, place long, s array<int>, n array<long>"
_PACKED = "n_contexts int, n_pairs int, data array<binary>, one long, two long"  # contexts of a range and length in one row


def passing_contexts(blobs: DataFrame, depth: int, head: int, cuts: np.ndarray, min_count: int = MIN_COUNT, min_gain: float = MIN_GAIN) -> DataFrame:
    """The contexts that pass the divergence test, all of them, as a written table: range g, length d, place
    in the order, next symbols s and their counts n. A context that ranges share is in each. The longer ones of
    a range are packed into a row for each length (see ``listed``).

    A context passes if its occurrences are at least ``min_count`` and coding their next symbols with
    its own distribution instead of the shorter context's saves at least ``min_gain`` nats: occurrences
    times the divergence of the two distributions. The empty context and all of one symbol are kept.

    Contexts of more than ``head`` symbols are judged where all strings of their range are, shorter ones by
    joins.
    """
    spark, path = blobs.sparkSession, scratch_path(blobs.sparkSession, "long-contexts")
    _long_contexts(blobs, depth, head, min_count, min_gain).write.parquet(path)
    long = spark.read.schema(f"{_CONTEXT}, {_PACKED}").parquet(path)
    last = long.where(F.col("d") == head).select("place", F.explode(F.arrays_zip("s", "n")).alias("x"))
    strings = last.select("place", F.col("x.s").alias("s"), F.col("x.n").alias("n"))
    short = _short_contexts(strings, depth, head, min_count, min_gain)
    reach = F.shiftleft(F.lit(1).cast("long"), BITS * depth)
    for d in range(head + 1):
        reach = F.when(F.col("d") == d, F.lit(1 << BITS * (depth - d))).otherwise(reach)
    shared = short.withColumn("g", F.explode(F.sequence(_range_of("place", cuts), _range_of(F.col("place") + reach - 1, cuts))))
    found = written(long.where(F.col("d") > head).unionByName(shared, allowMissingColumns=True), "contexts")
    drop_path(spark, path)
    return found


def _range_of(place: Column | str, cuts: np.ndarray) -> Column:
    @F.arrow_udf("int")
    def number(places: pa.Array) -> pa.Array:
        return pa.array(np.searchsorted(cuts, places.to_numpy(zero_copy_only=False), "right"), pa.int32())

    return number(place)


def _short_contexts(strings: DataFrame, depth: int, head: int, min_count: int, min_gain: float) -> DataFrame:
    """(d, place, s, n) of the contexts of at most ``head`` symbols that pass, from all strings (place, s, n)
    of exactly ``head`` symbols."""

    def shorter(place: Column, d: int) -> Column:  # what is left of a place with d symbols
        return F.shiftleft(F.shiftright(place, BITS * (depth - d)), BITS * (depth - d))

    levels = [strings]
    for d in range(head - 1, -1, -1):
        levels.append(written(levels[-1].groupBy(shorter(F.col("place"), d).alias("place"), "s").agg(F.sum("n").alias("n")), "symbol-strings"))
    found, above = None, None
    for d, level in enumerate(levels[::-1]):
        total = F.sum("n").over(Window.partitionBy("place"))  # at most SIZE rows each
        rows = level.withColumn("total", total).withColumn("share", F.col("n") / F.col("total"))
        if above is None:
            saved = rows.withColumn("gain", F.lit(0.0))
        else:
            frequent = rows.where(F.col("total") >= (min_count if d > 1 else 1)).withColumn("parent", shorter(F.col("place"), d - 1))
            saved = frequent.join(above, ["parent", "s"]).withColumn("gain", F.col("n") * F.log(F.col("share") / F.col("shorter_share")))
        kept = saved.groupBy("place").agg(F.sum("gain").alias("gain"), F.collect_list(F.struct("s", "n")).alias("next"))
        if d > 1:
            kept = kept.where(F.col("gain") >= min_gain)
        kept = kept.select(F.lit(d).alias("d"), "place", F.col("next.s").alias("s"), F.col("next.n").alias("n"))
        found = kept if found is None else found.unionByName(kept)
        above = rows.select(F.col("place").alias("parent"), "s", F.col("share").alias("shorter_share"))
    return found


def judged(keys: np.ndarray, n: np.ndarray, depth: int, head: int, min_count: int, min_gain: float) -> Iterator[tuple]:
    """(d, places, ends, next symbols, their counts) per length from the strings of a range: all contexts of
    ``head`` symbols, and the longer ones that pass."""
    levels = {depth: _summed(keys, n)}
    for d in range(depth - 1, head - 1, -1):  # without the oldest symbol
        keys, n = levels[d + 1]
        cut = BITS * (depth - d + 1)
        levels[d] = _summed(keys >> cut << cut | keys & LOW, n)
    shorter, shorter_share = None, None
    for d in range(head, depth + 1):
        keys, n = levels.pop(d)
        place = keys >> BITS
        first = _firsts(place)
        total = np.add.reduceat(n, first) if len(n) else n
        size = np.diff(np.append(first, len(keys)))
        share = n / np.repeat(total, size)
        keep = np.ones(len(first), bool)
        if d > head and len(keys):
            at = np.flatnonzero(np.repeat(total >= min_count, size))
            cut = BITS * (depth - d + 2)
            parent = keys[at] >> cut << cut | keys[at] & LOW
            gain = np.zeros(len(keys))
            gain[at] = n[at] * np.log(share[at] / shorter_share[np.searchsorted(shorter, parent)])
            keep = (total >= min_count) & (np.add.reduceat(gain, first) >= min_gain)
        shorter, shorter_share = keys, share
        chosen = np.repeat(keep, size)
        yield d, place[first[keep]], np.concatenate([[0], np.cumsum(size[keep])]), keys[chosen] & LOW, n[chosen]


def _long_contexts(blobs: DataFrame, depth: int, head: int, min_count: int, min_gain: float) -> DataFrame:
    def run(batches):
        for g, rows in _groups(batches, ["n_strings", "strings", "counts"]):
            found = []
            for n, strings, counts in rows:
                keys, times = unpacked_keys(strings, n), unpacked(counts, n)
                learned = times > 0
                found.append((keys[learned], times[learned]))
            keys, n = (np.concatenate(c) for c in zip(*found))
            del found
            for d, place, ends, s, times in judged(keys, n, depth, head, min_count, min_gain):
                if d > head:
                    yield _packed_contexts(g, d, place, ends, s, times)
                else:
                    yield from _context_rows(g, d, place, ends, s, times, 5)

    laid = blobs.select("g", "n_strings", "strings", "counts").repartition("g").sortWithinPartitions("g")
    return laid.mapInArrow(run, f"{_CONTEXT}, {_PACKED}")


_LISTS = [pa.int32(), pa.int32(), pa.int64(), pa.list_(pa.int32()), pa.list_(pa.int64()), pa.int32(), pa.int32(), pa.list_(pa.binary()), pa.int64(), pa.int64()]
_NAMES = [c.split()[0] for c in f"{_CONTEXT}, {_PACKED}".split(", ")]


def _context_rows(g: int, d: int, place, ends, s, n, more: int = 0) -> Iterator[pa.RecordBatch]:
    lists = [pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(x, k)) for x, k in ((s, pa.int32()), (n, pa.int64()))]
    columns = [*[pa.array(np.full(len(place), x), pa.int32()) for x in (g, d)], pa.array(place, pa.int64()), *lists]
    columns += [pa.nulls(len(place), k) for k in _LISTS[5 : 5 + more]]
    rows = pa.RecordBatch.from_arrays(columns, _NAMES[: 5 + more])
    yield from (rows.slice(i, 10_000) for i in range(0, len(place), 10_000))


def _packed_contexts(g: int, d: int, place, ends, s, n) -> pa.RecordBatch:
    data = [packed_keys(place), packed(np.diff(ends), 2), packed(s, 1), packed(n)]
    row = (g, d, None, None, None, len(place), len(s), data, int((n == 1).sum()), int((n == 2).sum()))
    return pa.RecordBatch.from_arrays([pa.array([x], k) for x, k in zip(row, _LISTS)], _NAMES)


def _unpacked_contexts(n_contexts: int, n_pairs: int, data: list[bytes]) -> tuple[np.ndarray, ...]:
    """Places, numbers of next symbols, next symbols and counts."""
    place, sizes, s, n = data
    return unpacked_keys(place, n_contexts), unpacked(sizes, n_contexts, 2), unpacked(s, n_pairs, 1), unpacked(n, n_pairs)


def listed(contexts: DataFrame) -> DataFrame:
    """(g, d, place, s, n): the contexts of a table of ``passing_contexts``, a row for each."""

    def run(batches):
        for batch in batches:
            for r in batch.to_pylist():
                place, sizes, s, n = _unpacked_contexts(r["n_contexts"], r["n_pairs"], r["data"])
                yield from _context_rows(r["g"], r["d"], place, np.concatenate([[0], np.cumsum(sizes)]), s, n)

    packs = contexts.where("data is not null").select("g", "d", "n_contexts", "n_pairs", "data")
    return contexts.where("data is null").select("g", "d", "place", "s", "n").unionByName(packs.mapInArrow(run, _CONTEXT))


def _groups(batches, columns: list[str], key: str = "g") -> Iterator[tuple]:
    """(key, rows) of batches sorted by ``key``, whole groups."""
    last, rows = None, []
    for batch in batches:
        for k, *row in zip(*[batch.column(c).to_pylist() for c in (key, *columns)]):
            if rows and k != last:
                yield last, rows
                rows = []
            last = k
            rows.append(row)
    if rows:
        yield last, rows


# ---- 3. look-up ------------------------------------------------------------------------------


def discounts(contexts: DataFrame, depth: int) -> list[float]:
    """What is taken off every count of a context of each length: singles / (singles + 2 doubles) of its
    pairs, which leaving one occurrence out makes likeliest."""
    times = lambda k: F.sum(F.size(F.filter("n", lambda x: x == k)))
    single = contexts.where("data is null").dropDuplicates(["d", "place"]).groupBy("d").agg(times(1).alias("one"), times(2).alias("two"))
    packs = contexts.where("data is not null").groupBy("d").agg(F.sum("one").alias("one"), F.sum("two").alias("two"))
    found = {r.d: r.one / (r.one + 2 * r.two) for r in single.unionByName(packs).collect() if r.one}
    return [min(0.9, max(0.1, found.get(d, 0.5))) for d in range(depth + 1)]


class SuffixTree:
    """Kept contexts of a range with smoothed distributions, found by search.

    p(a | s) = (n(s, a) - D) / n(s) + D m / n(s) p(a | shorter) for symbols seen after s, and the second
    part alone for others; m is the number of different symbols seen after s, D the discount of its length
    and ``shorter`` the longest kept proper suffix. The empty context is mixed with a uniform distribution.

    Contexts that end with s fill a range of places, and contexts are numbered in the order of places, so
    ascending look-ups read ascending memory. ``bounds`` cuts the places so that each piece has one longest
    context, ``owner``.
    """

    def __init__(self, d: np.ndarray, place: np.ndarray, ends: np.ndarray, s: np.ndarray, times: np.ndarray, depth: int, discount: Sequence[float]):
        self.depth = depth
        sizes = np.diff(ends)
        if not (d == 0).any():
            d, place, sizes = np.append(d, 0), np.append(place, 0), np.append(sizes, 0)
        order = np.lexsort((d, place))
        number = np.empty(len(order), np.int64)
        number[order] = np.arange(len(order))
        d, place = d[order], place[order]
        context = number[np.repeat(np.arange(len(sizes)), sizes)]
        n = len(d)
        total, m = np.bincount(context, times, n), np.bincount(context, minlength=n)
        # the longest context of every piece of places, painted by length
        end = place + (np.int64(1) << BITS * (depth - d))
        self.bounds = np.unique(np.concatenate([place, end]))
        first, stop = np.searchsorted(self.bounds, place), np.searchsorted(self.bounds, end)
        self.owner, self.shorter = np.zeros(len(self.bounds), np.int32), np.zeros(n, np.int32)
        for k in range(1, depth + 1):
            own = np.flatnonzero(d == k)
            self.shorter[own] = self.owner[first[own]]
            length = stop[own] - first[own]
            at = np.arange(length.sum()) - np.repeat(np.cumsum(length) - length - first[own], length)
            self.owner[at] = np.repeat(own, length)
        # the empty context has all symbols
        off = np.asarray(discount)[d]
        keep = context > 0
        root = np.bincount(s[~keep], times[~keep], SIZE)
        keys = np.concatenate([np.arange(SIZE), context[keep] << BITS | s[keep]])
        times = np.concatenate([root, times[keep]]).astype(float)
        order = np.argsort(keys)
        self.keys, times = keys[order], times[order]
        rest = np.ones(n)
        seen = total > 0
        rest[seen] = off[seen] * m[seen] / total[seen]
        self.less, self.found = np.log10(rest), np.zeros(len(self.keys))
        self.found[:SIZE] = np.log10(np.maximum(times[:SIZE] - off[0], 0) / max(1.0, total[0]) + rest[0] / SIZE)
        context = self.keys >> BITS
        level = d[context]
        for k in range(1, depth + 1):
            part = np.flatnonzero(level == k)
            own = context[part]
            base = 10 ** self._log(self.shorter[own], self.keys[part] & LOW)
            self.found[part] = np.log10((times[part] - off[own]) / total[own] + rest[own] * base)

    def _log(self, context: np.ndarray, symbol: np.ndarray) -> np.ndarray:
        """log10 p(symbol | context) of context numbers."""
        out = np.zeros(len(context))
        left, context = np.arange(len(context)), context.astype(np.int64)
        while len(left):
            key = context << BITS | symbol[left]
            at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            hit = self.keys[at] == key
            out[left] += np.where(hit, self.found[at], self.less[context])
            left, context = left[~hit], self.shorter[context[~hit]].astype(np.int64)
        return out

    def look_up(self, keys: np.ndarray) -> np.ndarray:
        """log10 p of the last symbols of strings."""
        owner = self.owner[np.searchsorted(self.bounds, keys >> BITS, "right") - 1]
        return self._log(owner, keys & LOW)


def _logarithms(blobs: DataFrame, contexts: DataFrame, depth: int, discount: list[float]) -> DataFrame:
    """(label, g, n_strings, logs): the packed logarithms of every chunk's strings of a range, in their order."""
    none = lambda c, kind: F.lit(None).cast(kind).alias(c)
    told = contexts.select("g", F.lit(0).alias("kind"), "d", "place", "s", "n", "n_contexts", "n_pairs", "data", none("label", "long"), none("n_strings", "int"), none("strings", "binary"))
    empty = [none(c, k) for c, k in (x.split() for x in f"{_CONTEXT}, {_PACKED}".split(", ")[1:8])]
    asked = blobs.select("g", F.lit(1).alias("kind"), *empty, "label", "n_strings", "strings")
    laid = told.unionByName(asked).repartition("g").sortWithinPartitions("g", "kind")

    def run(batches):
        at, held, tree = None, [], None
        for batch in batches:
            g, kind = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("g", "kind"))
            turn = _firsts(g * 2 + kind)
            for start, stop in zip(turn.tolist(), [*turn[1:].tolist(), batch.num_rows]):
                part = batch.slice(start, stop - start)
                if g[start] != at:
                    at, held, tree = g[start], [], None
                if kind[start] == 0:
                    held += _context_arrays(part)
                    continue
                if tree is None:
                    tree, held = _tree_of(held, depth, discount), []
                columns = [part.column(c).to_pylist() for c in ("label", "n_strings", "strings")]
                for label, n, strings in zip(*columns):
                    logs = np.rint(-tree.look_up(unpacked_keys(strings, n)) * STEPS).astype(np.int64)
                    row = {"label": pa.array([label], pa.int64()), "g": pa.array([at], pa.int32())}
                    row |= {"n_strings": pa.array([n], pa.int32()), "logs": pa.array([packed(logs, 3)], pa.binary())}
                    yield pa.RecordBatch.from_pydict(row)

    return laid.mapInArrow(run, "label long, g int, n_strings int, logs binary")


def _context_arrays(batch: pa.RecordBatch) -> list[tuple[np.ndarray, ...]]:
    """(lengths, places, numbers of next symbols, next symbols, counts) of rows of contexts, packed or not."""
    plain = batch.filter(pc.is_null(batch.column("data")))
    d, place = (plain.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("d", "place"))
    s, n = (plain.column(c) for c in ("s", "n"))
    sizes = pc.list_value_length(s).to_numpy(zero_copy_only=False).astype(np.int64)
    out = [(d, place, sizes, *[x.flatten().to_numpy(zero_copy_only=False).astype(np.int64) for x in (s, n)])]
    for r in batch.filter(pc.is_valid(batch.column("data"))).select(["d", "n_contexts", "n_pairs", "data"]).to_pylist():
        found = _unpacked_contexts(r["n_contexts"], r["n_pairs"], r["data"])
        out.append((np.full(r["n_contexts"], r["d"]), *found))
    return out


def _tree_of(held: list[tuple], depth: int, discount: Sequence[float]) -> SuffixTree:
    none = np.zeros(0, np.int64)
    d, place, sizes, s, n = (np.concatenate(c) for c in zip(*held)) if held else (none,) * 5
    return SuffixTree(d, place, np.concatenate([[0], np.cumsum(sizes)]), s, n, depth, discount)


# ---- 4. texts --------------------------------------------------------------------------------


class Words:
    """The frequent training words, and what the base makes of counts."""

    def __init__(self, frequent: dict[bytes, int]):
        self.frequent = frequent

    def rows(self, lines: list[bytes]):
        """n_tokens, n_known, sum of log10(c + 1) and the words that are not frequent."""
        get, ends = self.frequent.get, self.frequent.get(b"\n", 0)
        flat = b" ".join(filter(None, lines)).split(b" ") if any(lines) else []
        size = np.array([line.count(b" ") + 1 if line else 0 for line in lines], np.int64)
        c = np.fromiter(map(get, flat, repeat(0)), np.int64, len(flat))
        owner = np.repeat(np.arange(len(lines)), size)
        base = np.bincount(owner, np.log10(c + 1.0), len(lines)) + np.log10(ends + 1)
        rare = np.flatnonzero(c == 0)
        n_rare = np.bincount(owner[rare], minlength=len(lines))
        offsets = pa.array(np.concatenate([[0], np.cumsum(n_rare)]), pa.int32())
        lists = pa.ListArray.from_arrays(offsets, pa.array([flat[i] for i in rare.tolist()], pa.binary()))
        return size + 1, size - n_rare + (ends > 0), base, lists


def _text_logs(keys: np.ndarray, lengths: np.ndarray, strings: np.ndarray, logs: np.ndarray) -> np.ndarray:
    """Summed logarithms of texts whose symbols are ``keys``; ``logs`` are those of the different ``strings``,
    ascending. A string is sorted with the number of its text in the last byte, TEXTS texts at a time."""
    ends, out = np.concatenate([[0], np.cumsum(lengths)]), np.empty(len(lengths))
    for start in range(0, len(lengths), TEXTS):
        own = lengths[start : start + TEXTS]
        mixed = keys[ends[start] : ends[start + len(own)]].astype(np.uint64) << 8
        mixed |= np.repeat(np.arange(len(own), dtype=np.uint64), own)
        mixed.sort()
        mine = (mixed >> 8).astype(np.int64)
        first = _firsts(mine)
        found = logs[np.searchsorted(strings, mine[first])]
        of_symbol = np.repeat(found, np.diff(np.append(first, len(mine))))
        out[start : start + len(own)] = np.bincount((mixed & (TEXTS - 1)).astype(np.int64), of_symbol, len(own))
    return out


_RESULTS = {"n_tokens": "bigint", "n_known": "bigint", "base_score": "double", "score": "double"}


def score(docs: DataFrame, training: DataFrame | Column, text: str = "text", depth: int = DEPTH) -> DataFrame:
    """``docs`` without its text, with n_tokens, n_known, train_tokens (long), base_score and score (double):
    the log10 of the unigram base's and of the tree's probability of the whole text.

    ``training`` is a condition on ``docs``, true for the rows to learn from, or another table with a column
    ``text``; both the base and the tree count all of it.

    - A NULL or empty text is the end sign alone, in training and in scoring.
    - A symbol's logarithm is rounded to 1 / STEPS on its way, so a score is off by half that a symbol at most.
    - Without training texts the tree is uniform over symbols and nothing is known. A NULL condition is
      not true.
    - Repeated rows count as often as they stand in ``training`` and are scored alike; whole texts of
      any length are read. An empty table gives an empty table.
    - Other columns pass through; columns with the names of the five results are replaced.

    The counts of the MAX_WORDS most frequent words are broadcast; a text's other words are joined to
    the word counts, a row for each. Contexts and strings are dealt out by ranges of about RANGE_SYMBOLS
    training symbols, texts and logarithms by chunks; nothing of the tree is broadcast.
    """
    with brief_shuffles(docs.sparkSession):  # each step ends in a written table
        return _score(docs, training, text, depth)


def _score(docs: DataFrame, training: DataFrame | Column, text: str, depth: int) -> DataFrame:
    spark = docs.sparkSession
    plain = docs.drop(*_RESULTS, "train_tokens")
    learn, scored = fresh(plain, "__learn", "__scored")
    if isinstance(training, Column):
        flag = docs.select("*", F.coalesce(training, F.lit(False)).alias(learn)).drop(*_RESULTS, "train_tokens")
        rows = flag.withColumn(scored, F.lit(True))
        learned = flag.where(learn).select(F.col(f"`{text}`").alias("text"))
    else:
        learned = training.select("text")
        rows = plain.withColumns({learn: F.lit(False), scored: F.lit(True)})
        rows = rows.unionByName(learned.select(F.col("text").alias(text), F.lit(True).alias(learn), F.lit(False).alias(scored)), allowMissingColumns=True)
    rows = rows.withColumn(text, F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")))
    counts = written(count_words(learned.select(F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))), "word-counts")
    end = F.col("word") == F.lit(b"\n")
    sums = counts.agg(
        F.coalesce(F.sum(F.when(~end, F.col("n"))), F.lit(0)).alias("words"),
        F.coalesce(F.sum(F.when(end, F.col("n"))), F.lit(0)).alias("texts"),
        F.count(F.when(~end, 1)).alias("different"),
        F.coalesce(F.sum(F.col("n") * (F.octet_length("word") + 1)), F.lit(0)).alias("symbols"),
    ).first()
    norm = float(np.log10(sums.words + sums.texts + sums.different + (sums.texts > 0) + 1))
    top = largest(counts.where(F.octet_length("word") <= WORD_BYTES), "n", MAX_WORDS).toArrow().to_pydict()
    shared = share(spark, Words(dict(zip(top["word"], top["n"])) | ({b"\n": sums.texts} if sums.texts else {})))
    alphabet = Alphabet.of(counts)
    cuts, head = range_cuts(counts, alphabet, depth, sums.symbols)

    inner = rows.select([F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(rows.columns)])  # clashes with no inner name
    name = {c: f"c{i}" for i, c in enumerate(rows.columns)}
    kept = [c for c in plain.columns if c != text]
    schema = StructType([f for f in inner.schema if f.name in {name[c] for c in kept}])
    for f in StructType.fromDDL(", ".join(f"{c} {kind}" for c, kind in {**_RESULTS, "rare": "array<binary>"}.items())):
        schema = schema.add(f)
    at_text = name[text]

    def summed(key, left: pa.Table, right: pa.Table) -> pa.Table:
        from pyspark.sql.pandas.types import to_arrow_schema

        kinds = to_arrow_schema(schema)
        parts = [pa.ipc.open_stream(r).read_all() for r in left.column("rows").to_pylist()]
        symbols = [alphabet.strings_of(p.column(at_text).to_pylist(), depth) for p in parts]
        strings = np.concatenate([keys for keys, _ in symbols])
        strings.sort()
        strings = strings[_firsts(strings)]
        given = sorted(right.select(["g", "n_strings", "logs"]).to_pylist(), key=lambda r: r["g"])
        logs = np.concatenate([unpacked(r["logs"], r["n_strings"], 3) for r in given]) / -STEPS
        out = []
        for part, (keys, lengths) in zip(parts, symbols):
            n_tokens, n_known, base, unknown = shared.value.rows(part.column(at_text).to_pylist())
            of_text = _text_logs(keys, lengths, strings, logs)
            made = [c if k == "rare" else pa.array(c, kinds.field(k).type) for k, c in zip((*_RESULTS, "rare"), (n_tokens, n_known, base, of_text, unknown))]
            out.append(pa.table([*[part.column(c).cast(kinds.field(c).type) for c in kinds.names[:-5]], *made], names=kinds.names))
        return pa.concat_tables(out)

    labelled = chunked(inner, alphabet, depth, cuts, name[text], name[learn], name[scored])
    buckets = max(sums.symbols // CHUNK_SYMBOLS, int(spark.conf.get("spark.sql.shuffle.partitions")))
    with bucketed(labelled, "chunks", "label", min(buckets, MAX_BUCKETS)) as chunks:
        blobs = chunks.where("g is not null").select("label", "g", "n_strings", "strings", "counts")
        contexts = passing_contexts(blobs, depth, head, cuts)
        logs = _logarithms(blobs.where("label is not null"), contexts, depth, discounts(contexts, depth))
        packs = chunks.where("rows is not null").select("label", "rows")
        found = packs.groupBy("label").cogroup(logs.groupBy("label")).applyInArrow(summed, schema)
        parts = written(found.withColumn("rid", F.monotonically_increasing_id()), "scored")  # the ids of the rows hold from here on
    words = parts.select("rid", F.explode("rare").alias("word")).join(counts, "word")
    known = words.groupBy("rid").agg(F.count(F.lit(1)).alias("more"), F.sum(F.log10(F.col("n") + 1)).alias("log"))
    out = parts.join(known, "rid", "left")
    return out.select(
        *[F.col(name[c]).alias(c) for c in kept],
        "n_tokens",
        (F.col("n_known") + F.coalesce("more", F.lit(0))).alias("n_known"),
        F.lit(sums.words + sums.texts).cast("long").alias("train_tokens"),
        (F.col("base_score") + F.coalesce("log", F.lit(0.0)) - F.col("n_tokens") * F.lit(norm)).alias("base_score"),
        "score",
    )
