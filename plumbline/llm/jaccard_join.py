"""N-gram Jaccard join: exact components of documents whose word shingle sets are alike.

Set relations save most of the work, at three places:

- Equal sets are one node; only nodes are joined.
- Index lists (shingle to the sets that have it in their prefix) are sorted by the shingle's position
  in the set. From one set, whole blocks of a list are skipped whose position is too late to reach the
  wanted overlap; sets already tied to it through another one are skipped too.
- Of sets that are highly similar, the overlaps of the second with all others are derived from the
  first one's: only the index lists of the shingles in which the two differ are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.llm.components import connected
from plumbline.llm.tables import fresh, largest, map_pieces, written
from plumbline.session import share

WORDS = 5
PERCENT = 80
LIST_ROWS = 4096  # sets of an index list that are searched together; longer lists go in pairs of blocks
SHORT_LIST = 12  # sets of an index list whose pairs are looked at one by one
BLOCK_SHINGLES = 500_000  # shingles of a block of sets that are compared together
LONG_WORD = 64  # bytes; longer words are hashed one by one
PIECE = 1 << 19  # bytes of text that are hashed together
ORDER_SAMPLE = 65_536  # texts that show which shingles are frequent; decides the order, never a result
ORDER_BYTES = 256 << 20  # and their size
FREQUENT = 4  # texts of that sample that share a frequent shingle
FREQUENT_SHINGLES = 1_000_000  # of which so many, the most frequent, are broadcast at most

_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LAST = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)  # the first k bytes of eight


class Shingler:
    """64-bit hashes of word shingles. Words are hashed by mixing, not as polynomials: those with a base that
    is known agree on words made for it, and modulo a power of two on Thue-Morse words whatever the base."""

    def __init__(self, words: int):
        self.words = words

    def sets(self, texts: list[str | None]) -> list[np.ndarray]:
        """The distinct shingles of each text, ascending."""
        raw = [(t or "").encode("utf-8", "surrogatepass").lower() for t in texts]
        data = np.frombuffer(b"\n".join([b"", *raw, b"\n" * 8]), np.uint8)
        space = _IS_SPACE[data]
        starts = np.flatnonzero(~space[1:] & space[:-1]) + 1
        ends = np.flatnonzero(space[1:] & ~space[:-1]) + 1
        hashes = word_hashes(data, starts, ends)
        first = np.searchsorted(starts, np.cumsum([1] + [len(r) + 1 for r in raw]))
        return [self._shingles(hashes[a:b]) for a, b in zip(first, first[1:])]

    def _shingles(self, words: np.ndarray) -> np.ndarray:
        n = min(self.words, len(words))
        if not n:
            return np.zeros(0, np.uint64)
        found = np.full(len(words) - n + 1, n, np.uint64)
        for k in range(n):
            found = mixed(found + words[k : len(words) - n + 1 + k])
        return np.unique(found)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of the words that lie from ``starts`` to ``ends``: eight bytes at a time are mixed in, very long
    words go through blake2b. ``data`` goes on for seven bytes behind the last word."""
    sizes = ends - starts
    hashes = mixed(sizes.astype(np.uint64))
    if not len(starts):
        return hashes
    windows = np.lib.stride_tricks.sliding_window_view(data, 8)
    some = np.flatnonzero(sizes <= LONG_WORD)
    for at in range(0, LONG_WORD, 8):
        some = some[sizes[some] > at]
        if not len(some):
            break
        part = windows[starts[some] + at].view("<u8").ravel()
        part &= _LAST[np.minimum(sizes[some] - at, 8)]
        hashes[some] = mixed(hashes[some] + part)
    for i in np.flatnonzero(sizes > LONG_WORD).tolist():
        digest = hashlib.blake2b(data[starts[i] : ends[i]].tobytes(), digest_size=8).digest()
        hashes[i] = int.from_bytes(digest, "little")
    return hashes


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


def node_of(shingles: np.ndarray) -> int:
    """A signed 64-bit number that stands for a set."""
    return int.from_bytes(hashlib.blake2b(shingles.tobytes(), digest_size=8).digest(), "little", signed=True)


def prefix_of(shingles: np.ndarray, frequent: np.ndarray, percent: int) -> np.ndarray:
    """The first shingles, frequent ones last, of which any set as similar as wanted shares one."""
    n = len(shingles)
    length = n - -(-percent * n // 100) + 1 if n else 0
    if len(frequent):
        at = np.minimum(np.searchsorted(frequent, shingles), len(frequent) - 1)
        hot = frequent[at] == shingles
        shingles = np.concatenate([shingles[~hot][:length], shingles[hot][:length]])
    return shingles[:length]


def sketch_of(shingles: np.ndarray) -> bytes:
    """Shingles per bucket (up to 255), in a power of two of buckets, about eight shingles to each."""
    buckets = 1 << max(4, (len(shingles) // 8).bit_length())
    counts = np.bincount((shingles & np.uint64(buckets - 1)).astype(np.int64), minlength=buckets)
    return np.minimum(counts, 255).astype(np.uint8).tobytes()


def least_overlap(a, b, percent: int):
    """Shingles that sets of ``a`` and ``b`` shingles must share at least."""
    return -(-percent * (a + b) // (100 + percent))


def candidate_edges(sizes: np.ndarray, positions: np.ndarray, sketches: list[bytes], percent: int, tied: np.ndarray | None = None) -> list[tuple[int, int]]:
    """Edges that tie together all sets of one index list that may be similar, directly or through others.
    ``tied`` numbers the groups in which sets are tied already.

    Two sets may be similar if the overlap that sizes and positions allow is enough, and the buckets
    of their sketches do not show too many differing shingles. Neither bound ever excludes a similar
    pair in the list of the first shingle that the two share.
    """
    search = _ListSearch(sizes, positions, sketches, percent)
    label = np.arange(len(sizes)) if tied is None else np.unique(tied, return_inverse=True)[1][search.order]
    edges = []
    largest = np.bincount(label).argmax()
    outside = np.flatnonzero(label != largest)
    if 2 * len(outside) < len(label):  # most are tied: only look around the others
        for x in outside:
            for y in search.near(x, np.flatnonzero(label != label[x])):
                if label[x] != label[y]:
                    edges.append((x, y))
                    label[label == label[y]] = label[x]
    else:  # go from set to set; what has been reached is not looked at again
        left = np.arange(len(label))
        while len(left) > 1:
            stack, left = [left[0]], left[1:]
            while stack and len(left):
                x = stack.pop()
                found = search.near(x, left)
                if len(found):
                    edges.extend((x, y) for y in found)
                    stack.extend(found.tolist())
                    left = left[~np.isin(left, found)]
    return [(int(search.order[x]), int(search.order[y])) for x, y in edges]


class _ListSearch:
    """The sets of an index list in order of position, which makes its blocks."""

    def __init__(self, sizes: np.ndarray, positions: np.ndarray, sketches: list[bytes], percent: int):
        self.percent, self.order = percent, np.lexsort((sizes, positions))
        self.sizes, self.positions = sizes[self.order], positions[self.order]
        self.lengths = np.array([len(sketches[i]) for i in self.order])
        self.row = np.zeros(len(sizes), np.int64)
        self.buckets: dict[int, np.ndarray] = {}
        for kind in np.unique(self.lengths).tolist():
            at = np.flatnonzero(self.lengths == kind)
            self.row[at] = np.arange(len(at))
            self.buckets[kind] = np.frombuffer(b"".join([sketches[self.order[i]] for i in at]), np.uint8).reshape(-1, kind).astype(np.int16)

    def near(self, x: int, others: np.ndarray) -> np.ndarray:
        """Those of ``others`` (ascending) that may be similar to ``x``."""
        size, position, percent = self.sizes[x], self.positions[x], self.percent
        # a set may have at most size * 100 / percent shingles, of which it must share these
        latest = size * 100 // percent - -(-percent * size // 100)
        block = others[: np.searchsorted(self.positions[others], latest, "right")]
        needed = least_overlap(size, self.sizes[block], percent)
        possible = 1 + np.minimum(size - position - 1, self.sizes[block] - self.positions[block] - 1)
        block = block[(possible >= needed) & (np.minimum(size, self.sizes[block]) >= needed)]
        mine, out = self.buckets[int(self.lengths[x])][self.row[x]], [np.zeros(0, np.int64)]
        for kind in np.unique(self.lengths[block]).tolist():
            some = block[self.lengths[block] == kind]
            both = min(kind, len(mine))
            theirs = self.buckets[kind][self.row[some]].reshape(len(some), -1, both).sum(axis=1)
            apart = np.abs(theirs - mine.reshape(-1, both).sum(axis=0)).sum(axis=1)
            out.append(some[apart <= size + self.sizes[some] - 2 * least_overlap(size, self.sizes[some], percent)])
        return np.concatenate(out)


def similar_edges(sets: list[np.ndarray], percent: int) -> list[tuple[int, int]]:
    """Edges between similar sets that tie together all sets which similarity connects."""
    m = len(sets)
    sizes = np.array([len(s) for s in sets])
    owner = np.repeat(np.arange(m), sizes)
    _, token = np.unique(np.concatenate(sets), return_inverse=True)
    starts = np.concatenate([[0], np.cumsum(sizes)])
    own = [token[a:b] for a, b in zip(starts, starts[1:])]
    by_token = np.argsort(token, kind="stable")
    lists, first = owner[by_token], np.concatenate([[0], np.cumsum(np.bincount(token))])

    def overlaps(tokens: np.ndarray) -> np.ndarray:
        """How many of ``tokens`` every set has, from their index lists."""
        n = first[tokens + 1] - first[tokens]
        at = np.repeat(first[tokens] - (np.cumsum(n) - n), n) + np.arange(n.sum())
        return np.bincount(lists[at], minlength=m)

    def overlaps_of_few(x: int, few: np.ndarray) -> np.ndarray:
        """How many shingles of ``x`` the sets ``few`` have, from their own shingles."""
        mark = np.zeros(len(first) - 1, np.int64)
        mark[own[x]] = 1
        out = np.zeros(m, np.int64)
        out[few] = np.add.reduceat(mark[np.concatenate([own[z] for z in few])], np.cumsum(sizes[few]) - sizes[few])
        return out

    edges, left = [], np.ones(m, bool)
    last, counts = None, None
    for seed in range(m):
        if not left[seed]:
            continue
        left[seed] = False
        stack = [seed]
        while stack and left.any():
            x = stack.pop()
            few = np.flatnonzero(left)
            if 16 * len(few) < m:
                last, now = None, overlaps_of_few(x, few)
                _reached(x, now, left, sizes, percent, edges, stack)
                continue
            gained = lost = None
            if last is not None:
                gained, lost = np.setdiff1d(own[x], own[last], assume_unique=True), np.setdiff1d(own[last], own[x], assume_unique=True)
            if gained is not None and len(gained) + len(lost) < len(own[x]):
                counts = counts + overlaps(gained) - overlaps(lost)
            else:
                counts = overlaps(own[x])
            last = x
            _reached(x, counts, left, sizes, percent, edges, stack)
    return edges


def _reached(x: int, counts: np.ndarray, left: np.ndarray, sizes: np.ndarray, percent: int, edges: list, stack: list) -> None:
    """Take the sets that are left and similar to ``x``, which shares ``counts`` shingles with each."""
    similar = np.flatnonzero(left & (100 * counts >= percent * (sizes + sizes[x] - counts)))
    left[similar] = False
    edges.extend((x, int(y)) for y in similar)
    stack.extend(similar.tolist())


def _pairs_of_blocks(df: DataFrame, blocks: str, own: str) -> DataFrame:
    """Every row once for each pair (i, j) of blocks its own block is part of; once if there is one block."""
    other = F.explode(F.sequence(F.lit(0), F.col(blocks) - 1))
    return df.withColumn("__o", other).withColumns({"i": F.least(own, "__o"), "j": F.greatest(own, "__o")}).drop("__o")


def similar_components(docs: DataFrame, id_col: str = "doc_id", text: str = "text", words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """(doc_id, n_shingles, component_id) for every row of ``docs``.

    A text's set has its distinct shingles of ``words`` words (lower-cased A-Z, split at ASCII white
    space); the whole sequence if there are fewer. Two texts are linked if they share ``percent`` of
    the shingles that either has. component_id is the smallest id reached by links, itself included.

    - A NULL or empty text, or one without words, has no shingles and is linked with nothing.
    - Equal sets are linked whatever their texts; repeated rows are such. Rows may share an id.
    - A NULL id is never the smallest; a component of NULL ids has a NULL component_id.
    - An empty table gives an empty table. Other columns are not read.

    No pairs are listed: a task that finds sets connected gives as many edges as ties them together.
    Shingles are compared by 64-bit hashes.
    """
    found = _labelled(docs, id_col, text, words, percent)
    return found.select("doc_id", "n_shingles", "component_id")


def _labelled(docs: DataFrame, id_col: str, text: str, words: int, percent: int) -> DataFrame:
    """The result with the node of every row."""
    shingler = Shingler(words)
    ident = F.col(f"`{id_col}`")
    # rows without an id need some key to be found by
    texts = docs.select(ident.alias("doc_id"), F.coalesce(ident.cast("bigint"), F.lit(-(1 << 63))).alias("key"), F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("text"))
    shared = share(docs.sparkSession, _frequent_shingles(texts, shingler))

    def describe(values):
        sets = shingler.sets(values)
        prefix = [prefix_of(s, shared.value, percent).astype(np.int64) for s in sets]
        return [node_of(s) for s in sets], [len(s) for s in sets], [sketch_of(s) if len(s) else b"" for s in sets], prefix

    outputs = {"node": "bigint", "n_shingles": "bigint", "sketch": "binary", "prefix": "array<bigint>"}
    base = written(map_pieces(texts, describe, ["text"], outputs, ["doc_id", "key"], PIECE), "shingle-sets")
    by_node = base.where("n_shingles > 0").groupBy("node")
    nodes = written(by_node.agg(F.min("key").alias("key"), F.min("doc_id").alias("doc_id"), F.first("n_shingles").alias("n_shingles")), "nodes")

    clusters = _candidate_clusters(base.join(nodes.where("n_shingles > 1").select("key", "node"), ["key", "node"], "left_semi"), percent)
    labels = connected(_similar_links(texts, nodes, shingler, clusters, percent))
    labelled = nodes.join(labels, "node", "left").select("node", "doc_id", F.coalesce("label", "node").alias("group"))
    least = labelled.groupBy("group").agg(F.min("doc_id").alias("component_id"))
    named = labelled.join(least, "group").select("node", "component_id")
    # a text without shingles has a node that is not among the named ones
    out = base.select("doc_id", "node", "n_shingles").join(named, "node", "left")
    return out.withColumn("component_id", F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id")))


def _frequent_shingles(texts: DataFrame, shingler: Shingler) -> np.ndarray:
    """Shingles that several texts of a bounded sample share (by hash of the text), ascending.

    They come last in the order of shingles, so that lists of boilerplate stay short. Any order gives
    the same result.
    """
    total = texts.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("size")).first()
    share_of = min(1.0, ORDER_SAMPLE / max(1, total["n"]), ORDER_BYTES / max(1, total["size"]))
    sample = texts.where(F.pmod(F.xxhash64("text"), F.lit(1 << 30)) <= int((1 << 30) * share_of))
    sets = map_pieces(sample.dropDuplicates(["text"]), lambda v: ([s.astype(np.int64) for s in shingler.sets(v)],), ["text"], {"s": "array<bigint>"}, [], PIECE)
    rows = sets.select(F.explode("s").alias("s")).groupBy("s").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= FREQUENT)
    rows = largest(written(rows, "frequent-shingles"), "n", FREQUENT_SHINGLES).select("s").toArrow()
    return np.sort(rows.column("s").to_numpy().astype(np.uint64))


def _candidate_clusters(reps: DataFrame, percent: int) -> DataFrame:
    """(node, cluster): nodes that may be connected by similarity are in one cluster.

    The pairs of a short list go through the sketches once each, however many lists they are in; the
    sets of a long list are searched with their sketches at hand, in pairs of blocks if they are very
    many.
    """
    rows = reps.select("node", F.col("n_shingles").cast("int").alias("size"), F.posexplode("prefix").alias("position", "shingle"))
    laid = rows.select("shingle", "node", "size", "position").repartition("shingle").sortWithinPartitions("shingle")
    split = lambda batches: _pairs_of_short_lists(batches, percent)
    found = written(laid.mapInArrow(split, "a bigint, b bigint, shingle bigint, size int, position int"), "index-lists")
    sketches = reps.select("node", "sketch").dropDuplicates(["node"])

    pairs = found.where("b is not null").select("a", "b").distinct()
    for side in ("a", "b"):
        pairs = pairs.join(sketches.withColumnsRenamed({"node": side, "sketch": f"sketch_{side}"}), side)
    sizes = reps.select("node", F.col("n_shingles").cast("int").alias("n")).dropDuplicates(["node"])
    for side in ("a", "b"):
        pairs = pairs.join(sizes.withColumnsRenamed({"node": side, "n": f"n_{side}"}), side)

    def near(batches):
        for batch in batches:
            a, b = batch.column("a"), batch.column("b")
            columns = [batch.column(c).to_pylist() for c in ("sketch_a", "sketch_b", "n_a", "n_b")]
            kept = pa.array([_may_be_similar(*row, percent) for row in zip(*columns)], pa.bool_())
            yield pa.RecordBatch.from_arrays([a.filter(kept), b.filter(kept)], names=["a", "b"])

    tied = pairs.mapInArrow(near, "a bigint, b bigint")

    entries = found.where("b is null").select("shingle", F.col("a").alias("node"), "size", "position").dropDuplicates(["shingle", "node"])
    lists = entries.groupBy("shingle").agg(F.ceil(F.count(F.lit(1)) / LIST_ROWS).cast("int").alias("blocks"))
    entries = entries.join(lists, "shingle").withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    placed = _pairs_of_blocks(entries, "blocks", "block").join(sketches, "node").select("shingle", "i", "j", "node", "size", "position", "sketch")
    in_lists = placed.repartition("shingle", "i", "j").sortWithinPartitions("shingle", "i", "j")

    def search(batches):
        tied = Tied()

        def rows():
            a, b = zip(*tied.edges) if tied.edges else ((), ())
            return pa.RecordBatch.from_pydict({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

        for node, size, position, sketch in _groups(batches, 3):
            roots = [tied.root(x) for x in node]
            if len(set(roots)) > 1:
                for x, y in candidate_edges(np.array(size), np.array(position), sketch, percent, np.array(roots)):
                    tied.tie(node[x], node[y])
                if len(tied.edges) > 200_000:
                    yield rows()
                    tied = Tied()
        yield rows()

    edges = tied.unionByName(in_lists.mapInArrow(search, "a bigint, b bigint")).distinct()
    return connected(edges).withColumnRenamed("label", "cluster")


def _may_be_similar(a: bytes, b: bytes, size_a: int, size_b: int, percent: int) -> bool:
    """Do the buckets of two sketches leave few enough differing shingles?"""
    x, y = np.frombuffer(a, np.uint8).astype(np.int16), np.frombuffer(b, np.uint8).astype(np.int16)
    both = min(len(x), len(y))
    apart = np.abs(x.reshape(-1, both).sum(axis=0) - y.reshape(-1, both).sum(axis=0)).sum()
    return bool(apart <= size_a + size_b - 2 * least_overlap(size_a, size_b, percent))


def _pairs_of_short_lists(batches, percent: int):
    """From rows (shingle, node, size, position) sorted by shingle: (a, b) for the pairs of lists of up to
    SHORT_LIST sets whose sizes and positions allow enough overlap, and the rows of longer lists."""
    def pairs(columns):
        shingle, node, size, position = columns
        starts = np.flatnonzero(np.concatenate([[True], shingle[1:] != shingle[:-1]])) if len(shingle) else np.zeros(0, np.int64)
        length = np.repeat(np.diff(np.append(starts, len(shingle))), np.diff(np.append(starts, len(shingle))))
        out = []
        for d in range(1, min(SHORT_LIST, len(shingle))):
            i = np.flatnonzero((shingle[d:] == shingle[:-d]) & (length[d:] <= SHORT_LIST))
            j = i + d
            needed = least_overlap(size[i], size[j], percent)
            possible = 1 + np.minimum(size[i] - position[i] - 1, size[j] - position[j] - 1)
            good = (possible >= needed) & (np.minimum(size[i], size[j]) >= needed) & (node[i] != node[j])
            i, j = i[good], j[good]
            out.append(np.stack([np.minimum(node[i], node[j]), np.maximum(node[i], node[j])]))
        found = np.unique(np.concatenate(out, axis=1), axis=1) if out else np.zeros((2, 0), np.int64)
        long = length > SHORT_LIST
        return found, [c[long] for c in columns]

    def batch_of(found, long):
        n, m = found.shape[1], len(long[0])
        none, some = [None] * n, [None] * m
        return pa.RecordBatch.from_pydict(
            {
                "a": pa.array(np.concatenate([found[0], long[1]]), pa.int64()),
                "b": pa.concat_arrays([pa.array(found[1], pa.int64()), pa.array(some, pa.int64())]),
                "shingle": pa.concat_arrays([pa.array(none, pa.int64()), pa.array(long[0], pa.int64())]),
                "size": pa.concat_arrays([pa.array(none, pa.int32()), pa.array(long[2].astype(np.int32))]),
                "position": pa.concat_arrays([pa.array(none, pa.int32()), pa.array(long[3].astype(np.int32))]),
            }
        )

    nothing = np.zeros((2, 0), np.int64)
    rest, in_long = [np.zeros(0, np.int64)] * 4, None  # the list at the end of a batch goes on in the next
    for batch in batches:
        own = [c.to_numpy(zero_copy_only=False).astype(np.int64) for c in batch.columns]
        if in_long is not None and len(own[0]):
            n = int(np.searchsorted(own[0] != in_long, True)) if own[0][0] == in_long else 0
            n = len(own[0]) if n == 0 and own[0][0] == in_long else n
            if n:
                yield batch_of(nothing, [c[:n] for c in own])
                own = [c[n:] for c in own]
            if len(own[0]):
                in_long = None
        columns = [np.concatenate([a, b]) for a, b in zip(rest, own)]
        if not len(columns[0]):
            rest = columns
            continue
        last = int(np.searchsorted(columns[0], columns[0][-1], "left"))
        if len(columns[0]) - last > SHORT_LIST:
            yield batch_of(nothing, [c[last:] for c in columns])
            in_long = columns[0][-1]
            rest = [np.zeros(0, np.int64)] * 4
        else:
            rest = [c[last:] for c in columns]
        yield batch_of(*pairs([c[:last] for c in columns]))
    yield batch_of(*pairs(rest))


class Tied:
    """Nodes that edges have tied together so far, and the edges that did."""

    def __init__(self):
        self.up: dict[int, int] = {}
        self.edges: list[tuple[int, int]] = []

    def root(self, x: int) -> int:
        while (above := self.up.get(x, x)) != x:
            self.up[x] = x = self.up.get(above, above)
        return x

    def tie(self, x: int, y: int) -> None:
        a, b = sorted((self.root(x), self.root(y)))
        if a != b:
            self.up[b] = a
            self.edges.append((a, b))


def _groups(batches, keys: int) -> Iterator[list[list]]:
    """Columns behind the first ``keys`` of consecutive rows that agree in those."""
    current, held = None, None
    for batch in batches:
        columns = [c.to_pylist() for c in batch.columns]
        for row in zip(*columns):
            if row[:keys] != current:
                if held:
                    yield held
                current, held = row[:keys], [[] for _ in row[keys:]]
            for c, v in zip(held, row[keys:]):
                c.append(v)
    if held:
        yield held


def _similar_links(texts: DataFrame, nodes: DataFrame, shingler: Shingler, clusters: DataFrame, percent: int) -> DataFrame:
    """(a, b) of similar nodes: enough edges to tie together all that similarity connects."""
    members = clusters.join(nodes, "node")
    sizes = members.groupBy("cluster").agg(F.ceil(F.sum("n_shingles") / BLOCK_SHINGLES).cast("int").alias("blocks"))
    members = members.join(sizes, "cluster")
    found = texts.select("key", "text").join(members.select("key", "node", "cluster", "blocks"), "key").drop("key")

    def sets(values, nodes):
        made = shingler.sets(values)  # rows that share an id may have another text: only the node's own counts
        return ([s.tobytes() if node_of(s) == node else None for s, node in zip(made, nodes)],)

    sets_of = map_pieces(found, sets, ["text", "node"], {"shingles": "binary"}, ["node", "cluster", "blocks"], PIECE).where("shingles is not null")
    placed = _pairs_of_blocks(sets_of.withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")), "blocks", "block")

    def compare(rows: pa.Table) -> pa.Table:
        own = dict(zip(rows.column("node").to_pylist(), rows.column("shingles").to_pylist()))
        node = np.array(list(own), np.int64)
        edges = similar_edges([np.frombuffer(s, np.uint64) for s in own.values()], percent) if len(own) > 1 else []
        at = np.array(edges, np.int64).reshape(-1, 2)
        return pa.table({"a": node[at[:, 0]], "b": node[at[:, 1]]})

    grouped = placed.select("cluster", "i", "j", "node", "shingles").groupBy("cluster", "i", "j")
    return grouped.applyInArrow(compare, "a long, b long")


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text: str = "text", words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """``docs`` with one row of each component: that of the smallest id, and of the smallest set hash
    among rows that share this id. Texts without shingles and rows without an id all stay."""
    key, kept_node, node = fresh(docs, "__key", "__kept", "__node")
    found = _labelled(docs, id_col, text, words, percent).where("doc_id is not null")
    chosen = found.where("n_shingles > 0").groupBy("component_id").agg(F.min(F.struct("doc_id", "node")).alias("x")).select("x.doc_id", "x.node")
    kept = written(chosen.union(found.where("n_shingles = 0").select("doc_id", "node")).toDF(key, kept_node).distinct(), "kept-rows")
    ident = F.col(f"`{id_col}`")
    out = docs.join(kept, ident == F.col(key), "left_semi")
    if docs.groupBy(ident).count().where(ident.isNotNull() & (F.col("count") > 1)).limit(1).count():
        shingler = Shingler(words)
        out = map_pieces(out, lambda v: ([node_of(s) for s in shingler.sets(v)],), [text], {node: "bigint"})
        out = out.join(kept, (ident == F.col(key)) & (F.col(node) == F.col(kept_node)), "left_semi")
        wordless = F.col(node) == node_of(np.zeros(0, np.uint64))
        out = out.where(~wordless).dropDuplicates([id_col, node]).unionByName(out.where(wordless)).drop(node)
    return out.unionByName(docs.where(ident.isNull()))
