"""Cross-tokenizer alignment: groups of tokens of two vocabularies that cover the same bytes.

Both token sequences of a text cover the same bytes. A cut is a byte offset at which a token of either
side ends. The groups between cuts are found by divide and conquer: an interval looks for a common end
near its middle, trying the ends of its first side from the middle outwards and bisecting the other
side's ends for each; the cut splits it and both halves go on. An interval without one is a group. All
intervals of a block of texts that are open at a level are searched side by side.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Sequence
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType
from tokenizers import Tokenizer

from plumbline.llm.bpe import byte_signs
from plumbline.llm.tables import fresh, map_pieces, written
from plumbline.session import share

BLANK = "▁"  # a piece's sign for a blank
SET_PAIRS = 4_000_000  # pairs in one broadcast set of counts
SETS_AT_ONCE = 4  # sets that a pass over the texts looks into
CACHE = 150_000  # words a worker keeps between texts
PIECE_BYTES = 1 << 20  # of text aligned together

#: Fixed value: how a byte-level file without a pattern of its own splits texts.
BYTE_LEVEL_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
LONG_GAP = re.compile(r"\s{1000}")


class ByteTokens:
    """Side A: a byte-level BPE file of the tokenizers library; it encodes a blank and the text.

    Where the file has the plain byte-level steps and ids in the order of its merges, the faster coder of
    tiktoken gives the same ids; texts with a very long run of white space, which that cannot split, and
    all texts of other files are encoded by the tokenizers library.
    """

    def __init__(self, file: str):
        self.file, self.coder, self.quick = file, None, None
        signs = {s: b for b, s in enumerate(byte_signs())}
        spec = json.loads(file)
        added = {x["content"]: x["id"] for x in spec["added_tokens"]}
        entries = {**spec["model"]["vocab"], **added}
        self.size = max(entries.values()) + 1
        self.bytes = [b""] * self.size
        for token, i in entries.items():
            self.bytes[i] = token.encode() if token in added else bytes(signs[c] for c in token)
        self.ranks = {self.bytes[i]: i for token, i in entries.items() if token not in added} if _plain(spec, added) else None

    def __getstate__(self):
        return {**self.__dict__, "coder": None, "quick": None}

    def _start(self) -> None:
        self.coder = Tokenizer.from_str(self.file)
        self.coder.encode_special_tokens = True  # their strings in a text are plain text
        self.coder.no_truncation()
        self.coder.no_padding()
        if self.ranks:
            self.quick = tiktoken.Encoding("byte level", pat_str=BYTE_LEVEL_SPLIT, mergeable_ranks=self.ranks, special_tokens={})

    def encode(self, texts: Sequence[str]) -> list[np.ndarray | None]:
        """Ids of each text; None where its bytes are not those of its tokens."""
        if self.coder is None:
            self._start()
        out: list[np.ndarray | None] = []
        for text in texts:
            if self.quick and not LONG_GAP.search(text):
                ids = self.quick.encode_ordinary(" " + text)  # splits and merges bytes, so it changes none
            else:
                ids = self.coder.encode(" " + text, add_special_tokens=False).ids
                if b"".join([self.bytes[i] for i in ids]) != _bytes(" " + text):
                    ids = None
            out.append(ids if ids is None else np.fromiter(ids, np.int32, len(ids)))
        return out


def _bytes(text: str) -> bytes:
    return text.encode("utf-8", "surrogatepass")


def _plain(spec: dict, added: dict[str, int]) -> bool:
    """Does the file only split as BYTE_LEVEL_SPLIT does and merge in the order of its ids?"""
    model, split = spec["model"], spec["pre_tokenizer"]
    steps = not spec["normalizer"] and split["type"] == "ByteLevel" and split["use_regex"] and not split["add_prefix_space"]
    joined = ["".join(x if isinstance(x, list) else x.split(" ")) for x in model["merges"]]
    ids = [i for t, i in model["vocab"].items() if t not in added]
    first = len(ids) - len(joined)
    return bool(steps and not model["ignore_merges"] and sorted(ids) == list(range(len(ids))) and [model["vocab"][t] for t in joined] == list(range(first, len(ids))))


class PieceTokens:
    """Side B: a sentencepiece model; it puts the blank before the text by itself.

    If no piece has a blank after another character, words between single blanks are encoded on their
    own: the new words of a block together, as the one text that they make up. A worker keeps words in two
    generations, of which the older one is dropped when the younger one is full.
    """

    def __init__(self, model: bytes):
        self.model, self.coder, self.known, self.older, self.changed = model, None, {}, {}, set()
        coder = sentencepiece.SentencePieceProcessor(model_proto=model)
        pieces = [coder.id_to_piece(i) for i in range(coder.get_piece_size())]
        self.size = len(pieces)
        self.by_word = not any(BLANK in p.lstrip(BLANK) for p in pieces)
        self.begins = np.array([p.startswith(BLANK) for p in pieces])
        self.bytes = [bytes([int(p[3:5], 16)]) if coder.is_byte(i) else p.replace(BLANK, " ").encode() for i, p in enumerate(pieces)]

    def __getstate__(self):
        return {**self.__dict__, "coder": None, "known": {}, "older": {}, "changed": set()}

    def encode(self, texts: Sequence[str]) -> list[np.ndarray | None]:
        """Ids of each text; None where its bytes are not those of its tokens."""
        if self.coder is None:
            self.coder = sentencepiece.SentencePieceProcessor(model_proto=self.model)
        words = [t.split(" ") if self.by_word and BLANK not in t else [""] for t in texts]
        words = [None if "" in w else w for w in words]
        if len(self.known) > CACHE:
            self.older, self.known = self.known, {}
        self._learn(set().union(*[w for w in words if w]))
        get, out = self.known.__getitem__, []
        for text, own in zip(texts, words):
            if not own:
                out.append(self._whole(text))
                continue
            ids = np.frombuffer(b"".join(map(get, own)), np.int32)
            out.append(ids if not self.changed or self.changed.isdisjoint(own) else self._whole(text))
        return out

    def _whole(self, text: str) -> np.ndarray | None:
        ids = self.coder.encode(text)
        same = b"".join([self.bytes[i] for i in ids]) == _bytes(" " + text)
        return np.array(ids, np.int32) if same else None

    def _learn(self, words: set[str]) -> None:
        """Make the ids of all these words known, as bytes, and which of them have other bytes than their tokens."""
        new = []
        for word in words.difference(self.known):
            ids = self.older.get(word)
            if ids is None:
                new.append(word)
            else:
                self.known[word] = ids
        if not new:
            return
        ids = np.array(self.coder.encode(" ".join(new)), np.int32)
        starts = np.flatnonzero(self.begins[ids]) * 4
        raw = ids.tobytes()
        self.known.update(zip(new, [raw[i:j] for i, j in zip(starts.tolist(), [*starts[1:].tolist(), len(raw)])]))
        if b"".join([self.bytes[i] for i in ids.tolist()]) != _bytes(" " + " ".join(new)):
            self.changed.update(w for w in new if self._whole(w) is None)


def common_groups(a: np.ndarray, b: np.ndarray, whole: np.ndarray) -> tuple[np.ndarray, ...]:
    """Groups (first and last plus one of a, the same of b), in order. ``a`` and ``b`` are ascending ends,
    both with every number of ``whole``, at which the first intervals end."""
    a_stop, b_stop = np.searchsorted(a, whole) + 1, np.searchsorted(b, whole) + 1
    open_ = [np.concatenate([[0], a_stop[:-1]]), a_stop, np.concatenate([[0], b_stop[:-1]]), b_stop]
    closed: list[list[np.ndarray]] = []
    while len(open_[0]):
        at, match = _near_middle(a, b, *open_)
        cut = at >= 0
        closed.append([x[~cut] for x in open_])
        a0, a1, b0, b1, at, match = (x[cut] for x in (*open_, at, match))
        # both halves beside each other, so that intervals stay in order
        open_ = [np.stack(x, axis=1).ravel() for x in ((a0, at + 1), (at + 1, a1), (b0, match + 1), (match + 1, b1))]
    found = [np.concatenate(x) for x in zip(*closed)] if closed else [np.zeros(0, np.int64)] * 4
    order = np.argsort(found[0], kind="stable")
    return tuple(x[order] for x in found)


def _near_middle(a, b, a0, a1, b0, b1) -> tuple[np.ndarray, np.ndarray]:
    """For each interval the place in ``a`` of a common end inside it, near the middle, and its place in
    ``b``; -1 if there is none. The last end of an interval is not inside it."""
    at, match = np.full(len(a0), -1), np.full(len(a0), -1)
    middle = (a0 + a1 - 2) // 2
    rows = np.flatnonzero((a1 - a0 > 1) & (b1 - b0 > 1))
    near, far = 0, 1
    while len(rows):
        reach = np.arange(near, far)
        steps = np.stack([reach, -reach - 1], axis=1).ravel()  # outwards, sides in turn
        place = middle[rows, None] + steps
        inside = (place >= a0[rows, None]) & (place < a1[rows, None] - 1)
        row, step = np.nonzero(inside)
        end = a[place[row, step]]
        other = np.searchsorted(b, end)
        hit = b[other] == end  # every end is at most the last of b
        row, step, other = row[hit], step[hit], other[hit]
        first = np.concatenate([[True], row[1:] != row[:-1]]) if len(row) else np.zeros(0, bool)
        at[rows[row[first]]] = place[row[first], step[first]]
        match[rows[row[first]]] = other[first]
        rows = rows[(at[rows] < 0) & (middle[rows] + far <= a1[rows] - 2) | (at[rows] < 0) & (middle[rows] - far - 1 >= a0[rows])]
        near, far = far, 2 * far
    return at, match


class Aligner:
    """Encodes and aligns blocks of texts."""

    def __init__(self, a: ByteTokens, b: PieceTokens):
        self.a, self.b = a, b
        self.a_bytes, self.b_bytes = (np.array([len(x) for x in side.bytes], np.int64) for side in (a, b))
        self.signs: list[str] = []

    def __getstate__(self):
        return {**self.__dict__, "signs": []}

    def tokens(self, texts: Sequence[str | None]) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """Both sides' ids; none for texts that are NULL or empty or whose bytes either side changes."""
        used = [i for i, t in enumerate(texts) if t]
        none = np.zeros(0, np.int32)
        a, b = [none] * len(texts), [none] * len(texts)
        some = [texts[i] for i in used]
        for i, x, y in zip(used, self.a.encode(some), self.b.encode(some)):
            if x is not None and y is not None:
                a[i], b[i] = x, y
        return a, b

    def align(self, texts: Sequence[str | None], digest: bool):
        """Columns of ``aligned`` for a block of texts."""
        a_ids, b_ids = self.tokens(texts)
        n_a, n_b = (np.array([len(x) for x in ids], np.int64) for ids in (a_ids, b_ids))
        a, b = (np.concatenate(ids) if ids else np.zeros(0, np.int32) for ids in (a_ids, b_ids))
        a_end, b_end = np.cumsum(self.a_bytes[a]), np.cumsum(self.b_bytes[b])
        full = n_a > 0
        groups = common_groups(a_end, b_end, a_end[np.cumsum(n_a)[full] - 1])
        group_text = np.searchsorted(np.cumsum(n_a), groups[0], "right")
        n_groups = np.bincount(group_text, minlength=len(texts))
        texts_of = np.repeat(np.arange(len(texts)), n_a)
        left, right = self._links(a_end, b_end, groups)
        key = texts_of[left] * (self.a.size * self.b.size) + a[left].astype(np.int64) * self.b.size + b[right]
        n_links = np.bincount(texts_of[left], minlength=len(texts))
        pairs, times = np.unique(key, return_counts=True)
        owner, pairs = np.divmod(pairs, self.a.size * self.b.size)
        ends = np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=len(texts)))]).astype(np.int32)
        lists = [pa.ListArray.from_arrays(pa.array(ends), pa.array(x, pa.int64() if k == "pairs" else pa.int32())) for k, x in (("pairs", pairs), ("times", times))]
        return n_a, n_b, n_groups, n_links, self._written(a, b, groups, np.cumsum(n_a + n_b), digest), *lists

    @staticmethod
    def _links(a_end, b_end, groups) -> tuple[np.ndarray, np.ndarray]:
        """Places of the tokens whose bytes overlap. Two tokens of a group do if one ends inside the other
        or with it, so every end of either side stands for one link."""
        a0, a1, b0, b1 = groups
        last = np.zeros(len(b_end), bool)
        last[b1 - 1] = True  # these end with a token of a
        rest = np.flatnonzero(~last)
        left = np.concatenate([np.arange(len(a_end)), np.searchsorted(a_end, b_end[rest])])
        right = np.concatenate([np.searchsorted(b_end, a_end), rest])
        return left, right

    def _written(self, a, b, groups, ends, digest: bool) -> list[str]:
        """`a1,a2|b1;a3|b2,b3` of every text, or its SHA-256 in hex; empty without tokens."""
        size = max(self.a.size, self.b.size)
        if not self.signs:
            self.signs = [f"{i}{s}" for s in ",|;" for i in range(size)]
        a0, a1, b0, b1 = groups
        sign = np.zeros(len(a) + len(b), np.int64)
        sign[np.arange(len(a)) + np.repeat(b0, a1 - a0)] = a
        sign[np.arange(len(b)) + np.repeat(a1, b1 - b0)] = b
        sign[a1 - 1 + b0] += size
        sign[a1 + b1 - 1] += 2 * size
        out, signs = [], self.signs.__getitem__
        for start, stop in zip([0, *ends[:-1].tolist()], ends.tolist()):
            text = "".join(map(signs, sign[start:stop].tolist()))[:-1]
            out.append(hashlib.sha256(text.encode()).hexdigest() if digest and text else text)
        return out


def align(docs: DataFrame, a: ByteTokens, b: PieceTokens, text: str = "text", digest: bool = False) -> tuple[DataFrame, list[str]]:
    """``docs`` with seven more columns, and their names: tokens of either side, groups and links (long),
    the groups as `a1,a2|b1;a3|b2,b3` (or the SHA-256 of that), the different linked pairs of the text
    (array<bigint>, ascending: id of a times the size of b, plus id of b) and how often each is linked.

    - A NULL or empty text has no tokens: zeros, an empty string and empty lists. So has one whose bytes
      either vocabulary changes (the sign of the blank U+2581 itself, for one).
    - Texts and tokens may have any length; rows are aligned one by one, repeated rows alike.
    - The strings of special tokens in a text are plain text.
    - An empty table gives an empty table; other columns pass through, whatever their names.

    One pass, nothing is shuffled.
    """
    shared = share(docs.sparkSession, Aligner(a, b))
    new = fresh(docs, "n_a", "n_b", "n_groups", "n_links", "groups", "pairs", "times")
    kinds = ["bigint"] * 4 + ["string", "array<bigint>", "array<int>"]
    return map_pieces(docs, lambda texts: shared.value.align(texts, digest), [text], dict(zip(new, kinds)), nbytes=PIECE_BYTES), new


def pair_counts(aligned: DataFrame, size_b: int, pairs: str = "pairs") -> DataFrame:
    """(a, b, n): in how many rows of ``aligned`` the ids are linked. Counted in the tasks first."""
    pair = aligned.select(F.explode(f"`{pairs}`").alias("pair"))
    counted = pair.groupBy("pair").agg(F.count(F.lit(1)).alias("n"))
    return counted.select(F.expr(f"cast(pair div {size_b} as int)").alias("a"), F.expr(f"cast(pair % {size_b} as int)").alias("b"), "n")


class PairCounts:
    """Counts of some pairs, with all pairs of an id of a together."""

    def __init__(self, pair: np.ndarray, n: np.ndarray, size_b: int):
        order = np.argsort(pair)
        self.pair, self.n = pair[order], n[order]
        first = np.flatnonzero(np.concatenate([[True], np.diff(self.pair // size_b) > 0])) if len(pair) else np.zeros(0, np.int64)
        most = np.maximum.reduceat(self.n, first) if len(pair) else self.n
        self.best = self.n == np.repeat(most, np.diff(np.append(first, len(self.pair))))

    def sums(self, pairs: pa.Array, times: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(links with the highest count of their id, summed counts) of each list; unknown pairs are skipped."""
        sizes = pc.fill_null(pc.list_value_length(pairs), 0).to_numpy(zero_copy_only=False)
        flat, often = (x.flatten().to_numpy(zero_copy_only=False) for x in (pairs, times))
        row = np.repeat(np.arange(len(sizes)), sizes)
        best, total = np.zeros(len(sizes), np.int64), np.zeros(len(sizes), np.int64)
        if len(self.pair):
            at = np.minimum(np.searchsorted(self.pair, flat), len(self.pair) - 1)
            known = self.pair[at] == flat
            at, row, often = at[known], row[known], often[known].astype(np.int64)
            np.add.at(best, row, self.best[at] * often)
            np.add.at(total, row, self.n[at] * often)
        return best, total


def with_count_sums(
    aligned: DataFrame, counts: DataFrame, size_b: int, pairs: str = "pairs", times: str = "times", set_pairs: int = SET_PAIRS
) -> tuple[DataFrame, list[str]]:
    """``aligned`` with two more columns, and their names: links whose count is the highest of their id of
    a, ties included, and the sum of the counts of all links (long).

    ``counts`` goes out in sets of about ``set_pairs`` pairs, each with all pairs of its ids of a; every
    text looks into all of them, and what it finds adds up. After SETS_AT_ONCE of them the table is
    written, so that no task holds more.
    """
    spark = aligned.sparkSession
    counts = written(counts, "pair-counts")
    per_id = counts.groupBy("a").count().collect()  # one row per entry of the vocabulary
    sets: list[tuple[int, int]] = []
    first, held = 0, 0
    for a, n in sorted((r["a"], r["count"]) for r in per_id):
        if held and held + n > set_pairs:
            sets.append((first, a))
            first, held = a, 0
        held += n
    sets.append((first, 1 << 31))
    best, total = fresh(aligned, "n_best", "count_sum")
    out = aligned
    for k, (low, high) in enumerate(sets):
        table = counts.where((F.col("a") >= low) & (F.col("a") < high)).select((F.col("a").cast("long") * size_b + F.col("b")).alias("pair"), "n").toArrow()
        shared = share(spark, PairCounts(*[table.column(c).to_numpy() for c in ("pair", "n")], size_b))

        schema = StructType([x for x in out.schema if x.name not in (best, total)]).add(best, "long").add(total, "long")

        def add(batches, shared=shared, names=out.columns, schema=schema):
            for batch in batches:
                found = shared.value.sums(batch.column(names.index(pairs)), batch.column(names.index(times)))
                before = [batch.column(names.index(c)).to_numpy() if c in names else 0 for c in (best, total)]
                columns = [batch.column(names.index(c)) for c in schema.names[:-2]]
                yield pa.RecordBatch.from_arrays([*columns, *[pa.array(x + y) for x, y in zip(found, before)]], names=schema.names)

        out = out.mapInArrow(add, schema)
        if (k + 1) % SETS_AT_ONCE == 0 and k + 1 < len(sets):
            out = written(out, "count-sums")
    return out, [best, total]
