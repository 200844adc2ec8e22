"""Benchmark decontamination: a broadcast hash set of the benchmark's word windows, scanned over documents.

Word windows of a document are hashed with a rolling polynomial; a window whose hash is in the set is
verified word by word before it counts.
"""

from __future__ import annotations

import re
from collections import defaultdict

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.llm.tables import fresh, map_pieces
from plumbline.session import share

WINDOW = 13
MIN_SHARE = 20  # a document is contaminated if MIN_SHARE * hit words >= words
SET_BYTES = 16 << 20  # benchmark text in one broadcast set

#: Bytes of words to themselves, A-Z to lower case, all others to a blank.
WORD_BYTES = bytes(b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else b + 32 if 65 <= b <= 90 else 32 for b in range(256))
_STEP = np.uint64(0x9E3779B97F4A7C15)


def words(text: str | None) -> list[bytes]:
    """Lower-cased words: digits, letters a-z and all characters beyond ASCII."""
    return text.encode("utf-8", "surrogatepass").translate(WORD_BYTES).split() if text else []


class WindowSet:
    """Windows of ``window`` consecutive words of items; an item with fewer words is one window."""

    def __init__(self, items: list[tuple[str | None, str | None]], window: int = WINDOW):
        self.vocabulary: dict[bytes, int] = {}
        self.items: dict[tuple[int, ...], list[str]] = defaultdict(list)
        hashes: dict[int, set[int]] = defaultdict(set)
        for item_id, text in items:
            ids = [self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in words(text)]
            n = min(window, len(ids))
            for i in range(len(ids) - n + 1 if n else 0):
                found = self.items[tuple(ids[i : i + n])]
                if item_id not in found:
                    found.append(item_id)
            if n:
                hashes[n].update(rolling(np.array(ids, np.uint64), n).tolist())
        self.items = dict(self.items)
        self.hashes = {n: np.array(sorted(h), np.uint64) for n, h in hashes.items()}

    def hits(self, ids: list[int]) -> tuple[set[int], set[str]]:
        """Positions of words inside occurrences of windows, and the items whose windows occur."""
        hit, items = set(), set()
        known = np.array(ids, np.uint64)
        for n, table in self.hashes.items():
            if len(ids) < n:
                continue
            h = rolling(known, n)
            at = np.minimum(np.searchsorted(table, h), len(table) - 1)
            for i in np.flatnonzero(table[at] == h).tolist():
                found = self.items.get(tuple(ids[i : i + n]))
                if found is not None:
                    hit.update(range(i, i + n))
                    items.update(x for x in found if x is not None)
        return hit, items


def rolling(ids: np.ndarray, n: int) -> np.ndarray:
    """A hash of every ``n`` consecutive ids (modulo 2^64)."""
    h = np.zeros(len(ids) - n + 1, np.uint64)
    for k in range(n):
        h = h * _STEP + ids[k : len(ids) - n + 1 + k]
    return h


def contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    set_bytes: int = SET_BYTES,
) -> tuple[DataFrame, list[str]]:
    """``docs`` with three more columns, and their names: words (long), hit words' positions
    (array<int>, ascending) and items with occurring windows (array<string>, ascending).

    - A NULL or empty text has no words; so has a NULL or empty item, which then matches nothing.
    - An item with a NULL id still hits words but is not listed. Repeated item rows count once.
    - Rows of ``docs`` are judged one by one: repeated rows get equal results, whole texts of any
      length are scanned, and other columns pass through, whatever their names.
    - Empty tables give empty tables or documents without hits.

    The benchmark is broadcast in sets of at most ``set_bytes`` of text, one set unless the benchmark
    is larger; further sets are scanned one after the other in the same task. Nothing is shuffled.
    """
    spark = docs.sparkSession
    items = benchmark.select(F.col(f"`{item_id}`").cast("string").alias("i"), F.col(f"`{item_text}`").alias("t")).where("t is not null").distinct()
    total = items.agg(F.sum(F.octet_length("t"))).first()[0] or 0
    sets = max(1, -(-2 * total // set_bytes)) if total > set_bytes else 1
    new = fresh(docs, "n_words", "hit_words", "hit_items")
    outputs = dict(zip(new, ["bigint", "array<int>", "array<string>"]))
    out = docs
    for part in range(sets):
        own = items if sets == 1 else items.where(F.pmod(F.xxhash64("t"), F.lit(sets)) == part)
        shared = share(spark, WindowSet([(r.i, r.t) for r in own.collect()], window))

        def scan(texts, hits=None, listed=None, shared=shared):
            found = shared.value
            get = found.vocabulary.get
            counts, all_hits, all_items = [], [], []
            for i, value in enumerate(texts):
                ids = [get(w, 0) for w in words(value)]
                hit, of_items = found.hits(ids)
                counts.append(len(ids))
                all_hits.append(sorted(hit.union(hits[i]) if hits else hit))
                all_items.append(sorted(of_items.union(listed[i]) if listed else of_items))
            return counts, all_hits, all_items

        out = map_pieces(out, scan, [text, *new[1:]] if part else [text], outputs)
    return out, new


def is_contaminated(n_words, n_hit, min_share: int = MIN_SHARE):
    return (n_hit > 0) & (n_hit * min_share >= n_words)


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, text: str = "text", **options) -> DataFrame:
    """``docs`` without the documents of which a twentieth or more lies in benchmark windows."""
    marked, (n_words, hit, items) = contamination(docs, benchmark, text, **options)
    return marked.where(~is_contaminated(F.col(n_words), F.size(hit))).drop(n_words, hit, items)


def drop_hit_spans(docs: DataFrame, benchmark: DataFrame, text: str = "text", **options) -> DataFrame:
    """``docs`` with every hit word cut out of the text (what stands between words stays)."""
    marked, (_, hit, _) = contamination(docs, benchmark, text, **options)
    whole = dict(marked.dtypes)[text]
    cut = map_pieces(marked, lambda texts, hits: ([without_words(t, set(h)) for t, h in zip(texts, hits)],), [text, hit], {text: whole})
    return cut.select(*[f"`{c}`" for c in docs.columns])


def without_words(text: str | None, hit: set[int]) -> str | None:
    """``text`` without the words at the positions ``hit``."""
    if not hit:
        return text
    raw = text.encode("utf-8", "surrogatepass")
    kept, last = [], 0
    for position, word in enumerate(re.finditer(rb"[^ ]+", raw.translate(WORD_BYTES))):
        if position in hit:
            kept.append(raw[last : word.start()])
            last = word.end()
    return (b"".join(kept) + raw[last:]).decode("utf-8", "surrogatepass")
