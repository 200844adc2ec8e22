"""Language ID by cross-parsing entropy.

For every language, a suffix automaton holds all substrings of a labelled sample. A text is parsed
greedily into the longest phrases that occur in the sample (a Ziv-Merhav cross-parsing); the language
whose sample needs the fewest phrases, normalised by the sample's length, wins.
"""

from __future__ import annotations

import math
import zlib

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.llm.lanes import Lanes
from plumbline.llm.tables import map_pieces
from plumbline.session import share

SAMPLE_TEXTS = 128  # labelled texts per language that the automata are fitted on
SAMPLE_CHARS = 16_384  # code points per language, all of them together
TOTAL_CHARS = 1 << 19  # code points over all languages: bounds the broadcast
DENSE_LETTERS = 62  # a language with more letters has its moves searched instead of laid out as an array
BLOCK = 512  # code points parsed in one go; phrases end with a block
UNKNOWN = "und"


def letters_of(text: str) -> np.ndarray:
    """Code points of the lower-cased text."""
    return np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)


class Symbols:
    """Letters to symbols: 0 for all that is no letter, 1 for letters outside the samples."""

    def __init__(self, samples: list[str]):
        known = sorted({c for s in samples for c in s.lower() if c.isalpha()})
        self.size = len(known) + 2
        self.table = np.fromiter((chr(i).isalpha() for i in range(0x110000)), np.int32, 0x110000)
        for i, c in enumerate(known):
            self.table[ord(c)] = i + 2

    def of(self, text: str) -> np.ndarray:
        """Symbols of a text, a run of other characters as one 0."""
        found = self.table[letters_of(text)]
        if len(found):
            found = found[(found != 0) | np.concatenate([[True], found[:-1] != 0])]
        return found


def suffix_automaton(symbols: list[int]) -> list[dict[int, int]]:
    """Transitions of the suffix automaton; state 0 is the start and every path is a substring."""
    moves: list[dict[int, int]] = [{}]
    link, length, last = [-1], [0], 0
    for c in symbols:
        new = len(moves)
        moves.append({})
        link.append(0)
        length.append(length[last] + 1)
        p = last
        while p >= 0 and c not in moves[p]:
            moves[p][c] = new
            p = link[p]
        if p >= 0:
            q = moves[p][c]
            if length[q] == length[p] + 1:
                link[new] = q
            else:
                clone = len(moves)
                moves.append(dict(moves[q]))
                link.append(link[q])
                length.append(length[p] + 1)
                while p >= 0 and moves[p].get(c) == q:
                    moves[p][c] = clone
                    p = link[p]
                link[q] = link[new] = clone
        last = new
    return moves


class CrossParser:
    """One automaton per language over the letters of its own sample, all others being symbol 1.

    ``table[state + symbol]`` is the next state if the phrase goes on, and ``~`` the state in which
    the next phrase begins with that symbol if not (states are offsets into the table). Of a language
    with many letters only the moves that go on are held, sorted by state + symbol.
    """

    def __init__(self, samples: dict[str, list[str]], chars: int = SAMPLE_CHARS, total: int = TOTAL_CHARS):
        self.languages = sorted(samples)
        chars = min(chars, total // max(1, len(samples)))
        cut: dict[str, list[str]] = {}
        for language in self.languages:
            texts, cut[language] = sorted(samples[language], key=len), []
            for t, size in zip(texts, allotted([len(t) for t in texts], chars)):
                start = zlib.crc32(t.encode("utf-8", "surrogatepass")) % (len(t) - size + 1)
                cut[language].append(t[start : start + size])  # from anywhere in the text
        self.symbols = Symbols([t for texts in cut.values() for t in texts])
        self.own, self.tables, self.bits = [], [], []
        for language in self.languages:
            learned = np.concatenate([np.append(self.symbols.of(t), 0) for t in cut[language]])
            own = np.ones(self.symbols.size, np.int32)
            own[0] = 0
            letters = np.unique(learned[learned > 1])
            own[letters] = np.arange(2, len(letters) + 2)
            size = len(letters) + 2
            moves = suffix_automaton(own[learned].tolist())
            first = np.zeros(size, np.int64)
            for c, to in moves[0].items():
                first[c] = to * size
            if len(letters) <= DENSE_LETTERS:
                table = np.tile(~first.astype(np.int32), (len(moves), 1))
                for state, found in enumerate(moves):
                    for c, to in found.items():
                        table[state, c] = to * size
                self.tables.append(table.reshape(-1))
            else:
                steps = np.array([(state * size + c, to * size) for state, found in enumerate(moves) for c, to in sorted(found.items())], np.int64)
                self.tables.append((steps[:, 0].copy(), steps[:, 1].copy(), ~first))
            self.own.append(own)
            self.bits.append(math.log2(len(learned) + 1))

    def phrases(self, texts: list[np.ndarray]) -> np.ndarray:
        """Phrases per language and text."""
        lanes, out = Lanes(texts, BLOCK), []
        data = lanes.data
        for own, table in zip(self.own, self.tables):
            lanes.data = own[data]
            dense = isinstance(table, np.ndarray)
            state = np.zeros(len(lanes.length), np.int32 if dense else np.int64)
            ended = np.ones(len(lanes.length), np.int32)
            for _, n, symbols in lanes.steps():
                at = state[:n] + symbols
                found = table[at] if dense else self._searched(table, at, symbols)
                miss = (found < 0).astype(state.dtype)
                ended[:n] += miss
                state[:n] = found ^ -miss
            out.append(lanes.per_text(ended))
        return np.array(out)

    @staticmethod
    def _searched(table: tuple[np.ndarray, ...], at: np.ndarray, symbols: np.ndarray) -> np.ndarray:
        moves, to, first = table
        place = np.minimum(np.searchsorted(moves, at), len(moves) - 1)
        return np.where(moves[place] == at, to[place], first[symbols])

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        symbols = [self.symbols.of(t or "") for t in texts]
        if not self.languages:
            return [UNKNOWN] * len(texts), [0.0] * len(texts)
        cost = (self.phrases(symbols) + 1e-9) * np.array(self.bits)[:, None]
        best = cost.argmin(axis=0)  # the first language of equal ones
        share = (1 / cost.min(axis=0)) / (1 / cost).sum(axis=0)
        known = [bool((s != 0).any()) for s in symbols]
        return (
            [self.languages[b] if k else UNKNOWN for b, k in zip(best, known)],
            [float(s) if k else 0.0 for s, k in zip(share, known)],
        )


def allotted(lengths: list[int], room: int) -> list[int]:
    """Code points taken of texts of ascending lengths: short ones whole, the room left shared by the rest."""
    out = []
    for i, length in enumerate(lengths):
        out.append(min(length, max(1, room // (len(lengths) - i))))
        room -= out[-1]
    return out


def labelled_sample(labelled: DataFrame, texts: int = SAMPLE_TEXTS, chars: int = SAMPLE_CHARS, total: int = TOTAL_CHARS) -> dict[str, list[str]]:
    """Pieces from anywhere in up to ``texts`` different texts of each language: ``chars`` code points a
    language and ``total`` in all, cut before they leave the tasks.

    ``labelled`` is (lang, text). Texts are dealt into ``texts`` slots by hash; the lowest hash of a
    slot is taken, so the sample depends on the texts alone, not on order, layout or ids.
    """
    rows = labelled.where("lang is not null and text is not null and text <> ''").select("lang", "text", F.xxhash64("text").alias("h"))
    slot = F.pmod("h", F.lit(texts))
    chosen = rows.groupBy("lang", slot.alias("slot")).agg(F.min("h").alias("h")).drop("slot")  # texts x languages rows
    found = rows.join(F.broadcast(chosen), ["lang", "h"])
    lengths: dict[str, list[tuple[int, int]]] = {}
    for r in found.groupBy("lang", "h").agg(F.min(F.char_length("text")).alias("n")).collect():
        lengths.setdefault(r.lang, []).append((r.n, r.h))
    room, sizes = min(chars, total // max(1, len(lengths))), []
    for lang, known in lengths.items():
        known.sort()
        sizes += [(lang, h, size) for (_, h), size in zip(known, allotted([n for n, _ in known], room))]
    if not sizes:
        return {}
    size = labelled.sparkSession.createDataFrame(sizes, "lang string, h long, size int")  # a row per chosen text
    start = F.pmod(F.xxhash64("h"), F.greatest(F.char_length("text") - F.col("size") + 1, F.lit(1))).cast("int") + 1
    taken = rows.withColumn("lang", F.col("lang").cast("string")).join(F.broadcast(size), ["lang", "h"])
    taken = taken.groupBy("lang", "h").agg(F.min(F.col("text").substr(start, F.col("size"))).alias("text"))
    out: dict[str, list[str]] = {}
    for r in taken.orderBy("lang", "h").collect():
        out.setdefault(r.lang, []).append(r.text)
    return out


def fit(labelled: DataFrame, texts: int = SAMPLE_TEXTS, chars: int = SAMPLE_CHARS) -> CrossParser:
    return CrossParser(labelled_sample(labelled, texts, chars), chars)


def with_language(docs: DataFrame, parser: CrossParser, text: str = "text", lang_pred: str = "lang_pred", score: str = "score") -> DataFrame:
    """``docs`` with the predicted language of the whole text and a score between 0 and 1.

    The score is the winner's share of the reciprocal phrase costs: 1 / number of languages if all
    need the same, towards 1 the fewer phrases the winner needs.

    - A NULL text, or one without a letter, is ``und`` with score 0; so is every text if no labelled
      text was there to learn from.
    - Of languages that need equally many phrases the first by name is taken, as for a text whose
      letters no sample has.
    - Texts may have any length; every row is judged alone, so repeated rows get equal results.
    - An empty table gives an empty table; other columns pass through, whatever their names; columns
      already named ``lang_pred`` or ``score`` are replaced.
    """
    shared = share(docs.sparkSession, parser)
    return map_pieces(docs, lambda texts: shared.value.predict(texts), [text], {lang_pred: "string", score: "double"})


def remainder(doc_id: Column, divisor: int) -> Column:
    """crc32 of the id as text, modulo ``divisor``; 0 for a NULL id."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % divisor, F.lit(0))
