"""BPE encoding and decoding by a pair occurrence index.

All new words of a block are encoded together: every adjacent pair of symbols is mapped to all its
places in the block, the pair of the lowest active rank is merged at all of them, and the lists of
the pairs that appear beside the merged places are extended, until no listed pair has a rank.
"""

from __future__ import annotations

import heapq
import json
import re
import unicodedata
from collections import defaultdict
from collections.abc import Iterator
from itertools import chain

import numpy as np
import regex
from pyspark.sql import DataFrame
from tokenizers import Tokenizer

from plumbline.llm.tables import map_pieces
from plumbline.session import share

CACHE = 100_000  # words of a worker's younger generation, which then becomes the older one
BLOCK_BYTES = 1 << 16  # UTF-8 bytes of new words that are encoded together, or one word
PIECE = 1 << 19  # bytes of text that are split into words at once

#: Unicode white space as the vocabulary's normaliser understands it.
SPACE = r"[\t-\r \x85\xa0  -     　]"


def byte_signs() -> list[str]:
    """The printable character that stands for each byte: itself, or the next free one from U+0100."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    free = iter(range(256, 512))
    return [chr(b) if b in printable else chr(next(free)) for b in range(256)]


def ranges(points: list[int]) -> str:
    """Ascending code points as the inside of a character class."""
    out: list[list[int]] = []
    for i in points:
        if out and out[-1][1] == i - 1:
            out[-1][1] = i
        else:
            out.append([i, i])
    return "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in out)


#: Characters up to U+FFFF that Python's tables do not know; a class of those is one look-up a character, one
#: with characters beyond is gone through range by range.
UNASSIGNED = ranges([i for i in range(0x10000) if unicodedata.category(chr(i)) == "Cn"])
BEYOND = "\U00010000-\U0010ffff"
BYTE_OF = {s: b for b, s in enumerate(byte_signs())}


def blocks(words: list[str], nbytes: int = BLOCK_BYTES) -> Iterator[list[str]]:
    """The words in order, in blocks of at most ``nbytes`` bytes or one word: the index over a block takes a
    few hundred bytes of memory per byte of it."""
    start = size = 0
    for i, word in enumerate(words):
        own = len(word.encode("utf-8", "surrogatepass"))
        if size and size + own > nbytes:
            yield words[start:i]
            start = i
            size = 0
        size += own
    if start < len(words):
        yield words[start:]


class WordBpe:
    """A word-end BPE vocabulary read from a tokenizers file (lower case, white space dropped).

    Refuses files whose steps differ from what it carries out. It is broadcast; words a worker has
    encoded stay in its copy, in two generations: a word that is used again moves to the younger one, and
    when that is full the older one is dropped, so frequent words stay.

    Python's tables, the pattern library and the tokenizers library know different versions of Unicode.
    They agree on what Python's tables have; a text with a character that these lack is normalised and
    split by the tokenizers library itself.
    """

    def __init__(self, file: str):
        spec = json.loads(file)
        model = spec["model"]
        steps = [x["type"] for x in spec["normalizer"]["normalizers"]], [x["type"] for x in spec["pre_tokenizer"]["pretokenizers"]]
        if steps != (["NFC", "Replace", "Lowercase"], ["Split", "ByteLevel"]) or spec["decoder"] or model["type"] != "BPE":
            raise ValueError("not a word BPE file of the known form")
        self.end = model["end_of_word_suffix"]
        self.vocab: dict[str, int] = model["vocab"]
        self.tokens = {i: t for t, i in self.vocab.items()}
        self.merges: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, pair in enumerate(model["merges"]):
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            self.merges[self.vocab[a], self.vocab[b]] = rank, self.vocab[a + b]
        self.special = {x["content"]: x["id"] for x in spec["added_tokens"]}
        self.tokens.update({i: t for t, i in self.special.items()})
        # the file's \s, \p{L} and \p{N}; the split keeps what matches
        self.pattern = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"].replace(r"[^\s", f"[^{SPACE[1:-1]}")
        signs = byte_signs()
        self.first = [self.vocab[s] for s in signs]
        self.last = [self.vocab[s + self.end] for s in signs]
        self.file = file
        self.text_of = [self.tokens.get(i, "") for i in range(max(self.tokens) + 1)]
        self._start()

    def _start(self) -> None:
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.split, self.library = regex.compile(self.pattern), None
        self.unassigned, self.beyond = re.compile(f"[{UNASSIGNED}]"), re.compile(f"[{BEYOND}]")
        self.split_special = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None

    def __getstate__(self):
        own = ("split", "library", "split_special", "unassigned", "beyond", "known", "older")
        return {k: v for k, v in self.__dict__.items() if k not in own}

    def __setstate__(self, state):
        self.__dict__.update(state)
        self._start()

    def words(self, text: str) -> list[str]:
        """Words of a text in order; a special token stands as itself, as the one word with its id."""
        if self.split_special is None or not self.split_special.search(text):
            return self._words(text)
        out: list[str] = []
        for i, part in enumerate(self.split_special.split(text)):
            out.extend([part] if i % 2 else self._words(part))
        return out

    def _words(self, text: str) -> list[str]:
        if text.isascii():
            return self.split.findall(text.lower())
        if self._has_unassigned(text):
            return self._library_words(text)
        return self.split.findall(unicodedata.normalize("NFC", text).replace("Σ", "σ").lower())  # lower case letter by letter

    def _has_unassigned(self, text: str) -> bool:
        return bool(self.unassigned.search(text)) or any(unicodedata.category(c) == "Cn" for c in set(self.beyond.findall(text)))

    def _library_words(self, text: str) -> list[str]:
        if self.library is None:
            self.library = Tokenizer.from_str(self.file)
        pieces = self.library.pre_tokenizer.pre_tokenize_str(self.library.normalizer.normalize_str(text))
        return [bytes(BYTE_OF[c] for c in piece).decode("utf-8", "surrogatepass") for piece, _ in pieces]

    def encode_words(self, words: list[str]) -> list[list[int]]:
        """Ids of every word, by the pair occurrence index over all of them."""
        symbol: list[int] = []
        starts: list[int] = []
        for word in words:
            starts.append(len(symbol))
            raw = word.encode("utf-8", "surrogatepass")
            symbol.extend([self.first[b] for b in raw[:-1]])
            symbol.append(self.last[raw[-1]])
            symbol.append(-1)  # no pair crosses words
        after = list(range(1, len(symbol) + 1))
        before = list(range(-1, len(symbol) - 1))
        places: dict[tuple[int, int], list[int]] = defaultdict(list)
        merges = self.merges
        for i, pair in enumerate(zip(symbol, symbol[1:])):
            if pair in merges:
                places[pair].append(i)
        active = [(merges[pair][0], pair) for pair in places]
        heapq.heapify(active)
        while active:
            _, pair = heapq.heappop(active)
            a, b = pair
            merged = merges[pair][1]
            touched = set()
            for i in sorted(places.pop(pair)):
                if symbol[i] != a:
                    continue  # merged away meanwhile
                j = after[i]
                if symbol[j] != b:
                    continue
                symbol[i], symbol[j] = merged, -2
                k = after[i] = after[j]
                before[k] = i
                h = before[i]
                right = (merged, symbol[k])
                if right in merges:
                    if right not in places:
                        touched.add(right)
                    places[right].append(i)
                if h >= 0:
                    left = (symbol[h], merged)
                    if left in merges:
                        if left not in places:
                            touched.add(left)
                        places[left].append(h)
            for new in touched:
                heapq.heappush(active, (merges[new][0], new))
        ids = [x for x in symbol if x != -2]
        out, at = [], 0
        for _ in words:
            end = ids.index(-1, at)
            out.append(ids[at:end])
            at = end + 1
        return out

    def learn(self, words: set[str]) -> None:
        """Make all these words known, the new ones in one go."""
        if len(self.known) > CACHE:
            self.older, self.known = self.known, {}
        new = []
        for word in words.difference(self.known):
            if word in self.older:
                self.known[word] = self.older[word]
            elif word in self.special:
                self.known[word] = np.array([self.special[word]], "<u4").tobytes()
            else:
                new.append(word)
        for block in blocks(new):
            found = self.encode_words(block)
            raw = np.fromiter(chain.from_iterable(found), "<u4").tobytes()
            ends = np.cumsum([4 * len(ids) for ids in found]).tolist()
            self.known.update(zip(block, [raw[i:j] for i, j in zip([0, *ends], ends)]))

    def decode(self, ids: list[int]) -> str:
        """The tokens with a blank between them, special ones too; the file names no other decoder. Ids that
        the vocabulary lacks are left out."""
        try:
            return " ".join(map(self.text_of.__getitem__, ids))
        except IndexError:
            return " ".join([self.tokens[i] for i in ids if i in self.tokens])


def encode(docs: DataFrame, file: str, text: str = "text", ids: str = "ids", decoded: str = "decoded", keep: list[str] | None = None) -> DataFrame:
    """``docs`` with the whole text's ids (binary: little-endian unsigned 32-bit) and their decoding.

    ``file`` is the content of the vocabulary file. ``keep`` names the columns to pass on (all).

    - A NULL or empty text has no ids and decodes to an empty text; so does one of white space only.
    - Texts and words may have any length. Repeated rows get equal results.
    - The strings of special tokens inside a text become their ids, as the library's default has it.
    - An empty table gives an empty table; other columns pass through, and one that is already named
      ``ids`` or ``decoded`` is replaced.
    """
    shared = share(docs.sparkSession, WordBpe(file))

    def run(texts):
        bpe = shared.value
        split = [bpe.words(t) if t else [] for t in texts]
        bpe.learn(set().union(*split))
        all_ids = [b"".join(map(bpe.known.__getitem__, words)) for words in split]
        return all_ids, [bpe.decode(np.frombuffer(x, "<u4").tolist()) for x in all_ids]

    return map_pieces(docs, run, [text], {ids: "binary", decoded: "string"}, keep, PIECE)


def decode(encoded: DataFrame, file: str, ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """``encoded`` with the text of the binary column ``ids``; NULL ids decode to an empty text, and
    ids the vocabulary lacks are left out."""
    shared = share(encoded.sparkSession, WordBpe(file))

    def run(values):
        bpe = shared.value
        return ([bpe.decode(np.frombuffer(v, "<u4").tolist()) if v else "" for v in values],)

    return map_pieces(encoded, run, [ids], {decoded: "string"})
