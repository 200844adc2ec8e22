"""Token counts of a sentencepiece BPE model by a two-tier look-up of pre-token lengths.

No piece of such a model has a blank after another character, so no merge crosses the place before
a run of blanks and a text's count is the sum over its pre-tokens (a run of blanks and what follows).
Tier one is a broadcast table of the corpus's frequent pre-tokens; what it misses is encoded once
and kept in a bounded cache of the worker. Pre-tokens are never shuffled.
"""

from __future__ import annotations

import heapq
import re
from collections import Counter

import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.llm.tables import fresh, largest, map_pieces, written
from plumbline.session import share

FREQUENT = 65_536  # entries of the broadcast table
LONGEST = 64  # code points of its longest key, so it has a few MB at most
CACHE = 300_000  # entries of a worker's cache
TASK_KEYS = 200_000  # pre-tokens that a counting task holds
TASK_TOP = 4096  # of which it reports the most frequent
BLANK = "\u2581"  # the model's sign for a blank


def pre_tokens(text: str) -> list[str]:
    """Pre-tokens of a text, each without the first blank of its run."""
    text = text.replace(BLANK, " ")
    parts = text.split(" ")
    if "" in parts:
        parts = [m[1:] for m in re.findall(" +[^ ]*", " " + text)]
    return parts if text else []


class Lengths(dict):
    """Pre-token to number of tokens: the frequent ones for good, others while the cache has room.

    It is broadcast, so what a worker adds stays with that worker's copy and serves its later tasks.
    """

    def __init__(self, model: bytes, frequent: list[str]):
        self.model, self.coder, self.frequent = model, None, {}
        self.frequent = dict(zip(frequent, self._encode(frequent)))
        self.coder = None  # built again in every worker
        self.update(self.frequent)

    def __reduce__(self):
        return _lengths, (self.model, self.frequent)

    def __missing__(self, key: str) -> int:
        if len(self) >= CACHE + len(self.frequent):
            self.clear()
            self.update(self.frequent)
        self[key] = n = self._encode([key])[0]
        return n

    def _encode(self, keys: list[str]) -> list[int]:
        if self.coder is None:
            self.coder = sentencepiece.SentencePieceProcessor(model_proto=self.model)
        # one string a call: a call with a list starts threads. The empty pre-token is a single blank,
        # which the coder only puts before other characters
        encode = self.coder.encode
        return [len(encode(k)) if k else len(encode("\n")) - 1 for k in keys]

    def count(self, text: str) -> int:
        return sum(map(self.__getitem__, pre_tokens(text)))


def _lengths(model: bytes, frequent: dict[str, int]) -> Lengths:
    table = Lengths(model, [])
    table.frequent = frequent
    table.update(frequent)
    return table


def frequent_pre_tokens(docs: DataFrame, text: str = "text", limit: int = FREQUENT) -> list[str]:
    """The pre-tokens that most texts use, from all texts.

    Every task counts its own and reports its TASK_TOP most frequent, so what is added up is small
    however many pre-tokens there are. The list only decides what is quick, never a count.
    """

    def count(batches):
        import pyarrow as pa

        seen: Counter = Counter()
        for batch in batches:
            for value in batch.column(0).to_pylist():
                if value:
                    seen.update(pre_tokens(value))
                    if len(seen) > TASK_KEYS:
                        seen = Counter(dict(heapq.nlargest(TASK_KEYS // 4, seen.items(), key=lambda x: x[1])))
        top = [x for x in seen.most_common(TASK_TOP) if len(x[0]) <= LONGEST]
        yield pa.RecordBatch.from_pydict({"k": pa.array([x[0] for x in top], pa.string()), "n": pa.array([x[1] for x in top], pa.int64())})

    counted = docs.select(F.col(f"`{text}`").cast("string")).mapInArrow(count, "k string, n long")
    summed = written(counted.groupBy("k").agg(F.sum("n").alias("n")), "pre-tokens")
    return largest(summed, "n", limit).select("k").toArrow().column(0).to_pylist()


def with_token_counts(docs: DataFrame, model: bytes, text: str = "text", output: str = "n_tokens", limit: int = FREQUENT) -> DataFrame:
    """``docs`` with the number of tokens of the whole text in ``output``.

    - A NULL or empty text has 0 tokens.
    - Rows are counted one by one, repeated rows alike; texts and pre-tokens may have any length.
    - An empty table gives an empty table. Other columns pass through, whatever their names; a
      column already named ``output`` is replaced.
    - ``model`` is the content of a sentencepiece BPE file that does not change texts beyond blanks;
      a model with a piece that has a blank inside is refused.
    """
    coder = sentencepiece.SentencePieceProcessor(model_proto=model)
    if any(BLANK in coder.id_to_piece(i).lstrip(BLANK) for i in range(coder.get_piece_size())):
        raise ValueError("a piece with a blank inside: counts do not add up over pre-tokens")
    shared = share(docs.sparkSession, Lengths(model, frequent_pre_tokens(docs, text, limit)))
    name = fresh(docs, "n_tokens")[0] if output == text else output

    def count(texts):
        table = shared.value
        return ([table.count(t) if t else 0 for t in texts],)

    return map_pieces(docs, count, [text], {name: "bigint"})
