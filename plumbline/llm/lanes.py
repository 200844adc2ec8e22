"""Running an automaton over many texts at once: texts are cut into blocks, and numpy steps through
all blocks side by side."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np


class Lanes:
    """Blocks of at most ``block`` symbols, longest first; ``before`` symbols in front of a block
    are read again for warming up (a text must start with that many, which belong to no block)."""

    def __init__(self, texts: list[np.ndarray], block: int, before: int = 0):
        self.before = before
        sizes = np.array([len(t) - before for t in texts], np.int64)
        self.texts = len(texts)
        data = np.concatenate([*texts, np.zeros(1, np.uint8)])
        starts = np.concatenate([[0], np.cumsum(sizes + before)[:-1]]).astype(np.int64)
        per_text = -(-sizes // block)
        owner = np.repeat(np.arange(len(texts)), per_text)
        number = np.arange(len(owner)) - np.repeat(np.cumsum(per_text) - per_text, per_text)
        length = np.minimum(block, sizes[owner] - number * block)
        order = np.argsort(-length, kind="stable")
        self.owner, self.length = owner[order], length[order] + before
        self.start = (starts[owner] + number * block)[order]
        self.data = data

    def steps(self) -> Iterator[tuple[int, int, np.ndarray]]:
        """(step, number of lanes still open, their symbols)."""
        longest = int(self.length[0]) if len(self.length) else 0
        open_lanes = np.searchsorted(-self.length, -np.arange(longest), "left")
        for step in range(longest):
            n = int(open_lanes[step])
            yield step, n, self.data[self.start[:n] + step]

    def per_text(self, values: np.ndarray) -> np.ndarray:
        return np.bincount(self.owner, values, self.texts)
