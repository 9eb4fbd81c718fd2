"""Words of many texts at once, as numpy arrays over the bytes of a block."""

from __future__ import annotations

from functools import lru_cache

import numpy as np

from .exchange import Block, mix

#: Bytes between words: space and the five controls from tab to carriage return.
SPACES = bytes([0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D])
IS_SPACE = np.zeros(256, bool)
IS_SPACE[list(SPACES)] = True
BASE = 0x9E3779B97F4A7C15
LANES = (0x2545F4914F6CDD1D, 0x106689D45497FDB5)


@lru_cache(maxsize=2)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    up = np.cumprod(np.full(n, BASE, np.uint64))
    down = np.cumprod(np.full(n, pow(BASE, -1, 1 << 64), np.uint64))
    return up, down


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    up, down = _powers(1 << max(16, (n - 1).bit_length()))
    return up[:n], down[:n]


class Words:
    """starts and ends in the bytes of the block; of: the document of each word; bound: its first word, by document."""

    def __init__(self, block: Block):
        solid = ~IS_SPACE[block.bytes]
        begins = np.zeros(len(solid) + 1, bool)
        begins[block.at] = True
        before, after = np.empty_like(solid), np.empty_like(solid)
        if len(solid):
            before[0], before[1:] = True, ~solid[:-1]
            after[-1], after[:-1] = True, ~solid[1:]
        self.starts = np.flatnonzero(solid & (before | begins[:-1]))
        self.ends = np.flatnonzero(solid & (after | begins[1:])) + 1
        self.bound = np.searchsorted(self.starts, block.at)
        self.of = np.repeat(np.arange(block.n), np.diff(self.bound))
        self.n = len(self.starts)

    def hashes(self, data: np.ndarray) -> np.ndarray:
        """A 64-bit hash of the bytes of each word."""
        up, down = powers(len(data) + 1)
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(0x1F3)) * up[: len(data)], out=sums[1:])
        return mix((sums[self.ends] - sums[self.starts]) * down[self.starts] + (self.ends - self.starts).astype(np.uint64))
