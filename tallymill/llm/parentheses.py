"""Balanced parentheses with a tree of range minima over blocks of their excess."""

from __future__ import annotations

import numpy as np

BLOCK = 64
#: Queries worked out at once; each looks at one block.
_QUERIES = 1 << 15


class Parentheses:
    """A forest as a sequence of bits: 1 opens a node, 0 closes it.

    The excess at a place is the number of ones less the number of zeros up to and
    including it. It changes by one from place to place, so the parenthesis that closes
    the one at i is the first place behind i at which the excess is below that at i.
    """

    def __init__(self, bits: np.ndarray) -> None:
        self.bits = np.asarray(bits, np.uint8)
        n = len(self.bits)
        blocks = 1 << max(-(-n // BLOCK) - 1, 0).bit_length()
        excess = np.full(blocks * BLOCK, np.iinfo(np.int32).max, np.int32)
        excess[:n] = np.cumsum(2 * self.bits.astype(np.int32) - 1)
        self.excess = excess.reshape(blocks, BLOCK)
        self.minima = [self.excess.min(axis=1)]
        while len(self.minima[-1]) > 1:
            self.minima.append(self.minima[-1].reshape(-1, 2).min(axis=1))
        # Ones up to but not including each place, and pairs of a one and a zero that start before it.
        self.opened = np.r_[0, np.cumsum(self.bits, dtype=np.int64)]
        leaf = np.zeros(n, np.int64)
        leaf[:-1] = (self.bits[:-1] == 1) & (self.bits[1:] == 0)
        self.leaves = np.r_[0, np.cumsum(leaf)]

    def opens(self) -> np.ndarray:
        """The places of the ones: nodes in preorder."""
        return np.flatnonzero(self.bits)

    def closes(self, opens: np.ndarray) -> np.ndarray:
        """The place of the parenthesis that closes each of ``opens``."""
        parts = [self._closes(opens[at : at + _QUERIES]) for at in range(0, len(opens), _QUERIES)]
        return np.concatenate(parts) if parts else np.zeros(0, np.int64)

    def _closes(self, opens: np.ndarray) -> np.ndarray:
        block, inside = opens // BLOCK, opens % BLOCK
        target = self.excess[block, inside] - 1
        here = (self.excess[block] <= target[:, None]) & (np.arange(BLOCK) > inside[:, None])
        near = here.any(axis=1)
        result = np.where(near, block * BLOCK + here.argmax(axis=1), -1)
        far = np.flatnonzero(~near)
        if not len(far):
            return result
        # Up: at each level the sibling to the right, until one reaches down to the target.
        target, at = target[far], block[far]
        level = np.full(len(far), -1)
        for height, minima in enumerate(self.minima[:-1]):
            right = np.where((at & 1 == 0) & (level < 0), at + 1, 0)
            hit = (right > 0) & (minima[right] <= target)
            level[hit] = height
            at = np.where(level < 0, at >> 1, np.where(hit, right, at))
        # Down: to the left where that side reaches the target.
        for height in range(len(self.minima) - 2, 0, -1):
            going = level == height
            left = at[going] * 2
            at[going] = left + (self.minima[height - 1][left] > target[going])
            level[going] = height - 1
        result[far] = at * BLOCK + (self.excess[at] <= target[:, None]).argmax(axis=1)
        return result
