"""A forest as balanced parentheses with range min-max blocks over the excess.

Nodes are numbered in preorder; node i is the i-th opening parenthesis. All
queries are answered for many nodes at once, by array operations.
"""

from __future__ import annotations

import numpy as np

BLOCK = 64


class Parentheses:
    """Bits of a balanced sequence (1 opens, 0 closes)."""

    def __init__(self, bits: np.ndarray) -> None:
        self.bits = np.asarray(bits, np.int8)
        self.opens = np.flatnonzero(self.bits == 1)
        #: Excess of opening over closing parentheses after each position.
        self.excess = np.cumsum(2 * self.bits.astype(np.int64) - 1)
        self.rank_open = np.cumsum(self.bits, dtype=np.int64)
        leaf = np.zeros(len(self.bits), np.int64)
        leaf[:-1] = (self.bits[:-1] == 1) & (self.bits[1:] == 0)
        self.rank_leaf = np.cumsum(leaf)
        self._minima()

    def _minima(self) -> None:
        """Least excess per block, and per pair of blocks, of pairs, and so on up to one."""
        far = np.iinfo(np.int64).max
        blocks = max(1, -(-len(self.excess) // BLOCK))
        width = 1 << (blocks - 1).bit_length()
        self.padded = np.full(width * BLOCK, far)
        self.padded[: len(self.excess)] = self.excess
        levels = [self.padded.reshape(width, BLOCK).min(1)]
        while len(levels[-1]) > 1:
            levels.append(levels[-1].reshape(-1, 2).min(1))
        self.levels = levels

    def find_close(self, opens: np.ndarray) -> np.ndarray:
        """Place of the closing parenthesis of each opening one: the first later excess below its own."""
        goal = self.excess[opens] - 1
        out = np.full(len(opens), -1, np.int64)
        self._within(opens + 1, (opens // BLOCK + 1) * BLOCK, goal, out, np.arange(len(opens)))
        left = np.flatnonzero(out < 0)
        if not len(left):
            return out
        want, level = goal[left], 0
        node = opens[left] // BLOCK
        depth = np.zeros(len(left), np.int64)
        going = np.ones(len(left), bool)
        while going.any():  # up: until the neighbour on the right holds the goal
            values = self.levels[level]
            right = node ^ 1
            hit = going & (node % 2 == 0) & (values[np.minimum(right, len(values) - 1)] <= want)
            node[hit], depth[hit] = right[hit], level
            going &= ~hit
            node[going] //= 2
            level += 1
            if level == len(self.levels) and going.any():
                raise ValueError("the parentheses are not balanced")
        for level in range(int(depth.max()), 0, -1):  # down: into the first child that holds it
            at = depth == level
            child = node[at] * 2
            node[at] = child + (self.levels[level - 1][child] > want[at])
            depth[at] = level - 1
        self._within(node * BLOCK, (node + 1) * BLOCK, want, out, left)
        return out

    def _within(self, starts: np.ndarray, ends: np.ndarray, goal: np.ndarray, out: np.ndarray, slots: np.ndarray) -> None:
        """Scans of at most one block each, side by side."""
        at, end, want, slot = starts.copy(), ends, goal, slots
        while len(at):
            going = at < end
            at, end, want, slot = at[going], end[going], want[going], slot[going]
            hit = self.padded[at] == want
            out[slot[hit]] = at[hit]
            at, end, want, slot = at[~hit] + 1, end[~hit], want[~hit], slot[~hit]

    def subtrees(self) -> tuple[np.ndarray, np.ndarray]:
        """Per node: its subtree's nodes (itself included) and leaves."""
        closes = self.find_close(self.opens)
        sizes = (closes - self.opens + 1) // 2
        return sizes, self.rank_leaf[closes] - self.rank_leaf[self.opens] + (self.bits[self.opens + 1] == 0)


def range_minima(values: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Least of values[i : i + sizes[i]] for every i, from minima of ranges whose lengths are powers of two."""
    out = values.copy()
    power, table = 1, values
    while power <= sizes.max(initial=0):
        mine = np.flatnonzero((sizes >= power) & (sizes < 2 * power))
        out[mine] = np.minimum(table[mine], table[mine + sizes[mine] - power])
        if len(table) <= power:
            break
        table = np.minimum(table[:-power], table[power:])
        power *= 2
    return out
