"""A balanced search tree of (capacity, bin) pairs that finds the tightest bin an item still fits."""

from __future__ import annotations

import random
from dataclasses import dataclass, field


@dataclass(slots=True)
class _Node:
    key: tuple[int, int]
    weight: float
    left: _Node | None = field(default=None)
    right: _Node | None = field(default=None)


class CapacityTree:
    """Treap with a fixed seed: insert, remove and least key not below a capacity, each in logarithmic time."""

    def __init__(self, seed: int = 7):
        self._root: _Node | None = None
        self._random = random.Random(seed)

    def insert(self, capacity: int, number: int) -> None:
        low, high = self._split(self._root, (capacity, number))
        node = _Node((capacity, number), self._random.random())
        self._root = self._merge(self._merge(low, node), high)

    def take_tightest(self, need: int) -> tuple[int, int] | None:
        """Remove and return the (capacity, bin) of least capacity that is at least ``need``."""
        low, high = self._split(self._root, (need, -1))
        if high is None:
            self._root = low
            return None
        first = high
        while first.left is not None:
            first = first.left
        _, rest = self._split(high, (first.key[0], first.key[1] + 1))
        self._root = self._merge(low, rest)
        return first.key

    def _split(self, node: _Node | None, key: tuple[int, int]) -> tuple[_Node | None, _Node | None]:
        """Nodes below ``key``, and the others."""
        if node is None:
            return None, None
        if node.key < key:
            low, high = self._split(node.right, key)
            node.right = low
            return node, high
        low, high = self._split(node.left, key)
        node.left = high
        return low, node

    def _merge(self, low: _Node | None, high: _Node | None) -> _Node | None:
        if low is None or high is None:
            return low or high
        if low.weight > high.weight:
            low.right = self._merge(low.right, high)
            return low
        high.left = self._merge(low, high.left)
        return high


def best_fit_decreasing(sizes: list[int], capacity: int) -> tuple[list[int], int]:
    """(bin of each item, number of bins): items by decreasing size, each into the tightest bin it fits.

    An item above the capacity gets a bin of its own. Equal sizes keep their order.
    """
    tree, bins = CapacityTree(), 0
    placed = [0] * len(sizes)
    for item in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
        found = tree.take_tightest(sizes[item])
        left, number = found if found else (max(capacity, sizes[item]), bins)
        bins += found is None
        placed[item] = number
        tree.insert(left - sizes[item], number)
    return placed, bins
