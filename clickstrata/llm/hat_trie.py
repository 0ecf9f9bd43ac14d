"""A HAT-trie of phrases: branches by word for crowded beginnings, hash containers below.

A phrase is one integer, 21 bits for the id of each word, the first word on top. A
container holds the rests of phrases and their counts in a dict. When it gets too large
and the rests have more than one word, it bursts into a branch with a container for each
next word. Whole subtrees can be taken out, largest first.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np

WORD_BITS = 21
WORD_MASK = (1 << WORD_BITS) - 1
# Entries of a container that make it burst.
BURST = 4096


class Node:
    """A container (``counts``) or a branch (``children``) for rests of ``left`` words."""

    __slots__ = ("left", "counts", "children", "entries")

    def __init__(self, left: int):
        self.left = left
        self.counts: dict[int, int] | None = {}
        self.children: dict[int, Node] | None = None
        self.entries = 0

    def add(self, rests: np.ndarray, counts: np.ndarray) -> None:
        """Count rests in ascending order; equal ones may come again in later calls."""
        if not len(rests):
            return
        if self.children is None:
            self.count(rests.tolist(), counts.tolist())
            return
        shift = WORD_BITS * (self.left - 1)
        words, below = rests >> shift, rests & ((1 << shift) - 1)
        starts = np.flatnonzero(np.concatenate([[True], words[1:] != words[:-1]]))
        ends = np.append(starts[1:], len(rests)).tolist()
        low, own = below.tolist(), counts.tolist()
        for word, at, end in zip(words[starts].tolist(), starts.tolist(), ends):
            child = self.children.get(word)
            if child is None:
                child = self.children[word] = Node(self.left - 1)
            before = child.entries
            if child.children is None:
                child.count(low[at:end], own[at:end])
            else:
                child.add(below[at:end], counts[at:end])
            self.entries += child.entries - before

    def count(self, rests: list[int], counts: list[int]) -> None:
        own = self.counts
        for rest, count in zip(rests, counts):
            own[rest] = own.get(rest, 0) + count
        self.entries = len(own)
        if self.left > 1 and self.entries > BURST:
            phrases, totals = self.arrays()
            order = np.argsort(phrases)
            self.counts, self.children, self.entries = None, {}, 0
            self.add(phrases[order], totals[order])

    def containers(self, prefix: int = 0) -> Iterator[tuple[int, dict[int, int]]]:
        """The containers under this node, which lies under ``prefix``, with what leads there."""
        if self.children is None:
            yield prefix << (WORD_BITS * self.left), self.counts
        else:
            for word, child in self.children.items():
                yield from child.containers(prefix << WORD_BITS | word)

    def arrays(self) -> tuple[np.ndarray, np.ndarray]:
        """All phrases under this node and their counts."""
        return _arrays(self.containers())

    def spilled(self, keep: int, at_once: int = 1) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Take out subtrees of the root, largest first, until ``keep`` entries are left.

        Small ones are given together, until they have ``at_once`` entries.
        """
        if self.children is None:
            if self.entries > keep:
                yield self.arrays()
                self.counts, self.entries = {}, 0
            return
        taken: list[tuple[int, dict[int, int]]] = []
        held = 0
        for word in sorted(self.children, key=lambda word: -self.children[word].entries):
            if self.entries <= keep:
                break
            child = self.children.pop(word)
            self.entries -= child.entries
            held += child.entries
            taken.extend(child.containers(word))
            if held >= at_once:
                yield _arrays(taken)
                taken, held = [], 0
        if held:
            yield _arrays(taken)


def _arrays(containers: Iterable[tuple[int, dict[int, int]]]) -> tuple[np.ndarray, np.ndarray]:
    highs, sizes, rests, counts = [], [], [], []
    for high, own in containers:
        highs.append(high)
        sizes.append(len(own))
        rests.extend(own)
        counts.extend(own.values())
    leads = np.repeat(np.array(highs, dtype=np.int64), sizes)
    return np.array(rests, dtype=np.int64) | leads, np.array(counts, dtype=np.int64)
