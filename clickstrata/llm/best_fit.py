"""Best fit by capacity: a segment tree over the free room of open sequences."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterable


class RoomTree:
    """Which amounts of room exist; finds the least that is at least a length."""

    def __init__(self, capacity: int):
        self.leaves = 1 << capacity.bit_length()
        self.filled = bytearray(2 * self.leaves)

    def mark(self, room: int, there: bool) -> None:
        node = room + self.leaves
        self.filled[node] = there
        while node > 1:
            node >>= 1
            there = bool(self.filled[2 * node] or self.filled[2 * node + 1])
            if self.filled[node] == there:
                break
            self.filled[node] = there

    def least(self, length: int) -> int | None:
        node = length + self.leaves
        if self.filled[node]:
            return length
        while node > 1:
            # To the right of where we came from, then down the leftmost filled way.
            if not node & 1 and self.filled[node + 1]:
                node += 1
                while node < self.leaves:
                    node = 2 * node if self.filled[2 * node] else 2 * node + 1
                return node - self.leaves
            node >>= 1
        return None


def best_fit_decreasing(lengths: list[int], capacity: int) -> list[list[int]]:
    """Sequences as lists of item numbers; longest items first, each where it fits tightest."""
    sequences: list[list[int]] = []
    by_room: dict[int, list[int]] = defaultdict(list)
    tree = RoomTree(capacity)
    for item in sorted(range(len(lengths)), key=lambda i: (-lengths[i], i)):
        room = tree.least(lengths[item])
        if room is None:
            at, room = len(sequences), capacity
            sequences.append([item])
        else:
            at = by_room[room].pop()
            if not by_room[room]:
                tree.mark(room, False)
            sequences[at].append(item)
        left = room - lengths[item]
        if left:
            by_room[left].append(at)
            if len(by_room[left]) == 1:
                tree.mark(left, True)
    return sequences


def pieces(length: int, capacity: int) -> Iterable[tuple[int, int]]:
    """(start, length) of the pieces a document is cut into; one empty piece if it is empty."""
    for start in range(0, max(length, 1), capacity):
        yield start, min(capacity, length - start)
