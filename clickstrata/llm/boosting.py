"""Gradient boosting over a table of counted feature vectors.

Features are small whole numbers, so the training rows of any corpus group into
few distinct vectors with counts. Those are fitted on the driver; the trees
become one SQL expression.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

from pyspark.sql import Column, functions as F


@dataclass
class Node:
    """A leaf, or a test ``feature <= cut`` with the two nodes below."""

    value: float = 0.0
    feature: str = ""
    cut: int = 0
    below: Node | None = None
    above: Node | None = None

    def of(self, vector: dict[str, int]) -> float:
        node = self
        while node.below is not None:
            node = node.below if vector[node.feature] <= node.cut else node.above
        return node.value

    def column(self, features: dict[str, Column]) -> Column:
        if self.below is None:
            return F.lit(self.value)
        test = features[self.feature] <= self.cut
        return F.when(test, self.below.column(features)).otherwise(self.above.column(features))


@dataclass
class Trees:
    base: float = -20.0
    trees: list[Node] = field(default_factory=list)
    threshold: float = 1.0

    def margin(self, vector: dict[str, int]) -> float:
        return self.base + sum(tree.of(vector) for tree in self.trees)

    def score(self, features: dict[str, Column]) -> Column:
        margin = F.lit(self.base)
        for tree in self.trees:
            margin = margin + tree.column(features)
        return 1 / (1 + F.exp(-margin))


def sigmoid(x: float) -> float:
    return 1 / (1 + math.exp(-x)) if x >= 0 else math.exp(x) / (1 + math.exp(x))


def grow(rows: list[tuple], features: list[str], depth: int, least: float) -> Node:
    """A tree on (vector, gradient, hessian) rows, split where the loss falls most."""
    g, h = sum(r[1] for r in rows), sum(r[2] for r in rows)
    leaf = Node(value=-g / (h + 1.0))
    if depth == 0 or h < least:
        return leaf
    best, gain = None, 1e-6
    for name in features:
        sums: dict[int, list[float]] = {}
        for vector, rg, rh in rows:
            entry = sums.setdefault(vector[name], [0.0, 0.0])
            entry[0] += rg
            entry[1] += rh
        left_g = left_h = 0.0
        for cut in sorted(sums)[:-1]:
            left_g += sums[cut][0]
            left_h += sums[cut][1]
            right_g, right_h = g - left_g, h - left_h
            won = left_g**2 / (left_h + 1) + right_g**2 / (right_h + 1) - g**2 / (h + 1)
            if won > gain:
                best, gain = (name, cut), won
    if best is None:
        return leaf
    name, cut = best
    return Node(
        feature=name,
        cut=cut,
        below=grow([r for r in rows if r[0][name] <= cut], features, depth - 1, least),
        above=grow([r for r in rows if r[0][name] > cut], features, depth - 1, least),
    )


def fit(
    counted: list[tuple[dict[str, int], float, float]],
    features: list[str],
    rounds: int = 20,
    depth: int = 3,
    rate: float = 0.4,
    precision: float = 0.99,
) -> Trees:
    """Boosted trees for (vector, positives, negatives) rows.

    The threshold is the lowest score at which the share of positives among all
    rows scored as high or higher is ``precision``, and one half at least. Without rows of both kinds
    nothing can be told apart: the model then never selects.
    """
    positives = sum(p for _, p, _ in counted)
    negatives = sum(n for _, _, n in counted)
    if not positives or not negatives:
        return Trees()
    model = Trees(base=math.log(positives / negatives))
    margins = [model.base] * len(counted)
    for _ in range(rounds):
        rows = []
        for (vector, p, n), margin in zip(counted, margins):
            q = sigmoid(margin)
            rows.append((vector, (p + n) * q - p, (p + n) * q * (1 - q)))
        tree = grow(rows, features, depth, 1e-3)

        def shrink(node: Node) -> None:
            node.value *= rate
            if node.below is not None:
                shrink(node.below)
                shrink(node.above)

        shrink(tree)
        model.trees.append(tree)
        margins = [m + tree.of(vector) for (vector, _, _), m in zip(counted, margins)]
    ranked = sorted(zip(margins, counted), key=lambda x: -x[0])
    hits = misses = 0
    threshold = 1.0
    for at, (margin, (_, p, n)) in enumerate(ranked):
        hits, misses = hits + p, misses + n
        last = at + 1 == len(ranked) or ranked[at + 1][0] < margin
        if last and margin >= 0 and hits >= precision * (hits + misses):
            threshold = sigmoid(margin)
    model.threshold = min(threshold, 1.0) - 1e-9
    return model
