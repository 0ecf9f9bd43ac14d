"""A bidirectional LSTM that labels the items of sequences, in numpy."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass
class Batch:
    """Items of several sequences in a row; where each begins, longest first."""

    items: np.ndarray
    starts: np.ndarray
    lengths: np.ndarray

    @classmethod
    def of(cls, sequences: list[np.ndarray]) -> Batch:
        lengths = np.array([len(s) for s in sequences])
        starts = np.concatenate([[0], np.cumsum(lengths)])[:-1]
        order = np.argsort(-lengths, kind="stable")
        return cls(np.concatenate(sequences), starts[order], lengths[order])

    def steps(self, back: bool):
        """The items at step 0, 1, ... of the sequences that have as many."""
        for t in range(int(self.lengths[0]) if len(self.lengths) else 0):
            active = int(np.searchsorted(-self.lengths, -t, side="left"))
            first = self.starts[:active]
            yield first + (self.lengths[:active] - 1 - t if back else t)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


class BiLstm:
    """Two directions of ``hidden`` cells over ``width`` inputs, one output."""

    def __init__(self, width: int, hidden: int, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.hidden = hidden
        self.weights: dict[str, np.ndarray] = {}
        for way in ("ahead", "back"):
            self.weights[f"{way}_in"] = rng.normal(0, width**-0.5, (width, 4 * hidden))
            self.weights[f"{way}_own"] = rng.normal(0, hidden**-0.5, (hidden, 4 * hidden))
            bias = np.zeros(4 * hidden)
            bias[hidden : 2 * hidden] = 1
            self.weights[f"{way}_bias"] = bias
        self.weights["out"] = rng.normal(0, hidden**-0.5, 2 * hidden)
        self.weights["out_bias"] = np.zeros(1)

    def _run(self, batch: Batch, way: str) -> tuple[np.ndarray, list]:
        h_size = self.hidden
        given = batch.items @ self.weights[f"{way}_in"] + self.weights[f"{way}_bias"]
        out = np.zeros((len(batch.items), h_size))
        h = c = np.zeros((len(batch.starts), h_size))
        trace = []
        for at in batch.steps(way == "back"):
            h, c = h[: len(at)], c[: len(at)]
            gates = given[at] + h @ self.weights[f"{way}_own"]
            i, f, o = (sigmoid(gates[:, k * h_size : (k + 1) * h_size]) for k in range(3))
            g = np.tanh(gates[:, 3 * h_size :])
            new = f * c + i * g
            squashed = np.tanh(new)
            trace.append((at, h, c, i, f, o, g, squashed))
            h, c = o * squashed, new
            out[at] = h
        return out, trace

    def probabilities(self, batch: Batch) -> np.ndarray:
        both = np.concatenate([self._run(batch, way)[0] for way in ("ahead", "back")], axis=1)
        return sigmoid(both @ self.weights["out"] + self.weights["out_bias"][0])

    def slopes(self, batch: Batch, labels: np.ndarray) -> dict[str, np.ndarray]:
        """Gradient of the mean logistic loss."""
        runs = {way: self._run(batch, way) for way in ("ahead", "back")}
        both = np.concatenate([runs[way][0] for way in ("ahead", "back")], axis=1)
        p = sigmoid(both @ self.weights["out"] + self.weights["out_bias"][0])
        error = (p - labels) / len(labels)
        slopes = {"out": both.T @ error, "out_bias": np.array([error.sum()])}
        size = self.hidden
        for k, way in enumerate(("ahead", "back")):
            own = self.weights[f"{way}_own"]
            pull = np.outer(error, self.weights["out"][k * size : (k + 1) * size])
            d_given = np.zeros((len(batch.items), 4 * size))
            d_own = np.zeros_like(own)
            d_h = d_c = np.zeros((0, size))
            for at, h, c, i, f, o, g, squashed in reversed(runs[way][1]):
                more = len(at) - len(d_h)
                d_h = np.concatenate([d_h, np.zeros((more, size))]) + pull[at]
                d_c = np.concatenate([d_c, np.zeros((more, size))])
                d_c = d_c + d_h * o * (1 - squashed**2)
                d_gates = np.concatenate(
                    [
                        d_c * g * i * (1 - i),
                        d_c * c * f * (1 - f),
                        d_h * squashed * o * (1 - o),
                        d_c * i * (1 - g**2),
                    ],
                    axis=1,
                )
                d_given[at] = d_gates
                d_own += h.T @ d_gates
                d_h, d_c = d_gates @ own.T, d_c * f
            slopes[f"{way}_in"] = batch.items.T @ d_given
            slopes[f"{way}_bias"] = d_given.sum(axis=0)
            slopes[f"{way}_own"] = d_own
        return slopes

    def fit(
        self,
        sequences: list[np.ndarray],
        labels: list[np.ndarray],
        rounds: int = 10,
        size: int = 32,
        rate: float = 0.02,
        seed: int = 11,
    ) -> None:
        """Adam over shuffled batches of sequences."""
        rng = np.random.default_rng(seed)
        mean = {k: np.zeros_like(w) for k, w in self.weights.items()}
        square = {k: np.zeros_like(w) for k, w in self.weights.items()}
        step = 0
        for _ in range(rounds):
            order = rng.permutation(len(sequences))
            for at in range(0, len(order), size):
                some = order[at : at + size]
                batch = Batch.of([sequences[i] for i in some])
                slopes = self.slopes(batch, np.concatenate([labels[i] for i in some]))
                step += 1
                norm = np.sqrt(sum((s**2).sum() for s in slopes.values()))
                for name, slope in slopes.items():
                    slope = slope / max(1.0, norm)
                    mean[name] = 0.9 * mean[name] + 0.1 * slope
                    square[name] = 0.99 * square[name] + 0.01 * slope**2
                    move = mean[name] / (1 - 0.9**step)
                    move = move / (np.sqrt(square[name] / (1 - 0.99**step)) + 1e-6)
                    self.weights[name] = self.weights[name] - rate * move
