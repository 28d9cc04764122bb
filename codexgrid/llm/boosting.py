"""Gradient-boosted trees for small tables of features (binary log loss), fitted on the driver and applied in tasks."""

from __future__ import annotations

import numpy as np


class Boosted:
    """Depth-two regression trees on quantile-binned features."""

    def __init__(self, rounds: int = 60, rate: float = 0.3, bins: int = 24, least: int = 5) -> None:
        self.rounds, self.rate, self.bins, self.least = rounds, rate, bins, least
        self.trees: list[tuple] = []
        self.base = 0.0

    def fit(self, x: np.ndarray, y: np.ndarray) -> Boosted:
        p = np.clip(y.mean(), 1e-3, 1 - 1e-3)
        self.base = float(np.log(p / (1 - p)))
        edges = [np.unique(np.quantile(c, np.linspace(0, 1, self.bins + 1)[1:-1])) for c in x.T]
        code = np.stack([np.searchsorted(e, c, side="left") for e, c in zip(edges, x.T)], 1)
        score = np.full(len(y), self.base)
        for _ in range(self.rounds):
            q = 1 / (1 + np.exp(-score))
            g, h = y - q, np.maximum(q * (1 - q), 1e-6)
            root = self._split(code, edges, g, h, np.ones(len(y), bool))
            if root is None:
                break
            f, b, cut = root
            left = code[:, f] <= b
            leaves = []
            for side in (left, ~left):
                s = self._split(code, edges, g, h, side)
                if s is None:
                    v = self._value(g[side], h[side])
                    leaves.append((0, np.inf, v, v))
                    score[side] += v
                else:
                    f2, b2, cut2 = s
                    low, high = side & (code[:, f2] <= b2), side & (code[:, f2] > b2)
                    v1, v2 = self._value(g[low], h[low]), self._value(g[high], h[high])
                    leaves.append((f2, cut2, v1, v2))
                    score[low] += v1
                    score[high] += v2
            self.trees.append((f, cut, *leaves))
        return self

    def _value(self, g: np.ndarray, h: np.ndarray) -> float:
        return float(self.rate * g.sum() / (h.sum() + 1.0))

    def _split(self, code, edges, g, h, rows):
        best, found = 1e-6, None
        gs, hs = g[rows], h[rows]
        total = gs.sum() ** 2 / (hs.sum() + 1.0)
        for f in range(code.shape[1]):
            n = len(edges[f]) + 1
            if n < 2:
                continue
            c = code[rows, f]
            cg, ch, cn = np.cumsum(np.bincount(c, gs, n)), np.cumsum(np.bincount(c, hs, n)), np.cumsum(np.bincount(c, minlength=n))
            gain = cg[:-1] ** 2 / (ch[:-1] + 1) + (cg[-1] - cg[:-1]) ** 2 / (ch[-1] - ch[:-1] + 1) - total
            gain[(cn[:-1] < self.least) | (cn[-1] - cn[:-1] < self.least)] = -1
            b = int(gain.argmax())
            if gain[b] > best:
                best, found = gain[b], (f, b, float(edges[f][b]))
        return found

    def predict(self, x: np.ndarray) -> np.ndarray:
        """Probabilities."""
        score = np.full(len(x), self.base)
        for f, cut, *leaves in self.trees:
            left = x[:, f] <= cut
            for side, (f2, cut2, v1, v2) in zip((left, ~left), leaves):
                score += side * np.where(x[:, f2] <= cut2, v1, v2)
        return 1 / (1 + np.exp(-score))
