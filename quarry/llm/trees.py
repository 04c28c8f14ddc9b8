"""Gradient-boosted regression trees on the log loss, over binned features (helper of operator 7)."""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np


@dataclass
class Boosted:
    """Trees as arrays: at node k of a tree of depth d, children are 2k + 1 and 2k + 2."""

    edges: list[np.ndarray]
    base: float
    features: list[np.ndarray] = field(default_factory=list)
    cuts: list[np.ndarray] = field(default_factory=list)
    leaves: list[np.ndarray] = field(default_factory=list)

    def binned(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, x[:, k], side="left") for k, e in enumerate(self.edges)], axis=1).astype(np.uint8)

    def log_odds(self, x: np.ndarray) -> np.ndarray:
        b = self.binned(x)
        out = np.full(len(x), self.base)
        rows = np.arange(len(x))
        for f, c, leaf in zip(self.features, self.cuts, self.leaves, strict=True):
            at = np.zeros(len(x), dtype=np.int64)
            while at.size and at[0] < len(f):
                at = 2 * at + 1 + (b[rows, f[at]] > c[at])
            out += leaf[at - len(f)]
        return out


def boost(x: np.ndarray, y: np.ndarray, trees: int = 40, depth: int = 4, rate: float = 0.3, bins: int = 32, penalty: float = 1.0) -> Boosted:
    edges = [np.unique(np.quantile(x[:, k], np.linspace(0, 1, bins)[1:-1])) for k in range(x.shape[1])]
    share = np.clip(y.mean(), 1e-3, 1 - 1e-3)
    model = Boosted(edges, float(np.log(share / (1 - share))))
    b = model.binned(x)
    odds = np.full(len(y), model.base)
    n_features, inner = x.shape[1], (1 << depth) - 1
    for _ in range(trees):
        p = 1 / (1 + np.exp(-odds))
        g, h = y - p, p * (1 - p) + 1e-9
        f, c, at = np.zeros(inner, dtype=np.int64), np.full(inner, bins, dtype=np.int64), np.zeros(len(y), dtype=np.int64)
        for level in range(depth):
            first, n = (1 << level) - 1, 1 << level
            best = np.full(n, 1e-6)
            for k in range(n_features):
                cell = (at - first) * bins + b[:, k]
                gs = np.bincount(cell, g, n * bins).reshape(n, bins).cumsum(1)
                hs = np.bincount(cell, h, n * bins).reshape(n, bins).cumsum(1)
                gt, ht = gs[:, -1:], hs[:, -1:]
                gain = gs**2 / (hs + penalty) + (gt - gs) ** 2 / (ht - hs + penalty) - gt**2 / (ht + penalty)
                top = gain.argmax(1)
                better = gain[np.arange(n), top] > best
                best[better] = gain[np.arange(n), top][better]
                f[first : first + n][better], c[first : first + n][better] = k, top[better]
            at = 2 * at + 1 + (b[np.arange(len(y)), f[at]] > c[at])
        leaf = at - inner
        value = rate * np.bincount(leaf, g, inner + 1) / (np.bincount(leaf, h, inner + 1) + penalty)
        odds += value[leaf]
        model.features.append(f)
        model.cuts.append(c)
        model.leaves.append(value)
    return model
