"""Gradient-boosted trees for two classes, on a bounded table of numbers."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass
class Trees:
    """Complete trees of one depth: the feature and limit of each inner node, the value of each leaf."""

    features: np.ndarray
    limits: np.ndarray
    leaves: np.ndarray
    base: float

    def log_odds(self, x: np.ndarray) -> np.ndarray:
        n, many = len(x), len(self.features)
        at, rows, trees = np.zeros((n, many), np.int64), np.arange(n)[:, None], np.arange(many)[None, :]
        inner = self.features.shape[1]
        while many and at.min(initial=inner) < inner:
            at = 2 * at + 1 + (x[rows, self.features[trees, at]] > self.limits[trees, at])
        return self.base + (self.leaves[trees, at - inner].sum(axis=1) if many else np.zeros(n))

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.log_odds(x), -30, 30)))


def fit_trees(x: np.ndarray, y: np.ndarray, rounds: int = 60, depth: int = 4, rate: float = 0.3, bins: int = 32, ridge: float = 1.0, part: float = 0.5) -> Trees:
    """Boost ``rounds`` trees by second-order steps of the log loss, splits at quantiles of each feature.

    Each tree sees a seeded ``part`` of the features, so that none is relied on alone.
    """
    n, width = x.shape
    share = min(max(float(y.mean()) if n else 0.5, 1e-3), 1 - 1e-3)
    base = float(np.log(share / (1 - share)))
    inner, leaves = 2**depth - 1, 2**depth
    if n == 0 or y.min() == y.max():
        return Trees(np.zeros((0, inner), np.int64), np.zeros((0, inner)), np.zeros((0, leaves)), base)
    edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, bins + 1)[1:-1])) for f in range(width)]
    codes = np.stack([np.searchsorted(e, x[:, f], "left") for f, e in enumerate(edges)], axis=1)
    score, rng = np.full(n, base), np.random.default_rng(7)
    made = Trees(np.zeros((rounds, inner), np.int64), np.full((rounds, inner), np.inf), np.zeros((rounds, leaves)), base)
    for r in range(rounds):
        p = 1 / (1 + np.exp(-score))
        slope, bend = y - p, p * (1 - p)
        at = np.zeros(n, np.int64)
        some = np.sort(rng.choice(width, max(1, round(part * width)), replace=False))
        for level in range(depth):
            first, many = 2**level - 1, 2**level
            here = at - first
            best, cut = np.full(many, 1e-6), np.full(many, -1)
            for f in some:
                size = len(edges[f]) + 1
                key = here * size + codes[:, f]
                g = np.bincount(key, slope, many * size).reshape(many, size)
                h = np.bincount(key, bend, many * size).reshape(many, size)
                gl, hl, gt, ht = g.cumsum(1)[:, :-1], h.cumsum(1)[:, :-1], g.sum(1)[:, None], h.sum(1)[:, None]
                gain = gl**2 / (hl + ridge) + (gt - gl) ** 2 / (ht - hl + ridge) - gt**2 / (ht + ridge)
                if not gain.size:
                    continue
                k = gain.argmax(1)
                top = gain[np.arange(many), k]
                better = top > best
                best[better], cut[better] = top[better], k[better]
                made.features[r, first : first + many][better] = f
                made.limits[r, first : first + many][better] = edges[f][k[better]]
            at = 2 * at + 1 + (x[np.arange(n), made.features[r, at]] > made.limits[r, at])
        leaf = at - inner
        made.leaves[r] = rate * np.bincount(leaf, slope, leaves) / (np.bincount(leaf, bend, leaves) + ridge)
        score += made.leaves[r][leaf]
    return made
