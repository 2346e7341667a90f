"""Gradient-boosted trees for a yes/no label, on numpy arrays that fit one task (a bounded training sample)."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass
class Trees:
    """Complete binary trees of one depth. A row goes right where its feature exceeds the threshold."""

    feature: np.ndarray  # trees x inner nodes
    threshold: np.ndarray
    value: np.ndarray  # trees x leaves
    base: float

    def score(self, x: np.ndarray) -> np.ndarray:
        """Log-odds of the label for each row."""
        out = np.full(len(x), self.base)
        rows = np.arange(len(x))
        inner = self.feature.shape[1]
        for f, t, v in zip(self.feature, self.threshold, self.value, strict=True):
            at = np.zeros(len(x), np.int64)
            while inner and at.size and at[0] < inner:
                at = 2 * at + 1 + (x[rows, f[at]] > t[at])
            out += v[at - inner]
        return out


def fit(x: np.ndarray, y: np.ndarray, trees: int = 40, depth: int = 4, rate: float = 0.25, bins: int = 24, leaf: float = 1.0) -> Trees:
    """Boosting with second-order leaf values and histogram splits; deterministic."""
    n, m = x.shape
    cuts = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1])) for j in range(m)]
    binned = np.stack([np.searchsorted(c, x[:, j], side="left") for j, c in enumerate(cuts)], 1)
    base = float(np.log((y.mean() + 1e-3) / (1 - y.mean() + 1e-3)))
    score = np.full(n, base)
    inner = 2**depth - 1
    all_f, all_t, all_v = [], [], []
    for _ in range(trees):
        p = 1 / (1 + np.exp(-score))
        g, h = y - p, p * (1 - p)
        feature, threshold = np.zeros(inner, np.int64), np.full(inner, np.inf)
        at = np.zeros(n, np.int64)
        for node in range(inner):
            rows = np.flatnonzero(at == node)
            best = 1e-6
            if len(rows) > 1:
                gr, hr = g[rows], h[rows]
                G, H = gr.sum(), hr.sum()
                for j, c in enumerate(cuts):
                    if not len(c):
                        continue
                    b = binned[rows, j]
                    gl = np.cumsum(np.bincount(b, gr, len(c) + 1))[:-1]
                    hl = np.cumsum(np.bincount(b, hr, len(c) + 1))[:-1]
                    gain = gl**2 / (hl + leaf) + (G - gl) ** 2 / (H - hl + leaf) - G**2 / (H + leaf)
                    k = int(gain.argmax())
                    if gain[k] > best:
                        best, feature[node], threshold[node] = gain[k], j, c[k]
            at[rows] = 2 * node + 1 + (x[rows, feature[node]] > threshold[node])
        value = np.array([g[(r := at == inner + k)].sum() / (h[r].sum() + leaf) for k in range(inner + 1)]) * rate
        score += value[at - inner]
        all_f.append(feature)
        all_t.append(threshold)
        all_v.append(value)
    return Trees(np.array(all_f), np.array(all_t), np.array(all_v), base)
