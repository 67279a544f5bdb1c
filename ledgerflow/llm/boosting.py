"""Gradient-boosted trees with monotonic constraints, flattened into numpy node arrays.

Every tree is a full binary tree of one depth: node i has the children 2i + 1
and 2i + 2, a node that does not split sends all rows left. Scoring walks all
trees of all rows level by level with array lookups, without recursion.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass
class Forest:
    feature: np.ndarray  # (trees, inner nodes)
    threshold: np.ndarray  # (trees, inner nodes); a row goes right if its value is greater
    leaf: np.ndarray  # (trees, leaves)
    bias: float

    def score(self, x: np.ndarray) -> np.ndarray:
        """Log-odds of each row."""
        trees, inner = self.feature.shape
        every, node = np.arange(trees)[None, :], np.zeros((len(x), trees), np.int64)
        rows = np.arange(len(x))[:, None]
        for _ in range(int(np.log2(inner + 1))):
            right = x[rows, self.feature[every, node]] > self.threshold[every, node]
            node = 2 * node + 1 + right
        return self.bias + self.leaf[every, node - inner].sum(axis=1)


def _weight(g, h, l2, low, high):
    return np.clip(-g / (h + l2), low, high)


def fit(x: np.ndarray, y: np.ndarray, monotone: np.ndarray, trees: int = 60, depth: int = 3, rate: float = 0.2,
        bins: int = 64, l2: float = 1.0, least_weight: float = 2.0) -> Forest:
    """Logistic loss, histogram splits. ``monotone`` is +1, -1 or 0 for each feature.

    A split on a constrained feature must order its sides' weights; the middle of the two then bounds all
    weights below it, so the whole forest is monotonic in that feature. Ties go to the first feature and bin.
    """
    n, m = x.shape
    edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, bins)[1:-1])) for f in range(m)]
    binned = np.stack([np.searchsorted(edges[f], x[:, f], side="left") for f in range(m)], axis=1)
    share = np.clip(y.mean(), 1e-6, 1 - 1e-6)
    bias = float(np.log(share / (1 - share)))
    inner, margin = 2 ** depth - 1, np.full(n, bias)
    feature = np.zeros((trees, inner), np.int64)
    threshold = np.full((trees, inner), np.inf)
    leaf = np.zeros((trees, inner + 1))
    for t in range(trees):
        p = 1 / (1 + np.exp(-margin))
        g, h = p - y, p * (1 - p)
        node = np.zeros(n, np.int64)
        low, high = np.full(2 * inner + 1, -np.inf), np.full(2 * inner + 1, np.inf)
        for level in range(depth):
            first, width = 2 ** level - 1, 2 ** level
            best = np.zeros(width)
            split = np.full((width, 2), -1)
            ends = np.zeros((width, 2))
            at = (node - first) * bins
            for f in range(m):
                gs = np.bincount(at + binned[:, f], g, width * bins).reshape(width, bins)
                hs = np.bincount(at + binned[:, f], h, width * bins).reshape(width, bins)
                gl, hl = gs.cumsum(1), hs.cumsum(1)
                ga, ha = gl[:, -1:], hl[:, -1:]
                lo, hi = low[first:first + width, None], high[first:first + width, None]
                wl, wr = _weight(gl, hl, l2, lo, hi), _weight(ga - gl, ha - hl, l2, lo, hi)
                wa = _weight(ga, ha, l2, lo, hi)
                gain = -(gl * wl + (hl + l2) * wl ** 2 / 2) - ((ga - gl) * wr + (ha - hl + l2) * wr ** 2 / 2)
                gain += ga * wa + (ha + l2) * wa ** 2 / 2
                bad = (hl < least_weight) | (ha - hl < least_weight) | (np.arange(bins)[None, :] >= len(edges[f]))
                if monotone[f]:
                    bad |= monotone[f] * (wr - wl) < 0
                gain = np.where(bad, 0, gain)
                top = gain.argmax(axis=1)
                gained = gain[np.arange(width), top]
                better = gained > best + 1e-9
                best[better] = gained[better]
                split[better] = np.stack([np.full(width, f), top], axis=1)[better]
                ends[better] = np.stack([wl[np.arange(width), top], wr[np.arange(width), top]], axis=1)[better]
            for k in range(width):
                i, (f, b) = first + k, split[k]
                left, right = 2 * i + 1, 2 * i + 2
                low[left] = low[right] = low[i]
                high[left] = high[right] = high[i]
                if f >= 0:
                    feature[t, i], threshold[t, i] = f, edges[f][b]
                    middle = ends[k].mean()
                    if monotone[f] > 0:
                        high[left] = low[right] = middle
                    elif monotone[f] < 0:
                        low[left] = high[right] = middle
            chosen = split[node - first]
            goes_right = (chosen[:, 0] >= 0) & (binned[np.arange(n), chosen[:, 0]] > chosen[:, 1])
            node = 2 * node + 1 + goes_right
        place = node - inner
        weight = _weight(np.bincount(place, g, inner + 1), np.bincount(place, h, inner + 1), l2, low[inner:], high[inner:])
        leaf[t] = rate * weight
        margin += leaf[t][place]
    return Forest(feature, threshold, leaf, bias)
