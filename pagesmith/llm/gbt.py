"""Small gradient-boosted trees for binary labels: fitted with numpy on a bounded sample, scored with
numpy inside tasks or as a plain SQL expression."""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np

TREES, DEPTH, RATE, BINS, LEAST = 40, 3, 0.25, 32, 8.0


@dataclass
class Trees:
    """Complete binary trees of equal depth: node k has children 2k + 1 and 2k + 2; ``x <= cut`` goes left."""

    bias: float = 0.0
    features: list[np.ndarray] = field(default_factory=list)
    cuts: list[np.ndarray] = field(default_factory=list)
    leaves: list[np.ndarray] = field(default_factory=list)

    def margin(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.bias)
        rows = np.arange(len(x))
        for feature, cut, leaf in zip(self.features, self.cuts, self.leaves):
            at = np.zeros(len(x), np.int64)
            while len(at) and at[0] < len(feature):
                at = 2 * at + 1 + (x[rows, feature[at]] > cut[at])
            out += leaf[at - len(feature)]
        return out

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-self.margin(x)))

    def sql(self, names: list[str]) -> str:
        """The margin as a SQL expression over columns ``names``."""
        def node(t: int, k: int) -> str:
            if k >= len(self.features[t]):
                return f"{float(self.leaves[t][k - len(self.features[t])])!r}D"
            if not np.isfinite(self.cuts[t][k]):
                return node(t, 2 * k + 1)
            return f"IF({names[self.features[t][k]]} <= {float(self.cuts[t][k])!r}D, {node(t, 2 * k + 1)}, {node(t, 2 * k + 2)})"
        return " + ".join([f"{float(self.bias)!r}D", *(node(t, 0) for t in range(len(self.features)))])


def fit(x: np.ndarray, y: np.ndarray, trees: int = TREES, depth: int = DEPTH, rate: float = RATE, bins: int = BINS,
        least: float = LEAST, weight: np.ndarray | None = None, edges: list[np.ndarray] | None = None) -> Trees:
    """Newton boosting of the logistic loss on binned features; rows weigh 1 or ``weight``; bins end at
    quantiles, or at the ``edges`` given for each feature.  One class only, or no rows, gives its (smoothed) prior."""
    x, y = np.asarray(x, float), np.asarray(y, float)
    weight = np.ones(len(y)) if weight is None else np.asarray(weight, float)
    prior = ((weight * y).sum() + 1) / (weight.sum() + 2)
    model = Trees(bias=float(np.log(prior / (1 - prior))))
    if not len(y) or y.min() == y.max():
        return model
    edges = edges or [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins)[1:-1])) for j in range(x.shape[1])]
    binned = np.stack([np.searchsorted(e, x[:, j], side="left") for j, e in enumerate(edges)], 1)  # bin <= b  <=>  x <= edge b
    margin = np.full(len(y), model.bias)
    for _ in range(trees):
        p = 1 / (1 + np.exp(-margin))
        g, h = weight * (y - p), weight * p * (1 - p)
        feature, cut = np.zeros(2 ** depth - 1, np.int64), np.full(2 ** depth - 1, np.inf)
        at = np.zeros(len(y), np.int64)
        for level in range(depth):
            first, width = 2 ** level - 1, 2 ** level
            k = at - first
            gain = np.zeros(width)
            for j in range(x.shape[1]):
                m = len(edges[j]) + 1
                if m < 2:
                    continue
                key = k * m + binned[:, j]
                gs = np.bincount(key, g, width * m).reshape(width, m).cumsum(1)
                hs = np.bincount(key, h, width * m).reshape(width, m).cumsum(1)
                gl, hl, gr, hr = gs[:, :-1], hs[:, :-1], gs[:, -1:] - gs[:, :-1], hs[:, -1:] - hs[:, :-1]
                score = gl ** 2 / (hl + 1) + gr ** 2 / (hr + 1) - gs[:, -1:] ** 2 / (hs[:, -1:] + 1)
                score[(hl < least / 4) | (hr < least / 4)] = 0
                b = score.argmax(1)
                s = score[np.arange(width), b]
                better = s > gain + 1e-9
                gain[better] = s[better]
                feature[first:first + width][better] = j
                cut[first:first + width][better] = edges[j][b[better]]
            at = 2 * at + 1 + (x[np.arange(len(y)), feature[at]] > cut[at])
        leaf_at = at - (2 ** depth - 1)
        leaf = rate * np.bincount(leaf_at, g, 2 ** depth) / (np.bincount(leaf_at, h, 2 ** depth) + 1)
        model.features.append(feature)
        model.cuts.append(cut)
        model.leaves.append(leaf)
        margin += leaf[leaf_at]
    return model
