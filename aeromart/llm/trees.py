"""Histogram gradient-boosted trees in numpy, and flat node arrays to score them.

Training works on a bounded sample (the caller's rows); scoring is what runs over all documents.
Every tree is a complete binary tree of one depth, so node i has the children 2i + 1 and 2i + 2 and
a tree is one row of two arrays: the feature and the threshold of each inner node. A node that was
not split sends everything left.
"""

from dataclasses import dataclass

import numpy as np


@dataclass
class Trees:
    feature: np.ndarray  # trees x inner nodes
    threshold: np.ndarray  # trees x inner nodes
    value: np.ndarray  # trees x leaves
    bias: float

    def margins(self, x: np.ndarray) -> np.ndarray:
        """Log-odds of label 1 for the rows of x, one numpy step per tree and level."""
        out = np.full(len(x), self.bias)
        rows, inner = np.arange(len(x)), self.feature.shape[1]
        for feature, threshold, value in zip(self.feature, self.threshold, self.value, strict=True):
            node = np.zeros(len(x), np.int64)
            for _ in range((inner + 1).bit_length() - 1):
                node = 2 * node + 1 + (x[rows, feature[node]] > threshold[node])
            out += value[node - inner]
        return out

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.margins(x), -40, 40)))


def constant(rate: float = 0.5) -> Trees:
    """The model that gives every row the same probability."""
    return Trees(np.zeros((0, 1), np.int64), np.zeros((0, 1)), np.zeros((0, 2)), float(np.log(rate / (1 - rate))))


def fit(
    x: np.ndarray, y: np.ndarray, rounds: int = 80, depth: int = 4, rate: float = 0.15, bins: int = 64,
    ridge: float = 2.0, least: int = 8, signs: np.ndarray | None = None,
) -> Trees:
    """Boosted trees for the labels y (0 or 1).

    Features are cut into at most `bins` quantile bins; each level takes one histogram of gradients
    per feature and node. `signs` holds 1 where the margin may only rise with a feature, -1 where it
    may only fall, 0 where it is free: a split against the sign is not taken, and the middle of the
    two children bounds everything below them. One class only, or no rows, gives a constant.
    """
    n, width = x.shape if x.ndim == 2 else (0, 0)
    if n == 0:
        return constant()
    mean = (y.sum() + 0.5) / (n + 1)
    if y.min() == y.max():
        return constant(float(mean))
    signs = np.zeros(width, int) if signs is None else signs
    cuts = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1])) for j in range(width)]
    binned = np.column_stack([np.searchsorted(c, x[:, j], side="left") for j, c in enumerate(cuts)])
    inner, leaves = 2**depth - 1, 2**depth
    model = Trees(np.zeros((rounds, inner), np.int64), np.full((rounds, inner), np.inf), np.zeros((rounds, leaves)), float(np.log(mean / (1 - mean))))
    margin = np.full(n, model.bias)
    for t in range(rounds):
        p = 1 / (1 + np.exp(-margin))
        g, h = y - p, p * (1 - p)
        node = np.zeros(n, np.int64)
        low, high = np.full(1, -np.inf), np.full(1, np.inf)
        for level in range(depth):
            count, offset = 2**level, 2**level - 1
            best, choice = np.full(count, 1e-6), np.full((count, 2), -1)
            middle = np.zeros(count)
            for j in range(width):
                size = len(cuts[j]) + 1
                if size < 2:
                    continue
                key = (node - offset) * size + binned[:, j]
                sums = [np.bincount(key, w, count * size).reshape(count, size).cumsum(1) for w in (g, h, None)]
                (gl, gt), (hl, ht), (nl, nt) = ((s[:, :-1], s[:, -1:]) for s in sums)
                gain = gl**2 / (hl + ridge) + (gt - gl) ** 2 / (ht - hl + ridge) - gt**2 / (ht + ridge)
                left = np.clip(gl / (hl + ridge), low[:, None], high[:, None])
                right = np.clip((gt - gl) / (ht - hl + ridge), low[:, None], high[:, None])
                allowed = (nl >= least) & (nt - nl >= least) & (signs[j] * (right - left) >= 0)
                gain = np.where(allowed, gain, 0)
                top = gain.argmax(1)
                value = gain[np.arange(count), top]
                better = value > best
                best[better], choice[better, 0], choice[better, 1] = value[better], j, top[better]
                middle[better] = ((left + right) / 2)[np.arange(count), top][better]
            new_low, new_high = np.repeat(low, 2), np.repeat(high, 2)
            for k in np.flatnonzero(choice[:, 0] >= 0):
                j, b = choice[k]
                model.feature[t, offset + k], model.threshold[t, offset + k] = j, cuts[j][b]
                if signs[j]:
                    lower, upper = (2 * k, 2 * k + 1) if signs[j] > 0 else (2 * k + 1, 2 * k)
                    new_high[lower], new_low[upper] = min(high[k], middle[k]), max(low[k], middle[k])
            low, high = new_low, new_high
            f, c = model.feature[t, node], model.threshold[t, node]
            node = 2 * node + 1 + (x[np.arange(n), f] > c)
        leaf = node - inner
        top = np.bincount(leaf, g, leaves) / (np.bincount(leaf, h, leaves) + ridge)
        model.value[t] = rate * np.clip(top, low, high)
        margin += model.value[t][leaf]
    return model
