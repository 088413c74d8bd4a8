"""Gradient-boosted trees for a few classes, on binned features (softmax loss, exact on the bins)."""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np


@dataclass
class Model:
    classes: tuple[str, ...]
    base: np.ndarray
    trees: list[list[tuple]] = field(default_factory=list)  # per round, a tree per class
    temperature: float = 1.0
    shift: np.ndarray | float = 0.0  # added to the scores: what the sample's shares leave out
    thresholds: np.ndarray | None = None  # the probability that each class but the first needs

    def scores(self, x: np.ndarray) -> np.ndarray:
        out = np.tile(self.base, (len(x), 1))
        for round_ in self.trees:
            for k, tree in enumerate(round_):
                out[:, k] += _walk(tree, x)
        return out

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        return _softmax((self.scores(x) + self.shift) / self.temperature)

    def decided(self, p: np.ndarray) -> np.ndarray:
        """The class of each row of probabilities: the likeliest of those that reach their threshold, else the first."""
        if not len(p):
            return np.zeros(0, int)
        if self.thresholds is None:
            return p.argmax(axis=1)
        reached = np.where(p >= self.thresholds, p, -1.0)
        reached[:, 0] = 0.0
        return reached.argmax(axis=1)


def prior_shift(counts: np.ndarray) -> np.ndarray:
    """Score shift of classes that were trained in equal shares but occur `counts` times; unseen ones count as one."""
    seen = np.maximum(counts, 1)
    return np.log(seen / seen.sum()) - np.log(1 / len(seen))


def _softmax(s: np.ndarray) -> np.ndarray:
    e = np.exp(s - s.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def _walk(tree: tuple, x: np.ndarray) -> np.ndarray:
    feature, cut, left, right, value = tree
    at = np.zeros(len(x), np.int64)
    while True:
        f = feature[at]
        inner = f >= 0
        if not inner.any():
            return value[at]
        go = x[np.arange(len(x)), np.maximum(f, 0)] <= cut[at]
        at = np.where(inner, np.where(go, left[at], right[at]), at)


def _grow(binned: np.ndarray, edges: list[np.ndarray], g: np.ndarray, h: np.ndarray, depth: int, rate: float, least: int) -> tuple:
    """One regression tree on gradients; cuts lie midway between neighbouring values."""
    feature, cut, left, right, value = [], [], [], [], []

    def node(rows: np.ndarray, d: int) -> int:
        i = len(feature)
        gs, hs = g[rows].sum(), h[rows].sum()
        for a, v in ((feature, -1), (cut, 0.0), (left, 0), (right, 0), (value, -rate * gs / (hs + 1.0))):
            a.append(v)
        if d == 0 or len(rows) < 2 * least:
            return i
        best = (1e-6, -1, -1)
        for f, e in enumerate(edges):
            if not len(e):
                continue
            b = binned[rows, f]
            n = len(e) + 1
            cg, ch, cn = (np.cumsum(np.bincount(b, weights=w, minlength=n))[:-1] for w in (g[rows], h[rows], np.ones(len(rows))))
            gain = cg**2 / (ch + 1) + (gs - cg) ** 2 / (hs - ch + 1) - gs**2 / (hs + 1)
            gain[(cn < least) | (len(rows) - cn < least)] = -1
            k = int(gain.argmax())
            if gain[k] > best[0]:
                best = (gain[k], f, k)
        if best[1] < 0:
            return i
        f, k = best[1], best[2]
        go = binned[rows, f] <= k
        feature[i], cut[i] = f, float(edges[f][k])
        left[i] = node(rows[go], d - 1)
        right[i] = node(rows[~go], d - 1)
        return i

    node(np.arange(len(g)), depth)
    return tuple(np.array(a) for a in (feature, cut, left, right, value))


def train(x: np.ndarray, y: np.ndarray, classes: tuple[str, ...], rounds: int = 30, depth: int = 3, rate: float = 0.3, bins: int = 48, least: int = 5) -> Model:
    """y: class numbers.  An empty training set gives a model of equal scores."""
    model = Model(classes, np.zeros(len(classes)))
    if not len(x):
        return model
    edges = []
    for f in range(x.shape[1]):
        v = np.unique(x[:, f])
        mid = (v[1:] + v[:-1]) / 2
        edges.append(np.unique(np.quantile(mid, np.linspace(0, 1, bins))) if len(mid) > bins else mid)
    binned = np.stack([np.searchsorted(e, x[:, f], side="left") for f, e in enumerate(edges)], axis=1)
    onehot = np.eye(len(classes))[y]
    weight = 1 / np.maximum(onehot.sum(axis=0), 1)
    w = weight[y] / weight[y].mean()
    score = np.tile(model.base, (len(x), 1))
    for _ in range(rounds):
        p = _softmax(score)
        grown = []
        for k in range(len(classes)):
            g, h = w * (p[:, k] - onehot[:, k]), w * np.maximum(p[:, k] * (1 - p[:, k]), 1e-3)
            tree = _grow(binned, edges, g, h, depth, rate, least)
            score[:, k] += _walk(tree, x)
            grown.append(tree)
        model.trees.append(grown)
    return model


def calibrate(model: Model, x: np.ndarray, y: np.ndarray) -> Model:
    """Set the temperature that fits a checked holdout best, and for each class but the first the threshold with the best F1 there (ties: nearest to 1/2)."""
    if len(x):
        s = model.scores(x) + model.shift
        grid = np.geomspace(0.25, 8, 41)
        loss = [-np.log(_softmax(s / t)[np.arange(len(y)), y] + 1e-12).mean() for t in grid]
        model.temperature = float(grid[int(np.argmin(loss))])
        p = model.probabilities(x)
        cuts = np.arange(0.1, 0.95, 0.05)
        model.thresholds = np.zeros(len(model.classes))
        for k in range(1, len(model.classes)):
            hit = p[:, k, None] >= cuts
            good, bad, lost = (hit & (y == k)[:, None]).sum(0), (hit & (y != k)[:, None]).sum(0), (~hit & (y == k)[:, None]).sum(0)
            f1 = 2 * good / np.maximum(2 * good + bad + lost, 1)
            best = np.nonzero(f1 >= f1.max() - 1e-12)[0]
            model.thresholds[k] = cuts[best[np.argmin(np.abs(cuts[best] - 0.5))]]
    return model
