"""Gradient-boosted trees over a small grid of categorical features.

The training rows arrive already counted by grid cell, so fitting needs a few
thousand weighted cells whatever the corpus; the fitted trees are returned as
plain nested conditions that become a column expression.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass
class Tree:
    """Two levels of tests ``feature == value`` with four leaves: the root test,
    then one test on either side (None: the side is a leaf)."""

    root: tuple[int, int]
    yes: tuple[int, int] | None
    no: tuple[int, int] | None
    leaves: tuple[float, float, float, float]  # yes-yes, yes-no, no-yes, no-no


def _best(x, g, h, rows, l2):
    """The test with the largest gain among the rows, or None."""
    best, test = 1e-6, None
    gs, hs = g[rows].sum(), h[rows].sum()
    whole = gs * gs / (hs + l2)
    for f in range(x.shape[1]):
        for v in np.unique(x[rows, f]):
            m = rows & (x[:, f] == v)
            a, b = g[m].sum(), h[m].sum()
            gain = a * a / (b + l2) + (gs - a) ** 2 / (hs - b + l2) - whole
            if gain > best:
                best, test = gain, (f, int(v))
    return test


def fit(x: np.ndarray, pos: np.ndarray, neg: np.ndarray, rounds: int = 20, rate: float = 0.3,
        l2: float = 1.0) -> tuple[float, list[Tree]]:
    """Log-odds bias and trees for cells ``x`` with counts of either label."""
    weight = pos + neg
    total = max(weight.sum(), 1e-9)
    share = np.clip(pos.sum() / total, 1e-4, 1 - 1e-4)
    bias = float(np.log(share / (1 - share)))
    score, trees = np.full(len(x), bias), []
    everything = np.ones(len(x), bool)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-score))
        g, h = pos - weight * p, weight * p * (1 - p)
        root = _best(x, g, h, everything, l2)
        if root is None:
            break
        left = x[:, root[0]] == root[1]
        yes, no = _best(x, g, h, left, l2), _best(x, g, h, ~left, l2)
        leaves, step = [], np.zeros(len(x))
        for side, test in ((left, yes), (~left, no)):
            split = np.zeros(len(x), bool) if test is None else x[:, test[0]] == test[1]
            for part in (side & split, side & ~split):
                value = float(rate * g[part].sum() / (h[part].sum() + l2))
                leaves.append(value)
                step[part] = value
        trees.append(Tree(root, yes, no, tuple(leaves)))
        score = score + step
    return bias, trees


def predict(bias: float, trees: list[Tree], x: np.ndarray) -> np.ndarray:
    score = np.full(len(x), bias)
    for t in trees:
        left = x[:, t.root[0]] == t.root[1]
        a = np.zeros(len(x), bool) if t.yes is None else x[:, t.yes[0]] == t.yes[1]
        b = np.zeros(len(x), bool) if t.no is None else x[:, t.no[0]] == t.no[1]
        score += np.select([left & a, left & ~a, ~left & b], t.leaves[:3], t.leaves[3])
    return 1 / (1 + np.exp(-score))


def threshold(p: np.ndarray, pos: np.ndarray, neg: np.ndarray, precision: float) -> float:
    """The lowest score at which held-out cells reach ``precision`` from there
    upwards; above one (nothing passes) if no score does."""
    order = np.argsort(-p, kind="stable")
    hit, all_ = np.cumsum(pos[order]), np.cumsum((pos + neg)[order])
    last = np.append(p[order][1:] != p[order][:-1], True) if len(p) else np.zeros(0, bool)
    ok = np.flatnonzero(last & (all_ > 0) & (hit >= precision * all_))
    return float(p[order][ok[-1]]) if len(ok) else 2.0
