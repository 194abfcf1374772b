"""Gradient-boosted trees over small whole-number features: fitted on counts, scored as a column."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass
class Boosted:
    """Log-odds are ``bias`` plus one leaf per tree; a tree is a leaf or (feature, limit, left, right),
    left where the feature is at most the limit."""

    bias: float = 0.0
    trees: list = field(default_factory=list)

    def logits(self, rows: np.ndarray) -> np.ndarray:
        total = np.full(len(rows), self.bias)
        for tree in self.trees:
            total += _values(tree, rows)
        return total

    def score(self, features: Column) -> Column:
        """Probability as a column; ``features`` is an array<int> column."""
        total = F.lit(self.bias)
        for tree in self.trees:
            total = total + _column(tree, features)
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-total))


def _values(tree, rows: np.ndarray) -> np.ndarray:
    if isinstance(tree, float):
        return np.full(len(rows), tree)
    feature, limit, left, right = tree
    return np.where(rows[:, feature] <= limit, _values(left, rows), _values(right, rows))


def _column(tree, features: Column) -> Column:
    if isinstance(tree, float):
        return F.lit(tree)
    feature, limit, left, right = tree
    return F.when(features[feature] <= limit, _column(left, features)).otherwise(_column(right, features))


def fit(
    rows: Sequence[Sequence[int]],
    positive: Sequence[float],
    negative: Sequence[float],
    rounds: int = 24,
    depth: int = 3,
    rate: float = 0.3,
    penalty: float = 1.0,
) -> Boosted:
    """Newton boosting of the logistic loss. ``rows`` are distinct feature vectors, each with the
    weight of its positive and negative cases; without both kinds the model is a constant."""
    x = np.array(rows, np.int64).reshape(len(rows), -1)
    up, down = np.array(positive, float), np.array(negative, float)
    total_up, total_down = up.sum() + 1.0, down.sum() + 1.0
    model = Boosted(math.log(total_up / total_down))
    if not up.sum() or not down.sum():
        return model

    def grow(members: np.ndarray, slope: np.ndarray, curve: np.ndarray, left: int):
        g, h = slope[members].sum(), curve[members].sum()
        best, least = None, 1e-6
        for feature in range(x.shape[1]) if left else ():
            values = x[members, feature]
            low = values.min()
            gs, hs = (np.bincount(values - low, w[members]).cumsum()[:-1] for w in (slope, curve))
            gain = gs**2 / (hs + penalty) + (g - gs) ** 2 / (h - hs + penalty) - g**2 / (h + penalty)
            if len(gain) and gain.max() > least:
                best, least = (feature, int(low + gain.argmax())), gain.max()
        if best is None:
            return float(rate * g / (h + penalty))
        inside = x[members, best[0]] <= best[1]
        return (*best, grow(members[inside], slope, curve, left - 1), grow(members[~inside], slope, curve, left - 1))

    for _ in range(rounds):
        p = 1.0 / (1.0 + np.exp(-model.logits(x)))
        model.trees.append(grow(np.arange(len(x)), up - (up + down) * p, (up + down) * p * (1 - p), depth))
    return model
