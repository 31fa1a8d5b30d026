"""Gradient-boosted regression trees for a probability, in numpy."""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np

ROUNDS = 60
DEPTH = 4
RATE = 0.2
LEAF_WEIGHT = 1.0  # ridge on leaf values
LEAST_CURVE = 1.0  # of the second derivatives in a leaf
CUTS = 32


@dataclass
class Trees:
    """Complete trees: inner node ``i`` sends a row to ``2 i + 1`` if its feature is at most the cut, else to ``2 i + 2``."""

    base: float = 0.0
    features: list[np.ndarray] = field(default_factory=list)
    cuts: list[np.ndarray] = field(default_factory=list)
    leaves: list[np.ndarray] = field(default_factory=list)

    def raw(self, rows: np.ndarray) -> np.ndarray:
        total = np.full(len(rows), self.base)
        each = np.arange(len(rows))
        for feature, cut, leaf in zip(self.features, self.cuts, self.leaves):
            node = np.zeros(len(rows), np.int64)
            for _ in range(DEPTH):
                node = 2 * node + 1 + (rows[each, feature[node]] > cut[node])
            total += leaf[node - len(feature)]
        return total

    def probability(self, rows: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.raw(rows), -40, 40)))


def best_split(rows, slope, curve, choices):
    """Feature and cut with the largest gain in the logistic loss."""
    total_slope, total_curve = slope.sum(), curve.sum()
    best = (1e-9, 0, np.inf)
    for feature, cuts in enumerate(choices):
        if not len(cuts):
            continue
        place = np.searchsorted(cuts, rows[:, feature], side="left")
        left_slope = np.cumsum(np.bincount(place, weights=slope, minlength=len(cuts) + 1))[:-1]
        left_curve = np.cumsum(np.bincount(place, weights=curve, minlength=len(cuts) + 1))[:-1]
        right_slope, right_curve = total_slope - left_slope, total_curve - left_curve
        gain = left_slope**2 / (left_curve + LEAF_WEIGHT) + right_slope**2 / (right_curve + LEAF_WEIGHT)
        gain -= total_slope**2 / (total_curve + LEAF_WEIGHT)
        gain[(left_curve < LEAST_CURVE) | (right_curve < LEAST_CURVE)] = 0
        at = int(gain.argmax())
        if gain[at] > best[0]:
            best = (gain[at], feature, cuts[at])
    return best[1], best[2]


def train(rows: np.ndarray, labels: np.ndarray) -> Trees:
    share = np.clip(labels.mean() if len(labels) else 0.5, 1e-3, 1 - 1e-3)
    trees = Trees(float(np.log(share / (1 - share))))
    if not len(labels):
        return trees
    choices = []
    for column in rows.T:
        values = np.unique(column)
        middle = (values[1:] + values[:-1]) / 2
        choices.append(middle if len(middle) <= CUTS else np.unique(np.quantile(middle, np.linspace(0, 1, CUTS))))
    for _ in range(ROUNDS):
        guess = trees.probability(rows)
        slope, curve = guess - labels, guess * (1 - guess)
        inner = 2**DEPTH - 1
        feature, cut = np.zeros(inner, np.int64), np.full(inner, np.inf)
        node = np.zeros(len(rows), np.int64)
        for i in range(inner):
            own = node == i
            if own.any():
                feature[i], cut[i] = best_split(rows[own], slope[own], curve[own], choices)
                node[own] = 2 * i + 1 + (rows[own, feature[i]] > cut[i])
        leaf = np.zeros(inner + 1)
        for i in range(inner + 1):
            own = node == inner + i
            leaf[i] = -RATE * slope[own].sum() / (curve[own].sum() + LEAF_WEIGHT)
        trees.features.append(feature)
        trees.cuts.append(cut)
        trees.leaves.append(leaf)
    return trees


def threshold_for(probabilities: np.ndarray, labels: np.ndarray, precision: float) -> float:
    """The lowest threshold at and above which at least this share of the rows is labelled 1; above 1 if there is none."""
    order = np.argsort(-probabilities, kind="stable")
    right = np.cumsum(labels[order]) / np.arange(1, len(order) + 1)
    last = np.append(probabilities[order][1:] < probabilities[order][:-1], True)  # equal ones go together
    good = np.flatnonzero((right >= precision) & last) if len(order) else []
    return float(probabilities[order][good[-1]]) if len(good) else 2.0
