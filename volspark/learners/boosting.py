"""Boosted regression trees on one bounded table of numbers, for use inside a task.

Squared error, second-order gains, equal-frequency bins, level-wise trees. Gradients
are held as whole multiples of a power of two, so histogram sums are exact whatever
the order of the rows; with row sampling decided by a formula on the row number, a
model depends on its training rows only. ``spread`` fits the same model as Spark
aggregates, for series too long for a task.
"""

from __future__ import annotations

import json
import math
from dataclasses import dataclass

import numpy as np


@dataclass(frozen=True)
class BoostParams:
    """Settings of a fit; the defaults are those of the study."""

    trees: int = 100
    depth: int = 3
    learning_rate: float = 0.05
    subsample: float = 0.8
    seed: int = 42
    reg_lambda: float = 1.0
    min_child_rows: int = 1
    min_gain: float = 1e-6
    max_bins: int = 256


# Row sampling: arithmetic modulo this prime, on numbers whose products fit 64 bits.
PRIME = 2**31 - 1
ROW_FACTOR, TREE_FACTOR, SEED_FACTOR, TREE_SHIFT = 48_271, 1_566_083_941, 69_621, 630_360_016


def power_of_two(x: float, bits: int) -> float:
    """The power of two that ``x`` is ``2**bits`` to ``2**(bits + 1)`` times as large as."""
    return 2.0 ** (math.frexp(x)[1] - 1 - bits) if x > 0 else 1.0


def bin_edges(x: np.ndarray, max_bins: int) -> np.ndarray:
    """Borders of about equally filled bins, by rank; a value on a border is in the upper bin."""
    values, counts = np.unique(x, return_counts=True)
    level = np.cumsum(counts) * max_bins // len(x)
    # A border lies between a value at which the level rose and the next one.
    rose = np.flatnonzero(np.diff(level, prepend=0) > 0)
    return values[rose[rose < len(values) - 1] + 1]


def sampled(row_idx: np.ndarray, tree: int, params: BoostParams) -> np.ndarray:
    """Which rows a tree is grown on: a fixed pseudo-random share."""
    if params.subsample >= 1:
        return np.ones(len(row_idx), bool)
    shift = (tree * TREE_FACTOR + params.seed * SEED_FACTOR) % PRIME
    v = (row_idx % PRIME * ROW_FACTOR + shift) % PRIME
    square = v * v % PRIME
    fifth = square * square % PRIME * v % PRIME
    draw = (fifth + tree * TREE_SHIFT) % PRIME
    return draw < int(params.subsample * PRIME)


@dataclass
class Tree:
    """Nodes in heap order: the children of i are 2i+1 and 2i+2; feature -1 is a leaf."""

    feature: np.ndarray
    threshold: np.ndarray
    value: np.ndarray
    gain: np.ndarray

    @classmethod
    def empty(cls, depth: int) -> Tree:
        size = 2 ** (depth + 1) - 1
        return cls(np.full(size, -1), np.zeros(size), np.zeros(size), np.zeros(size))

    def leaf_of(self, x: np.ndarray) -> np.ndarray:
        node = np.zeros(len(x), int)
        rows = np.arange(len(x))
        for _ in range(int(math.log2(len(self.feature) + 1)) - 1):
            split = self.feature[node]
            right = x[rows, np.maximum(split, 0)] >= self.threshold[node]
            node = np.where(split >= 0, 2 * node + 1 + right, node)
        return node


@dataclass
class Model:
    """A fitted sum of trees."""

    columns: list[str]
    base: float
    trees: list[Tree]

    def predict(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.base)
        for tree in self.trees:
            total = total + tree.value[tree.leaf_of(x)]
        return total

    def importances(self) -> dict[str, float]:
        """Mean gain of the splits on each feature, scaled to sum to one."""
        feature = np.concatenate([t.feature for t in self.trees] or [np.array([], int)])
        gain = np.concatenate([t.gain for t in self.trees] or [np.array([])])
        used = feature >= 0
        size = len(self.columns)
        total = np.bincount(feature[used], gain[used], size)
        mean = total / np.maximum(np.bincount(feature[used], minlength=size), 1)
        scale = mean.sum()
        share = mean / scale if scale > 0 else mean
        return dict(zip(self.columns, share.tolist()))

    def to_json(self) -> str:
        trees = [
            {
                "feature": t.feature.tolist(),
                "threshold": t.threshold.tolist(),
                "value": t.value.tolist(),
                "gain": t.gain.tolist(),
            }
            for t in self.trees
        ]
        return json.dumps({"columns": self.columns, "base": self.base, "trees": trees})

    @classmethod
    def from_json(cls, text: str) -> Model:
        stored = json.loads(text)
        trees = [
            Tree(
                np.array(t["feature"], int),
                np.array(t["threshold"], float),
                np.array(t["value"], float),
                np.array(t["gain"], float),
            )
            for t in stored["trees"]
        ]
        return cls(stored["columns"], stored["base"], trees)


def best_splits(grads, rows, unit, params):
    """For each node the best (gain, feature, bin) over histograms (node, feature, bin)."""
    lam = params.reg_lambda
    left, left_rows = np.cumsum(grads, axis=2), np.cumsum(rows, axis=2)
    left *= unit
    total, total_rows = left[:, :1, -1:], left_rows[:, :1, -1:]
    parent = total * total / (total_rows + lam)
    right, right_rows = total - left, total_rows - left_rows
    left *= left
    left /= left_rows + lam
    right *= right
    right /= right_rows + lam
    gain = left
    gain += right
    gain -= parent
    # A split that leaves one side empty gains nothing and needs no rule of its own.
    if params.min_child_rows > 1:
        gain[np.minimum(left_rows, right_rows) < params.min_child_rows] = -np.inf
    flat = gain.reshape(len(gain), -1)
    best = flat.argmax(axis=1)
    return flat[np.arange(len(flat)), best], *np.divmod(best, gain.shape[2])


def _histograms(codes, grad, node, count, size):
    """Gradient sums and row counts by (node, feature, bin); a feature at a time fits the cache."""
    start, cells = node * size, count * size
    sums, rows = np.empty((count, len(codes), size)), np.empty((count, len(codes), size))
    for f, code in enumerate(codes):
        index = start + code
        sums[:, f] = np.bincount(index, grad, cells).reshape(count, size)
        rows[:, f] = np.bincount(index, minlength=cells).reshape(count, size)
    return sums, rows


def _by_smaller_child(codes, at, grads, place, rows, above, size):
    """The same from the histograms of the level above: only smaller children are counted.

    The larger one is its parent less the smaller, exactly, as gradients are whole numbers.
    """
    count = len(rows)
    small = np.arange(0, count, 2) + (rows[1::2] < rows[::2])
    slot = np.full(count, -1)
    slot[small] = np.arange(count // 2)
    taken = slot[place] >= 0
    own = _histograms(codes[:, at[taken]], grads[taken], slot[place[taken]], count // 2, size)
    # a node that was not split has no children: it leaves no rows to subtract from
    split = (rows[::2] + rows[1::2] > 0)[:, None, None]
    found = []
    for mine, parent in zip(own, above):
        whole = np.empty((count, *mine.shape[1:]))
        whole[small], whole[small ^ 1] = mine, np.where(split, parent - mine, 0.0)
        found.append(whole)
    return tuple(found)


def fit(
    x: np.ndarray, y: np.ndarray, row_idx: np.ndarray, columns: list[str], params: BoostParams
) -> Model:
    """Fit on rows that all lie in this task."""
    n, width = x.shape
    y_unit = power_of_two(float(np.abs(y).max()), 30)
    base = int(np.rint(y / y_unit).astype(np.int64).sum()) * y_unit / n
    unit = power_of_two(max(abs(float(y.max()) - base), abs(float(y.min()) - base)), 29)

    edges = [bin_edges(x[:, f], params.max_bins) for f in range(width)]
    size = max(map(len, edges)) + 1
    codes = np.stack([np.searchsorted(e, x[:, f], side="right") for f, e in enumerate(edges)])

    predicted = np.full(n, base)
    trees = []
    for t in range(params.trees):
        grad = np.rint((predicted - y) / unit)
        keep = np.flatnonzero(sampled(row_idx, t, params))
        kept_grad, kept_codes = grad[keep], codes[:, keep]
        tree = Tree.empty(params.depth)
        split_bin = np.zeros(len(tree.feature), int)
        node, at = np.zeros(len(keep), int), np.arange(len(keep))
        above = None
        for level in range(params.depth + 1):
            # ``at`` are the rows still on their way down, ``place`` their node in the level.
            first, count = 2**level - 1, 2**level
            place, grads = node[at] - first, kept_grad[at]
            total = np.bincount(place, grads, count) * unit
            rows = np.bincount(place, minlength=count)
            tree.value[first : first + count] = np.where(
                rows > 0, -total / (rows + params.reg_lambda) * params.learning_rate, 0.0
            )
            if level == params.depth or not len(at):
                break
            if above is None:
                down = kept_codes if len(at) == len(keep) else kept_codes[:, at]
                found = _histograms(down, grads, place, count, size)
            else:
                found = _by_smaller_child(kept_codes, at, grads, place, rows, above, size)
            above = found
            gain, feature, cut = best_splits(*found, unit, params)
            for i in np.flatnonzero(gain > params.min_gain):
                f = feature[i]
                tree.feature[first + i], split_bin[first + i] = f, cut[i]
                tree.threshold[first + i], tree.gain[first + i] = edges[f][cut[i]], gain[i]
            at = at[tree.feature[node[at]] >= 0]
            here = node[at]
            node[at] = 2 * here + 1 + (kept_codes[tree.feature[here], at] > split_bin[here])
        tree.value[tree.feature >= 0] = 0.0
        predicted = predicted + tree.value[tree.leaf_of(x)]
        trees.append(tree)
    return Model(columns, base, trees)
