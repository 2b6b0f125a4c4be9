"""One isolation tree: growth on its sub-sample, and the path-length constant.

Nodes are numbered as in a heap: the children of ``i`` are ``2 i + 1`` and ``2 i + 2``.  Feature ``f`` is a numeric
column below ``N_NUMERIC`` and the one-hot column of slot ``f - N_NUMERIC`` from there on.  Values up to the
threshold go left.
"""

from __future__ import annotations

import math

import numpy as np

from pactlens.config import NUMERIC

N_NUMERIC = len(NUMERIC)
EULER = 0.5772156649015329


def average_path(n):
    """Expected path length of an unsuccessful search among ``n`` points."""
    n = np.asarray(n, dtype=np.float64)
    large = np.maximum(n, 3.0)
    out = 2.0 * (np.log(large - 1.0) + EULER) - 2.0 * (large - 1.0) / large
    return np.where(n <= 1, 0.0, np.where(n == 2, 1.0, out))


def depth_limit(sample_size: int) -> int:
    return math.ceil(math.log2(max(sample_size, 2)))


def grow(numbers: np.ndarray, slots: np.ndarray, limit: int, n_slots: int, max_features: float, rng) -> dict:
    """Columns of the node table of one tree, grown level by level: all nodes of a level are split at once.

    Rows are kept in the order of their nodes, so a node is a segment.  Its feature is drawn evenly from those which vary
    inside it: numeric columns with more than one value, and slots that some of its rows have and others not.
    """
    n_features = N_NUMERIC + n_slots
    allowed = np.ones(n_features, dtype=bool)
    if max_features < 1.0:
        allowed[:] = False
        allowed[rng.choice(n_features, size=max(1, int(max_features * n_features)), replace=False)] = True
    found = []

    def leaves(ids, sizes, depth):
        n = len(ids)
        found.append((ids, np.full(n, -1), np.full(n, np.nan), sizes, depth + average_path(sizes)))

    numbers, slots = np.ascontiguousarray(numbers.T), np.ascontiguousarray(slots.T)
    ids, starts = np.zeros(1, np.int64), np.zeros(1, np.int64)
    for depth in range(limit + 1):
        sizes = np.diff(np.r_[starts, numbers.shape[1]])
        if depth == limit or not len(ids):
            leaves(ids, sizes, depth)
            break
        low, high = np.minimum.reduceat(numbers, starts, axis=1), np.maximum.reduceat(numbers, starts, axis=1)
        varying = (high > low) & allowed[:N_NUMERIC, None]
        segment = np.repeat(np.arange(len(ids)), sizes)
        own, some = _varying_slots(segment, slots, sizes, n_slots, allowed)
        n_numeric = varying.sum(axis=0)
        n_own = np.bincount(own, minlength=len(ids))
        choices = n_numeric + n_own
        pick = (rng.random(len(ids)) * choices).astype(np.int64)
        share = rng.random(len(ids))
        split = choices > 0
        feature = np.full(len(ids), -1)
        threshold = np.full(len(ids), np.nan)
        is_number = split & (pick < n_numeric)
        column = (np.cumsum(varying, axis=0) > pick).argmax(axis=0)
        at = np.flatnonzero(is_number)
        feature[at] = column[at]
        bottom, top = low[column[at], at], high[column[at], at]
        cut = bottom + share[at] * (top - bottom)
        threshold[at] = np.where(cut >= top, bottom, cut)
        at = np.flatnonzero(split & ~is_number)
        first = np.cumsum(n_own) - n_own
        feature[at] = N_NUMERIC + some[first[at] + pick[at] - n_numeric[at]]
        threshold[at] = 0.5
        if not split.all():
            leaves(ids[~split], sizes[~split], depth)
        found.append((ids[split], feature[split], threshold[split], sizes[split], np.full(split.sum(), np.nan)))

        rows = np.flatnonzero(split[segment])
        segment = (np.cumsum(split) - 1)[segment[rows]]
        ids, feature, threshold, sizes = ids[split], feature[split], threshold[split], sizes[split]
        f = feature[segment]
        right = numbers[np.minimum(f, N_NUMERIC - 1), rows] > threshold[segment]
        hot = np.flatnonzero(f >= N_NUMERIC)
        wanted, has = f[hot] - N_NUMERIC, np.zeros(len(hot), dtype=bool)
        for column in slots:
            has |= column[rows[hot]] == wanted
        right[hot] = has
        child = 2 * segment + right
        # A stable sort of 16-bit numbers counts instead of comparing.
        order = rows[np.argsort(child.astype(np.uint16) if 2 * len(ids) < 1 << 16 else child, kind="stable")]
        numbers, slots = numbers.take(order, axis=1), slots.take(order, axis=1)
        sizes = np.bincount(child, minlength=2 * len(ids))
        ids = np.stack([2 * ids + 1, 2 * ids + 2], axis=1).ravel()
        starts = np.cumsum(sizes) - sizes
    columns = [np.concatenate(c) for c in zip(*found)]
    return dict(zip(("node_id", "feature", "threshold", "n_samples", "value"), columns))


def _varying_slots(segment, slots, sizes, n_slots, allowed):
    """(segment, slot) of the slots that some rows of a segment have and others not, by segment."""
    if not n_slots:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    keys = (segment * n_slots + slots)[slots >= 0]
    if len(sizes) * n_slots <= 8 * len(keys):
        table = np.bincount(keys, minlength=len(sizes) * n_slots)
        heads = np.flatnonzero(table)
        counts = table[heads]
    else:
        heads, counts = np.unique(keys, return_counts=True)
    own, some = np.divmod(heads, n_slots)
    varies = (counts < sizes[own]) & allowed[N_NUMERIC + some]
    return own[varies], some[varies]


def pack(nodes: dict) -> dict:
    """A node table as arrays for walking it: nodes by number, so that children stand side by side, and the place of the left
    one.  A leaf passes every row on to itself."""
    order = np.argsort(nodes["node_id"])
    ids, feature, threshold, value = (nodes[c][order] for c in ("node_id", "feature", "threshold", "value"))
    leaf = feature < 0
    left = np.where(leaf, np.arange(len(ids)), np.searchsorted(ids, 2 * ids + 1))
    return {
        "feature": np.where(leaf, 0, feature).astype(np.int32),
        "threshold": np.where(leaf, np.inf, threshold),
        "left": left.astype(np.int32),
        "path": np.where(leaf, value, 0.0),
    }
