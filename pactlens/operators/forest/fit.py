"""Isolation forest: seeded sub-samples per tree, drawn in one pass, and one bounded group per tree to grow it."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pactlens.config import DEFAULTS, NUMERIC, Settings
from pactlens.functions.hashing import content_hash, mixed
from pactlens.operators.encode import SLOTS, complete, encode, fit_index
from pactlens.operators.forest import tree
from pactlens.operators.ranks import values_at_ranks
from pactlens.operators.sampling import with_margin
from pactlens.session import materialize, one_task_per_group

POINT = (*NUMERIC, *SLOTS)
#: Rows one task can hold to grow a tree; a larger sub-sample per tree is refused.
MAX_TREE_ROWS = 1 << 20
_MASK = (1 << 64) - 1
NODE_SCHEMA = "tree_id int, node_id int, feature int, threshold double, n_samples int, value double"


@dataclass(frozen=True)
class Forest:
    """A fitted model: node table and category index as tables, the rest as numbers."""

    nodes: DataFrame
    index: DataFrame
    n_trees: int
    sample_size: int
    n_slots: int
    offset: float = -0.5

    @property
    def depth(self) -> int:
        return tree.depth_limit(self.sample_size)


def resolve_samples(max_samples: int | float | str, rows: int) -> int:
    """Rows per tree: ``auto`` is 256, a float a share of all rows; never more than there are."""
    if max_samples == "auto":
        wanted = 256
    elif isinstance(max_samples, float):
        if not 0.0 < max_samples <= 1.0:
            raise ValueError("a max_samples share must be in (0, 1]")
        wanted = int(max_samples * rows)
    else:
        wanted = int(max_samples)
    size = min(wanted, rows)
    if size < 1:
        raise ValueError("no rows to fit")
    if size > MAX_TREE_ROWS:
        raise ValueError(f"{size} rows per tree exceed the {MAX_TREE_ROWS} one task may hold")
    return size


def draws(keys: np.ndarray, n_trees: int, rate: float) -> tuple[np.ndarray, np.ndarray]:
    """(row, tree): each row enters each tree with probability ``rate``, all by its key.

    A row jumps from one of its trees to the next, so the work is that of the draws made, at any rate.
    """
    rows, trees = [], []
    at, place = np.arange(len(keys)), np.full(len(keys), -1.0)
    step, scale = 0, np.log1p(-rate) if rate < 1.0 else -np.inf
    while len(at):
        step += 1
        u = ((mixed(keys[at] + np.uint64(step * 0x9E3779B97F4A7C15 & _MASK)) >> np.uint64(11)).astype(np.float64) + 1.0) * 2.0**-53
        place = place + 1.0 + np.floor(np.log(u) / scale)
        more = place < n_trees
        at, place = at[more], place[more]
        rows.append(at)
        trees.append(place.astype(np.int64))
    return np.concatenate(rows or [at]), np.concatenate(trees or [at])


def own_keys(keys: np.ndarray, task: int, batch: int) -> np.ndarray:
    """Keys under which equal rows of a batch are drawn each for itself."""
    order = np.argsort(keys, kind="stable")
    ranked = keys[order]
    again = np.flatnonzero(ranked[1:] == ranked[:-1]) + 1
    if not len(again):
        return keys
    salt = np.arange(len(again), dtype=np.uint64) + np.uint64(((task << 40) + (batch << 20)) & _MASK)
    keys = keys.copy()
    keys[order[again]] ^= mixed(salt + np.uint64(1))
    return keys


def tree_samples(encoded: DataFrame, rows: int, n_trees: int, size: int, seed: int) -> DataFrame:
    """(tree_id, _order, _key, the point's columns): candidates of every tree, slightly more than ``size`` each.

    Rows are drawn where they are read, and only drawn rows move.  A draw hashes all columns of ``encoded``, so the layout of
    the data does not change it.  Equal rows of a batch each have their own draws, hence a row that makes up a third of the
    data enters the trees as often; only their first copies in several batches share theirs, and only for them does the
    sample depend on the layout.
    """
    rate = min(1.0, with_margin(size) / rows)
    points = encoded.filter(complete()).select(content_hash(encoded.columns, seed).alias("_key"), *POINT)

    def draw(batches):
        task = TaskContext.get().partitionId()
        for number, batch in enumerate(batches):
            keys = own_keys(batch["_key"].to_numpy(np.int64).view(np.uint64), task, number)
            row, trees = draws(keys, n_trees, rate)
            drawn = batch.iloc[row]
            drawn.insert(0, "tree_id", trees.astype(np.int32))
            drawn.insert(1, "_order", mixed(mixed(keys[row] + np.uint64(1)) + trees.astype(np.uint64)).view(np.int64))
            yield drawn

    types = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in points.schema)
    return points.mapInPandas(draw, f"tree_id int, _order long, {types}")


def _first_by_order(group: pd.DataFrame, size: int) -> np.ndarray:
    """Positions of the tree's rows in a fixed order."""
    return np.lexsort((group["_key"].to_numpy(), group["_order"].to_numpy()))[:size]


def grow_trees(
    samples: DataFrame, n_trees: int, size, max_features, n_slots: int, seed: int, keys: Sequence[str] = ("tree_id",)
) -> DataFrame:
    """Node table of all trees.  ``size`` and ``max_features`` are numbers, or dicts by the first key."""
    keys = list(keys)
    prefix = "".join(f"{k} int, " for k in keys if k != "tree_id")

    def grow_one(key, group):
        key = [int(k) for k in key]
        limit_rows = size[key[0]] if isinstance(size, dict) else size
        share = max_features[key[0]] if isinstance(max_features, dict) else max_features
        rows = _first_by_order(group, limit_rows)
        rng = np.random.default_rng([seed, *key])
        nodes = tree.grow(
            group[list(NUMERIC)].to_numpy(np.float64)[rows],
            group[list(SLOTS)].to_numpy(np.int64)[rows],
            tree.depth_limit(limit_rows),
            n_slots,
            share,
            rng,
        )
        return pd.DataFrame({**dict(zip(keys, key)), **nodes})

    return one_task_per_group(samples, n_trees, *keys).groupBy(*keys).applyInPandas(grow_one, prefix + NODE_SCHEMA)


def fit_forest(features: DataFrame, settings: Settings = DEFAULTS, index: DataFrame | None = None) -> Forest:
    """Fit on a features table.  Rows with a missing number take no part."""
    index = fit_index(features, settings) if index is None else index
    n_slots = index.count()
    rows = features.filter(complete()).count()
    size = resolve_samples(settings.max_samples, rows)
    samples = tree_samples(encode(features, index), rows, settings.n_trees, size, settings.seed)
    nodes = materialize(grow_trees(samples, settings.n_trees, size, settings.max_features, n_slots, settings.seed), "forest-nodes")
    forest = Forest(nodes, index, settings.n_trees, size, n_slots)
    if settings.contamination == "auto":
        return forest
    return with_contamination(forest, features, float(settings.contamination))


def with_contamination(forest: Forest, features: DataFrame, share: float) -> Forest:
    """Move the cut so that this share of the fitted rows lies above it (linear interpolation between ranks)."""
    from pactlens.operators.forest.score import with_scores

    if not 0.0 < share <= 0.5:
        raise ValueError("contamination must be in (0, 0.5]")
    scored = with_scores(features, replace(forest, offset=0.0)).select("anomaly_score")
    scores = materialize(scored.filter(F.col("anomaly_score").isNotNull()), "training-scores")
    n = scores.count()
    position = (n - 1) * (1.0 - share)
    below = int(position)
    (low, _, _), (high, _, _) = values_at_ranks(scores, F.col("anomaly_score"), [below + 1, min(below + 2, n)])
    return replace(forest, offset=-(low + (position - below) * (high - low)))
