"""Scores of a fitted forest: a map over Arrow batches with the trees as broadcast arrays."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from pactlens.config import IDENTIFIERS, NUMERIC
from pactlens.operators.encode import SLOTS, complete, encode
from pactlens.operators.forest.fit import Forest
from pactlens.operators.forest.tree import N_NUMERIC, average_path
from pactlens.session import materialize, spread

#: Bound on the node slots of a broadcast forest (24 bytes per pair).
MAX_NODE_SLOTS = 50_000_000
#: Rows and trees which are walked together, and a bound on the cells of one block of rows.
BLOCK_ROWS, BLOCK_TREES, BLOCK_CELLS = 1_024, 8, 1 << 20


@dataclass(frozen=True)
class Arrays:
    """Complete binary trees, one row each and numbered from 1, so that ``i`` has the children ``2 i`` and ``2 i + 1``.

    A leaf above the last level passes every row on to the left.
    """

    feature: np.ndarray
    threshold: np.ndarray
    path: np.ndarray
    depth: int
    n_slots: int

    @classmethod
    def of(cls, forest: Forest) -> Arrays:
        depth, trees = forest.depth, forest.n_trees
        size = 1 << depth
        if trees * size * 2 > MAX_NODE_SLOTS:
            raise ValueError("the forest is too large to broadcast; use fewer trees or rows per tree")
        # At most two nodes per sampled row and tree, checked above.
        nodes = forest.nodes.select("tree_id", "node_id", "feature", "threshold", "value").toPandas()
        feature = np.zeros((trees, size), dtype=np.int64)
        threshold = np.full((trees, size), np.inf)
        path = np.zeros((trees, size))
        leaf = nodes["feature"].to_numpy() < 0
        split = nodes[~leaf]
        at = (split["tree_id"].to_numpy(), split["node_id"].to_numpy() + 1)
        feature[at] = split["feature"].to_numpy()
        threshold[at] = split["threshold"].to_numpy()
        ends = nodes[leaf]
        bottom = ends["node_id"].to_numpy(dtype=np.int64, copy=True) + 1
        while (shallow := bottom < size).any():
            bottom[shallow] *= 2
        path[ends["tree_id"].to_numpy(), bottom - size] = ends["value"].to_numpy()
        return cls(feature, threshold, path, depth, forest.n_slots)

    def mean_path(self, numbers: np.ndarray, slots: np.ndarray) -> np.ndarray:
        """Mean path length per row."""
        width = N_NUMERIC + self.n_slots
        block = max(64, min(BLOCK_ROWS, BLOCK_CELLS // width))
        out = np.empty(len(numbers))
        for start in range(0, len(numbers), block):
            out[start : start + block] = self._block(numbers[start : start + block], slots[start : start + block], width)
        return out

    def _block(self, numbers, slots, width):
        """A block of rows through a few trees at a time, all of them one level down at each step."""
        n = len(numbers)
        matrix = np.zeros((n, width))
        matrix[:, :N_NUMERIC] = numbers
        row, column = np.nonzero(slots >= 0)
        matrix[row, N_NUMERIC + slots[row, column]] = 1.0
        cells = matrix.ravel()
        first = np.arange(n, dtype=np.int64) * width
        total = np.zeros(n)
        trees, size = self.feature.shape
        for start in range(0, trees, BLOCK_TREES):
            some = slice(start, start + BLOCK_TREES)
            feature, threshold, path = (a[some].ravel() for a in (self.feature, self.threshold, self.path))
            base = np.arange(0, len(feature), size)[:, None]
            node = np.repeat(base + 1, n, axis=1)
            for _ in range(self.depth):
                cell = feature.take(node)
                cell += first
                right = cells.take(cell) > threshold.take(node)
                node += node
                node -= base
                node += right
            node -= size
            for lengths in path.take(node):
                total += lengths
        return total / trees


def _mean_path_udf(forest: Forest, session):
    shared = session.sparkContext.broadcast(Arrays.of(forest))

    @F.pandas_udf(DoubleType())
    def mean_path(numbers: pd.DataFrame, slots: pd.DataFrame) -> pd.Series:
        return pd.Series(shared.value.mean_path(numbers.to_numpy(np.float64), slots.to_numpy(np.int64)))

    return mean_path(F.struct(*NUMERIC), F.struct(*SLOTS))


def score_encoded(encoded: DataFrame, forest: Forest) -> DataFrame:
    """Add ``anomaly_score`` (higher is more atypical) and ``is_anomaly``; NULL where a number is missing."""
    normal = float(average_path(forest.sample_size)) or 1.0
    path = _mean_path_udf(forest, encoded.sparkSession)
    score = F.pow(F.lit(2.0), -path / F.lit(normal)) + F.lit(forest.offset)
    return encoded.withColumn("anomaly_score", F.when(complete(), score)).withColumn(
        "is_anomaly", F.col("anomaly_score") > 0
    )


def with_scores(features: DataFrame, forest: Forest) -> DataFrame:
    """The features with score and flag, without a refit; works on batch and streaming input."""
    return score_encoded(encode(spread(features), forest.index), forest).drop(*SLOTS)


def score_contracts(features: DataFrame, forest: Forest) -> DataFrame:
    """Identifiers, score and flag, most atypical first."""
    scored = with_scores(features, forest).select(*IDENTIFIERS, "anomaly_score", "is_anomaly")
    # A sort reads its rows twice, to find ranges first; without the files every row would be scored twice.
    return materialize(scored, "scores").orderBy(F.desc_nulls_last("anomaly_score"), *IDENTIFIERS)


def scoring_summary(scored: DataFrame) -> DataFrame:
    return scored.agg(
        F.count("*").alias("total_contratos"),
        F.count_if("is_anomaly").alias("n_anomalias_detectadas"),
        F.count_if(F.col("anomaly_score").isNull()).alias("not_scored"),
    ).withColumn(
        "pct_anomalias",
        F.round(F.try_divide(100.0 * F.col("n_anomalias_detectadas"), F.col("total_contratos")), 4),
    )
