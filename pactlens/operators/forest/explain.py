"""Attribution of the mean path length to features: exact path-dependent Shapley values, tree by tree."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from math import factorial

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pactlens.config import CATEGORICAL, DEFAULTS, IDENTIFIERS, NUMERIC, Settings
from pactlens.functions.hashing import content_hash
from pactlens.operators.encode import SLOTS, encode, feature_names
from pactlens.operators.forest.fit import Forest
from pactlens.operators.forest.score import MAX_NODE_SLOTS
from pactlens.operators.forest.tree import N_NUMERIC
from pactlens.operators.sampling import most_atypical, sample_rows
from pactlens.session import deal, materialize

#: Bound on the values (rows x features) a task works on at a time.
MAX_CELLS = 1 << 22
#: Rows that are looked up together, and answers that a table of leaves is made for.
BLOCK_ROWS, TABLE_BITS = 16_384, 10
#: Forests of deeper trees are explained leaf by leaf.
MAX_DEPTH = 12


@dataclass
class _Leaf:
    value: float
    features: list[int]
    #: Per feature of the path: share of the tree's rows it lets through, and whether each explained row passes.
    shares: list[float]
    passes: list[np.ndarray]


def _leaves(nodes: dict[int, tuple], goes_right: dict[int, np.ndarray], n_rows: int) -> list[_Leaf]:
    leaves = []
    stack = [(0, {})]
    while stack:
        node, path = stack.pop()
        feature, _, size, value = nodes[node]
        if feature < 0:
            leaves.append(_Leaf(value, list(path), [p[0] for p in path.values()], [p[1] for p in path.values()]))
            continue
        for child, taken in ((2 * node + 1, ~goes_right[node]), (2 * node + 2, goes_right[node])):
            share, passed = path.get(feature, (1.0, np.ones(n_rows, dtype=bool)))
            stack.append((child, {**path, feature: (share * nodes[child][2] / size, passed & taken)}))
    return leaves


def _leaf_attribution(leaf: _Leaf, phi: np.ndarray) -> None:
    """Add the Shapley values of one leaf: a player multiplies by 'passes' when present and by its share when not.

    Rows that pass the same features have the same values, so these are found once for each set that occurs.
    ``sums[i, s]`` is the sum, over coalitions of ``s`` players other than ``i``, of the product of all factors.
    """
    k = len(leaf.features)
    weights = np.array([factorial(s) * factorial(k - 1 - s) / factorial(k) for s in range(k)])
    code = np.zeros(len(phi), np.int64)
    for j, passed in enumerate(leaf.passes):
        code |= passed.astype(np.int64) << j
    sets, place = np.unique(code, return_inverse=True)
    shares = np.array(leaf.shares)
    passes = (sets >> np.arange(k)[:, None] & 1).astype(np.float64)
    sums = np.zeros((k, k, len(sets)))
    sums[:, 0] = 1.0
    for j in range(k):
        joined = sums * shares[j]
        joined[:, 1:] += sums[:, :-1] * passes[j]
        joined[j] = sums[j]
        sums = joined
    value = np.einsum("s,isr->ir", weights, sums) * (passes - shares[:, None]) * leaf.value
    phi[:, leaf.features] += value.T[place]


def explain_tree(tree: pd.DataFrame, numbers: np.ndarray, slots: np.ndarray, width: int) -> np.ndarray:
    """Attributions (rows x features) of one tree; they add up to its path length minus the expected one."""
    nodes = {
        n: (f, t, size, v)
        for n, f, t, size, v in zip(tree["node_id"], tree["feature"], tree["threshold"], tree["n_samples"], tree["value"])
    }
    goes_right = {}
    for node, (feature, threshold, _, _) in nodes.items():
        if feature >= N_NUMERIC:
            goes_right[node] = (slots == feature - N_NUMERIC).any(axis=1)
        elif feature >= 0:
            goes_right[node] = numbers[:, feature] > threshold
    phi = np.zeros((len(numbers), width))
    for leaf in _leaves(nodes, goes_right, len(numbers)):
        if leaf.features:
            _leaf_attribution(leaf, phi)
    return phi


@dataclass(frozen=True)
class _Group:
    """Leaves next to each other whose paths ask few questions together: ``questions`` number them, first bit first, and the
    first ``n_path`` are those above all of the leaves."""

    questions: tuple[int, ...]
    n_path: int
    leaves: slice
    features: np.ndarray
    #: Per leaf and feature of its path: the bits that are asked, their answers if a row passes, the place in ``features``.
    mask: np.ndarray
    wanted: np.ndarray
    place: np.ndarray


@dataclass(frozen=True)
class _Plan:
    """A tree for looking up attributions; a path of fewer features than ``shares`` has columns is filled up with ones."""

    questions: list[tuple[int, float]]
    values: np.ndarray
    shares: np.ndarray
    groups: list[_Group]

    def leaf_tables(self) -> np.ndarray:
        """(leaf, feature of the path, features passed as a binary number): Shapley values, a feature multiplying by 'passes'
        when present and by its share when not.

        The sum over coalitions is the integral, from 0 to 1, of the product of the others at ``share (1 - y) + passes y``, a
        polynomial for which Gauss' rule is exact.
        """
        n, k = self.shares.shape
        y, weight = np.polynomial.legendre.leggauss(max(1, (k + 1) // 2))
        y, weight = (y + 1) / 2, weight / 2
        passes = np.array([0.0, 1.0])
        factor = self.shares[:, :, None, None] * (1 - y[:, None]) + passes * y[:, None]
        product = (weight * self.values[:, None])[:, :, None]
        for j in range(k):
            product = (factor[:, j, :, :, None] * product[:, :, None, :]).reshape(n, len(y), -1)
        out = np.empty((n, k, 1 << k))
        for j in range(k):
            own = (passes - self.shares[:, j, None])[:, None] / factor[:, j]
            parts = product.reshape(n, len(y), -1, 2, 1 << j)
            out[:, j] = np.einsum("nyapb,nyp->napb", parts, own).reshape(n, -1)
        return out

    def tables(self) -> list[np.ndarray]:
        """For each group (feature, answers as a binary number): the sum over its leaves."""
        by_leaf = self.leaf_tables()
        out = []
        for group in self.groups:
            answers = np.arange(1 << len(group.questions))
            passed = np.zeros((len(group.mask), len(answers)), np.int64)
            for j in range(group.mask.shape[1]):
                passed |= ((answers & group.mask[:, j, None]) == group.wanted[:, j, None]).astype(np.int64) << j
            # The last line takes what is filled up.
            table = np.zeros((len(group.features) + 1, len(answers)))
            for own, code, place in zip(by_leaf[group.leaves], passed, group.place):
                table[place] += own.take(code, axis=1)
            out.append(table)
        return out


def _plan(tree: pd.DataFrame, bits: int) -> _Plan:
    nodes = {
        n: (int(f), t, size, v)
        for n, f, t, size, v in zip(*(tree[c].tolist() for c in ("node_id", "feature", "threshold", "n_samples", "value")))
    }
    questions: dict[tuple[int, float], int] = {}
    asked: dict[int, tuple[int, ...]] = {}

    def below(node):
        """The questions of the nodes from this one on."""
        if node not in asked:
            feature, threshold, _, _ = nodes[node]
            if feature < 0:
                asked[node] = ()
            else:
                key = (feature, threshold if feature < N_NUMERIC else 0.5)
                own = questions.setdefault(key, len(questions))
                asked[node] = tuple(dict.fromkeys((own, *below(2 * node + 1), *below(2 * node + 2))))
        return asked[node]

    groups, leaves = [], []
    # A node, the questions above it with their answers, and the share of each feature among them.
    stack = [(0, {}, {})]
    while stack:
        node, path, shares = stack.pop()
        feature, _, size, value = nodes[node]
        more = [q for q in below(node) if q not in path]
        if len(path) + len(more) <= bits:
            groups.append(((*path, *more), len(path), node, path, shares))
            continue
        own = below(node)[0]
        for child, answer in ((2 * node + 2, 1), (2 * node + 1, 0)):
            share = shares.get(feature, 1.0) * nodes[child][2] / size
            stack.append((child, {**path, own: answer}, {**shares, feature: share}))
    found = []
    feature_of = {q: feature for (feature, _), q in questions.items()}
    for order, n_path, top, path, shares in groups:
        bit = {q: 1 << (len(order) - 1 - k) for k, q in enumerate(order)}
        inside, first = [(top, path, shares)], len(leaves)
        while inside:
            node, path, shares = inside.pop()
            feature, _, size, value = nodes[node]
            if feature >= 0:
                for child, answer in ((2 * node + 2, 1), (2 * node + 1, 0)):
                    share = shares.get(feature, 1.0) * nodes[child][2] / size
                    inside.append((child, {**path, below(node)[0]: answer}, {**shares, feature: share}))
                continue
            mask, wanted = dict.fromkeys(shares, 0), dict.fromkeys(shares, 0)
            for q, answer in path.items():
                mask[feature_of[q]] |= bit[q]
                wanted[feature_of[q]] |= bit[q] * answer
            leaves.append((value, shares, mask, wanted))
        if len(order):
            found.append((order, n_path, slice(first, len(leaves))))
    widest = max(len(shares) for _, shares, _, _ in leaves)

    def filled(dicts, fill):
        return np.array([[*d.values(), *[fill] * (widest - len(d))] for d in dicts])

    out = []
    for order, n_path, some in found:
        _, shares, mask, wanted = zip(*leaves[some])
        features = sorted(set().union(*shares))
        place = [dict.fromkeys(s) and {f: features.index(f) for f in s} for s in shares]
        out.append(_Group(order, n_path, some, np.array(features), filled(mask, 0), filled(wanted, 0), filled(place, len(features))))
    return _Plan(list(questions), np.array([v for v, *_ in leaves]), filled([x[1] for x in leaves], 1.0), out)


def _explain_block(plans: list[_Plan], numbers: np.ndarray, slots: np.ndarray, width: int) -> np.ndarray:
    """Attributions (features x rows), added up over the trees."""
    n = len(numbers)
    phi = np.zeros((width, n))
    columns = np.ascontiguousarray(numbers.T)
    used = sorted({f - N_NUMERIC for plan in plans for f, _ in plan.questions if f >= N_NUMERIC})
    hot = np.zeros((len(used), n), np.uint16)
    for column in slots.T:
        place = np.searchsorted(used, column)
        has = np.flatnonzero(np.r_[used, -2][place] == column)
        hot[place[has], has] = 1
    line = {s + N_NUMERIC: k for k, s in enumerate(used)}
    size = min(n, BLOCK_ROWS)
    most = max((len(plan.questions) for plan in plans), default=0)
    numeric, prefix = np.empty((most, size), np.uint16), np.empty((MAX_DEPTH + 1, size), np.uint16)
    above, codes, places, found = np.empty(size, bool), np.empty(size, np.uint16), np.empty(size, np.int64), np.empty(size)
    for plan in plans:
        tables = plan.tables()
        for start in range(0, n, BLOCK_ROWS):
            end = min(n, start + BLOCK_ROWS)
            m = end - start
            answers = []
            for k, (feature, threshold) in enumerate(plan.questions):
                if feature < N_NUMERIC:
                    np.greater(columns[feature, start:end], threshold, out=above[:m])
                    np.copyto(numeric[k, :m], above[:m])
                answers.append(numeric[k, :m] if feature < N_NUMERIC else hot[line[feature], start:end])
            code, place, value = codes[:m], places[:m], found[:m]
            prefix[0, :m] = 0
            path: tuple[int, ...] = ()
            for group, table in zip(plan.groups, tables):
                # Neighbours share what is above them.
                own = group.questions[: group.n_path]
                same = next((k for k, (a, b) in enumerate(zip(path, own)) if a != b), min(len(path), len(own)))
                for k in range(same, len(own)):
                    np.left_shift(prefix[k, :m], 1, out=prefix[k + 1, :m])
                    prefix[k + 1, :m] |= answers[own[k]]
                path = own
                code[:] = prefix[len(own), :m]
                for q in group.questions[group.n_path :]:
                    code <<= 1
                    code |= answers[q]
                place[:] = code
                for feature, values in zip(group.features, table):
                    values.take(place, out=value, mode="clip")
                    phi[feature, start:end] += value
    return phi


def pick_examples(scored: DataFrame, n: int, seed: int) -> DataFrame:
    """The ``n`` most atypical rows and up to ``n`` other rows which are not flagged."""
    columns = scored.columns
    # Whole rows are told apart, by a hash for which NULLs are equal: others of the same ids stay.
    hashed = scored.withColumn("_row", content_hash(columns))
    top = materialize(most_atypical(hashed, n), "examples-top")
    rest = hashed.filter(~F.col("is_anomaly")).join(F.broadcast(top.select("_row").distinct()), "_row", "left_anti")
    normal = sample_rows(rest.select(*columns), n, seed)
    top = top.select(*columns)
    return top.withColumn("example", F.lit("atypical")).unionAll(normal.withColumn("example", F.lit("normal")))


def attributions(forest: Forest, examples: DataFrame) -> DataFrame:
    """(row_id, feature, attribution) of the rows of a written table, as many as there are; zeros are left out.

    Rows stay where they are, in Arrow batches; the trees, whose number and size are bounded as for scoring, are
    broadcast.  A row's values come from one task, in the order of the trees.
    """
    if forest.n_trees << forest.depth > MAX_NODE_SLOTS:
        raise ValueError("the forest is too large to broadcast; use fewer trees or rows per tree")
    trees = [tree for _, tree in forest.nodes.toPandas().groupby("tree_id", sort=True)]
    by_table = forest.depth <= MAX_DEPTH
    if by_table:
        trees = [_plan(tree, max(TABLE_BITS, forest.depth)) for tree in trees]
    shared = examples.sparkSession.sparkContext.broadcast(trees)
    width, n_trees = N_NUMERIC + forest.n_slots, forest.n_trees
    block = max(1, MAX_CELLS // width)

    def explain_rows(rows: pd.DataFrame) -> Iterator[pd.DataFrame]:
        numbers, slots = rows[list(NUMERIC)].to_numpy(np.float64), rows[list(SLOTS)].to_numpy(np.int64)
        if by_table:
            phi = _explain_block(shared.value, numbers, slots, width).T
        else:
            phi = np.zeros((len(rows), width))
            for tree in shared.value:
                phi += explain_tree(tree, numbers, slots, width)
        ids = rows["row_id"].to_numpy()
        for start in range(0, len(rows), BLOCK_ROWS):
            part = np.ascontiguousarray(phi[start : start + BLOCK_ROWS])
            row, feature = np.nonzero(part)
            yield pd.DataFrame({"row_id": ids[start:][row], "feature": feature.astype(np.int32), "attribution": part[row, feature] / n_trees})

    def explain(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        # Tables are made anew for every block, so small batches are put together.
        waiting, n = [], 0
        for batch in batches:
            for start in range(0, len(batch), block):
                part = batch.iloc[start : start + block]
                if n + len(part) > block:
                    yield from explain_rows(pd.concat(waiting))
                    waiting, n = [], 0
                waiting.append(part)
                n += len(part)
        if waiting:
            yield from explain_rows(pd.concat(waiting))

    wide = encode(deal(examples, examples.count()), forest.index).select(F.col("row_id").cast("long").alias("row_id"), *NUMERIC, *SLOTS)
    return wide.mapInPandas(explain, "row_id long, feature int, attribution double")


def explain_forest(scored: DataFrame, forest: Forest, settings: Settings = DEFAULTS) -> tuple[DataFrame, DataFrame]:
    """Attributions per example row, and the mean absolute attribution per feature in descending order.

    ``scored`` is a written features table with scores.
    """
    kept = scored.select(*IDENTIFIERS, *NUMERIC, *CATEGORICAL, "anomaly_score", "is_anomaly").filter(
        F.col("anomaly_score").isNotNull()
    )
    # Twice ``settings.examples`` rows at most: numbering them is one small window.
    number = F.row_number().over(Window.orderBy("example", F.desc("anomaly_score"), *IDENTIFIERS)) - 1
    picked = pick_examples(kept, settings.examples, settings.seed).withColumn("row_id", number)
    examples = materialize(picked, "examples")
    values = materialize(attributions(forest, examples), "attributions")
    n_rows = examples.count()
    importance = (
        feature_names(forest.index)
        .join(values.groupBy("feature").agg(F.sum(F.abs("attribution")).alias("total")), "feature", "left")
        .select(F.col("name").alias("feature"), (F.coalesce("total", F.lit(0.0)) / n_rows).alias("mean_abs_attribution"))
        .orderBy(F.desc("mean_abs_attribution"), "feature")
    )
    return examples.select("row_id", "example", *IDENTIFIERS, "anomaly_score").join(values, "row_id"), importance

