"""Many forests at once: their trees from shared sub-samples, their scores in one pass, and the cut of each by histograms.

Tree t of every trial grows from the first rows of sub-sample t, as many as the trial asks for.  So the trials differ by
their parameters and not by the luck of the draw, and the rows of a sub-sample move once.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType

from pactlens.config import NUMERIC
from pactlens.operators.encode import SLOTS
from pactlens.operators.forest import tree
from pactlens.operators.forest.fit import _first_by_order
from pactlens.session import deal, materialize, one_task_per_group

#: Nodes (about 12 bytes each) that one pass of scoring broadcasts; more trials take more passes.
MOST_NODES = 10_000_000
#: Rows and trees that are worked on together, and a bound on the bytes of their masks.
BLOCK_ROWS, BLOCK_TREES, BLOCK_BYTES = 10_240, 8, 1 << 25
BINS = 1_024
PACKED = "trial_id int, tree_id int, n_nodes int, feature binary, threshold binary, left binary, path binary"
_TYPES = {"feature": np.int32, "threshold": np.float64, "left": np.int32, "path": np.float64}


def grow_trials(samples: DataFrame, trials: Sequence[dict], sizes: Sequence[int], n_slots: int, seed: int) -> DataFrame:
    """The packed trees of all trials, a row each: ``samples`` holds a sub-sample for every tree number.

    One task holds one sub-sample, which is bounded, and grows the tree of this number for each trial that has as many.
    """
    wanted = [(k, t["n_trees"], sizes[k], t["max_features"]) for k, t in enumerate(trials)]

    def grow(key, group):
        number = int(key[0])
        rows = _first_by_order(group, max(sizes))
        numbers = group[list(NUMERIC)].to_numpy(np.float64)[rows]
        slots = group[list(SLOTS)].to_numpy(np.int64)[rows]
        out = []
        for k, n_trees, size, share in wanted:
            if number < n_trees:
                rng = np.random.default_rng([seed, k, number])
                packed = tree.pack(tree.grow(numbers[:size], slots[:size], tree.depth_limit(size), n_slots, share, rng))
                out.append((k, number, len(packed["left"]), *(packed[c].tobytes() for c in _TYPES)))
        return pd.DataFrame(out, columns=[c.split()[0] for c in PACKED.split(", ")])

    most = max(t["n_trees"] for t in trials)
    return one_task_per_group(samples, most, "tree_id").groupBy("tree_id").applyInPandas(grow, PACKED)


class Masks:
    """What the nodes of any tree ask of a block of rows, as bits: a line of words for each answer, a bit for each row.

    Of a numeric column there is a line for each rank among the block's values, of a slot one if some row has it; so a line
    serves all nodes that cut between the same two values, whatever their number.
    """

    def __init__(self, numbers: np.ndarray, slots: np.ndarray):
        n = len(numbers)
        words = -(-n // 64)
        row = np.arange(n)
        bit = np.uint64(1) << (row % 64).astype(np.uint64)
        self.all = np.zeros(words, np.uint64)
        np.bitwise_or.at(self.all, row // 64, bit)
        # No cut is below a missing number or the least one: neither ever goes right.
        columns = np.where(np.isnan(numbers), -np.inf, numbers).T
        ranked = [np.unique(column, return_inverse=True) for column in columns]
        self.values = [values for values, _ in ranked]
        self.slots = np.unique(slots[slots >= 0])
        sizes = [len(values) + 1 for values in self.values] + [len(self.slots) + 1]
        #: The first line of each numeric column, and last that of the slots; the line before the end has no row.
        self.starts = np.cumsum([0, *sizes])
        self.lines = np.zeros((self.starts[-1], words), np.uint64)
        for start, end, (_, rank) in zip(self.starts, self.starts[1:], ranked):
            own = self.lines[start:end]
            own[0] = self.all
            np.bitwise_or.at(own, (rank + 1, row // 64), bit)
            # Line p keeps the rows of rank p and above.
            np.bitwise_xor.accumulate(own, axis=0, out=own)
        at, column = np.nonzero(slots >= 0)
        place = self.starts[-2] + np.searchsorted(self.slots, slots[at, column])
        np.bitwise_or.at(self.lines, (place, at // 64), bit[at])

    def above(self, column: int, cuts: np.ndarray) -> np.ndarray:
        """Lines of the rows whose number is above each of these cuts, which are in order."""
        values = self.values[column]
        upto = np.bincount(np.searchsorted(cuts, values), minlength=len(cuts) + 1)[: len(cuts)]
        return self.starts[column] + np.cumsum(upto)

    def having(self, wanted: np.ndarray) -> np.ndarray:
        """Lines of the rows that have each of these slots."""
        place = np.searchsorted(self.slots, wanted)
        known = np.r_[self.slots, -1][place] == wanted
        return self.starts[-2] + np.where(known, place, len(self.slots))


@dataclass(frozen=True)
class Stack:
    """The trees of several trials, one after the other, level by level: a block holds some trees of one trial.

    Inner nodes are numbered by block, level and tree.  ``inherit`` tells for each the place of its rows: those that the nodes
    of the level above send left, in the order of these nodes, and then those they send right.  A leaf is told by ``code``,
    the turns that lead to it as a binary number, filled up with turns to the left.
    """

    #: Per block: its trial, and the bounds of its trees' inner nodes in each level (levels x trees + 1).
    blocks: list[tuple[int, np.ndarray]]
    inherit: np.ndarray
    #: Per numeric column: cuts in order and the nodes that have them; for the slots the same.
    cuts: list[np.ndarray]
    cut_nodes: list[np.ndarray]
    code: np.ndarray
    path: np.ndarray
    #: Bounds of each tree's leaves.
    leaves: np.ndarray
    depths: list[int]
    normals: list[float]

    @classmethod
    def of(cls, packed: DataFrame, trials: Sequence[int], sizes: Sequence[int]) -> Stack:
        # Within ``MOST_NODES``, which the caller checks.
        rows = packed.where(F.col("trial_id").isin(list(trials))).toPandas().sort_values(["trial_id", "tree_id"])
        counts = rows["n_nodes"].to_numpy()
        starts = np.cumsum(counts) - counts
        feature, threshold, left, path = (np.concatenate([np.frombuffer(x, kind) for x in rows[c]]) for c, kind in _TYPES.items())
        trial = np.searchsorted(trials, rows["trial_id"].to_numpy())
        depths = [tree.depth_limit(sizes[k]) for k in trials]
        normals = [float(tree.average_path(sizes[k])) or 1.0 for k in trials]
        limit = np.array(depths)[trial]
        first = np.r_[0, np.flatnonzero(np.diff(trial)) + 1]
        within = np.arange(len(rows)) - first[trial]
        block = np.cumsum(within % BLOCK_TREES == 0) - 1
        heads = np.flatnonzero(np.diff(block, prepend=-1))
        # All trees one level down at a time; nodes of a level stand in the order of their trees.
        number, node, code = np.arange(len(rows)), starts.copy(), np.zeros(len(rows), np.int64)
        place = np.zeros(len(rows), np.int64)
        levels, ends = [], []
        for level in range(max(depths) + 1):
            inner = left[node] + starts[number] != node
            ends.append((number[~inner], code[~inner] << (limit[number[~inner]] - level), path[node[~inner]]))
            number, node, code, place = number[inner], node[inner], code[inner], place[inner]
            if not len(node):
                break
            per_tree = np.bincount(number, minlength=len(rows))
            bounds = np.r_[0, np.cumsum(per_tree)]
            levels.append((node, place, bounds))
            low, high = bounds[heads][block[number]], bounds[np.r_[heads[1:], len(rows)]][block[number]]
            own, child = np.arange(len(node)) - low, left[node] + starts[number]
            number = np.repeat(number, 2)
            node, code, place = (np.stack(x, axis=1).ravel() for x in ((child, child + 1), (2 * code, 2 * code + 1), (own, own + high - low)))
        blocks, parts, done = [], [], 0
        for b, (head, end) in enumerate(zip(heads, np.r_[heads[1:], len(rows)])):
            rank = []
            for node, place, bounds in levels:
                low, high = bounds[head], bounds[end]
                if low == high:
                    break
                rank.append(done + bounds[head : end + 1] - low)
                parts.append((node[low:high], place[low:high]))
                done += high - low
            blocks.append((int(trial[head]), np.array(rank, np.int64).reshape(len(rank), end - head + 1)))
        node, inherit = (np.concatenate([p[j] for p in parts] or [np.empty(0, np.int64)]) for j in range(2))
        cuts, cut_nodes = [], []
        for f in range(tree.N_NUMERIC + 1):
            own = np.flatnonzero(feature[node] == f if f < tree.N_NUMERIC else feature[node] >= f)
            cut = threshold[node[own]] if f < tree.N_NUMERIC else feature[node[own]] - f
            order = np.argsort(cut, kind="stable")
            cuts.append(cut[order])
            cut_nodes.append(own[order].astype(np.int32))
        number, code, path = (np.concatenate([e[j] for e in ends]) for j in range(3))
        order = np.argsort(number, kind="stable")
        leaves = np.r_[0, np.cumsum(np.bincount(number, minlength=len(rows)))]
        return cls(blocks, inherit.astype(np.int32), cuts, cut_nodes, code[order].astype(np.int32), path[order], leaves, depths, normals)

    def scores(self, numbers: np.ndarray, slots: np.ndarray) -> np.ndarray:
        """Scores of each row (first axis) under each trial."""
        widest = max((int((b[:, -1] - b[:, 0]).max()) for _, b in self.blocks if len(b)), default=1)
        most = max(64, min(BLOCK_ROWS, BLOCK_BYTES // (2 * widest) * 8 // 64 * 64))
        # Of similar size, as a block has work of its own for every node.
        block = -(-len(numbers) // max(1, -(-len(numbers) // most)))
        out = np.zeros((len(numbers), len(self.depths)))
        for start in range(0, len(numbers), max(1, block)):
            some = slice(start, start + block)
            self._block(numbers[some], slots[some], out[some], widest)
        return out

    def _block(self, numbers: np.ndarray, slots: np.ndarray, out: np.ndarray, widest: int) -> None:
        """Rows as bits, all of them through the nodes of a level: whoever is at a node goes left or right.

        The turns of a level, over all its nodes, are a line of bits for each tree; its lines make up the code of a row's leaf.
        """
        masks = Masks(numbers, slots)
        line = np.empty(len(self.inherit), np.int32)
        for f, (cuts, nodes) in enumerate(zip(self.cuts, self.cut_nodes)):
            line[nodes] = masks.above(f, cuts) if f < tree.N_NUMERIC else masks.having(cuts)
        n, words = len(numbers), len(masks.all)
        here, sent = np.empty((widest, words), np.uint64), np.empty((2 * widest, words), np.uint64)
        turns = np.empty((max(self.depths), BLOCK_TREES, words), np.uint64)
        table = np.empty(1 << max(self.depths))
        bytes_, code = np.empty((-(-max(self.depths) // 8), BLOCK_TREES, n), np.uint8), np.empty(n, np.int64)
        found, value = np.empty((2, n))
        total, n_trees, first = np.zeros((len(self.depths), n)), np.zeros(len(self.depths)), 0
        for trial, bounds in self.blocks:
            depth, trees = self.depths[trial], bounds.shape[1] - 1
            turns[:] = 0
            before = 0
            for level, own in enumerate(bounds):
                low, high = own[0], own[-1]
                m = high - low
                rows, left, right = here[:m], sent[:m], sent[m : 2 * m]
                if level:
                    sent[: 2 * before].take(self.inherit[low:high], axis=0, out=rows, mode="clip")
                else:
                    rows[:] = masks.all
                masks.lines.take(line[low:high], axis=0, out=right, mode="clip")
                right &= rows
                for t, (a, b) in enumerate(zip(own - low, own[1:] - low)):
                    if a < b:
                        np.bitwise_or.reduce(right[a:b], axis=0, out=turns[level, t])
                if level + 1 < len(bounds):
                    np.bitwise_xor(rows, right, out=left)
                before = m
            parts = bytes_[: -(-depth // 8), :trees]
            parts[:] = 0
            for level in range(depth):
                part = parts[(depth - level - 1) // 8]
                part <<= 1
                part |= np.unpackbits(turns[level, :trees].view(np.uint8), axis=1, count=n, bitorder="little")
            for t in range(trees):
                a, b = self.leaves[first + t], self.leaves[first + t + 1]
                table[self.code[a:b]] = self.path[a:b]
                code[:] = parts[-1, t]
                for part in parts[-2::-1]:
                    code <<= 8
                    code |= part[t]
                table.take(code, out=found if t else value, mode="clip")
                if t:
                    value += found
            total[trial] += value
            n_trees[trial] += trees
            first += trees
        for k, normal in enumerate(self.normals):
            out[:, k] = np.exp2(-total[k] / (n_trees[k] * normal)) - 0.5


def passes(nodes_per_trial: Sequence[int], most: int = MOST_NODES) -> list[list[int]]:
    """Trials in turn, as many in each pass as its bound of nodes holds."""
    out: list[list[int]] = []
    used = 0
    for k, n in enumerate(nodes_per_trial):
        if n > most:
            raise ValueError("the trees of one trial are too large to broadcast; use fewer trees or rows per tree")
        if not out or used + n > most:
            out.append([])
            used = 0
        out[-1].append(k)
        used += n
    return out


def _scores_udf(shared):
    @F.pandas_udf(ArrayType(DoubleType()))
    def scores(numbers: pd.DataFrame, slots: pd.DataFrame) -> pd.Series:
        return pd.Series(list(shared.value.scores(numbers.to_numpy(np.float64), slots.to_numpy(np.int64))))

    return scores


def score_trials(encoded: DataFrame, packed: DataFrame, sizes: Sequence[int], n_slots: int, most: int = MOST_NODES) -> DataFrame:
    """``encoded`` with ``scores``, an array with the score of each trial.

    Rows are read once for as many trials as fit into a broadcast, whatever the number of trees.
    """
    counts = {r["trial_id"]: r["n"] for r in packed.groupBy("trial_id").agg(F.sum("n_nodes").alias("n")).collect()}
    scored, rows = encoded.withColumn("scores", F.array().cast("array<double>")), encoded.count()
    for some in passes([counts[k] for k in range(len(sizes))], most):
        shared = encoded.sparkSession.sparkContext.broadcast(Stack.of(packed, some, sizes))
        scored = deal(scored, rows).withColumn("scores", F.concat("scores", _scores_udf(shared)(F.struct(*NUMERIC), F.struct(*SLOTS))))
        scored = materialize(scored, "trial-scores")
        shared.destroy()
    return scored


@dataclass(frozen=True)
class Cut:
    """The score of the last of the top rows, how many are above it, and how many have just this score."""

    score: float
    above: int
    equal: int


def _matrix(batch: pd.DataFrame) -> np.ndarray:
    return np.stack(batch["scores"].to_numpy()) if len(batch) else np.empty((0, 0))


def top_cuts(scored: DataFrame, n_trials: int, k: int, bins: int = BINS) -> list[Cut]:
    """For each place of the array ``scores`` the cut of its top ``k`` rows, exact.

    Every round counts, in the tasks, the scores that are still in question in even bins; sums of bins say in which the cut
    lies, and the next round looks into this one.  It ends when a bin holds a single value.  What moves is ``bins`` rows for
    each trial and task, and a round or two do for most data.
    """
    ranges: dict[int, tuple[float, float, int]] = {t: (-np.inf, np.inf, 0) for t in range(n_trials)}
    done: dict[int, Cut] = {}
    while ranges:
        asked = dict(ranges)

        def count(batches: Iterator[pd.DataFrame], asked=asked) -> Iterator[pd.DataFrame]:
            for batch in batches:
                found = []
                matrix = _matrix(batch)
                for t, (low, high, _) in asked.items() if len(matrix) else ():
                    own = matrix[:, t]
                    own = np.sort(own[(own >= low) & (own <= high)])
                    if not len(own):
                        continue
                    a, b = max(low, -0.5), min(high, 0.5)
                    place = np.clip(((own - a) / (b - a or 1.0) * bins).astype(np.int64), 0, bins - 1)
                    heads = np.flatnonzero(np.diff(np.r_[-1, place]))
                    ends = np.r_[heads[1:], len(own)]
                    found.append(pd.DataFrame({"trial": t, "bin": place[heads], "n": ends - heads, "low": own[heads], "high": own[ends - 1]}))
                if found:
                    yield pd.concat(found)

        counted = scored.select("scores").mapInPandas(count, "trial int, bin int, n long, low double, high double")
        counted = counted.groupBy("trial", "bin").agg(F.sum("n").alias("n"), F.min("low").alias("low"), F.max("high").alias("high"))
        by_trial: dict[int, list] = {}
        for r in counted.collect():  # a row for each bin and trial
            by_trial.setdefault(r["trial"], []).append(r)
        for t, found in by_trial.items():
            above = asked[t][2]
            for r in sorted(found, key=lambda r: -r["bin"]):
                if above + r["n"] >= k:
                    break
                above += r["n"]
            if r["low"] == r["high"]:
                done[t] = Cut(r["low"], above, r["n"])
                del ranges[t]
            else:
                ranges[t] = (r["low"], r["high"], above)
    return [done[t] for t in range(n_trials)]


def detected(scored: DataFrame, cuts: Sequence[Cut], k: int, identifier: str, planted: str) -> list[int]:
    """For each trial, how many of the planted rows (a flag; few, and collected) are among the top ``k``.

    Rows with the score of the cut go by their identifier.
    """
    rows = scored.where(planted).select(identifier, "scores").collect()
    out = [sum(r["scores"][t] > cut.score for r in rows) for t, cut in enumerate(cuts)]
    tied = {t: sorted(r[identifier] for r in rows if r["scores"][t] == cut.score) for t, cut in enumerate(cuts)}
    asked = {t: ids for t, ids in tied.items() if ids}
    if not asked:
        return out

    def before(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Rows of the cut's score by the number of tied planted rows that do not come after them."""
        for batch in batches:
            matrix = _matrix(batch)
            found = [
                (t, bisect_right(ids, own))
                for t, ids in (asked.items() if len(matrix) else ())
                for own in batch[identifier][matrix[:, t] == cuts[t].score]
            ]
            yield pd.DataFrame(found, columns=["trial", "place"])

    counted = scored.select(identifier, "scores").mapInPandas(before, "trial int, place int").groupBy("trial", "place").count()
    counts = {(r["trial"], r["place"]): r["count"] for r in counted.collect()}  # a row for each planted one
    for t, ids in asked.items():
        for j in range(len(ids)):
            earlier = sum(counts.get((t, p), 0) for p in range(j + 1))
            out[t] += cuts[t].above + earlier < k
    return out
