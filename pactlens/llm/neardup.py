"""Near duplicates by Order MinHash, verified by banded alignment.

A text is the sequence of its k-mers (shingles of five words), each labelled with the number of its earlier occurrences.
A sketch takes the ``ELL`` labelled k-mers least under a hash of its own and keeps them in text order.  Two texts share a
sketch when these agree, so the rate of agreement follows edit similarity and not only the set of shingles.

Edits that are spread evenly leave few shingles of five words, or none, so every text has more sketches, of runs of
three words: two of them in text order, in texts of more than ``SHORT`` words, and the least one in shorter texts, of which
few runs outlive an edit.  Texts a little longer than ``SHORT`` have both, so similar texts have one kind in common.  Up to
``TINY`` words what is left of the text after every choice of as many deletions as similarity allows edits is a key.  Two
texts that are similar share one of the latter, so there no pair is lost.

Texts that share a key are candidates, without listing the pairs of a group:

1. Equal texts fall together first; only distinct texts go on.  Of keys that the same texts share only the first goes on.
2. Every text is compared with the one of its groups' least texts that it shares most keys with; then, in groups of several
   components, with a random text of another one.  Groups of true copies become one component here.
3. Groups that still hold several components are compared exactly, in blocks of rows ordered by component; block pairs
   inside one component are left out.  A pair comes from the least of the groups that both its texts are in, so once.

A lower bound of the edit distance, from lengths and counts of word classes, discards pairs that cannot be similar before
their texts move; it loses none that are.  In blocks, longer texts also bring 16-bit marks of their words, as few classes
tell them apart badly.

A pair counts as similar when 1 - distance / length of the longer >= ``SIMILARITY``, the distance being the least number
of words to insert, delete or replace.  Classes are the components of the similar pairs.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache
from itertools import combinations
from operator import ne

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pactlens.llm.graph import components
from pactlens.llm.text import read_table, whole_text, words
from pactlens.llm.wordhash import WordHashes, mix64
from pactlens.session import materialize

K = 5
ELL = 2
SKETCHES = 36
SHORT = 80
RUN_K = 3
RUN_SKETCHES = 60
TINY = 14
#: Places of keys: sketches of shingles, of ordered runs, of single runs; the last is what all remainders count as.
REMAINDER = SKETCHES + 2 * RUN_SKETCHES
#: A place without a key.
NONE = 0
#: A posted key is its place, so that the least key has the least place, and as many bits of a hash.
HASH_BITS = 55
SIMILARITY = 0.8
BLOCK_ROWS = 2048
#: Rows of a block that are held against the other block at once.
STRIP_ROWS = 256
#: Rows of block pairs, of all sizes, that one call compares, about; and pairs whose word classes are compared at once.
BIN_ROWS = 4096
CHUNK_PAIRS = 4096
CLASSES = 256
#: Texts of more words than classes, and of at most as many as this, have marks.
MOST_MARKED = 4096
#: Rounds in which a random text of each group is compared with those of other components.
TURNS = 1
_U64 = np.uint64
_MIX = _U64(0x9E3779B97F4A7C15)


_SEEDS = mix64(np.arange(1, 2 * 4096 + 1, dtype=_U64) * _MIX)


def kmers(hashes: np.ndarray, k: int = K) -> np.ndarray:
    """Hashes of all runs of k words; a shorter text is one k-mer."""
    n = max(1, len(hashes) - k + 1)
    out = np.zeros(n, _U64)
    for j in range(min(k, len(hashes))):
        out = out * _MIX + hashes[j : j + n]
    return mix64(out)


def occurrences(values: np.ndarray) -> np.ndarray:
    """For each value, how often it stood further left."""
    s = np.sort(values)
    if not (s[1:] == s[:-1]).any():
        return np.zeros(len(values), _U64)
    order = np.argsort(values, kind="stable")
    s = values[order]
    first = np.r_[True, s[1:] != s[:-1]]
    starts = np.maximum.accumulate(np.where(first, np.arange(len(s)), 0))
    out = np.empty(len(s), _U64)
    out[order] = (np.arange(len(s)) - starts).astype(_U64)
    return out


def order_sketches(hashes: np.ndarray, sketches: int = SKETCHES, ell: int = ELL, k: int = K) -> np.ndarray:
    """One key for each sketch, of its ``ell`` least labelled k-mers in text order; none for a text without words."""
    if not len(hashes):
        return np.empty(0, np.int64)
    grams = kmers(hashes, k)
    labelled = mix64(grams + occurrences(grams) * _MIX)
    keys = np.arange(sketches, dtype=_U64)
    ell = min(ell, len(grams))
    step = max(1, (1 << 21) // len(grams))
    for at in range(0, sketches, step):
        some = slice(at, min(sketches, at + step))
        bids = (labelled[None, :] ^ _SEEDS[some, None]) * (_SEEDS[4096:][some, None] | _U64(1))
        bids ^= bids >> _U64(32)
        rows = np.arange(bids.shape[0])
        picked = np.empty((len(rows), ell), np.int64)
        for e in range(ell):
            picked[:, e] = bids.argmin(axis=1)
            bids[rows, picked[:, e]] = ~_U64(0)
        picked.sort(axis=1)
        for e in range(ell):
            keys[some] = mix64(keys[some] * _MIX + grams[picked[:, e]])
    return keys.view(np.int64)


@lru_cache(maxsize=None)
def _stays(n: int, k: int) -> np.ndarray:
    """The places that stay after each choice of k deletions from n, one row each."""
    return np.array(list(combinations(range(n), n - k)), np.int64).reshape(-1, n - k)


def remainders(hashes: np.ndarray, edits: int) -> np.ndarray:
    """Distinct keys of what is left after any choice of up to ``edits`` deletions."""
    out = []
    for k in range(edits + 1):
        kept = hashes[_stays(len(hashes), k)]
        key = np.zeros(len(kept), _U64)
        for column in kept.T:
            key = key * _MIX + column
        out.append(mix64(key))
    return np.unique(np.concatenate(out)).view(np.int64)


def all_keys(hashes: np.ndarray, similarity: float = SIMILARITY) -> np.ndarray:
    """The keys of a text by place, ``NONE`` where it has none, and from place ``REMAINDER`` the remainders of a tiny one."""
    n = len(hashes)
    keys = np.full(REMAINDER if n else 0, NONE, np.int64)
    if n:
        keys[:SKETCHES] = order_sketches(hashes)
    if n > SHORT:
        keys[SKETCHES : SKETCHES + RUN_SKETCHES] = order_sketches(hashes, RUN_SKETCHES, ELL, RUN_K)
    if 0 < n and most_edits(n, similarity) >= n - SHORT:  # not longer than a text similar to a short one
        keys[SKETCHES + RUN_SKETCHES :] = order_sketches(hashes, RUN_SKETCHES, 1, RUN_K)
    if 0 < n <= TINY:
        keys = np.r_[keys, remainders(hashes, most_edits(n, similarity))]
    return keys


def word_classes(hashes: np.ndarray, classes: int = CLASSES) -> np.ndarray:
    return np.bincount((hashes >> _U64(40)).astype(np.int64) % classes, minlength=classes)


def word_marks(hashes: np.ndarray) -> np.ndarray:
    """Distinct 16-bit hashes of the words, each with the number of its earlier occurrences; none for a text of few words,
    whose classes tell enough, or of very many."""
    if not CLASSES < len(hashes) <= MOST_MARKED:
        return np.empty(0, "<u2")
    return np.unique((mix64(hashes + occurrences(hashes) * _MIX) >> _U64(48)).astype("<u2"))


def _sketch_rows(similarity: float):
    """The keys of texts, their lengths, and their word classes, a byte for each where that holds all counts."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = WordHashes()
        for batch in batches:
            out: dict = {"node": batch["node"].tolist(), "keys": [], "size": [], "classes": []}
            for text in batch["text"]:
                hashes = known.of(words(text))
                counts = word_classes(hashes)
                out["keys"].append(all_keys(hashes, similarity))
                out["size"].append(len(hashes))
                out["classes"].append(counts.astype("u1" if counts.max() < 256 else "<u4").tobytes())
            yield pd.DataFrame(out)

    return run


def _mark_rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    known = WordHashes()
    for batch in batches:
        marks = [word_marks(known.of(words(text))).tobytes() for text in batch["text"]]
        yield batch.drop(columns="text").assign(marks=marks)


def unpacked(classes: list[bytes]) -> np.ndarray:
    """Word classes, one row for each text."""
    if all(len(c) == CLASSES for c in classes):
        return np.frombuffer(b"".join(classes), "u1").reshape(-1, CLASSES)
    return np.stack([np.frombuffer(c, "u1" if len(c) == CLASSES else "<u4").astype(np.uint32) for c in classes])


def mark_bits(marks: list[np.ndarray]) -> np.ndarray:
    """Marks as the bits of one row for each text."""
    out = np.empty((len(marks), 1 << 10), _U64)
    for at in range(0, len(marks), 256):
        some = marks[at : at + 256]
        flags = np.zeros((len(some), 1 << 16), bool)
        flags[np.repeat(np.arange(len(some)), [len(m) for m in some]), np.concatenate(some)] = True
        out[at : at + 256] = np.packbits(flags, axis=1).view(_U64)
    return out


def _places(a: list) -> dict:
    out: dict = {}
    for i, x in enumerate(a):
        out[x] = out.get(x, 0) | (1 << i)
    return out


def _whole_distance(a: list, b: list) -> int:
    """Edit distance; the differences down a column of the table are the bits of two integers."""
    rows, places = len(a), _places(a)
    mask = (1 << rows) - 1
    plus, minus, score = mask, 0, rows
    for x in b:
        match = places.get(x, 0)
        d0 = (((match & plus) + plus) ^ plus) | match | minus
        hp, hn = minus | ~(d0 | plus), d0 & plus
        score += (hp >> (rows - 1) & 1) - (hn >> (rows - 1) & 1)
        hp, hn = hp << 1 | 1, hn << 1
        plus, minus = (hn | ~(d0 | hp)) & mask, hp & d0 & mask
    return score


def _band_distance(a: list, b: list, most: int) -> int:
    """The same on the diagonals within ``most`` of the main one; needs len(a) > most and lengths at most that far apart."""
    width = 2 * most + 2
    mask = (1 << width) - 1
    places = _places(a)
    plus, minus, score = mask & ~((1 << (width - most - 1)) - 1), 0, most
    start, last, top = most + 1 - width, len(a) - most, width - 2
    for i, x in enumerate(b):
        own = places.get(x, 0)
        match = (own >> start if start >= 0 else own << -start) & mask
        d0 = ((((match & plus) + plus) ^ plus) | match | minus) & mask
        hp, hn = (minus | ~(d0 | plus)) & mask, d0 & plus
        if i < last:  # down the lowest diagonal
            score += 1 - (d0 >> (width - 1) & 1)
        else:  # along the last row
            score += (hp >> top & 1) - (hn >> top & 1)
            top -= 1
        plus, minus = (hn | ~((d0 >> 1) | hp)) & mask, (d0 >> 1) & hp
        start += 1
    return score


def banded_distance(a: list, b: list, most: int) -> int:
    """Edit distance of two sequences if it is at most ``most``, else a greater number.  Widens the band as needed."""
    if len(a) < len(b):
        a, b = b, a
    at, end = 0, 0
    while at < len(b) and a[at] == b[at]:
        at += 1
    while end < len(b) - at and a[-1 - end] == b[-1 - end]:
        end += 1
    a, b = a[at : len(a) - end], b[at : len(b) - end]
    if not b or len(a) - len(b) > most:
        return len(a) - len(b) if len(a) - len(b) > most else len(a)
    band = max(8, len(a) - len(b))
    while band < most and band < len(a):
        found = _band_distance(a, b, band)
        if found <= band:
            return found
        band *= 4
    return _band_distance(a, b, most) if most < len(a) else _whole_distance(a, b)


def most_edits(longer: int, similarity: float = SIMILARITY) -> int:
    return int((1 - similarity) * longer + 1e-9)


def aligned_distance(a: list, b: list, in_a: Counter, in_b: Counter) -> int:
    """Edits of one alignment, so never less than the edit distance: words that stand once in either sequence, as many as
    are in common order, and word by word between them."""
    once = {w: j for j, w in enumerate(b) if in_b[w] == 1}
    tails, ends, before, places = [], [], [], []
    for i, w in enumerate(a):
        j = once.get(w)
        if j is None or in_a[w] != 1:
            continue
        at = bisect_left(tails, j)
        before.append(ends[at - 1] if at else -1)
        if at == len(tails):
            tails.append(j)
            ends.append(len(places))
        else:
            tails[at], ends[at] = j, len(places)
        places.append((i, j))
    edits, i, j = 0, len(a), len(b)
    at = ends[-1] if ends else -1
    while True:
        x, y = places[at] if at >= 0 else (-1, -1)
        rows, columns = i - x - 1, j - y - 1
        if rows == columns:
            if rows:
                edits += sum(map(ne, a[x + 1 : i], b[y + 1 : j]))
        else:
            edits += max(rows, columns)
        if at < 0:
            return edits
        i, j, at = x, y, before[at]


def similar(a: list, b: list, similarity: float = SIMILARITY) -> bool:
    most = most_edits(max(len(a), len(b)), similarity)
    if abs(len(a) - len(b)) > most:
        return False
    in_a, in_b = Counter(a), Counter(b)
    if max(len(a), len(b)) - sum([min(n, in_b[w]) for w, n in in_a.items() if w in in_b]) > most:
        return False
    return aligned_distance(a, b, in_a, in_b) <= most or banded_distance(a, b, most) <= most


def _within_bound(similarity: float):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            longer = np.maximum(batch["size_a"].to_numpy(), batch["size_b"].to_numpy())
            shared = np.minimum(unpacked(batch["classes_a"].tolist()), unpacked(batch["classes_b"].tolist())).sum(axis=1, dtype=np.int64)
            yield batch.loc[longer - shared <= (1 - similarity) * longer + 1e-9, ["a", "b"]]

    return run


def _verify(similarity: float):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            keep = [similar(words(x), words(y), similarity) for x, y in zip(batch["text_a"], batch["text_b"], strict=True)]
            yield batch.loc[keep, ["a", "b"]]

    return run


def _sides(pairs: DataFrame, table: DataFrame, *columns: str) -> DataFrame:
    """The pairs (a, b) with the columns of both nodes."""
    for side in ("a", "b"):
        pairs = pairs.join(table.select(F.col("node").alias(side), *[F.col(c).alias(f"{c}_{side}") for c in columns]), side)
    return pairs


def _possible(pairs: DataFrame, known: DataFrame, similarity: float) -> DataFrame:
    """Those of ``pairs`` that the bound does not exclude; their texts need not move."""
    sides = _sides(pairs, known, "size", "classes")
    sides = sides.where(F.abs(F.col("size_a") - F.col("size_b")) <= (1 - similarity) * F.greatest("size_a", "size_b") + 1e-9)
    return materialize(sides.mapInPandas(_within_bound(similarity), "a long, b long"), "possible")


def _verified(pairs: DataFrame, texts: DataFrame, similarity: float) -> DataFrame:
    """Those of ``pairs`` (a, b) whose texts are similar."""
    return materialize(_sides(pairs, texts, "text").mapInPandas(_verify(similarity), "a long, b long"), "similar")


def _block_pairs(similarity: float):
    """Pairs of different components between the two blocks of each task (side 0 and 1, or all of side 0) that the bound
    does not exclude.  A call takes many tasks, as most are small.  Rows may tell their group (``key``) and all groups of
    their text (``met``); a pair then comes from the least group that both have."""

    def by_marks(pairs: np.ndarray, size: np.ndarray, marks: list[np.ndarray]) -> np.ndarray:
        """The bound for rows (i, j) that have marks: a mark that the other text lacks is a word that it lacks."""
        known = np.array([len(m) for m in marks])
        near = np.ones(pairs.shape[1], bool)
        told = np.flatnonzero((known[pairs] > 0).all(axis=0))
        used, place = np.unique(pairs[:, told], return_inverse=True)
        bits, place = mark_bits([marks[i] for i in used]), place.reshape(2, -1)
        for at in range(0, len(told), CHUNK_PAIRS // 8):
            some = slice(at, at + CHUNK_PAIRS // 8)
            own = pairs[:, told[some]]
            both = np.bitwise_count(bits[place[0, some]] & bits[place[1, some]]).sum(axis=1, dtype=np.int64)
            longer, shared = size[own].max(axis=0), both + (size[own] - known[own]).min(axis=0)
            near[told[some]] = longer - shared <= (1 - similarity) * longer + 1e-9
        return near

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["task", "side"])
        task, side, node, label, size = (rows[c].to_numpy() for c in ("task", "side", "node", "label", "size"))
        counts = unpacked(rows["classes"].tolist())
        starts = np.flatnonzero(np.r_[True, task[1:] != task[:-1]])
        out = [np.empty((2, 0), np.int64)]
        strips = []
        for start, end in zip(starts, np.r_[starts[1:], len(rows)], strict=True):
            middle = start + int((side[start:end] == 0).sum())
            stop = middle if middle < end else end
            strips += [(x, min(x + STRIP_ROWS, stop), middle if middle < end else x, end) for x in range(start, stop, STRIP_ROWS)]
        for start, stop, other, end in strips:  # a block against itself begins at the diagonal
            x, y = slice(start, stop), slice(other, end)
            longer = np.maximum(size[x, None], size[None, y])
            open_ = (label[x, None] != label[None, y]) & (np.abs(size[x, None] - size[None, y]) <= (1 - similarity) * longer + 1e-9)
            left, right = np.nonzero(np.triu(open_, 1) if other == start else open_)
            for at in range(0, len(left), CHUNK_PAIRS):
                i, j = left[at : at + CHUNK_PAIRS], right[at : at + CHUNK_PAIRS]
                shared = np.minimum(counts[start + i], counts[other + j]).sum(axis=1, dtype=np.int64)
                near = longer[i, j] - shared <= (1 - similarity) * longer[i, j] + 1e-9
                out.append(np.stack([start + i[near], other + j[near]]))
        pairs = np.concatenate(out, axis=1)
        if "marks" in rows:
            pairs = pairs[:, by_marks(pairs, size, [np.frombuffer(m, "<u2") for m in rows["marks"]])]
        if "met" in rows:
            key, met = rows["key"].tolist(), {i: set(rows["met"].iat[i].tolist()) for i in np.unique(pairs).tolist()}
            first = [min(met[i] & met[j]) == key[i] for i, j in pairs.T.tolist()]
            pairs = pairs[:, np.array(first, bool)]
        return pd.DataFrame({"a": node[pairs[0]], "b": node[pairs[1]]})

    return run


def _mixed(members: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows, with their labels and the group's number of rows, of the groups that hold several components.  Components
    only grow, so a group that is left out once need not be looked at again."""
    labelled = members.select("key", "node").join(labels, "node", "left")
    labelled = materialize(labelled.select("key", "node", F.coalesce("label", "node").alias("label")), "labelled-members")
    mixed = labelled.groupBy("key").agg(F.min("label").alias("lo"), F.max("label").alias("hi"), F.count(F.lit(1)).alias("n"))
    mixed = mixed.where("lo <> hi").select("key", "n")
    return materialize(labelled.join(materialize(mixed, "mixed-groups"), "key"), "mixed-members")


def similar_pairs(texts: DataFrame, similarity: float = SIMILARITY) -> tuple[DataFrame, DataFrame]:
    """From distinct texts (node, text): similar pairs that span every class, as links (a, b); and (node, label)."""
    sketched = texts.mapInPandas(_sketch_rows(similarity), "node long, keys array<long>, size long, classes binary")
    sketched = materialize(sketched.dropDuplicates(["node"]), "order-sketches")
    known = sketched.select("node", "size", "classes")
    posted = sketched.select("node", F.posexplode("keys").alias("place", "key")).where(F.col("key") != NONE)
    place = F.least("place", F.lit(REMAINDER)).cast("long")
    tail = F.shiftrightunsigned(F.xxhash64(place, "key"), 64 - HASH_BITS)
    posted = posted.select("node", F.shiftleft(place, HASH_BITS).bitwiseOR(tail).alias("key"))
    # A group is known by its least text and the sum of its texts' hashes in binary, without carry.
    groups = posted.groupBy("key").agg(F.min("node").alias("least"), F.bit_xor(F.xxhash64("node")).alias("all"))
    groups = groups.where(F.col("all") != F.xxhash64("least")).groupBy("least", "all").agg(F.min("key").alias("key"), F.count(F.lit(1)).alias("keys"))
    groups = materialize(groups.select("key", "least", "keys"), "sketch-groups")
    members = materialize(posted.join(groups, "key"), "sketch-members")
    wanted = members.select("node").distinct()
    held = materialize(texts.join(wanted, "node", "left_semi").dropDuplicates(["node"]), "candidate-texts")

    ordered = lambda x, y: [F.least(x, y).alias("a"), F.greatest(x, y).alias("b")]
    shared = members.where("node <> least").groupBy("node", "least").agg(F.sum("keys").alias("keys"))
    best = shared.groupBy("node").agg(F.max(F.struct("keys", "least")).alias("best")).select("node", F.col("best.least").alias("least"))
    tried = materialize(best.select(*ordered("least", "node")), "least-pairs")
    links = _verified(_possible(tried, known, similarity), held, similarity)
    labels, rest = components(links), members
    for turn in range(1, 1 + TURNS):
        rest = _mixed(rest, labels)
        line = Window.partitionBy("key").orderBy(F.xxhash64("node", F.lit(turn)), "node").rowsBetween(Window.unboundedPreceding, 0)
        met = rest.withColumn("centre", F.first(F.struct("node", "label")).over(line)).where("label <> centre.label")
        pairs = met.select(*ordered("centre.node", "node")).distinct()
        pairs = materialize(pairs.join(tried, ["a", "b"], "left_anti"), "centre-pairs")
        tried = tried.unionByName(pairs)
        links = links.unionByName(_verified(_possible(pairs, known, similarity), held, similarity))
        labels = components(links)

    rest = _mixed(rest, labels)
    row = F.row_number().over(Window.partitionBy("key").orderBy("label", "node"))
    large = rest.where(F.col("n") > BLOCK_ROWS).withColumn("block", F.floor((row - 1) / BLOCK_ROWS).cast("int"))
    large = materialize(large, "mixed-blocks")
    blocks = large.groupBy("key", "block").agg(F.min("label").alias("lo"), F.max("label").alias("hi"))
    right = blocks.select("key", F.col("block").alias("other"), F.col("lo").alias("lo2"), F.col("hi").alias("hi2"))
    tasks = blocks.join(right, "key").where("block <= other and not (lo = hi and lo2 = hi2 and lo = lo2)")
    tasks = tasks.select("key", "block", "other", F.xxhash64("key", "block", "other").alias("task"))
    sides = F.array(F.struct(F.col("block"), F.lit(0).alias("side")), F.struct(F.col("other").alias("block"), F.lit(1).alias("side")))
    sides = F.explode(F.when(F.col("block") == F.col("other"), F.slice(sides, 1, 1)).otherwise(sides)).alias("s")
    dealt = tasks.select("key", "task", sides).select("key", "task", "s.*").join(large, ["key", "block"])
    small = rest.where(F.col("n") <= BLOCK_ROWS).select("key", F.xxhash64("key").alias("task"), F.lit(0).alias("side"), "node", "label")
    dealt = materialize(dealt.select("key", "task", "side", "node", "label").unionByName(small), "block-members")
    bins = -(-dealt.count() // BIN_ROWS) or 1
    met = rest.groupBy("node").agg(F.collect_list("key").alias("met"))
    marked = held.join(met, "node").select("node", "text", "met").mapInPandas(_mark_rows, "node long, met array<long>, marks binary")
    described = materialize(known.join(marked, "node"), "block-texts")
    described = dealt.join(described, "node").withColumn("bin", F.pmod(F.xxhash64("task"), F.lit(bins)))
    found = described.groupBy("bin").applyInPandas(_block_pairs(similarity), "a long, b long")
    found = found.select(*ordered("a", "b")).distinct().join(tried, ["a", "b"], "left_anti")
    links = links.unionByName(_verified(materialize(found, "block-candidates"), held, similarity))
    return links, components(links)


def near_duplicates(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", similarity: float = SIMILARITY) -> DataFrame:
    """For every row of ``docs``: ``row`` (as a struct), ``node`` (hash of its text), ``class_id`` (least id of the class) and
    ``keeper`` (the node that stands for the class: the least id's, then the least node).

    Null text is empty.  Texts without words are alike only if equal.  Rows without an id belong to classes too; a class
    without any id has a null class_id.  Repeated rows are copies.  An empty table gives no rows.
    """
    text = whole_text(text_column)
    packed = docs.select(F.struct("*").alias("row"), F.col(id_column).cast("long").alias("id"), F.xxhash64(text).alias("node"))
    nodes = materialize(packed.groupBy("node").agg(F.min("id").alias("id")), "texts")
    _, labels = similar_pairs(docs.select(F.xxhash64(text).alias("node"), text.alias("text")), similarity)
    labelled = nodes.join(labels, "node", "left").select("node", "id", F.coalesce("label", "node").alias("label"))
    best = F.min(F.struct(F.col("id").isNull(), "id", "node"))
    heads = labelled.groupBy("label").agg(best.alias("best")).select("label", F.col("best.id").alias("class_id"), F.col("best.node").alias("keeper"))
    classes = materialize(labelled.join(heads, "label").select("node", "class_id", "keeper"), "classes")
    return packed.join(classes, "node").select("row", "node", "class_id", "keeper")


def keep_one(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", similarity: float = SIMILARITY) -> DataFrame:
    """One row of each class: of the keeper's text, the row of the least id."""
    marked = near_duplicates(docs, id_column, text_column, similarity).where("node = keeper")
    line = Window.partitionBy("node").orderBy(F.col(f"row.`{id_column}`").asc_nulls_last(), F.xxhash64("row"))
    return marked.withColumn("place", F.row_number().over(line)).where("place = 1").select("row.*")


def op4_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return near_duplicates(docs).select("row.doc_id", "class_id")
