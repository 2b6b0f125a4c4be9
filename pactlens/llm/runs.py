"""Periodic runs: stretches of words that repeat with a period, found as maximal pairs.

A run of period q is a maximal pair at distance q: two equal stretches, q words apart, that no neighbouring word extends to
either side.  All maximal pairs meet in the tree of LCP intervals of a text's suffix array.  The tree is walked from the
leaves up; each interval holds the places of its suffixes in text order, each of the class of the word to its left.  Where
two lists merge, places of different classes are a pair that nothing extends to the left, and the interval's LCP is its
exact length, so nothing extends it to the right.  Pairs whose distance is short enough for the wanted exponent are runs as
they are.  The multiples of a run's period give pairs with the same ends; the least distance is the period.

Places as close as that lie in one arithmetic progression, and all but the first of it have the same word to the left.
So the look into a list ends at the first place of the same class, and costs as much as there are pairs.

A run of the wanted size repeats each of its stretches of ``GRAM`` words inside the text.  Words outside such stretches are
left out before suffixes are sorted, which spares most texts the sort.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pactlens.llm.text import BLANKS, WORD_GAP, read_table, whole_text, words
from pactlens.llm.wordhash import WordHashes

SHORTEST = 6
EXPONENT = 4
#: Words of a stretch that each run repeats: a run of period 1 has six words, others at least four periods.
GRAM = 5
_U64 = np.uint64
_FACTORS = [_U64(x | 1) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4E, 0x165667B19E3779F9, 0x27D4EB2F165667C5, 0x85EBCA77C2B2AE63)]


def repeated_stretches(hashes: np.ndarray) -> list[tuple[int, int]]:
    """(first, after the last) of the maximal stretches of words covered by runs of ``GRAM`` words that occur twice."""
    n = len(hashes) - GRAM + 1
    if n < 2:
        return []
    grams = hashes[:n] * _FACTORS[0]
    for j in range(1, GRAM):
        grams = (grams ^ (grams >> _U64(29))) + hashes[j : j + n] * _FACTORS[j]
    ordered = np.sort(grams)
    twice = ordered[1:][ordered[1:] == ordered[:-1]]
    if not len(twice):
        return []
    edges = np.zeros(len(hashes) + 1, np.int64)
    at = np.flatnonzero(np.isin(grams, twice))
    edges[at] += 1
    edges[at + GRAM] -= 1
    turns = np.flatnonzero(np.diff(np.r_[0, (np.cumsum(edges[:-1]) > 0).astype(np.int8), 0]))
    return list(zip(turns[::2].tolist(), turns[1::2].tolist(), strict=True))


def suffix_array(symbols: np.ndarray) -> np.ndarray:
    """Order of the suffixes, by doubling."""
    n = len(symbols)
    rank = np.unique(symbols, return_inverse=True)[1].astype(np.int64)
    step = 1
    while True:
        after = np.zeros(n, np.int64)
        after[: n - step] = rank[step:] + 1
        key = rank * (n + 1) + after
        order = np.argsort(key, kind="stable")
        key = key[order]
        rank[order] = np.cumsum(np.r_[0, key[1:] != key[:-1]])
        if rank[order[-1]] == n - 1 or step >= n:
            return order
        step *= 2


def common_prefixes(symbols: list[int], order: list[int]) -> list[int]:
    """For each place of the order the length of the prefix that its suffix shares with the one before; 0 for the first."""
    n = len(symbols)
    place = [0] * n
    for i, p in enumerate(order):
        place[p] = i
    lcp, h = [0] * n, 0
    for p in range(n):
        i = place[p]
        if i == 0:
            h = 0
            continue
        q = order[i - 1]
        most = n - max(p, q)
        while h < most and symbols[p + h] == symbols[q + h]:
            h += 1
        lcp[i] = h
        if h:
            h -= 1
    return lcp


def close_pairs(symbols: list[int], order: list[int], lcp: list[int], shortest: int, exponent: int) -> Iterator[tuple[int, int, int]]:
    """(place, distance, length) of the maximal pairs with length + distance >= shortest and >= exponent * distance."""
    left = [-1, *symbols[:-1]]
    least = max(1, -(-shortest * (exponent - 1) // exponent))  # no shorter pair can do

    def merged(a: list[int], b: list[int], length: int):
        if len(a) < len(b):
            a, b = b, a
        reach, near = length // (exponent - 1), shortest - length
        for p in b:
            own = left[p]
            for i in range(bisect_left(a, p - reach), len(a)):
                other = a[i]
                if other > p + reach or left[other] == own:
                    break
                distance = abs(other - p)
                if distance >= near:
                    found.append((min(p, other), distance, length))
        if len(b) == 1:
            insort(a, b[0])
        else:
            a.extend(b)
            a.sort()
        return a

    found: list[tuple[int, int, int]] = []
    stack: list[tuple[int, list[int]]] = []
    for k, p in enumerate(order):
        shared = lcp[k + 1] if k + 1 < len(lcp) else 0
        places = [p]
        while stack and stack[-1][0] > shared:
            length, others = stack.pop()
            places = merged(others, places, length)
        if shared >= least:
            if stack and stack[-1][0] == shared:
                stack[-1] = (shared, merged(stack[-1][1], places, shared))
            else:
                stack.append((shared, places))
        yield from found
        found.clear()


def find_runs(own: list[bytes], hashes: np.ndarray, shortest: int = SHORTEST, exponent: int = EXPONENT) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run with length >= shortest and >= exponent * period, by start and period.

    ``hashes`` only choose the stretches to look into; words are compared as they are.
    """
    if shortest < GRAM + 1 or exponent < 4:
        raise ValueError(f"runs need at least {GRAM + 1} words and four periods")
    stretches = repeated_stretches(hashes)
    if not stretches:
        return []
    known: dict[bytes, int] = {}
    symbols: list[int] = []
    origin: list[int] = []
    for number, (a, b) in enumerate(stretches):
        symbols += [known.setdefault(w, len(known)) for w in own[a:b]]
        symbols.append(-2 - number)  # ends no pair can cross
        origin += range(a, b + 1)
    order = suffix_array(np.array(symbols, np.int64)).tolist()
    lcp = common_prefixes(symbols, order)
    periods: dict[tuple[int, int], int] = {}
    for p, distance, length in close_pairs(symbols, order, lcp, shortest, exponent):
        ends = (origin[p], length + distance)
        if distance < periods.get(ends, distance + 1):
            periods[ends] = distance
    return sorted(((start, length, q) for (start, length), q in periods.items()), key=lambda r: (r[0], r[2]))


def collapsed(own: list[bytes], runs: list[tuple[int, int, int]]) -> list[bytes]:
    """The words without those which a run holds after its first period."""
    if not runs:
        return own
    edges = np.zeros(len(own) + 1, np.int64)
    for start, length, q in runs:
        edges[start + q] += 1
        edges[start + length] -= 1
    gone = np.cumsum(edges[:-1]) > 0
    return [own[i] for i in np.flatnonzero(~gone)]


def _run_rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    known = WordHashes()
    for batch in batches:
        sizes, runs, kept = [], [], []
        for text in batch["text"]:
            own = words(text)
            found = find_runs(own, known.of(own))
            sizes.append(len(own))
            runs.append([{"start": s, "length": n, "period": q} for s, n, q in found])
            kept.append(b" ".join(collapsed(own, found)).decode("utf-8"))
        yield pd.DataFrame({"id": batch["id"], "n_words": sizes, "runs": runs, "collapsed": kept})


def periodic_runs(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(id, n_words, runs, collapsed) of every row: its runs by start and period, and its words, joined by one space, without
    those that a run holds after its first period.

    Null text has no words; a row without runs has an empty list; repeated rows each give a row, null ids too; columns of
    other names take no part; an empty table gives no rows.  A text is worked on as a whole in its task, with memory in
    proportion to its length.
    """
    rows = docs.select(F.col(id_column).cast("long").alias("id"), whole_text(text_column).alias("text"))
    return rows.mapInPandas(_run_rows, "id long, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string")


def with_planted_periods(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(doc_id, text): a tenth of the texts, chosen by id, repeat a part of their own words from some word on.

    Rows without id or words stay as they are.
    """
    h = F.crc32(F.col(id_column).cast("string"))
    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"), whole_text(text_column).alias("text"), h.alias("h"))
    chosen = (F.col("h") % 10 == 0) & (F.trim("text", F.lit(BLANKS)) != "")
    rows = rows.withColumn("own", F.when(chosen, F.split(F.trim("text", F.lit(BLANKS)), WORD_GAP)))
    rows = rows.withColumn("g", F.floor(F.col("h") / 10)).withColumn("n", F.size("own").cast("long"))
    rows = rows.withColumn("a", F.expr("CASE WHEN own IS NOT NULL THEN g % n END"))
    rows = rows.withColumn("p", F.expr("CASE WHEN own IS NOT NULL THEN 1 + (n - a) DIV (3 + g % 8) END"))
    planted = F.expr("array_join(transform(own, (w, i) -> IF(i < a, w, own[CAST(a + (i - a) % p AS INT)])), ' ')")
    return rows.select("doc_id", F.coalesce(planted, "text").alias("text"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs(with_planted_periods(read_table(spark, sf_dir, "documents")))
    best = F.expr("""get(array_sort(runs, (x, y) -> CASE
        WHEN x.length * y.period <> y.length * x.period THEN IF(x.length * y.period > y.length * x.period, -1, 1)
        WHEN x.start <> y.start THEN IF(x.start < y.start, -1, 1)
        ELSE CAST(sign(x.period - y.period) AS INT) END), 0)""")
    lines = F.expr(r"array_join(transform(runs, r -> concat(r.start, ',', r.length, ',', r.period, '\n')), '')")
    return found.withColumn("best", best).select(
        F.col("id").alias("doc_id"),
        F.size("runs").cast("long").alias("n_runs"),
        "best.start",
        "best.length",
        "best.period",
        F.expr("(1000 * best.length) DIV best.period").alias("exponent_milli"),
        F.sha2(lines.cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )
