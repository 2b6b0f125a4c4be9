"""Substring dedup: removal of every word in a window of ``WINDOW`` words whose sequence starts somewhere else, too.

Every window has a Rabin-Karp hash, a polynomial of word hashes modulo 2^64, taken from prefix sums.  To count windows
without moving all of them, a window is filed under its anchor: of the shorter runs of ``GRAM`` words inside it, the one of
the least hash.  Equal windows have equal anchors at equal places.  Windows that follow each other mostly share an anchor,
and so one row stands for about a dozen windows: (hash of the anchor, hash of its stretch, that is of all words of its
windows).  Spark counts these rows:

* An anchor that occurs once has no repeated window.
* Where all occurrences of an anchor have the same stretch, all its windows are repeated.
* Otherwise the windows of each distinct stretch are hashed one by one and counted, weighted by the stretch's count.

The result is exact up to collisions of 128 bits, and what is shuffled is a small part of the windows.  Repeated windows
merge into maximal intervals inside each document.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pactlens.llm.text import read_table, whole_text, words
from pactlens.llm.wordhash import WordHashes, mix64
from pactlens.session import materialize

WINDOW = 35
GRAM = 10
_U64 = np.uint64
_BASE = 0xD1342543DE82EF95
_POWERS = [np.ones(1, _U64), np.ones(1, _U64)]


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2^64."""
    if len(_POWERS[0]) < n:
        size = 1 << (n - 1).bit_length()
        for i, base in enumerate((_BASE, pow(_BASE, -1, 1 << 64))):
            steps = np.full(size, base, _U64)
            steps[0] = 1
            _POWERS[i] = np.cumprod(steps, dtype=_U64)
    return _POWERS[0][:n], _POWERS[1][:n]


class Rolling:
    """Rabin-Karp hashes of any run of a sequence."""

    def __init__(self, hashes: np.ndarray):
        self.up, down = _powers(len(hashes) + 1)
        self.sums = np.zeros(len(hashes) + 1, _U64)
        np.cumsum(hashes * down[:-1], out=self.sums[1:])

    def runs(self, start: np.ndarray, length: np.ndarray | int) -> np.ndarray:
        return mix64((self.sums[start + length] - self.sums[start]) * self.up[start])


class Anchors:
    """For each anchor of a document: its place, and the first and last of the window starts that are filed under it."""

    def __init__(self, hashes: np.ndarray, window: int = WINDOW, gram: int = GRAM):
        self.n, self.window = len(hashes), window
        self.place = self.first = self.last = np.empty(0, np.int64)
        self.key = self.stretch = np.empty(0, _U64)
        if self.n < window:
            return
        self.rolling = Rolling(hashes)
        grams = self.rolling.runs(np.arange(self.n - gram + 1), gram)
        span = window - gram + 1
        starts = np.arange(self.n - window + 1)
        least = starts + np.lib.stride_tricks.sliding_window_view(grams, span).argmin(axis=1)
        heads = np.flatnonzero(np.r_[True, least[1:] != least[:-1]])
        self.first, self.last = heads, np.r_[heads[1:], len(least)] - 1
        self.place = least[heads]
        self.key = grams[self.place]
        shape = ((self.place - self.first) * 4096 + (self.last - self.first)).astype(_U64)
        self.stretch = mix64(self.rolling.runs(self.first, self.last - self.first + window) + mix64(shape))

    def windows(self, i: int) -> tuple[np.ndarray, np.ndarray]:
        """Starts and hashes of the windows of anchor i."""
        starts = np.arange(self.first[i], self.last[i] + 1)
        return starts, self.rolling.runs(starts, self.window)


def _anchor_rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    known = WordHashes()
    for batch in batches:
        found = [Anchors(known.of(words(t))) for t in batch["text"]]
        yield pd.DataFrame({"k": batch["k"], "anchor": [a.key.view(np.int64) for a in found], "stretch": [a.stretch.view(np.int64) for a in found]})


def _window_rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """(anchor, stretch, n, bit, shift, hash): each window of the stretches asked for."""
    known = WordHashes()
    for batch in batches:
        out = {c: [] for c in ("anchor", "stretch", "n", "bit", "shift", "hash")}
        for text, asked in zip(batch["text"], batch["asked"], strict=True):
            anchors = Anchors(known.of(words(text)))
            wanted = {(int(x["anchor"]), int(x["stretch"])): int(x["n"]) for x in asked}
            keys, stretches = anchors.key.view(np.int64), anchors.stretch.view(np.int64)
            for i, pair in enumerate(zip(keys.tolist(), stretches.tolist(), strict=True)):
                n = wanted.pop(pair, 0)
                if n:
                    starts, hashes = anchors.windows(i)
                    size = len(starts)
                    for c, values in zip(out, ([pair[0]] * size, [pair[1]] * size, [n] * size, range(size), (anchors.place[i] - starts).tolist(), hashes.view(np.int64).tolist()), strict=True):
                        out[c].extend(values)
        yield pd.DataFrame(out)


def removed_words(anchors: Anchors, flags: list) -> np.ndarray:
    """Which words lie in a repeated window.  ``flags``: (number of an anchor, bits of its repeated windows; -1 for all)."""
    edges = np.zeros(anchors.n + 1, np.int64)
    for x in flags:
        i, bits = int(x["place"]), int(x["bits"])
        starts = np.arange(anchors.first[i], anchors.last[i] + 1)
        if bits != -1:
            starts = starts[[bool(bits >> b & 1) for b in range(len(starts))]]
        np.add.at(edges, starts, 1)
        np.add.at(edges, starts + anchors.window, -1)
    return np.cumsum(edges[:-1]) > 0


def intervals(gone: np.ndarray) -> list[tuple[int, int]]:
    """Maximal runs of removed words, as (first, after the last)."""
    edges = np.flatnonzero(np.diff(np.r_[0, gone.astype(np.int8), 0]))
    return list(zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True))


def _cut_rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    known = WordHashes()
    for batch in batches:
        spans, sizes, kept = [], [], []
        for text, flags in zip(batch["text"], batch["flags"], strict=True):
            own = words(text)
            if flags is None or not len(flags):
                gone = np.zeros(len(own), bool)
            else:
                gone = removed_words(Anchors(known.of(own)), flags)
            spans.append([{"start": a, "stop": b} for a, b in intervals(gone)])
            sizes.append(len(own))
            kept.append(hashlib.sha256(b" ".join([w for w, g in zip(own, gone.tolist(), strict=True) if not g])).hexdigest())
        yield pd.DataFrame({"id": batch["id"], "n_words": sizes, "spans": spans, "kept_sha256": kept})


def repeated_spans(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(id, n_words, spans, kept_sha256) of every row: the maximal intervals of words that lie in repeated windows, and a
    digest of the other words, joined by one space.

    Null text has no words; texts shorter than a window lose nothing; repeated rows are copies of each other and lose all
    their windows; an empty table gives no rows.
    """
    text = whole_text(text_column)
    rows = docs.select(F.col(id_column).cast("long").alias("id"), text.alias("text"), F.xxhash64(text, F.col(id_column)).alias("k"))
    texts = rows.select("k", "id", "text")
    filed = materialize(rows.select("k", "text").mapInPandas(_anchor_rows, "k long, anchor array<long>, stretch array<long>"), "anchors")
    seen = filed.select("k", F.posexplode(F.arrays_zip("anchor", "stretch")).alias("place", "x")).select("k", "place", "x.anchor", "x.stretch")
    groups = seen.groupBy("anchor").agg(F.count(F.lit(1)).alias("n"), F.min("stretch").alias("lo"), F.max("stretch").alias("hi")).where("n > 1")
    groups = materialize(groups.select("anchor", (F.col("lo") != F.col("hi")).alias("mixed")), "repeated-anchors")
    hits = materialize(seen.join(groups, "anchor"), "anchor-hits")

    mixed = hits.where("mixed")
    stretches = materialize(mixed.groupBy("anchor", "stretch").agg(F.count(F.lit(1)).alias("n"), F.min("k").alias("k")), "stretches")
    asked = stretches.groupBy("k").agg(F.collect_list(F.struct("anchor", "stretch", "n")).alias("asked"))
    windows = texts.join(asked, "k").select("text", "asked").mapInPandas(_window_rows, "anchor long, stretch long, n long, bit int, shift int, hash long")
    windows = materialize(windows.dropDuplicates(["anchor", "stretch", "bit"]), "windows")
    repeated = windows.groupBy("anchor", "shift", "hash").agg(F.sum("n").alias("n")).where("n > 1").select("anchor", "shift", "hash")
    repeated = windows.join(materialize(repeated, "repeated-windows"), ["anchor", "shift", "hash"])
    bits = repeated.groupBy("anchor", "stretch").agg(F.expr("bit_or(shiftleft(1L, bit))").alias("bits"))
    some = mixed.join(materialize(bits, "window-bits"), ["anchor", "stretch"]).select("k", "place", "bits")
    flags = hits.where("not mixed").select("k", "place", F.lit(-1).cast("long").alias("bits")).unionByName(some)
    flags = flags.groupBy("k").agg(F.collect_list(F.struct("place", "bits")).alias("flags"))
    marked = texts.join(flags, "k", "left").select("id", "text", "flags")
    return marked.mapInPandas(_cut_rows, "id long, n_words long, spans array<struct<start:long,stop:long>>, kept_sha256 string")


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    spans = repeated_spans(read_table(spark, sf_dir, "documents"))
    lost = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["stop"] - s["start"])
    return spans.select(F.col("id").alias("doc_id"), "n_words", lost.alias("n_removed"), "kept_sha256")
