"""Removal of repeated byte strings by a distributed difference-cover suffix sort.

Every byte that lies in a string of ``WINDOW`` bytes which also starts anywhere else goes.

**What is sorted.**  Each window is filed under its anchor, of the runs of ``GRAM`` bytes inside it the one of least hash;
equal windows have equal anchors at equal places.  Windows that follow each other mostly share an anchor, and together are a
stretch.  A window whose anchor occurs once has no twin.  Of the others only distinct stretches are sorted, each once, with
the number of its occurrences.

**The cover.**  A stretch is cut into blocks of ``BLOCK`` bytes, counted from its anchor, so that equal windows are cut
alike.  Block suffixes whose number is no multiple of three are the sample.  Their triples of blocks are sorted by Spark and
named by their place in the order (level one); triples of names, the names three blocks apart, are sorted and named in turn
(level two).  A window spans seven whole blocks in any case, and two levels name seven, so the recursion ends there, and a
name that occurs once drops out: its suffix has no neighbour to be compared with.  The remaining block suffixes are placed by their
first block and the names of the sampled suffix behind it, and the suffixes between blocks by the bytes before the next
block, its name, and the bytes that are left.

**Neighbours.**  Suffixes stand next to each other in this order when their prefixes agree; those of one name differ in less
than a block on either side.  Comparing these two ends tells for every window whether ``WINDOW`` bytes agree.  Up to ``LARGE``
suffixes of one name are compared where they stand; the windows of a larger name are spread and counted by Spark.

Distinct stretches and triples are told apart by two 64-bit hashes and by their bytes; nothing is collected, and no key's rows
must meet in one task.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pactlens.llm.text import read_table, whole_text
from pactlens.operators.lookup import at_most
from pactlens.session import materialize

WINDOW = 200
GRAM = 32
BLOCK = 25
#: Whole blocks inside every window, wherever it starts.
WHOLE = (WINDOW - BLOCK + 1) // BLOCK
#: Different ends of a name up to which one task compares them.
LARGE = 2_000
#: Texts with a chosen stretch up to which their keys (some 60 MB) are broadcast, to leave the other texts unmoved.
MOST_KEYS = 400_000
#: Windows of a text that are looked at together; bounds the memory a very long text takes.
PIECE = 1 << 20
_U64 = np.uint64
_BASE = 0xD1342543DE82EF95
_MIX = _U64(0xBF58476D1CE4E5B9)
_LOW = _U64((1 << 21) - 1)
_POWERS = [np.ones(1, _U64), np.ones(1, _U64)]
_TOP = np.iinfo(np.uint64).max


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2^64."""
    if len(_POWERS[0]) < n:
        size = 1 << (n - 1).bit_length()
        for i, base in enumerate((_BASE, pow(_BASE, -1, 1 << 64))):
            steps = np.full(size, base, _U64)
            steps[0] = 1
            _POWERS[i] = np.cumprod(steps, dtype=_U64)
    return _POWERS[0][:n], _POWERS[1][:n]


def _sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """Least value of every run of ``width``, from the least up to and from the borders of blocks."""
    n = len(values)
    padded = np.full(-(-n // width) * width, _TOP, _U64)
    padded[:n] = values
    rows = padded.reshape(-1, width)
    until = np.minimum.accumulate(rows, axis=1).ravel()
    since = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    runs = n - width + 1
    return np.minimum(since[:runs], until[width - 1 : width - 1 + runs])


def anchors(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(hash, place, first, last): each anchor, and the first and last of the windows filed under it.

    Among equal hashes the leftmost counts.  Pieces of a very long text end stretches, which changes no window's anchor.
    """
    found = []
    raw = np.frombuffer(data, np.uint8)
    for piece in range(0, len(raw) - WINDOW + 1, PIECE):
        own = raw[piece : piece + PIECE + WINDOW - 1]
        up, down = _powers(len(own) + 1)
        sums = np.zeros(len(own) + 1, _U64)
        np.cumsum((own.astype(_U64) + _U64(1)) * down[:-1], out=sums[1:])
        grams = sums[GRAM:] - sums[:-GRAM]
        grams *= up[: len(own) - GRAM + 1]
        grams ^= grams >> _U64(32)
        grams *= _MIX
        keys = (grams & ~_LOW) | np.arange(len(grams), dtype=_U64)
        least = _sliding_least(keys, WINDOW - GRAM + 1)
        first = np.flatnonzero(np.r_[True, least[1:] != least[:-1]])
        place = (least[first] & _LOW).astype(np.int64)
        last = np.r_[first[1:], len(least)] - 1
        found.append((grams[place], place + piece, first + piece, last + piece))
    if not found:
        return np.empty(0, _U64), *(np.empty(0, np.int64) for _ in range(3))
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def _spots(place: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """A stretch's first window, number of windows less one, and the anchor's place behind the first, in one number."""
    return (first << 16) | ((last - first) << 8) | (place - first)


def _open_spot(spot: int) -> tuple[int, int, int]:
    return spot >> 16, (spot >> 8 & 255) + 1, spot & 255


def _anchor_rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        out = []
        for text in batch["text"]:
            data = text.encode("utf-8")
            key, place, first, last = anchors(data)
            ends = (last + WINDOW).tolist()
            stretch = [xxhash.xxh3_64_intdigest(data[a:b]) for a, b in zip(first.tolist(), ends, strict=True)]
            out.append((key.view(np.int64), np.array(stretch, _U64).view(np.int64), _spots(place, first, last)))
        yield pd.DataFrame({"k1": batch["k1"], "k2": batch["k2"], **{c: [x[j] for x in out] for j, c in enumerate(("anchor", "stretch", "spot"))}})


def _stretch_rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The bytes of the stretches a text was chosen for."""
    for batch in batches:
        out = []
        for text, chosen in zip(batch["text"], batch["chosen"], strict=True):
            data = text.encode("utf-8")
            for x in chosen:
                first, windows, at = _open_spot(x["spot"])
                out.append((x["anchor"], x["stretch"], x["n"], at, windows, data[first : first + windows - 1 + WINDOW]))
        yield pd.DataFrame(out, columns=["anchor", "stretch", "n", "at", "windows", "body"])


def _triple_rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Triples of blocks at the sampled block suffixes."""
    for batch in batches:
        out = []
        for sid, n, at, body in zip(*(batch[c].tolist() for c in ("sid", "n", "at", "body")), strict=True):
            for start in range(at % BLOCK, min(len(body), at + WHOLE * BLOCK) - 3 * BLOCK + 1, BLOCK):
                number = (start - at) // BLOCK
                if number % 3:
                    out.append((sid, number, n, body[start : start + 3 * BLOCK]))
        yield pd.DataFrame(out, columns=["sid", "number", "n", "triple"])


def _suffix_rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The block suffixes that windows reach: the names and the block of ``WHOLE`` blocks, and the bytes around them."""
    for batch in batches:
        out = []
        for sid, n, at, windows, body, numbers, names in zip(*(batch[c].tolist() for c in ("sid", "n", "at", "windows", "body", "numbers", "names")), strict=True):
            known = dict(zip(numbers.tolist(), names.tolist(), strict=True))
            for start in range(at % BLOCK, windows - 1 + BLOCK, BLOCK):
                number = (start - at) // BLOCK
                sampled = number % 3 != 0
                one, two = (known.get(number + (0 if sampled else 1) + d) for d in (0, 3))
                if one is None or two is None:
                    continue
                end = start + WHOLE * BLOCK
                block = body[end - BLOCK : end] if sampled else body[start : start + BLOCK]
                out.append((sid, number, n, sampled, one, two, block, body[max(0, start - BLOCK + 1) : start], body[end : end + BLOCK]))
        yield pd.DataFrame(out, columns=["sid", "number", "n", "sampled", "one", "two", "block", "head", "tail"])


def _ways(head: bytes, tail: bytes) -> range:
    """How many bytes of the head the windows over these ends hold; they fill up from the tail."""
    return range(BLOCK - len(tail), len(head) + 1)


def _ends(head: bytes, tail: bytes, j: int) -> bytes:
    return head[len(head) - j :] + tail[: BLOCK - j]


def _compare(group: list[tuple]) -> Iterator[tuple[int, int, int]]:
    """(sid, number, bits): the windows of neighbouring suffixes (sid, number, n, head, tail) that agree with another's."""
    if len(group) == 1:
        sid, number, n, head, tail = group[0]
        if n > 1:
            yield sid, number, (1 << len(head) + 1) - (1 << BLOCK - len(tail))
        return
    counts: dict[tuple[int, bytes], int] = defaultdict(int)
    for _, _, n, head, tail in group:
        for j in _ways(head, tail):
            counts[j, _ends(head, tail, j)] += n
    for sid, number, _, head, tail in group:
        bits = sum(1 << j for j in _ways(head, tail) if counts[j, _ends(head, tail, j)] > 1)
        if bits:
            yield sid, number, bits


def _neighbour_rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """From suffixes in order, those of one key next to each other."""
    group: list[tuple] = []
    last = None
    for batch in batches:
        out: list[tuple[int, int, int]] = []
        columns = (batch[c].tolist() for c in ("sampled", "one", "two", "block", "sid", "number", "n", "head", "tail"))
        for row in zip(*columns, strict=True):
            if row[:4] != last:
                out += _compare(group) if group else ()
                group, last = [], row[:4]
            group.append(row[4:])
        yield pd.DataFrame(out, columns=["sid", "number", "bits"])
    if group:
        yield pd.DataFrame(list(_compare(group)), columns=["sid", "number", "bits"])


def _spread_rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        out = []
        for name, n, head, tail in zip(*(batch[c].tolist() for c in ("name", "n", "head", "tail")), strict=True):
            out += [(name, n, head, tail, j, _ends(head, tail, j)) for j in _ways(head, tail)]
        yield pd.DataFrame(out, columns=["name", "n", "head", "tail", "way", "ends"])


def _range_rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The marked windows of a stretch as ranges, (lo, hi) counted from its first window."""
    for batch in batches:
        out = []
        for anchor, stretch, at, windows, numbers, bits in zip(*(batch[c].tolist() for c in ("anchor", "stretch", "at", "windows", "numbers", "bits")), strict=True):
            marked = np.zeros(windows + 2, np.int8)
            for number, own in zip(numbers.tolist(), bits.tolist(), strict=True):
                block = at + BLOCK * number
                for j in range(BLOCK):
                    if own >> j & 1:
                        marked[block - j + 1] = 1
            edges = np.flatnonzero(np.diff(marked))
            out.append((anchor, stretch, edges[::2], edges[1::2] - 1))
        yield pd.DataFrame(out, columns=["anchor", "stretch", "lo", "hi"])


def repeated_windows(stretches: DataFrame, large: int = LARGE) -> DataFrame:
    """From written distinct stretches (sid, anchor, stretch, n, at, windows, body): (anchor, stretch, lo, hi), the ranges of
    windows that stand elsewhere too."""
    triples = stretches.mapInPandas(_triple_rows, "sid long, number int, n long, triple binary")
    hashes = [F.xxhash64("triple").alias("t1"), F.xxhash64(F.lit(1), "triple").alias("t2")]
    counted = triples.groupBy("triple").agg(F.sum("n").alias("n")).where(F.col("n") > 1)
    names = counted.orderBy("triple").select(*hashes, F.monotonically_increasing_id().alias("name"))
    named = triples.select("sid", "number", *hashes).join(materialize(names, "triple-names"), ["t1", "t2"])
    # Ten blocks a stretch at most; a pair keeps number and name together.
    named = named.groupBy("sid").agg(F.collect_list(F.struct("number", "name")).alias("x"))
    named = materialize(named.select("sid", F.col("x.number").alias("numbers"), F.col("x.name").alias("names")), "block-names")
    suffixes = stretches.select("sid", "n", "at", "windows", "body").join(named, "sid").mapInPandas(
        _suffix_rows, "sid long, number int, n long, sampled boolean, one long, two long, block binary, head binary, tail binary"
    )
    suffixes = materialize(suffixes, "block-suffixes")
    key = ["sampled", "one", "two", "block"]
    many = suffixes.groupBy(*key).agg(F.count(F.lit(1)).alias("rows")).where(F.col("rows") > large)
    many = materialize(many.select(*key, F.monotonically_increasing_id().alias("name")), "large-names")
    any_large = not many.isEmpty()
    few = suffixes.join(many, key, "left_anti") if any_large else suffixes
    marked = few.repartitionByRange(*key).sortWithinPartitions(*key).mapInPandas(_neighbour_rows, "sid long, number int, bits long")
    if any_large:
        rest = materialize(suffixes.join(many, key).drop(*key), "large-suffixes")
        ends = rest.groupBy("name", "head", "tail").agg(F.sum("n").alias("n"))
        windows = ends.mapInPandas(_spread_rows, "name long, n long, head binary, tail binary, way int, ends binary")
        windows = materialize(windows, "large-windows")
        twice = windows.groupBy("name", "way", "ends").agg(F.sum("n").alias("n")).where(F.col("n") > 1).drop("n")
        twice = windows.drop("n").join(materialize(twice, "repeated-ends"), ["name", "way", "ends"])
        bits = twice.groupBy("name", "head", "tail").agg(F.expr("bit_or(shiftleft(1L, way))").alias("bits"))
        bits = rest.select("sid", "number", "name", "head", "tail").join(materialize(bits, "large-bits"), ["name", "head", "tail"])
        marked = marked.unionByName(bits.select("sid", "number", "bits"))
    marks = marked.groupBy("sid").agg(F.collect_list(F.struct("number", "bits")).alias("x"))
    marks = marks.select("sid", F.col("x.number").alias("numbers"), F.col("x.bits").alias("bits"))
    ranges = stretches.select("sid", "anchor", "stretch", "at", "windows").join(marks, "sid")
    return ranges.mapInPandas(_range_rows, "anchor long, stretch long, lo array<long>, hi array<long>")


def _cut_rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        sizes, spans, kept = [], [], []
        for text, starts, stops in zip(batch["text"], batch["starts"], batch["stops"], strict=True):
            data = text.encode("utf-8")
            sizes.append(len(data))
            if starts is None:
                spans.append([])
                kept.append(data)
                continue
            depth = np.zeros(len(data) + 1, np.int64)
            np.add.at(depth, starts, 1)
            np.add.at(depth, stops, -1)
            gone = np.cumsum(depth[:-1]) > 0
            edges = np.flatnonzero(np.diff(np.r_[0, gone.astype(np.int8), 0]))
            spans.append([{"start": a, "stop": b} for a, b in zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True)])
            kept.append(np.frombuffer(data, np.uint8)[~gone].tobytes())
        yield pd.DataFrame({"id": batch["id"], "n_bytes": sizes, "spans": spans, "kept": kept})


def without_repeats(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", large: int = LARGE) -> DataFrame:
    """(id, n_bytes, spans, kept) of every row: the maximal runs of bytes to be removed from its text in UTF-8, and the other
    bytes, which need not be whole characters.

    Null text is empty; texts shorter than a window lose nothing; repeated rows are copies of each other, so all their windows
    go; null ids are kept; an empty table gives no rows; columns of other names take no part.
    """
    text = whole_text(text_column)
    rows = docs.select(F.col(id_column).cast("long").alias("id"), text.alias("text"))
    rows = rows.select("*", F.xxhash64("text", "id").alias("k1"), F.xxhash64("id", F.lit(1), "text").alias("k2"))
    key = ["k1", "k2"]
    texts = rows.select(*key, "text")
    copies = rows.groupBy(*key).agg(F.count(F.lit(1)).alias("copies")).where(F.col("copies") > 1)
    copies = materialize(copies, "repeated-rows")
    repeats = not copies.isEmpty()
    if repeats:
        # Rows of equal id and text are looked at once; only these texts are grouped.
        again = texts.join(copies.select(*key), key, "left_semi").groupBy(*key).agg(F.any_value("text").alias("text"))
        texts = materialize(texts.join(copies, key, "left_anti").unionByName(again), "texts-once")
    filed = texts.mapInPandas(_anchor_rows, "k1 long, k2 long, anchor array<long>, stretch array<long>, spot array<long>")
    filed = materialize(filed, "byte-anchors")

    def weighted(table: DataFrame) -> DataFrame:
        if not repeats:
            return table.withColumn("copies", F.lit(1))
        return table.join(copies, key, "left").withColumn("copies", F.coalesce("copies", F.lit(1)))

    seen = filed.select(*key, F.explode(F.arrays_zip("anchor", "stretch", "spot")).alias("x")).select(*key, "x.*")
    repeated = weighted(filed.select(*key, F.explode("anchor").alias("anchor"))).groupBy("anchor").agg(F.sum("copies").alias("n"))
    repeated = materialize(repeated.where(F.col("n") > 1).select("anchor"), "repeated-anchors")
    hits = materialize(seen.join(repeated, "anchor"), "anchor-hits")

    chosen = weighted(hits).groupBy("anchor", "stretch").agg(F.sum("copies").alias("n"), F.min(F.struct(*key, "spot")).alias("at"))
    chosen = chosen.groupBy(F.col("at.k1").alias("k1"), F.col("at.k2").alias("k2")).agg(
        F.collect_list(F.struct("anchor", "stretch", "n", "at.spot")).alias("chosen")
    )
    chosen = materialize(chosen, "chosen-stretches")
    keys = chosen.select(*key)
    wanted = texts.join(F.broadcast(keys), key, "left_semi") if at_most(keys, MOST_KEYS) else texts
    stretches = wanted.join(chosen, key).select("text", "chosen").mapInPandas(
        _stretch_rows, "anchor long, stretch long, n long, at int, windows int, body binary"
    )
    stretches = materialize(stretches.withColumn("sid", F.monotonically_increasing_id()), "stretches")
    ranges = materialize(repeated_windows(stretches, large), "stretch-ranges")
    flags = hits.select("anchor", "stretch", *key, F.expr("shiftright(spot, 16)").alias("first")).join(ranges, ["anchor", "stretch"])
    flags = flags.select(*key, "first", F.explode(F.arrays_zip("lo", "hi")).alias("x"))
    flags = flags.groupBy(*key).agg(F.collect_list(F.struct((F.col("first") + F.col("x.lo")).alias("a"), (F.col("first") + F.col("x.hi") + WINDOW).alias("b"))).alias("x"))
    flags = materialize(flags.select(*key, F.col("x.a").alias("starts"), F.col("x.b").alias("stops")), "text-flags")

    keys = flags.select(*key)
    if at_most(keys, MOST_KEYS):
        # Texts that lose nothing stay where they are.
        whole = rows.join(F.broadcast(keys), key, "left_anti").select("id", "text")
        none = F.lit(None).cast("array<long>")
        marked = rows.join(F.broadcast(keys), key, "left_semi").join(flags, key).select("id", "text", "starts", "stops")
        marked = marked.unionByName(whole.select("id", "text", none.alias("starts"), none.alias("stops")))
    else:
        marked = rows.join(flags, key, "left").select("id", "text", "starts", "stops")
    return marked.mapInPandas(_cut_rows, "id long, n_bytes long, spans array<struct<start:long,stop:long>>, kept binary")


def op13_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = without_repeats(read_table(spark, sf_dir, "documents"))
    return done.select(
        F.col("id").alias("doc_id"),
        "n_bytes",
        (F.col("n_bytes") - F.octet_length("kept")).alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )
