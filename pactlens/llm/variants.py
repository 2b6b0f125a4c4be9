"""Spelling variants: words one letter apart, found by PartEnum signatures of their letters.

A word's letters are a multiset, and as a binary vector have a place for each (letter, how often it came before).  One letter
inserted, deleted or replaced changes at most two places.  PartEnum deals the places to three first-level partitions, so
that of vectors at most two apart one partition at least is equal, whole; each partition gives an exact signature, and
equal signatures are joined.

Letters alone do not tell words that are made of the same syllables, so a signature also holds what one edit leaves in
place.  Cut the shorter word into ``PARTS`` stretches: the edit lies in one of them, and what stands before and after it
is equal in both words.  The signature of (partition, stretch) holds the partition and the letters around the stretch.

Where more than ``GROUP`` words share a signature, they are posted again with the stretch cut in halves, of which the edit
touches one, until it is a single letter.  So no pair is lost and no group stays large.  Candidates are verified by their
edit distance.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pandas as pd
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pactlens.llm.text import read_table, whole_text
from pactlens.session import materialize

SHORTEST = 7
LEAST_COUNT = 2
RATIO = 10
DELETE_EVERY = 31
PARTITIONS = 3
PARTS = 4
GROUP = 256
WORDS_PER_TASK = 40_000
#: Words counted in a task before their counts are passed on.
MOST_WORDS = 200_000
_RUN = re.compile(rb"[a-z\xc0-\xff]+")
POSTED = "sig long, word string, n long, m int, lo int, hi int, part int"


def text_words(doc_id: str | None, text: str, shortest: int) -> Iterator[bytes]:
    """The text's words of at least ``shortest`` letters, in Latin 1, with the letters that the ids' checksums delete.

    Characters beyond Latin 1 end a word like any other that is no letter.  A row without id loses no letter.
    """
    start = None if doc_id is None else zlib.crc32(f"{doc_id}:".encode())
    for word in _RUN.findall(text.encode("latin-1", "replace").lower()):
        if len(word) < shortest:
            continue
        if start is not None:
            h = zlib.crc32(word if word.isascii() else word.decode("latin-1").encode(), start)
            if h % DELETE_EVERY == 0:
                at = h % len(word)
                word = word[:at] + word[at + 1 :]
                if len(word) < shortest:
                    continue
        yield word


def _count_rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    def table():
        return pd.DataFrame({"word": [w.decode("latin-1") for w in counts], "n": list(counts.values())})

    counts: Counter[bytes] = Counter()
    for batch in batches:
        ids = batch["id"].astype(object).where(batch["id"].notna(), None)
        for doc_id, text in zip(ids, batch["text"], strict=True):
            counts.update(text_words(doc_id, text, SHORTEST))
            if len(counts) >= MOST_WORDS:
                yield table()
                counts.clear()
    if counts:
        yield table()


def word_counts(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", least: int = LEAST_COUNT) -> DataFrame:
    """(word, n): the distinct words of all texts that occur at least ``least`` times.

    Null and empty texts have no words; repeated rows count each; an empty table gives no rows.  A word is counted in its
    task first, so one that stands in every text costs a row per task.
    """
    # As text, for an id column with nulls reaches Python as floats, which do not hold every id.
    rows = docs.select(F.col(id_column).cast("long").cast("string").alias("id"), whole_text(text_column).alias("text"))
    counted = rows.mapInPandas(_count_rows, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return counted.where(F.col("n") >= least)


class Signatures:
    """Partitions of letter multisets, remembered by (letter, occurrence)."""

    def __init__(self, partitions: int = PARTITIONS):
        self.partitions = partitions
        self.places: dict[tuple[str, int], tuple[int, int]] = {}

    def partition_hashes(self, word: str) -> list[int]:
        """For each partition a hash of the places set in it, whatever their order."""
        out, seen = [0] * self.partitions, {}
        for letter in word:
            before = seen[letter] = seen.get(letter, -1) + 1
            place = self.places.get((letter, before))
            if place is None:
                value = xxhash.xxh3_64_intdigest(f"{letter}{before}".encode())
                place = self.places[letter, before] = (value % self.partitions, value >> 2)
            out[place[0]] = (out[place[0]] + place[1]) & 0xFFFFFFFFFFFFFFFF
        return out

    @staticmethod
    def signature(word: str, m: int, lo: int, hi: int, part: int, value: int) -> int:
        """Of one partition, and of the letters before ``lo`` and from ``hi`` on, counted in a word of ``m`` letters."""
        key = f"{word[:lo]}\t{word[len(word) - (m - hi):] if m > hi else ''}\t{m},{lo},{hi},{part},{value}"
        return xxhash.xxh3_64_intdigest(key.encode()) - (1 << 63)


def _post_rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """All signatures of words: for a partner of the same length or longer (m: its own length), and for a shorter one."""
    signatures = Signatures()
    for batch in batches:
        out = []
        for word, n in zip(batch["word"], batch["n"].tolist(), strict=True):
            values = signatures.partition_hashes(word)
            for m in (len(word), len(word) - 1):
                for j in range(PARTS):
                    lo, hi = m * j // PARTS, m * (j + 1) // PARTS
                    out += [(signatures.signature(word, m, lo, hi, p, v), word, n, m, lo, hi, p) for p, v in enumerate(values)]
        yield pd.DataFrame(out, columns=[c.split()[0] for c in POSTED.split(", ")])


def _split_rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Signatures with the free stretch cut in halves."""
    signatures = Signatures()
    for batch in batches:
        out = []
        for _, word, n, m, lo, hi, part in batch.itertuples(index=False):
            value = signatures.partition_hashes(word)[part]
            mid = (lo + hi) // 2
            out += [(signatures.signature(word, m, a, b, part, value), word, n, m, a, b, part) for a, b in ((lo, mid), (mid, hi))]
        yield pd.DataFrame(out, columns=[c.split()[0] for c in POSTED.split(", ")])


def near_pairs(words: DataFrame, group: int = GROUP) -> DataFrame:
    """(a, an, b, bn): each pair of words one inserted, deleted or replaced code point apart, once, with their counts."""
    # A word makes two dozen rows: a small table of words is much work.
    tasks = max(words.sparkSession.sparkContext.defaultParallelism, -(-words.count() // WORDS_PER_TASK))
    dealt = words.select("word", "n").repartition(tasks, "word")
    posted = materialize(dealt.mapInPandas(_post_rows, POSTED), "letter-signatures")
    ready = []
    while True:
        large = posted.groupBy("sig").agg(F.count(F.lit(1)).alias("size")).where(F.col("size") > group).select("sig")
        large = materialize(large, "large-signatures")
        if large.isEmpty():
            ready.append(posted)
            break
        # A stretch of one letter is as fine as can be: such a group holds an alphabet's worth of words.
        fine = F.col("hi") - F.col("lo") <= 1
        marked = posted.join(large.withColumn("large", F.lit(True)), "sig", "left")
        again = F.col("large").isNotNull() & ~fine
        ready.append(marked.where(~again).drop("large"))
        split = marked.where(again).drop("large")
        if split.isEmpty():
            break
        posted = materialize(split.mapInPandas(_split_rows, POSTED), "letter-signatures")
    pairs = None
    for rows in ready:
        rows = rows.select("sig", "word", "n", "m")
        short = rows.where(F.length("word") == F.col("m")).select("sig", F.col("word").alias("a"), F.col("n").alias("an"))
        other = rows.select("sig", F.col("word").alias("b"), F.col("n").alias("bn"))
        longer = F.length("b") > F.length("a")
        found = short.join(other, "sig").where((longer | (F.length("b") == F.length("a")) & (F.col("b") > F.col("a"))) & (F.levenshtein("a", "b", 1) == 1))
        pairs = found.drop("sig") if pairs is None else pairs.unionByName(found.drop("sig"))
    return pairs.distinct()


def variant_groups(words: DataFrame, ratio: int = RATIO, group: int = GROUP) -> DataFrame:
    """From distinct (word, n): word, n, ``n_near`` (words one edit away), ``form`` (the near word of largest n, the smallest
    of equals, if its n is at least ``ratio`` times the word's; else null), ``form_n`` and ``root``, where forms end.

    Forms have larger counts than their words, so they never form a circle.  An empty table gives no rows.
    """
    words = materialize(words, "word-counts")
    pairs = materialize(near_pairs(words, group), "near-words")
    both = pairs.select(F.col("a").alias("word"), F.col("an").alias("own"), F.col("b").alias("near"), F.col("bn").alias("n"))
    both = both.unionByName(pairs.select(F.col("b").alias("word"), F.col("bn").alias("own"), F.col("a").alias("near"), F.col("an").alias("n")))
    # One near word at least is there, so ``own`` and ``best`` are set.
    best = both.groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"), F.max("own").alias("own"), F.min(F.struct((-F.col("n")).alias("less"), F.col("near").alias("near"))).alias("best")
    )
    is_form = -F.col("best.less") >= ratio * F.col("own")
    best = materialize(
        best.select("word", "n_near", F.when(is_form, F.col("best.near")).alias("form"), F.when(is_form, -F.col("best.less")).alias("form_n")), "word-forms"
    )
    forms = best.where("form is not null").select("word", "form")
    roots = forms.withColumnRenamed("form", "root")
    while True:
        ahead = roots.select(F.col("word").alias("root"), F.col("root").alias("further"))
        moved = materialize(roots.join(ahead, "root", "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")), "word-roots")
        roots = moved.select("word", "root")
        if moved.where("moved").isEmpty():
            break
    found = words.join(best, "word", "left").join(roots, "word", "left")
    return found.select("word", "form", F.coalesce("root", "word").alias("root"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), "form_n")


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variant_groups(word_counts(read_table(spark, sf_dir, "documents")))
