"""Language-model scoring by online logistic mixing of hashed contexts, see mixnet, beside a unigram base.

All training documents count: their words for the base, their bits for the tables.  Tables have a fixed size and are added
up by Spark, block by block and in levels, so no group grows with the number of tasks.  Training documents of one fold are
left out of the bit tables; the mixing weights learn from them, and the tasks' weights are averaged.

Documents are dealt to blocks of bounded size by hash.  A block asks for the counts of its distinct words, and is scored
with them; the vocabulary is never held as a whole anywhere.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pactlens.llm.mixnet import ORDERS, SLOT_BITS, Mixer, count_bits, first_weights, stream, tables
from pactlens.llm.text import read_table, whole_text
from pactlens.session import materialize

FOLDS = 10
END = b"\n"
BLOCK_BYTES = 12_000_000
#: Bytes of documents that are scored together.
STEP_BYTES = 1_000_000
MOST_COUNTED = 400_000
PIECE = 1 << 15
FAN_IN = 64
_TOP = np.iinfo(np.uint32).max // 4


def fold(id_column: Column, folds: int = FOLDS) -> Column:
    """crc32 of the id as text modulo ``folds``; a null id is in the last fold, so it is learned from."""
    return F.coalesce(F.crc32(id_column.cast("string")) % folds, F.lit(folds - 1))


def tokens(text: str) -> list[bytes]:
    """Words with A-Z in lower case."""
    return text.encode("utf-8", "replace").lower().split()


def word_key(word: bytes) -> int:
    return xxhash.xxh3_64_intdigest(word) - (1 << 63)


def _word_counts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    counts: Counter = Counter()

    def rows() -> pd.DataFrame:
        out = pd.DataFrame({"word": [word_key(w) for w in counts], "n": list(counts.values())})
        counts.clear()
        return out

    for batch in batches:
        for text in batch["text"]:
            counts.update(tokens(text))
            if len(counts) >= MOST_COUNTED:
                yield rows()
    yield rows()


def _bit_counts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    counts = np.zeros((ORDERS, 2 << SLOT_BITS), np.uint32)
    for batch in batches:
        count_bits([stream(tokens(t)) for t in batch["text"]], counts)
    flat = counts.reshape(-1, PIECE)
    used = np.flatnonzero(flat.any(axis=1))
    for at in range(0, len(used), 64):
        some = used[at : at + 64]
        yield pd.DataFrame({"piece": some, "part": [int(xxhash.xxh3_64_intdigest(flat[i].tobytes()) >> 1) for i in some], "counts": [flat[i].astype("<u4").tobytes() for i in some]})


def _add_pieces(rows: pd.DataFrame) -> pd.DataFrame:
    total = np.zeros(PIECE, np.uint64)
    for x in rows["counts"]:
        total += np.frombuffer(x, "<u4")
    while total.max() > _TOP:  # both counts of all slots of the piece are halved; the chances stay
        total >>= np.uint64(1)
    return pd.DataFrame({"piece": [rows["piece"].iat[0]], "part": [int(rows["part"].min())], "counts": [total.astype("<u4").tobytes()]})


def bit_tables(texts: DataFrame) -> np.ndarray:
    """The logits of all slots, from all rows of (text); ORDERS * 2^SLOT_BITS bytes."""
    schema = "piece int, part long, counts binary"
    pieces = materialize(texts.select("text").mapInPandas(_bit_counts, schema), "bit-counts")
    while True:
        most = pieces.groupBy("piece").count().agg(F.max("count")).head()[0] or 0
        if most <= 1:
            break
        groups = -(-most // FAN_IN)
        pieces = pieces.groupBy("piece", F.pmod("part", F.lit(groups))).applyInPandas(_add_pieces, schema)
        pieces = materialize(pieces, "bit-counts")
    counts = np.zeros((ORDERS * (2 << SLOT_BITS) // PIECE, PIECE), np.uint32)
    for row in pieces.select("piece", "counts").toLocalIterator():  # one row for each piece of fixed tables
        counts[row["piece"]] = np.frombuffer(row["counts"], "<u4")
    return tables(counts.reshape(ORDERS, 2 << SLOT_BITS))


def mixing_weights(texts: DataFrame, table) -> np.ndarray:
    """Weights after an online pass over all rows of (text), averaged over tasks by the bytes they saw."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        mixer, seen = Mixer(table.value, first_weights()), 0
        for batch in batches:
            streams = [stream(tokens(t)) for t in batch["text"]]
            mixer.learn(streams)
            seen += sum(map(len, streams))
        flat = mixer.weights.reshape(-1).astype(float)
        yield pd.DataFrame({"i": range(len(flat)), "total": flat * seen, "seen": float(seen)})

    rows = texts.select("text").mapInPandas(run, "i int, total double, seen double").groupBy("i").agg(F.sum("total").alias("total"), F.sum("seen").alias("seen")).toPandas()
    start = first_weights()
    if not len(rows) or not rows["seen"].min() > 0:
        return start
    flat = np.round((rows.sort_values("i")["total"] / rows.sort_values("i")["seen"]).to_numpy(), 4)
    return flat.astype(np.float32).reshape(start.shape)


def _asked(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """(block, word): the distinct words of a task's blocks, sent on when many have come together."""
    seen: dict[int, set] = {}

    def rows() -> pd.DataFrame:
        found = [np.array([word_key(w) for w in own], np.int64) for own in seen.values()]
        out = pd.DataFrame({"block": np.repeat(np.array(list(seen), np.int32), [len(x) for x in found]), "word": np.concatenate([np.empty(0, np.int64), *found])})
        seen.clear()
        return out

    for batch in batches:
        held = sum(map(len, seen.values()))
        for block, text in zip(batch["block"], batch["text"], strict=True):
            own = seen.setdefault(block, set())
            held -= len(own)
            own.update(tokens(text))
            held += len(own)
            if held >= MOST_COUNTED:
                yield rows()
                held = 0
    yield rows()


def _score_block(table, weights: np.ndarray, n_ends: int, total: int, distinct: int):
    smooth = total + 0.1 * (distinct + 1)

    def run(key: tuple, docs: pd.DataFrame, found: pd.DataFrame) -> pd.DataFrame:
        counts = dict(zip(found["word"].tolist(), found["n"].tolist(), strict=True))
        by_word: dict[bytes, int] = {}
        mixer = Mixer(table.value, weights)
        out: dict = {c: [] for c in ("id", "n_tokens", "n_known", "base_score", "score")}
        waiting: list = []

        def flush() -> None:
            if waiting:
                scores = mixer.scores([s for s, _ in waiting], [p for _, p in waiting])
                out["score"].extend((scores / math.log(10)).tolist())
                waiting.clear()

        size = 0
        for name, text in zip(docs["id"], docs["text"], strict=True):
            own = tokens(text)
            seen = np.empty(len(own) + 1)
            for i, w in enumerate(own):
                c = by_word.get(w)
                if c is None:
                    c = by_word[w] = counts.get(word_key(w), 0)
                seen[i] = c
            seen[-1] = n_ends
            chance = (seen + 0.1) / smooth
            out["id"].append(name)
            out["n_tokens"].append(len(seen))
            out["n_known"].append(int((seen > 0).sum()))
            out["base_score"].append(float(np.log10(chance).sum()))
            waiting.append((stream(own), np.where(seen > 0, np.log(chance), -np.inf)))
            size += len(waiting[-1][0])
            if size >= STEP_BYTES:
                flush()
                size = 0
        flush()
        return pd.DataFrame(out)

    return run


def score_texts(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(id, held_out, n_tokens, n_known, train_tokens, base_score, score) of every row.

    Null text is empty and has the end token only.  Without training rows all counts are 0 and every bit is even.  Repeated
    rows each count and each give a row; an empty table gives none.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_column).cast("long").alias("id"), whole_text(text_column).alias("text"))
    rows = rows.withColumn("fold", fold(F.col("id")))
    training = rows.where("fold <> 0")
    vocabulary = training.select("text").mapInPandas(_word_counts, "word long, n long").groupBy("word").agg(F.sum("n").alias("n"))
    vocabulary = materialize(vocabulary, "vocabulary")
    n_words, n_distinct = vocabulary.agg(F.sum("n"), F.count(F.lit(1))).head()
    n_docs, size = rows.agg(F.count(F.when(F.col("fold") != 0, 1)), F.sum(F.octet_length("text"))).head()
    total, distinct = (n_words or 0) + n_docs, n_distinct + (1 if n_docs else 0)

    table = spark.sparkContext.broadcast(bit_tables(rows.where("fold > 1")))
    weights = mixing_weights(rows.where("fold = 1"), table)

    blocks = max(1, -(-(size or 0) // BLOCK_BYTES))
    dealt = rows.select("id", "text", F.pmod(F.xxhash64("id", "text"), F.lit(blocks)).cast("int").alias("block")).repartition(blocks, "block")
    # All columns, though ids are not asked for: both uses of the dealt texts are then one shuffle.
    # Words that are dealt for the join are made distinct where they have come.
    asked = dealt.mapInPandas(_asked, "block int, word long").repartition("word").distinct()
    found = asked.join(vocabulary, "word").select("block", "word", "n")
    both = dealt.groupBy("block").cogroup(found.groupBy("block"))
    scored = both.applyInPandas(_score_block(table, weights, n_docs, total, distinct), "id long, n_tokens long, n_known long, base_score double, score double")
    held = fold(F.col("id")) == 0
    return scored.select("id", held.alias("held_out"), "n_tokens", "n_known", F.lit(total).cast("long").alias("train_tokens"), "base_score", "score")


def op10_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_texts(read_table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")
