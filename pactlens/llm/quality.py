"""Quality of documents by a byte-level convolutional network, see bytenet.

The network learns from at most ``SAMPLE`` labelled documents, the least by a hash of their id, each by at most
``SAMPLE_CHUNKS`` chunks spread over the whole text; this bounds what reaches the driver, whatever the size of the table.
Scoring reads every byte of every document, in blocks of chunks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pactlens.llm.bytenet import CHUNK, ByteNet, chunks_of
from pactlens.llm.text import read_table, whole_text

SAMPLE = 6000
SAMPLE_CHUNKS = 8
EPOCHS = 5
BATCH = 32
#: A small sample is gone through more often.
LEAST_STEPS = 600
FOLDS = 5
THRESHOLD = 0.3
_SEED = 6


def held_out(id_column: Column, folds: int = FOLDS) -> Column:
    """Rows whose crc32 of the id as text divides by ``folds``; a null id is not held out."""
    return F.coalesce(F.crc32(id_column.cast("string")) % folds == 0, F.lit(False))


def _sample_chunks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        out = []
        for text in batch["text"]:
            chunks = chunks_of(text.encode("utf-8", "replace"))
            if len(chunks) > SAMPLE_CHUNKS:
                chunks = chunks[np.linspace(0, len(chunks) - 1, SAMPLE_CHUNKS).astype(int)]
            out.append(chunks.astype("<i2").tobytes())
        yield pd.DataFrame({"id": batch["id"], "label": batch["label"], "chunks": out})


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> ByteNet | float:
    """A network fitted to the labelled documents that are not held out; the share of label 1 where only one label, or none
    (then 1), is at hand.  Of several labels of an id the greatest counts."""
    known = labels.where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    known = known.groupBy("doc_id").agg(F.max("quality").cast("double").alias("label"))
    known = known.orderBy(F.xxhash64(F.lit(_SEED), "doc_id"), "doc_id").limit(sample).withColumnRenamed("doc_id", "id")
    # At most ``sample`` rows of 16 bytes.
    rows = docs.select(F.col("doc_id").alias("id"), whole_text().alias("text")).join(F.broadcast(known), "id")
    found = rows.mapInPandas(_sample_chunks, "id long, label double, chunks binary").limit(2 * sample).toPandas()
    found["chunks"] = [bytes(x) for x in found["chunks"]]
    found = found.drop_duplicates().sort_values(["id", "chunks"]).reset_index(drop=True)
    y = found["label"].to_numpy(np.float32)
    if not 0 < y.sum() < len(y):
        return float(y.mean()) if len(y) else 1.0
    net = ByteNet()
    epochs = max(EPOCHS, -(-LEAST_STEPS * BATCH // len(y)))
    net.fit([np.frombuffer(x, "<i2").reshape(-1, CHUNK).astype(np.int16) for x in found["chunks"]], y, epochs, BATCH)
    return net


def _score_rows(net: ByteNet | float):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts = [t.encode("utf-8", "replace") for t in batch["text"]]
            score = net.score(texts) if isinstance(net, ByteNet) else np.full(len(texts), net)
            yield batch.drop(columns="text").assign(score=score)

    return run


def scores(docs: DataFrame, net: ByteNet | float) -> DataFrame:
    """(id, score) of every row of (doc_id, text); null text is empty."""
    rows = docs.select(F.col("doc_id").cast("long").alias("id"), whole_text().alias("text"))
    return rows.mapInPandas(_score_rows(net), "id long, score double")


def drop_rejected(docs: DataFrame, net: ByteNet | float, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs``, all columns, that score at least ``threshold``."""
    def one(texts: pd.Series) -> pd.Series:
        if not isinstance(net, ByteNet):
            return pd.Series(np.full(len(texts), net))
        return pd.Series(net.score([t.encode("utf-8", "replace") for t in texts]))

    score = F.pandas_udf(one, "double")
    packed = docs.select(F.struct("*").alias("row"), whole_text().alias("text"))
    return packed.where(score("text") >= threshold).select("row.*")


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = scores(docs, train(docs, read_table(spark, sf_dir, "labels")))
    return scored.select(F.col("id").alias("doc_id"), held_out(F.col("id")).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
