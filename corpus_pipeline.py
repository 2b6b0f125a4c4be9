"""A run over a corpus: reject junk, drop boilerplate lines, keep one of each group of near duplicates, mix the sources to
their target weights, and encode what is left.

Each stage is written as Parquet to the shared folder and read again by the next.  All but the last return the columns of
``documents``.  Python workers serve one stage after another and keep what they hold, so all stages bound their batches.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pactlens.llm.bpe import encode_digests
from pactlens.llm.lines import drop_boilerplate
from pactlens.llm.mixing import apply_mix
from pactlens.llm.neardup import keep_one
from pactlens.llm.quality import drop_rejected, train
from pactlens.llm.text import read_table
from pactlens.session import bound_batches, materialize, ship_package


def reject_junk(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the quality classifier does not reject."""
    ship_package(spark)
    bound_batches(spark)
    return drop_rejected(docs, train(docs, read_table(spark, sf_dir, "labels")))


def drop_boilerplate_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that stand on many sites; ``n_chars`` follows the text.  Documents that lose nothing,
    and null texts, stay as they are."""
    ship_package(spark)
    bound_batches(spark)
    done = drop_boilerplate(docs)
    changed = F.col("n_removed") > 0
    columns = []
    for c in docs.columns:
        old = F.col("row").getField(c)
        new = {"text": F.col("kept"), "n_chars": F.length("kept").cast(docs.schema[c].dataType)}.get(c, old)
        columns.append(F.when(changed, new).otherwise(old).alias(c))
    return done.select(*columns)


def keep_one_of_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every class of near duplicates, the one of the least id."""
    ship_package(spark)
    bound_batches(spark)
    return keep_one(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    ship_package(spark)
    bound_batches(spark)
    return apply_mix(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """For every document the number of its token ids and digests of the ids and of what they decode to."""
    ship_package(spark)
    bound_batches(spark)
    return encode_digests(docs).withColumnRenamed("id", "doc_id")


STAGES = [
    ("quality classifier", reject_junk),
    ("line dedup", drop_boilerplate_lines),
    ("MinHash near-dedup", keep_one_of_near_duplicates),
    ("mixing sources to target weights", mix_sources),
    ("BPE encoding and decoding", encode),
]

#: A network, an alignment and a tokenizer are beyond SQL; tests check counts and ids of each stage, and the operators apart.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
