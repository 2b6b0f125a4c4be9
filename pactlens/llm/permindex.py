"""Nearest neighbours by a permutation index.

Pivots are a bounded sample of the vectors.  A vector is represented by its ``PREFIX`` nearest pivots in order.  Every
vector is posted in the inverted file of each pivot of its prefix, with the pivot's place.  A query adds up, over the files
of its own prefix, what two prefixes have in common: with weights w = PREFIX - place, the footrule distance of two
prefixes is a constant minus twice the sum of min(w of the query, w of the vector) over shared pivots.  The candidates of
least footrule distance are reranked by the inner product in double precision.

Nearness is the largest inner product.  Vectors get one more coordinate that gives them all the norm of the longest, and
queries a zero there; angles then order as inner products do, whatever the norms.

The index is cut into shards by hash and the queries into blocks; each pair of a shard and a block is one group, of bounded
size.  Equal vectors are one entry with its least ids: a result can show at most ``TOP`` of them and the query's own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pactlens.llm.text import read_table
from pactlens.session import materialize

TOP = 20
EVERY = 20
PIVOTS = 256
PREFIX = 64
#: Share of a shard that is reranked, and the least number.
RERANKED = 0.2
LEAST_RERANKED = 600
SHARD_ROWS = 4096
BLOCK_QUERIES = 4096


def _valid_rows(vectors: DataFrame, id_column: str, vector_column: str) -> DataFrame:
    """(id, vec): rows with an id and a vector that is not null, empty or zero and whose components are all finite."""
    v = F.col(vector_column).cast("array<double>")
    rows = vectors.select(F.col(id_column).cast("long").alias("id"), v.alias("vec"))
    return rows.where(F.col("id").isNotNull() & F.coalesce(F.forall("vec", lambda x: x.isNotNull()), F.lit(False))).where(
        F.forall("vec", lambda x: ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("vec", lambda x: x != 0)
    )


def _pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        packed = [(np.asarray(v, "<f8") + 0.0).tobytes() for v in batch["vec"]]
        norms = [float(np.sqrt(np.square(np.frombuffer(v, "<f8")).sum())) for v in packed]
        yield pd.DataFrame({"id": batch["id"], "vec": packed, "norm": norms})


def _matrix(column: pd.Series) -> np.ndarray:
    return np.frombuffer(b"".join(column), "<f8").reshape(len(column), -1)


def prefixes(vectors: np.ndarray, pivots: np.ndarray, norm: float | None, prefix: int = PREFIX) -> np.ndarray:
    """For each vector its nearest pivots in order.  ``norm``: that of the longest vector, for rows of the index."""
    rest = np.zeros(len(vectors)) if norm is None else np.sqrt(np.maximum(norm * norm - np.square(vectors).sum(axis=1), 0))
    near = np.c_[vectors, rest] @ pivots.T
    return np.argsort(-near, axis=1, kind="stable")[:, : min(prefix, len(pivots))].astype(np.int16)


class Shard:
    """Inverted files of the pivots over some vectors."""

    def __init__(self, vectors: np.ndarray, pivots: np.ndarray, norm: float):
        self.vectors = vectors
        order = prefixes(vectors, pivots, norm)
        self.size = order.shape[1]
        posted = order.reshape(-1)
        by_pivot = np.argsort(posted, kind="stable")
        self.rows = by_pivot // self.size
        self.weights = (self.size - by_pivot % self.size).astype(np.int32)
        self.starts = np.searchsorted(posted[by_pivot], np.arange(len(pivots) + 1))

    def candidates(self, prefix: np.ndarray, number: int) -> np.ndarray:
        """Rows of least footrule distance to a query's prefix; all, if there are not more than ``number``."""
        if len(self.vectors) <= number:
            return np.arange(len(self.vectors))
        common = np.zeros(len(self.vectors), np.int32)
        for place, pivot in enumerate(prefix):
            at = slice(self.starts[pivot], self.starts[pivot + 1])
            common[self.rows[at]] += np.minimum(self.weights[at], self.size - place)
        return np.argpartition(-common, number)[:number]


def _search(pivots: np.ndarray, norm: float, top: int):
    def run(key: tuple, index: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        out = {"query": [], "ids": [], "scores": []}
        if len(index) and len(queries):
            index = index.sort_values("vec").reset_index(drop=True)
            shard = Shard(_matrix(index["vec"]), pivots, norm)
            ids = [np.asarray(x) for x in index["ids"]]
            number = max(LEAST_RERANKED, int(np.ceil(RERANKED * len(index))))
            wanted = _matrix(queries["vec"])
            for name, vec, prefix in zip(queries["query"], wanted, prefixes(wanted, pivots, None), strict=True):
                rows = np.sort(shard.candidates(prefix, number))
                scores = shard.vectors[rows] @ vec
                if len(rows) > top:  # distinct vectors: those beyond the ``top`` best cannot show
                    edge = np.partition(scores, -top)[-top]
                    keep = scores >= edge
                    rows, scores = rows[keep], scores[keep]
                found_ids = np.concatenate([ids[r] for r in rows])
                found = np.repeat(scores, [len(ids[r]) for r in rows])
                order = np.lexsort((found_ids, -found))[:top]
                out["query"].append(name)
                out["ids"].append(found_ids[order])
                out["scores"].append(found[order])
        return pd.DataFrame(out)

    return run


def nearest(vectors: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding", every: int = EVERY, top: int = TOP) -> DataFrame:
    """(query_id, rank, vec_id, score): for each row whose id is divisible by ``every`` its nearest other rows.

    Rows without an id, and vectors that are null, empty, zero or hold null or non-finite components, take no part; nor do
    vectors of another dimension than most (the smaller of equally frequent ones).  Repeated rows count once.  Rows of one
    id are never each other's neighbours.  An empty table gives no rows.
    """
    spark = vectors.sparkSession
    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    valid = _valid_rows(vectors, id_column, vector_column)
    sizes = valid.groupBy(F.size("vec").alias("size")).count().orderBy(F.desc("count"), "size").head()
    if sizes is None:
        return empty
    rows = valid.where(F.size("vec") == sizes["size"]).mapInPandas(_pack, "id long, vec binary, norm double")
    rows = materialize(rows.distinct().withColumn("query", F.md5("vec")), "vectors")
    norm = rows.agg(F.max("norm")).head()[0]

    wanted = rows.where(F.col("id") % every == 0).select("id", "query", "vec")
    least = F.row_number().over(Window.partitionBy("query").orderBy("id"))
    entries = rows.withColumn("place", least).where(F.col("place") <= top + 1).groupBy("query").agg(F.first("vec").alias("vec"), F.collect_list("id").alias("ids"))
    entries = materialize(entries, "entries")
    queries = materialize(wanted.groupBy("query").agg(F.first("vec").alias("vec")), "queries")
    sample = entries.orderBy("query").limit(PIVOTS).toPandas()
    pivots = _matrix(sample["vec"])
    pivots = np.c_[pivots, np.sqrt(np.maximum(norm * norm - np.square(pivots).sum(axis=1), 0))]
    pivots = pivots / np.sqrt(np.square(pivots).sum(axis=1, keepdims=True))

    shards, blocks = -(-entries.count() // SHARD_ROWS), -(-queries.count() // BLOCK_QUERIES)
    if not blocks:
        return empty
    own = lambda n, seed: F.pmod(F.xxhash64("query", F.lit(seed)), F.lit(n)).cast("int")
    left = entries.select(own(shards, 1).alias("shard"), F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"), "vec", "ids")
    right = queries.select(F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"), own(blocks, 2).alias("block"), "query", "vec")
    both = left.groupBy("shard", "block").cogroup(right.groupBy("shard", "block"))
    found = both.applyInPandas(_search(pivots, norm, top + 1), "query string, ids array<long>, scores array<double>")
    found = found.select("query", F.explode(F.arrays_zip("ids", "scores")).alias("x")).select("query", F.col("x.ids").alias("vec_id"), F.col("x.scores").alias("score"))
    order = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    best = found.withColumn("place", F.row_number().over(order)).where(F.col("place") <= top + 1)
    best = materialize(best.groupBy("query").agg(F.sort_array(F.collect_list(F.struct("place", "vec_id", "score"))).alias("best")), "nearest")
    named = wanted.select(F.col("id").alias("query_id"), "query").join(best, "query")
    others = F.slice(F.filter("best", lambda x: x["vec_id"] != F.col("query_id")), 1, top)
    shown = named.select("query_id", F.posexplode(others).alias("at", "x"))
    return shown.select("query_id", (F.col("at") + 1).cast("int").alias("rank"), "x.vec_id", "x.score")


def op5_permutation_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(read_table(spark, sf_dir, "embeddings"))
