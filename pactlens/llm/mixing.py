"""Mixing sources to target weights by balanced sampling, the cube method.

Every source has a target number of words.  A document of a source of size S and target T is wanted m = T / S times: floor
of m copies, and one more with probability p = m - floor(m).  The cube method decides on these extra copies so that both the
number of documents and the number of words of the sample stay at their expectation.

Flight: of any three undecided documents a step along the null space of the two balancing equations decides at least one
and leaves both totals as they are.  A source is cut into blocks by hash, each block flies alone and leaves two documents
undecided; these meet in the next round, and so on, until a source is one block.  Landing: the two documents left are taken or not so that the number of words comes nearest to its target.
The last block lands its large documents first and lets the small ones make up for the words gained or lost.

Draws depend on content and the seed alone; a rerun on any cluster gives the same mix.
"""

from __future__ import annotations

import itertools

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pactlens.llm.text import n_words, read_table, whole_text
from pactlens.session import materialize

MOST_COPIES = 3
WEIGHTS = 3
BLOCK_UNITS = 2048
SEED = 7
#: Up to this many sources their totals are broadcast, about 100 bytes each; beyond it they are joined by a shuffle.
BROADCAST_SOURCES = 50_000
_EDGE = 1e-9


def _step(p: list[float], along: list[float], draw: float) -> None:
    """Move p both ways along a line to the cube's faces, and stay at either end with the chance that keeps p on average."""
    up = down = float("inf")
    for x, u in zip(p, along, strict=True):
        if u > 0:
            up, down = min(up, (1 - x) / u), min(down, x / u)
        elif u < 0:
            up, down = min(up, x / -u), min(down, (1 - x) / -u)
    move = up if draw * (up + down) < down else -down
    for i, u in enumerate(along):
        x = p[i] + move * u
        p[i] = 0.0 if x < _EDGE else 1.0 if x > 1 - _EDGE else x


def _null(first: list[float], second: list[float]) -> list[float]:
    """A direction that changes neither total; ``first`` is positive throughout."""
    (a, b, c), (x, y, z) = first, second
    along = [b * z - c * y, c * x - a * z, a * y - b * x]
    if not any(along):
        along = [b, -a, 0.0]
    top = max(map(abs, along))
    return [u / top for u in along]


def fly(p: np.ndarray, count: np.ndarray, size: np.ndarray, draws: np.random.Generator) -> np.ndarray:
    """Decide all but at most two of the probabilities ``p``, keeping the sums of ``count`` and ``size``."""
    p = p.astype(float).copy()
    open_: list[int] = []
    for i in np.flatnonzero((p > _EDGE) & (p < 1 - _EDGE)):
        open_.append(int(i))
        while len(open_) == 3:
            own = [float(p[k]) for k in open_]
            _step(own, _null([float(count[k]) for k in open_], [float(size[k]) for k in open_]), draws.random())
            p[open_] = own
            open_ = [k for k, x in zip(open_, own, strict=True) if 0.0 < x < 1.0]
    return p


def land(p: np.ndarray, size: np.ndarray, owed: float) -> np.ndarray:
    """Decide the few that are open so that the words they gain or lose best make up for ``owed``."""
    p = p.copy()
    open_ = np.flatnonzero((p > _EDGE) & (p < 1 - _EDGE))
    corners = list(itertools.product((0.0, 1.0), repeat=len(open_)))
    left = [abs(owed + float(((p[open_] - x) * size[open_]).sum())) for x in map(np.array, corners)]
    best = corners[int(np.argmin(left))]
    p[open_] = best
    return np.round(p)


def fly_and_land(p: np.ndarray, count: np.ndarray, size: np.ndarray, draws: np.random.Generator) -> np.ndarray:
    """Decide everything.  Rows come largest first and land in parts, each half of what is left; the words that landing
    gains or loses in one part are made up for by the chances of the next, whose documents are smaller."""
    out, owed, at = np.empty(len(p)), 0.0, 0
    while at < len(p):
        part = slice(at, at + max(1, (len(p) - at) // 2))
        words = float(size[part].sum())
        wanted = np.clip(p[part] + (owed / words if words else 0.0), 0.0, 1.0)
        flown = fly(wanted, count[part], size[part], draws)
        owed += float(((p[part] - flown) * size[part]).sum())
        out[part] = land(flown, size[part], owed)
        owed += float(((flown - out[part]) * size[part]).sum())
        at = part.stop
    return out


def _fly_block(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
    rows = rows.sort_values(["size", "k1", "k2"], ascending=False, kind="stable")
    seed = xxhash.xxh3_64_intdigest(repr([SEED, *map(str, key)]).encode())
    last = bool((rows["blocks"] == 1).all())
    n = rows["n"].to_numpy(float)
    p, sizes, draws = rows["extra"].to_numpy(), n * rows["size"].to_numpy(float), np.random.default_rng(seed)
    rows["extra"] = fly_and_land(p, n, sizes, draws) if last else fly(p, n, sizes, draws)
    return rows.drop(columns=["blocks", "block"])


def targets(sizes: DataFrame) -> DataFrame:
    """From (source, source_size): adds ``target``.

    Sources by code point, null last, weigh 1, 2, 3, repeating, and share the whole size; a target stops at three times
    its source's size and the excess is shared again by weight, until none is above.
    """
    spark = sizes.sparkSession
    ordered = materialize(sizes, "source-sizes").orderBy(F.asc_nulls_last("source"))
    ranked = ordered.rdd.zipWithIndex().map(lambda x: (x[0]["source"], x[0]["source_size"], x[1] % WEIGHTS + 1))
    ranked = materialize(spark.createDataFrame(ranked, "source string, source_size long, weight long"), "source-weights")
    total = ranked.agg(F.sum("source_size")).head()[0] or 0
    share, capped = 0.0, -1
    while True:
        above = (F.col("weight") * F.lit(share) > MOST_COPIES * F.col("source_size")) | (F.col("source_size") == 0)
        free, fixed, n = ranked.agg(F.sum(F.when(~above, F.col("weight"))), F.sum(F.when(above, MOST_COPIES * F.col("source_size"))), F.count(F.when(above, 1))).head()
        share = (total - (fixed or 0)) / free if free else 0.0
        if n == capped:
            break
        capped = n
    full = (MOST_COPIES * F.col("source_size")).cast("double")
    return ranked.select("source", "source_size", F.least(F.col("weight") * F.lit(share), full).alias("target"))


def mix(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", source_column: str = "source") -> DataFrame:
    """Units (k1, k2, id, source, size, n, source_size, target, copies): each distinct (id, source, text), the number ``n`` of
    rows that have it, and how often the mix takes each of them, 0 to 3 times.

    Null text has size 0; documents of size 0 take part with no words; a null source is a source; repeated rows are taken
    alike; an empty table gives no units.
    """
    text, source, key = whole_text(text_column), F.col(source_column).cast("string"), F.col(id_column)
    rows = docs.select(key.alias("id"), source.alias("source"), n_words(text).alias("size"), *unit_key(id_column, text_column, source_column))
    units = materialize(rows.groupBy("k1", "k2", "id", "source", "size").agg(F.count(F.lit(1)).alias("n")), "units")
    sources = materialize(targets(units.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"))), "targets")
    few = sources.count() <= BROADCAST_SOURCES
    small = lambda df: F.broadcast(df) if few else df
    named = small(sources.withColumnRenamed("source", "s"))
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    rows = units.join(named, F.col("source").eqNullSafe(F.col("s"))).drop("s").withColumn("rate", rate)
    whole = F.floor("rate").cast("long")
    rows = materialize(rows.withColumn("whole", whole).withColumn("extra", F.col("rate") - whole).drop("rate"), "unit-rates")
    undecided = (F.col("extra") > _EDGE) & (F.col("extra") < 1 - _EDGE)
    done = [rows.where(~undecided).withColumn("extra", F.round("extra"))]
    flying = rows.where(undecided)
    while True:
        counts = materialize(flying.groupBy(F.col("source").alias("s")).agg(F.ceil(F.count(F.lit(1)) / BLOCK_UNITS).alias("blocks")), "blocks")
        if counts.isEmpty():
            break
        dealt = flying.join(small(counts), F.col("source").eqNullSafe(F.col("s"))).drop("s")
        dealt = dealt.withColumn("block", F.pmod(F.xxhash64("k1", "k2", F.lit(len(done))), "blocks"))
        flown = dealt.groupBy("source", "block").applyInPandas(_fly_block, rows.schema)
        flown = materialize(flown, "flown")
        done.append(flown.where(~undecided))
        flying = flown.where(undecided)
    out = done[0]
    for part in done[1:]:
        out = out.unionByName(part)
    return out.select("k1", "k2", "id", "source", "size", "n", "source_size", "target", (F.col("whole") + F.col("extra")).cast("int").alias("copies"))


def unit_key(id_column: str, text_column: str, source_column: str) -> list[Column]:
    parts = [F.col(id_column), F.col(source_column).cast("string"), whole_text(text_column)]
    return [F.xxhash64(*parts).alias("k1"), F.xxhash64(*parts[::-1]).alias("k2")]


def apply_mix(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", source_column: str = "source") -> DataFrame:
    """``docs`` with every row as often as the mix takes it."""
    copies = materialize(mix(docs, id_column, text_column, source_column).where("copies > 0").select("k1", "k2", "copies"), "copies")
    packed = docs.select(F.struct("*").alias("row"), *unit_key(id_column, text_column, source_column)).join(copies, ["k1", "k2"])
    return packed.select("row", F.explode(F.sequence(F.lit(1), "copies"))).select("row.*")


def op2_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    units = mix(read_table(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    rows = units.select("*", F.explode(F.sequence(F.lit(1), F.col("n"))))
    return rows.select(F.col("id").alias("doc_id"), "size", "source_size", "target", (F.col("size") * F.col("copies")).cast("long").alias("taken"))
