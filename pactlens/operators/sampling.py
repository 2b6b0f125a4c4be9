"""Seeded samples and top sets which do not depend on the layout of the data."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pactlens.functions.hashing import content_hash, uniform
from pactlens.operators.lookup import at_most
from pactlens.operators.ranks import IN_ONE_TASK, first_rows
from pactlens.session import materialize

CHUNK = 10_000
#: Drawn hashes (8 bytes each) up to which they are broadcast to the second scan.
MAX_DRAWN = 10_000_000


def with_margin(n: int) -> float:
    """Expected size of a draw which yields at least ``n`` rows (eight standard deviations of slack)."""
    return n + 8.0 * math.sqrt(n) + 32.0


def draws(copies: Column, rate: float, u: Column) -> Column:
    """How many of ``copies`` equal rows enter a sample of this rate: the mean is exact, ``u`` decides the rest."""
    expected = copies * F.lit(rate)
    return F.least(F.floor(expected) + (u < expected - F.floor(expected)).cast("int"), copies).cast("bigint")


def repeat_rows(rows: DataFrame, times: str, number: str) -> DataFrame:
    """Each row ``times`` times, numbered from 1; long runs unfold in chunks, not in one array."""
    chunk = F.explode(F.sequence(F.lit(0), F.floor((F.col(times) - 1) / CHUNK))).alias("_chunk")
    first = F.col("_chunk") * CHUNK + 1
    keep = [c for c in rows.columns if c != times]
    return (
        rows.filter(F.col(times) > 0)
        .select(*rows.columns, chunk)
        .select(*keep, F.explode(F.sequence(first, F.least(first + (CHUNK - 1), F.col(times)))).alias(number))
    )


def copy_counts(rows: DataFrame, columns: Sequence[str], seed: int) -> DataFrame:
    """(_point, copies): the number of equal rows under a 64-bit hash of their content.

    Only hashes and counts move, already added up in the map tasks: a sixth of what the rows themselves would be.
    """
    return rows.groupBy(content_hash(columns, seed).alias("_point")).agg(F.count("*").alias("copies"))


def fetch_points(rows: DataFrame, columns: Sequence[str], seed: int, drawn: DataFrame) -> DataFrame:
    """One row per drawn ``_point`` with its columns: a second, filtering scan against the drawn hashes."""
    wanted = drawn.select("_point").distinct()
    if at_most(wanted, MAX_DRAWN):
        wanted = F.broadcast(wanted)
    found = rows.select(content_hash(columns, seed).alias("_point"), F.struct(*columns).alias("_row")).join(
        wanted, "_point", "left_semi"
    )
    return found.groupBy("_point").agg(F.min("_row").alias("_row")).select("_point", "_row.*")


def sample_rows(rows: DataFrame, n: int, seed: int) -> DataFrame:
    """Exactly ``min(n, all)`` rows without replacement.

    Equal rows are counted before anything moves; each copy then has the same chance as any other row.
    """
    total = rows.count()
    if n >= total:
        return rows
    rate = min(1.0, with_margin(n) / total)
    counted = copy_counts(rows, rows.columns, seed)
    times = draws(F.col("copies"), rate, uniform(F.xxhash64("_point")))
    numbered = repeat_rows(counted.select("_point", times.alias("_times")), "_times", "_copy")
    candidates = materialize(numbered.withColumn("_order", F.xxhash64("_point", "_copy")), "sample-candidates")
    chosen = materialize(first_rows(candidates, F.col("_order"), n, seed).select("_point"), "sample-chosen")
    return chosen.join(fetch_points(rows, rows.columns, seed, chosen), "_point").select(*rows.columns)


def top_count(total: int, fraction: float) -> int:
    return max(1, int(total * fraction))


def top_fraction(scored: DataFrame, score: str, fraction: float) -> DataFrame:
    """The ``max(1, int(rows * fraction))`` rows with the highest score."""
    total = scored.count()
    if total == 0:
        return scored
    return first_rows(scored, -F.col(score), top_count(total, fraction))


def most_atypical(scored: DataFrame, n: int = 10, score: str = "anomaly_score") -> DataFrame:
    ties = [c for c in scored.columns if c != score]
    if n > IN_ONE_TASK:
        return first_rows(scored.filter(F.col(score).isNotNull()), -F.col(score), n)
    return scored.orderBy(F.desc_nulls_last(score), *ties).limit(n)
