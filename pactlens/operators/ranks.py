"""Running totals over all distinct values, spread over tasks; exact order statistics and top sets on top of them."""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce
from operator import and_

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pactlens.functions.hashing import content_hash
from pactlens.session import materialize

#: A square: a bucket is found in two steps of its root.
BUCKETS = 256
#: Up to this many rows a top-n goes through one task.
IN_ONE_TASK = 10_000
BANDS_PER_E = 256
#: Makes the magnitude of the smallest positive double positive.
LOWEST_MAGNITUDE = 746 * BANDS_PER_E


def running_totals(
    freq: DataFrame, value: str, counts: Sequence[str], group: Sequence[str] = (), buckets: int = BUCKETS
) -> DataFrame:
    """Add ``cum_<count>`` (total up to and including the value) and ``next_value`` to a table of distinct values.

    ``freq`` has one row per (group, value) and should be a written table, as it is read three times; there must
    be few groups.  Approximate quantiles of the distinct values cut each group into buckets of similar size, a
    window runs inside each bucket, and the totals of the earlier buckets come by broadcast: at most
    ``buckets + 1`` rows per group.  No task ever holds all values of a group.
    """
    group = list(group)
    cuts = F.lit(np.arange(1, buckets) / buckets)
    # Collected, one row per group: two evaluations of an approximate quantile may differ, and all parts of the
    # result must use the same cuts.
    bounds = freq.groupBy(*group).agg(F.percentile_approx(value, cuts, 8 * buckets).alias("_bounds")).collect()
    step = math.isqrt(buckets)

    def below(cuts: Column) -> Column:
        return F.size(F.filter(cuts, lambda b: b < F.col(value)))

    def bucket_in(found: list) -> Column:
        """The number of bounds below the value: among every ``step``-th of them, then among those in between."""
        found = np.array(found)
        whole = below(F.lit(found[step - 1 :: step])) * step
        return whole + below(F.slice(F.lit(found), whole + 1, step))

    bucket = F.lit(None).cast("int")
    for row in bounds:
        if row["_bounds"] is not None:
            here = reduce(and_, [F.col(g).eqNullSafe(F.lit(row[g])) for g in group], F.lit(True))
            bucket = F.when(here, bucket_in(row["_bounds"])).otherwise(bucket)
    bucketed = freq.withColumn("_bucket", bucket)

    totals = bucketed.groupBy(*group, "_bucket").agg(
        *[F.sum(c).alias(f"_sum_{c}") for c in counts], F.min(value).alias("_first")
    )
    # One group is a handful of bucket rows; a constant stands in where there is no grouping column.
    order = Window.partitionBy(*(group or [F.lit(0)])).orderBy("_bucket")
    earlier = order.rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        *group,
        "_bucket",
        *[F.coalesce(F.sum(f"_sum_{c}").over(earlier), F.lit(0)).alias(f"_before_{c}") for c in counts],
        F.lead("_first").over(order).alias("_next_first"),
    )
    inside = Window.partitionBy(*group, "_bucket").orderBy(value)
    running = inside.rowsBetween(Window.unboundedPreceding, 0)
    return bucketed.join(F.broadcast(offsets), [*group, "_bucket"]).select(
        *freq.columns,
        *[(F.col(f"_before_{c}") + F.sum(c).over(running)).alias(f"cum_{c}") for c in counts],
        F.coalesce(F.lead(value).over(inside), F.col("_next_first")).alias("next_value"),
    )


def _band(value: Column) -> Column:
    """A number which never falls as the value rises: one per 0.4 % of magnitude, so there are few of them."""
    v = value.cast("double")
    size = F.abs(v)
    magnitude = F.floor(F.ln(size) * BANDS_PER_E) + LOWEST_MAGNITUDE
    band = F.when(v > 0, magnitude).when(v < 0, -magnitude).otherwise(F.lit(0).cast("bigint"))
    beyond = F.lit(1 << 40).cast("bigint")
    infinite = F.when(v > 0, beyond).otherwise(-beyond)
    return F.when(F.isnan(v), beyond * 2).when(size == F.lit(float("inf")), infinite).otherwise(band)


def values_at_ranks(rows: DataFrame, value: Column, ranks: Sequence[int]) -> list[tuple]:
    """(value, rows before it, rows with it) at ascending ranks which count from 1; NULLs have no rank.

    A first pass counts bands of similar values, a second one counts the distinct values of the bands which hold
    the ranks.  Only these counts move.
    """
    banded = rows.select(value.alias("value")).filter(F.col("value").isNotNull()).withColumn("band", _band(F.col("value")))
    bands = sorted(map(tuple, banded.groupBy("band").agg(F.count("*").alias("n")).collect()))
    ends = np.cumsum([n for _, n in bands])
    at = [int(np.searchsorted(ends, rank)) for rank in ranks]
    wanted = {bands[i][0] for i in at}
    counts = materialize(
        banded.filter(F.col("band").isin(*wanted)).groupBy("band", "value").agg(F.count("*").alias("n")), "value-counts"
    )
    totals = running_totals(counts, "value", ["n"], ["band"])
    found = []
    for rank, i in zip(ranks, at):
        before = int(ends[i] - bands[i][1])
        hit = totals.filter(
            (F.col("band") == bands[i][0]) & (F.col("cum_n") >= rank - before) & (F.col("cum_n") - F.col("n") < rank - before)
        ).first()
        found.append((hit["value"], before + hit["cum_n"] - hit["n"], hit["n"]))
    return found


def quantile_rank(q: float, n: int) -> int:
    """Rank of the discrete quantile: the smallest value which at least a share ``q`` of the rows does not exceed."""
    return max(1, math.ceil(q * n))


def first_rows(rows: DataFrame, order: Column, n: int, seed: int = 0, in_one_task: int = IN_ONE_TASK) -> DataFrame:
    """Exactly the ``n`` rows with the smallest ``order``, rows without one left out; ties fall by a hash of the row.

    Few rows are a plain top-n.  A larger cut is found by counting, so neither a large ``n`` nor a large group of
    ties ever gathers in one task; ``rows`` should then be a written table.
    """
    if n <= 0:
        return rows.limit(0)
    keyed = rows.withColumns({"_order": order, "_tie": content_hash(rows.columns, seed)}).filter(
        F.col("_order").isNotNull()
    )
    if n <= in_one_task:
        return keyed.orderBy("_order", "_tie").limit(n).select(*rows.columns)
    if keyed.count() <= n:
        return keyed.select(*rows.columns)
    cut, before, _ = values_at_ranks(keyed, F.col("_order"), [n])[0]
    inside = keyed.filter(F.col("_order") < F.lit(cut))
    ties = keyed.filter(F.col("_order") == F.lit(cut))
    tie_cut, tie_before, equal = values_at_ranks(ties, F.col("_tie"), [n - before])[0]
    chosen = inside.unionAll(ties.filter(F.col("_tie") < F.lit(tie_cut))).select(*rows.columns)
    last = ties.filter(F.col("_tie") == F.lit(tie_cut)).select(*rows.columns)
    wanted = n - before - tie_before
    if wanted == equal:
        return chosen.unionAll(last)
    # The rows left are copies of one row, of which some are wanted.
    example = last.first()
    copies = rows.sparkSession.range(wanted).select(
        *[F.lit(example[f.name]).cast(f.dataType).alias(f.name) for f in rows.schema.fields]
    )
    return chosen.unionAll(copies)
