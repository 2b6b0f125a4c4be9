"""Seeded draws which depend on row content only, so that they survive re-runs, retries and any layout."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F


def content_hash(columns: Sequence[Column | str], *salt: Column | int) -> Column:
    """64-bit hash of the columns; NULLs count by their position."""
    cols = [F.col(c) if isinstance(c, str) else c for c in columns]
    nulls = F.concat(*[F.when(c.isNull(), F.lit("1")).otherwise(F.lit("0")) for c in cols])
    salts = [s if isinstance(s, Column) else F.lit(int(s)).cast("bigint") for s in salt]
    return F.xxhash64(*cols, nulls, *salts)


def uniform(hash_value: Column) -> Column:
    """Map a 64-bit hash to a double in [0, 1)."""
    return F.shiftrightunsigned(hash_value, 11).cast("double") * F.lit(2.0**-53)


def exact_sum(value: Column) -> Column:
    """Sum of money in decimal arithmetic: no dependence on the order of addition."""
    return F.sum(value.cast("decimal(20,2)"))


def exact_mean(total: Column, count: Column) -> Column:
    return total.cast("double") / count.cast("double")


def mixed(x: np.ndarray) -> np.ndarray:
    """64-bit numbers with every bit spread over all of them, for draws inside a task."""
    x = x.astype(np.uint64)
    for shift, factor in ((33, 0xFF51AFD7ED558CCD), (33, 0xC4CEB9FE1A85EC53)):
        x ^= x >> np.uint64(shift)
        x *= np.uint64(factor)
    return x ^ (x >> np.uint64(33))
