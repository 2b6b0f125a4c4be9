"""Joins of many rows to one value per key, planned by the measured size of the lookup side."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pactlens.functions.hashing import content_hash

#: A key is hot when it holds at least this share of all rows, so there are at most its inverse of them.
HOT_SHARE = 1 / 2_000
SPREAD = 4_096
#: Copies of each key of a lookup that is too large to broadcast.
KEY_PARTS = 16


def at_most(table: DataFrame, rows: int) -> bool:
    """Whether the table has at most ``rows`` rows; reads no more than needed to tell."""
    return table.limit(rows + 1).count() <= rows


def attach_small(
    rows: DataFrame, table: DataFrame, keys: Sequence[str], how: str, broadcast_rows: int
) -> DataFrame:
    """Join a lookup with one row per key: broadcast within the bound.

    Beyond it, each key of the lookup stands ``KEY_PARTS`` times, and the rows of a key are spread over its copies by
    their content, so no task gets a whole hot key.
    """
    if at_most(table, broadcast_rows):
        return rows.join(F.broadcast(table), list(keys), how)
    part = F.pmod(content_hash(rows.columns), F.lit(KEY_PARTS)).cast("int")
    copies = table.withColumn("_part", F.explode(F.sequence(F.lit(0), F.lit(KEY_PARTS - 1))))
    return rows.withColumn("_part", part).join(copies, [*keys, "_part"], how).drop("_part")


def attach_counts(
    rows: DataFrame, counts: DataFrame, key: str, count: str, how: str, broadcast_rows: int
) -> DataFrame:
    """Join the number of occurrences of each key; ``counts`` must be a written table.

    Beyond the broadcast bound the table itself tells which keys are hot.  Those few come by broadcast; their
    rows then take the shuffle under scattered keys which match nothing, so no task gets a whole hot key.
    """
    if at_most(counts, broadcast_rows):
        return rows.join(F.broadcast(counts), key, how)
    total = counts.agg(F.sum(count)).first()[0]
    return _split_hot(rows, counts, key, count, how, max(1, int(total * HOT_SHARE)))


def _split_hot(rows: DataFrame, counts: DataFrame, key: str, count: str, how: str, hot_from: int) -> DataFrame:
    columns = rows.columns
    # Rows without a key match nothing; they are dropped or scattered like the hot ones.
    if how == "inner":
        rows = rows.filter(F.col(key).isNotNull())
    hot = counts.filter((F.col(count) >= hot_from) & F.col(key).isNotNull())
    light = counts.filter((F.col(count) < hot_from) & F.col(key).isNotNull())
    scatter = F.pmod(content_hash(columns), F.lit(SPREAD)).cast("string")
    marked = rows.join(F.broadcast(hot.withColumnRenamed(count, "_hot")), key, "left").withColumns(
        {
            "_part": F.when(F.col("_hot").isNull() & F.col(key).isNotNull(), F.lit("")).otherwise(scatter),
            "_key": F.when(F.col("_hot").isNull() & F.col(key).isNotNull(), F.col(key).cast("string")).otherwise(F.lit("")),
        }
    )
    other = light.select(F.col(key).cast("string").alias("_key"), F.lit("").alias("_part"), F.col(count).alias("_light"))
    joined = marked.join(other, ["_key", "_part"], "left").withColumn(count, F.coalesce("_hot", "_light"))
    if how == "inner":
        joined = joined.filter(F.col(count).isNotNull())
    return joined.select(*columns, count)
