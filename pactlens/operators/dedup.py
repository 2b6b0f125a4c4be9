"""Whole-row deduplication which keeps the latest sighting."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def dedup_rows(raw: DataFrame, sighting: str = "ingestion_date") -> DataFrame:
    """One row per distinct content, with its latest ``ingestion_date`` as text.

    Rows are equal when every other column is equal, NULLs included.  The maximum is taken over a date, which
    the hash aggregate can update in place; over text Spark would sort every wide row.  Equal rows collapse in
    the map tasks first, so a much-repeated row reaches its reducer once per task.
    """
    content = [c for c in raw.columns if c != sighting]
    latest = F.max(F.to_date(sighting, "yyyy-MM-dd"))
    return raw.groupBy(*content).agg(F.date_format(latest, "yyyy-MM-dd").alias(sighting))


def dedup_summary(raw: DataFrame, deduped: DataFrame) -> DataFrame:
    """One row: rows in, rows out and duplicates removed."""
    sides = raw.select(F.lit(1).alias("i"), F.lit(0).alias("o")).unionAll(
        deduped.select(F.lit(0).alias("i"), F.lit(1).alias("o"))
    )
    return sides.agg(
        F.coalesce(F.sum("i"), F.lit(0)).alias("input_rows"), F.coalesce(F.sum("o"), F.lit(0)).alias("output_rows")
    ).withColumn("duplicates_removed", F.col("input_rows") - F.col("output_rows"))
