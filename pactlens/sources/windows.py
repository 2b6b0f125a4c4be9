"""Range and windows of an incremental extract, and its checkpoint table."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pactlens.config import DEFAULTS, Settings

CHECKPOINT_SCHEMA = "last_extraction_end timestamp, updated_at timestamp"


def read_checkpoint(spark: SparkSession, path: str) -> DataFrame:
    """The stored ends of extractions, one row each; none before the first run."""
    try:
        return spark.read.schema(CHECKPOINT_SCHEMA).json(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], CHECKPOINT_SCHEMA)


def write_checkpoint(spark: SparkSession, path: str, end: datetime) -> None:
    """Add the end of a finished extraction; call it after its data are committed.  The latest end counts.

    Rows are only ever added: a crash in between leaves the checkpoint as it was.
    """
    row = spark.createDataFrame([(end, datetime.now(timezone.utc))], CHECKPOINT_SCHEMA)
    row.coalesce(1).write.mode("append").json(path)


def extract_range(checkpoints: DataFrame, now: Column, settings: Settings = DEFAULTS) -> DataFrame:
    """One row (lo, hi): from the checkpoint less the overlap, never before the start of the history, to tomorrow."""
    start = F.lit(settings.history_start).cast("timestamp")
    day = F.make_dt_interval(F.lit(1))
    overlap = F.make_dt_interval(F.lit(settings.overlap_days))
    return checkpoints.agg(F.max("last_extraction_end").alias("last")).select(
        F.greatest(F.coalesce(F.col("last") - overlap, start), start).alias("lo"),
        F.date_trunc("day", now + day).alias("hi"),
    )


def date_windows(ranges: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """Consecutive half-open windows (window_start, window_end) of each range; the last one ends with the range."""
    step = F.make_dt_interval(F.lit(settings.window_days))
    inside = F.col("hi") - F.make_dt_interval(secs=F.lit(0.000001))
    starts = F.explode(F.sequence("lo", inside, step)).alias("window_start")
    return (
        ranges.filter(F.col("lo") < F.col("hi"))
        .select("hi", starts)
        .select("window_start", F.least(F.col("window_start") + step, F.col("hi")).alias("window_end"))
    )


def within(moment: Column, lo: Column, hi: Column) -> Column:
    """Half-open range."""
    return (moment >= lo) & (moment < hi)
