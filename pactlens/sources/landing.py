"""Raw landing: the fixed text columns of a source, appended by ingestion date."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from pactlens.config import DEFAULTS, RAW_COLUMNS, SIGN_DATE, Settings
from pactlens.functions.calendar import text_bound
from pactlens.sources.windows import date_windows, extract_range, read_checkpoint, within, write_checkpoint

RAW_SCHEMA = StructType([StructField(c, StringType()) for c in RAW_COLUMNS])


def land(source: DataFrame) -> DataFrame:
    """The raw columns as text, values untouched; a column the source lacks is NULL."""
    present = set(source.columns)
    return source.select(
        *[(F.col(c) if c in present else F.lit(None)).cast("string").alias(c) for c in RAW_COLUMNS]
    )


def read_json_pages(spark: SparkSession, path: str) -> DataFrame:
    """JSON records under the fixed schema: a missing key is NULL and further keys are ignored."""
    return spark.read.schema(RAW_SCHEMA).json(path)


def write_raw(rows: DataFrame, raw_root: str, ingestion_date: str) -> int:
    """Append to the run's partition and return the rows, counted on the way.

    File names are unique: a second run on one day keeps the files of the first.  Rows lie by signing date within
    a file, which lets later date filters skip parts of it.
    """
    counted = Observation()
    dated = rows.withColumn("ingestion_date", F.lit(ingestion_date)).observe(counted, F.count("*").alias("n"))
    dated.sortWithinPartitions(SIGN_DATE).write.mode("append").partitionBy("ingestion_date").parquet(raw_root)
    return counted.get["n"]


def extract(
    source: DataFrame,
    raw_root: str,
    checkpoint: str,
    now: datetime | None = None,
    windows_per_commit: int | None = None,
    settings: Settings = DEFAULTS,
) -> DataFrame:
    """One incremental extract; returns a one-row summary.

    All windows run as one job, since the source is filtered and split by Spark; ``windows_per_commit`` cuts a
    long run into jobs of that many windows.  The checkpoint moves after the data of a job are committed, also
    when there were none.  ``source`` holds the signing date as ISO text.
    """
    spark = source.sparkSession
    now = now or datetime.now(timezone.utc)
    ingestion_date = now.astimezone(timezone.utc).strftime("%Y-%m-%d")
    span = extract_range(read_checkpoint(spark, checkpoint), F.lit(now).cast("timestamp"), settings)
    lo, hi = span.first()
    windows = date_windows(span, settings).orderBy("window_start").collect()
    step = windows_per_commit or max(1, len(windows))
    total = 0
    for first in range(0, len(windows), step):
        job = windows[first : first + step]
        start, end = job[0]["window_start"], job[-1]["window_end"]
        from_text, to_text = (text_bound(F.lit(t).cast("timestamp")) for t in (start, end))
        total += write_raw(land(source.filter(within(F.col(SIGN_DATE), from_text, to_text))), raw_root, ingestion_date)
        write_checkpoint(spark, checkpoint, end)
    return spark.createDataFrame(
        [(lo, hi, len(windows), total, f"{raw_root}/ingestion_date={ingestion_date}")],
        "desde timestamp, hasta timestamp, n_windows bigint, total_rows bigint, output_dir string",
    )
