"""Reads of the raw partitions."""

from __future__ import annotations

import logging

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from pactlens.sources.landing import RAW_SCHEMA

logger = logging.getLogger(__name__)


class NoPartitions(FileNotFoundError):
    """The raw folder has no ``ingestion_date=`` partition."""


def read_raw(spark: SparkSession, raw_root: str, schema: StructType = RAW_SCHEMA) -> DataFrame:
    """All partitions, with ``ingestion_date`` as text; folders such as ``_checkpoints`` are not data.

    The schema names the partition column, so it is not inferred as a date.
    """
    full = StructType([*schema.fields, StructField("ingestion_date", StringType())])
    try:
        return spark.read.schema(full).option("basePath", raw_root).parquet(f"{raw_root}/ingestion_date=*")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        raise NoPartitions(f"no ingestion_date=* partition in {raw_root}") from error


def partition_folders(spark: SparkSession, raw_root: str) -> DataFrame:
    """(ingestion_date, n_files) of every partition folder, by listing names; data files are those a reader takes."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(raw_root)
    files = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = []
    for folder in files.listStatus(path) if files.exists(path) else ():
        key, _, day = folder.getPath().getName().partition("=")
        if folder.isDirectory() and key == "ingestion_date":
            names = [f.getPath().getName() for f in files.listStatus(folder.getPath()) if f.isFile()]
            found.append((day, sum(n.endswith(".parquet") and n[0] not in "._" for n in names)))
    if not found:
        raise NoPartitions(f"no ingestion_date=* partition in {raw_root}")
    return spark.createDataFrame(sorted(found), "ingestion_date string, n_files int")


def warn_empty_folders(spark: SparkSession, raw_root: str) -> list[str]:
    """Dates of partition folders without a data file, with a warning for each."""
    empty = [r["ingestion_date"] for r in partition_folders(spark, raw_root).where("n_files = 0").collect()]
    for day in empty:
        logger.warning("partition without data files: ingestion_date=%s", day)
    return empty


def partition_inventory(raw: DataFrame) -> DataFrame:
    return raw.groupBy("ingestion_date").agg(F.count("*").alias("n"))


def empty_partitions(raw: DataFrame, expected: DataFrame) -> DataFrame:
    """Expected run dates (``ingestion_date`` as text) without a single row, with a warning for each."""
    missing = expected.select("ingestion_date").join(partition_inventory(raw), "ingestion_date", "left_anti")
    for row in missing.collect():
        logger.warning("partition without rows: ingestion_date=%s", row["ingestion_date"])
    return missing
