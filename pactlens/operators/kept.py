"""Incremental deduplication: a new ingestion partition against a kept table, instead of the whole history each run.

The kept table lies in folders by ``bucket``, a part of the hash of a row's content:

* ``rows`` holds every distinct row once, with the date of the run that brought it and a 128-bit digest of its content.
* ``seen`` holds (digest, date) of its later sightings.

A run reads of ``rows`` the digests in the buckets that its own rows touch, and nothing else of the history.  Digests tell
which of its rows are new; only those move whole, and none do if there are none.  It appends new rows to ``rows`` and the others' dates to ``seen``.  Nothing is replaced, so a run that failed can be repeated, and partitions
may come in any order.  One run at a time may write.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StringType, StructField, StructType

from pactlens.operators.dedup import dedup_rows
from pactlens.session import materialize
from pactlens.sources.landing import RAW_SCHEMA

BUCKETS = 64
#: Parts of a bucket that new rows are dealt by, so that tasks are not bound to the number of buckets.
PARTS = 16
#: Up to so many equal rows of a run meet in the task of their digest; of more the map tasks keep one each first.
MOST_COPIES = 10_000
SIGHTING = "ingestion_date"
_DIGEST = [StructField("_d1", LongType()), StructField("_d2", LongType())]
_BUCKET = StructField("bucket", IntegerType())
SEEN_SCHEMA = StructType([*_DIGEST, StructField(SIGHTING, StringType()), _BUCKET])
DIGEST = ["_d1", "_d2"]


def _digests(columns: list[str]) -> list[Column]:
    """Two 64-bit hashes of the content; NULLs count by their position."""
    nulls = F.concat(*[F.when(F.col(c).isNull(), F.lit("1")).otherwise(F.lit("0")) for c in columns])
    texts = [F.col(c).cast("string") for c in columns]
    return [F.xxhash64(*texts, nulls), F.xxhash64(nulls, F.lit(1), *texts[::-1])]


def _read(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def _rows_schema(schema: StructType) -> StructType:
    return StructType([*schema.fields, StructField(SIGHTING, StringType()), *_DIGEST, _BUCKET])


def add_partition(rows: DataFrame, root: str, schema: StructType = RAW_SCHEMA, buckets: int = BUCKETS) -> DataFrame:
    """Add sightings (the columns of ``schema`` and ``ingestion_date``) to the kept table at ``root``; returns one row with
    the rows read, those new and those seen before, and the number of buckets touched.

    A table keeps the number of ``buckets`` it began with.
    """
    spark = rows.sparkSession
    first, second = _digests(schema.names)
    own = rows.select(*schema.names, SIGHTING)

    def digested(df: DataFrame) -> DataFrame:
        return df.withColumns({"_d1": first, "_d2": second}).withColumn("bucket", F.pmod("_d1", F.lit(buckets)).cast("int"))

    latest = F.date_format(F.max(F.to_date(SIGHTING, "yyyy-MM-dd")), "yyyy-MM-dd")
    new = digested(own).groupBy("bucket", *DIGEST).agg(latest.alias(SIGHTING), F.count(F.lit(1)).alias("_copies"))
    new = materialize(new, "new-digests")
    touched = sorted(r["bucket"] for r in new.select("bucket").distinct().collect())  # at most ``buckets``
    kept = _read(spark, f"{root}/rows", _rows_schema(schema)).where(F.col("bucket").isin(touched)).select("bucket", *DIGEST)
    marked = materialize(new.join(kept.withColumn("_known", F.lit(True)), ["bucket", *DIGEST], "left"), "marked-sightings")
    known = F.col("_known").isNotNull()
    unseen = marked.where(~known).select("bucket", *DIGEST)
    if not unseen.isEmpty():
        most = new.agg(F.max("_copies")).head()[0]
        # Both sides are dealt alike, so join and grouping move nothing again and the rows of a bucket are in few tasks.
        part = F.pmod("_d2", F.lit(PARTS)).alias("_part")
        whole = digested(own if most <= MOST_COPIES else dedup_rows(own))
        whole, unseen = (df.select("*", part).repartition("bucket", "_part") for df in (whole, unseen))
        fresh = whole.join(unseen, ["bucket", "_part", *DIGEST], "left_semi")
        fresh = fresh.groupBy("bucket", "_part", *DIGEST, *schema.names).agg(latest.alias(SIGHTING)).select(*_rows_schema(schema).names)
        fresh.write.mode("append").partitionBy("bucket").parquet(f"{root}/rows")
    again = marked.where(known).select(*SEEN_SCHEMA.names)
    again.hint("rebalance", F.col("bucket")).write.mode("append").partitionBy("bucket").parquet(f"{root}/seen")
    return marked.agg(
        F.lit(rows.count()).alias("input_rows"), F.count_if(~known).alias("new_rows"), F.count_if(known).alias("seen_before"), F.lit(len(touched)).alias("buckets_touched")
    )


def read_kept(spark: SparkSession, root: str, schema: StructType = RAW_SCHEMA) -> DataFrame:
    """Every distinct row with its latest ``ingestion_date``, as ``dedup_rows`` over all partitions would give them."""
    rows = _read(spark, f"{root}/rows", _rows_schema(schema))
    # Digests of repeated runs are many and their rows few: one date each, before the join.
    last = _read(spark, f"{root}/seen", SEEN_SCHEMA).groupBy("bucket", *DIGEST).agg(F.max(F.to_date(SIGHTING)).alias("_last"))
    joined = rows.join(last, ["bucket", *DIGEST], "left")
    latest = F.date_format(F.greatest(F.to_date(SIGHTING), "_last"), "yyyy-MM-dd")
    return joined.select(*schema.names, latest.alias(SIGHTING))
