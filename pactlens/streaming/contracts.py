"""Contracts as streams: landing, bounded deduplication, upsert of the latest sighting, and scoring."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery
from pyspark.sql.types import StringType, StructField, StructType

from pactlens.config import DEFAULTS, RAW_COLUMNS, SIGN_DATE, Settings
from pactlens.functions.casts import to_date_or_null
from pactlens.operators.dedup import dedup_rows
from pactlens.operators.forest.fit import Forest
from pactlens.operators.forest.score import with_scores
from pactlens.operators.reference import ReferenceTables, featurize_new, split_valid
from pactlens.sources.landing import RAW_SCHEMA


DAY_MS = 86_400_000
#: Groups of state per signing day.
BUCKETS = 4
_KEYED = ("_day", "_bucket", "_signed_ms", "_digest")
STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def read_json_stream(spark: SparkSession, folder: str, files_per_trigger: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(RAW_SCHEMA)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.json(folder)


def land_stream(pages: DataFrame, raw_root: str, checkpoint: str) -> StreamingQuery:
    """Append new records to the raw partitions, exactly once, and stop when all available input is in."""
    dated = pages.withColumn("ingestion_date", F.date_format(F.current_timestamp(), "yyyy-MM-dd"))
    return (
        dated.writeStream.format("parquet")
        .partitionBy("ingestion_date")
        .option("checkpointLocation", checkpoint)
        .option("path", raw_root)
        .trigger(availableNow=True)
        .start()
    )


def _signed() -> Column:
    return to_date_or_null(F.col(SIGN_DATE)).cast("timestamp")


def left_to_batch(pages: DataFrame, before: str) -> DataFrame:
    """The rows ``dedup_stream`` does not take, with the ``reason``: ``undated`` or ``after_bound``."""
    signed = _signed()
    reason = F.when(signed.isNull(), "undated").when(signed >= F.lit(before).cast("timestamp"), "after_bound")
    return pages.withColumn("reason", reason).filter(F.col("reason").isNotNull())


def _first_sightings(columns: list[str]) -> StatefulProcessor:
    # A class of its own for each query: Spark also loads it where the package is not shipped, and then needs it by value.
    class FirstSightings(StatefulProcessor):
        """The first of equal rows per signing day and bucket; rows behind the watermark go on as ``late``.

        State is one value per day and bucket, the digests seen, read and written once a batch.  A timer drops it when the
        watermark has passed the day, since every row of the day is late from then on.
        """

        def init(self, handle: StatefulProcessorHandle) -> None:
            self.handle = handle
            self.seen = handle.getValueState("seen", "digests binary")

        def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
            watermark = timerValues.getCurrentWatermarkInMs()
            kept = self.seen.get()[0] if self.seen.exists() else b""
            seen = {kept[i : i + 16] for i in range(0, len(kept), 16)}
            found = []
            for frame in rows:
                if frame.empty:
                    continue
                # Computed columns arrive under names of Spark's own, in their order.
                frame = frame.set_axis([*columns, *_KEYED], axis=1)
                late = frame["_signed_ms"].to_numpy() < watermark
                sides = []
                for digest, is_late in zip(frame["_digest"], late.tolist(), strict=True):
                    digest = bytes(digest)
                    sides.append("late" if is_late else None if digest in seen else "kept")
                    if not is_late and digest not in seen:
                        seen.add(digest)
                        found.append(digest)
                out = frame[columns].assign(side=sides)
                yield out[out["side"].notna()]
            if found:
                self.seen.update((kept + b"".join(found),))
                self.handle.registerTimer((int(key[0]) + 1) * DAY_MS)

        def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
            self.seen.clear()
            return iter(())

        def close(self) -> None:
            pass

    return FirstSightings()


def dedup_sides(pages: DataFrame, before: str, settings: Settings = DEFAULTS, buckets: int = BUCKETS) -> DataFrame:
    """Rows with their ``side``: ``kept`` for the first sighting of each whole row within the overlap, by signing date, and
    ``late`` for rows signed before the watermark, which is the latest signing date of earlier batches less the overlap.

    Rows signed at or after ``before`` take no part, as a wrong future date would close the window, and neither do rows
    without a date: ``left_to_batch`` has them.  So every row of the input is kept, a repeat of a kept row, late, or left
    to the batch run.  Arbitrary state needs the RocksDB store, which this sets for the session.  State holds 16 bytes for each row of the overlap's days, in ``buckets`` groups a day, so that no
    group grows beyond a task.
    """
    columns = list(RAW_COLUMNS)
    content = F.concat(*[F.when(F.col(c).isNull(), F.lit("-")).otherwise(F.concat(F.length(c), F.lit(":"), F.col(c))) for c in columns])
    signed = pages.withColumn("_signed", _signed()).filter(F.col("_signed") < F.lit(before).cast("timestamp"))
    keyed = signed.withWatermark("_signed", f"{settings.overlap_days} days").select(
        *columns,
        F.floor(F.unix_millis("_signed") / DAY_MS).alias("_day"),
        F.pmod(F.xxhash64(content), F.lit(buckets)).alias("_bucket"),
        F.unix_millis("_signed").alias("_signed_ms"),
        F.unhex(F.md5(content)).alias("_digest"),
    )
    schema = StructType([*RAW_SCHEMA.fields, StructField("side", StringType())])
    pages.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_STORE)
    # Without the watermark's own column, Spark hands late rows over instead of dropping them.
    return keyed.groupBy("_day", "_bucket").transformWithStateInPandas(_first_sightings(columns), schema, "Append", "EventTime")


def dedup_stream(pages: DataFrame, before: str, settings: Settings = DEFAULTS) -> DataFrame:
    """First sighting of each whole row within the overlap; ``dedup_sides`` without the late rows."""
    return dedup_sides(pages, before, settings).filter(F.col("side") == "kept").drop("side")


SIGHTING_SCHEMA = StructType([*RAW_SCHEMA.fields, StructField("ingestion_date", StringType())])


def _signing_month() -> Column:
    return F.coalesce(F.date_format(to_date_or_null(F.col(SIGN_DATE)), "yyyy-MM"), F.lit("none"))


def append_sightings(batch: DataFrame, root: str) -> None:
    """Add the latest sighting of each row of a batch to the folders by signing month, which equal rows share.

    Nothing is ever replaced, so streams, restarts and new checkpoints cannot lose a row; a batch that is written
    again after a failure adds rows which ``read_latest`` takes for one.
    """
    latest = dedup_rows(batch.select(*SIGHTING_SCHEMA.names)).withColumn("month", _signing_month())
    latest.hint("rebalance", F.col("month")).write.mode("append").partitionBy("month").parquet(root)


def read_latest(spark: SparkSession, root: str) -> DataFrame:
    """Contracts with their latest sighting.  A filter on ``month`` reads its folder only."""
    table = spark.read.schema(StructType([*SIGHTING_SCHEMA.fields, StructField("month", StringType())])).parquet(root)
    return dedup_rows(table)


def compact_latest(spark: SparkSession, root: str, target: str) -> int:
    """Write the latest sightings as a table of one row per contract, for the streams to go on with; returns its rows."""
    rows = read_latest(spark, root)
    rows.hint("rebalance", F.col("month")).write.mode("append").partitionBy("month").parquet(target)
    return read_latest(spark, target).count()


def upsert_stream(sightings: DataFrame, root: str, checkpoint: str) -> StreamingQuery:
    """Keep the latest ``ingestion_date`` of every row across micro-batches."""
    return (
        sightings.writeStream.foreachBatch(lambda batch, _: append_sightings(batch, root))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def score_stream(
    new: DataFrame, tables: ReferenceTables, forest: Forest, settings: Settings = DEFAULTS
) -> tuple[DataFrame, DataFrame]:
    """Scores of the accepted contracts of a stream or table, and the quarantine of the others."""
    accepted, rejected = split_valid(new)
    scored = with_scores(featurize_new(accepted, tables, settings), forest)
    return scored.select("numero_del_contrato", "anomaly_score", "is_anomaly"), rejected


def append_stream(rows: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    return (
        rows.writeStream.format("parquet")
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
