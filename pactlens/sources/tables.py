"""Processed tables and small sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from pactlens.config import CATEGORICAL, IDENTIFIERS, NUMERIC, SIGN_DATE, SIGN_YEAR
from pactlens.functions.calendar import year_of


def write_table(df: DataFrame, path: str) -> int:
    """Overwrite a table and return its rows, counted while it is written."""
    observation = Observation()
    df.observe(observation, F.count("*").alias("n")).write.mode("overwrite").parquet(path)
    return observation.get["n"]


def write_by_year(df: DataFrame, path: str) -> int:
    """Overwrite a features table in folders by signing year, which readers that name years can skip; returns its rows.

    Rows of one year are gathered first and large years split, so a folder gets few files.
    """
    observation = Observation()
    dated = df.withColumn(SIGN_YEAR, year_of(F.col(SIGN_DATE))).observe(observation, F.count("*").alias("n"))
    dated.hint("rebalance", F.col(SIGN_YEAR)).write.mode("overwrite").partitionBy(SIGN_YEAR).parquet(path)
    return observation.get["n"]


def load_features(spark: SparkSession, path: str) -> DataFrame:
    """Identifiers, numbers and categories only; the scan reads no other column."""
    return spark.read.parquet(path).select(*IDENTIFIERS, *NUMERIC, *CATEGORICAL)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)
