"""Reading tables and cutting texts into words, alike in every operator.

A word is a run of characters other than space and the controls 9 to 13.  ``bytes.split`` cuts UTF-8 at just these.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

WORD_GAP = r"[\x20\x09-\x0D]+"
BLANKS = " \t\n\x0b\x0c\r"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def whole_text(column: str = "text") -> Column:
    """The text as it is; null counts as empty."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def n_words(text: Column) -> Column:
    body = F.trim(text, F.lit(BLANKS))
    return F.when(body == "", 0).otherwise(F.size(F.split(body, WORD_GAP))).cast("long")


def words(text: str) -> list[bytes]:
    return text.encode("utf-8", "replace").split()
