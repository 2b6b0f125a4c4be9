"""Fitted forests as three tables in a folder."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import SparkSession

from pactlens.operators.forest.fit import Forest

PARTS = ("nodes", "category_index", "model")


class ModelNotAvailable(RuntimeError):
    """A table of the model does not exist."""


def save_forest(forest: Forest, folder: str) -> None:
    spark = forest.nodes.sparkSession
    numbers = [(forest.n_trees, forest.sample_size, forest.n_slots, forest.offset)]
    model = spark.createDataFrame(numbers, "n_trees int, sample_size int, n_slots int, offset double")
    for part, table in zip(PARTS, (forest.nodes, forest.index, model)):
        table.write.mode("overwrite").parquet(f"{folder}/{part}")


def load_forest(spark: SparkSession, folder: str) -> Forest:
    try:
        nodes, index, model = (spark.read.parquet(f"{folder}/{part}") for part in PARTS)
    except AnalysisException as error:
        raise ModelNotAvailable(f"no complete model in {folder}; train one first") from error
    row = model.first()
    return Forest(nodes, index, row["n_trees"], row["sample_size"], row["n_slots"], row["offset"])
