"""One-hot encoding of the categorical columns as slot numbers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pactlens.config import CATEGORICAL, DEFAULTS, NUMERIC, Settings
from pactlens.operators.lookup import at_most
from pactlens.session import materialize


def categories(features: DataFrame, columns: Sequence[str] = CATEGORICAL) -> DataFrame:
    """Distinct (position of the column, column, category); NULL is a category of its own.

    Equal combinations collapse before the columns are unpivoted, so few rows are multiplied.
    """
    position = F.array_position(F.array(*[F.lit(c) for c in columns]), F.col("column")).cast("int")
    return (
        features.select(*columns)
        .distinct()
        .unpivot([], list(columns), "column", "category")
        .distinct()
        .select(position.alias("position"), "column", "category")
    )


def category_index(features: DataFrame, columns: Sequence[str] = CATEGORICAL) -> DataFrame:
    """(column, category, slot): slots count from 0 over the columns in order and their sorted categories."""
    return _number(categories(features, columns))


def _number(found: DataFrame) -> DataFrame:
    per_column = found.groupBy("position").agg(F.count("*").alias("width"))
    before = Window.orderBy("position").rowsBetween(Window.unboundedPreceding, -1)
    starts = per_column.select("position", F.coalesce(F.sum("width").over(before), F.lit(0)).alias("start"))
    within = Window.partitionBy("position").orderBy(F.asc_nulls_last("category"))
    return found.join(F.broadcast(starts), "position").select(
        "column", "category", (F.col("start") + F.row_number().over(within) - 1).cast("int").alias("slot")
    )


def fit_index(features: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """Written category index, refused when its columns are not categorical at all."""
    found = materialize(categories(features), "categories")
    if not at_most(found, settings.max_categories):
        raise ValueError(f"more than {settings.max_categories} categories: these columns are not categorical")
    return materialize(_number(found), "category-index")


def feature_names(index: DataFrame) -> DataFrame:
    """(feature number, name): the numeric columns, then ``column_category`` per slot."""
    numeric = index.sparkSession.createDataFrame(list(enumerate(NUMERIC)), "feature int, name string")
    named = F.concat_ws("_", "column", F.coalesce("category", F.lit("None")))
    return numeric.unionAll(index.select((F.col("slot") + len(NUMERIC)).cast("int"), named))


def slot_column(column: str) -> str:
    return f"slot_{column}"


SLOTS = tuple(slot_column(c) for c in CATEGORICAL)


def encode(features: DataFrame, index: DataFrame) -> DataFrame:
    """Add one slot number per categorical column, -1 for a category the index does not know.

    Six broadcast joins with the index, whose size is checked.
    """
    if not at_most(index, DEFAULTS.max_categories):
        raise ValueError(f"more than {DEFAULTS.max_categories} categories: the index is too large to broadcast")
    encoded = features
    for column in CATEGORICAL:
        lookup = F.broadcast(
            index.filter(F.col("column") == column).select(F.col("category").alias("_c"), F.col("slot").alias("_s"))
        )
        encoded = (
            encoded.join(lookup, F.col(column).eqNullSafe(F.col("_c")), "left")
            .withColumn(slot_column(column), F.coalesce("_s", F.lit(-1)))
            .drop("_c", "_s")
        )
    return encoded.withColumns({c: F.col(c).cast("double") for c in NUMERIC})


def complete() -> Column:
    """Whether a row has all its numbers; the model does not take the others."""
    known = F.lit(True)
    for column in NUMERIC:
        known = known & F.col(column).isNotNull()
    return known


def matrix_stats(encoded: DataFrame, index: DataFrame) -> DataFrame:
    """Shape and density of the matrix: rows, numeric and one-hot columns, non-zero entries, density in %."""
    entries = F.lit(0)
    for column in NUMERIC:
        entries = entries + F.coalesce((F.col(column) != 0).cast("int"), F.lit(0))
    for column in SLOTS:
        entries = entries + (F.col(column) >= 0).cast("int")
    one_hot = index.agg(F.count("*").alias("n")).scalar()
    return (
        encoded.agg(F.count("*").alias("n_rows"), F.coalesce(F.sum(entries), F.lit(0)).alias("nnz"))
        .withColumns({"n_numeric": F.lit(len(NUMERIC)).cast("bigint"), "n_one_hot": one_hot})
        .withColumn(
            "density_pct",
            F.round(F.try_divide(100.0 * F.col("nnz"), F.col("n_rows") * (F.col("n_numeric") + F.col("n_one_hot"))), 1),
        )
    )
