"""Reference tables of the history and the features of contracts which are not part of it yet."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pactlens.config import CATEGORICAL, DEFAULTS, SIGN_DATE, SIGN_YEAR, SUPPLIER, Settings
from pactlens.functions.calendar import days_between, month_of, weekday_of, year_of
from pactlens.functions.hashing import content_hash, exact_mean, exact_sum
from pactlens.operators.lookup import at_most, attach_counts

MEAN_SALT = 32


def reference_category_means(features: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    return _with_year(features, settings).groupBy(*settings.feature_category_keys).agg(
        exact_mean(exact_sum(F.col("valor_contrato")), F.count("valor_contrato")).alias("promedio_categoria")
    )


def reference_supplier_counts(features: DataFrame) -> DataFrame:
    return features.groupBy(SUPPLIER).agg(F.count("*").alias("concentracion_proveedor"))


def mean_of_means(means: DataFrame) -> DataFrame:
    """One row: the unweighted mean of the category means, the fallback of an unseen category."""
    total = F.sum(F.col("promedio_categoria").cast("decimal(30,6)"))
    return means.agg(exact_mean(total, F.count("promedio_categoria")).alias("global_mean_of_means"))


@dataclass(frozen=True)
class ReferenceTables:
    means: DataFrame
    counts: DataFrame
    global_mean: float
    broadcast_means: bool
    broadcast_counts: bool


def reference_tables(means: DataFrame, counts: DataFrame, settings: Settings = DEFAULTS) -> ReferenceTables:
    """Bind two written reference tables; their sizes are checked here, once."""
    return ReferenceTables(
        means,
        counts,
        mean_of_means(means).first()[0],
        at_most(means, settings.broadcast_rows),
        at_most(counts, settings.broadcast_rows),
    )


def load_reference_tables(spark: SparkSession, folder: str, settings: Settings = DEFAULTS) -> ReferenceTables:
    return reference_tables(
        spark.read.parquet(f"{folder}/categoria_promedios"), spark.read.parquet(f"{folder}/proveedor_conteos"), settings
    )


def featurize_new(new: DataFrame, tables: ReferenceTables, settings: Settings = DEFAULTS) -> DataFrame:
    """The 12 model columns of new contracts, batch or stream.

    A known supplier gets its count plus this contract, an unknown one 1; an unseen category is compared with
    the mean of means; a zero mean gives ratio 0.  The mean of a category does not include the new contract.
    """
    keyed = _attach_means(_with_year(new, settings), tables, list(settings.feature_category_keys))
    counts = tables.counts.withColumnRenamed("concentracion_proveedor", "_seen")
    known = attach_counts(keyed, counts, SUPPLIER, "_seen", "left", settings.broadcast_rows)
    mean = F.coalesce(F.col("promedio_categoria"), F.lit(tables.global_mean))
    return known.select(
        "numero_del_contrato",
        "valor_contrato",
        F.coalesce(F.try_divide(F.col("valor_contrato"), mean), F.lit(0.0)).alias("valor_vs_promedio_categoria"),
        days_between(F.col("fecha_inicio_ejecucion"), F.col("fecha_fin_ejecucion")).alias("duracion_dias"),
        month_of(F.col(SIGN_DATE)).alias("mes_firma"),
        weekday_of(F.col(SIGN_DATE)).alias("dia_semana_firma"),
        F.coalesce(F.col("_seen") + 1, F.lit(1)).cast("bigint").alias("concentracion_proveedor"),
        *CATEGORICAL,
    )


def _attach_means(new: DataFrame, tables: ReferenceTables, keys: list[str]) -> DataFrame:
    """Join the mean of each category.  Beyond the broadcast bound the rows of a category go to ``MEAN_SALT`` tasks."""
    if tables.broadcast_means:
        return new.join(F.broadcast(tables.means), keys, "left")
    salt = F.pmod(content_hash(new.columns), F.lit(MEAN_SALT)).cast("int")
    copies = tables.means.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(MEAN_SALT - 1))))
    return new.withColumn("_salt", salt).join(copies, [*keys, "_salt"], "left").drop("_salt")


REQUIRED_NEW = (
    "numero_del_contrato",
    "valor_contrato",
    SIGN_DATE,
    "fecha_inicio_ejecucion",
    "fecha_fin_ejecucion",
    SUPPLIER,
    *CATEGORICAL,
)


def violations() -> Column:
    """Codes of the broken input rules of a new contract; an empty array means it is accepted."""
    rules = [F.when(F.col(c).isNull(), F.lit(f"missing:{c}")) for c in REQUIRED_NEW]
    value = F.col("valor_contrato")
    rules.append(F.when(~(value > 0) | F.isnan(value), F.lit("value_not_positive")))
    rules.append(F.when(F.col("fecha_fin_ejecucion") < F.col("fecha_inicio_ejecucion"), F.lit("end_before_start")))
    return F.array_compact(F.array(*rules))


def validate_new(new: DataFrame) -> DataFrame:
    return new.withColumn("violations", violations())


def split_valid(new: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Accepted contracts, and the rest with the codes of the rules they break."""
    checked = validate_new(new)
    accepted = F.size("violations") == 0
    return checked.filter(accepted).drop("violations"), checked.filter(~accepted)


def _with_year(df: DataFrame, settings: Settings) -> DataFrame:
    return df.withColumn(SIGN_YEAR, year_of(F.col(SIGN_DATE))) if SIGN_YEAR in settings.category_keys else df
