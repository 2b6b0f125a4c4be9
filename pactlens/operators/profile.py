"""Profile tables of the contracts before the business filter."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pactlens.config import DEFAULTS, END_DATE, SIGN_DATE, START_DATE, SUPPLIER, Settings
from pactlens.functions.calendar import year_of
from pactlens.functions.casts import to_date_or_null, to_double_or_null
from pactlens.operators.ranks import quantile_rank, values_at_ranks
from pactlens.session import materialize

KEY_COLUMNS = (
    "valor_contrato",
    "estado_del_proceso",
    SIGN_DATE,
    START_DATE,
    END_DATE,
    SUPPLIER,
    "modalidad_de_contrataci_n",
    "departamento_entidad",
)
CATEGORY_COLUMNS = ("modalidad_de_contrataci_n", "departamento_entidad", "tipo_de_contrato")
QUANTILES = {"mediana": 0.5, "p95": 0.95, "p99": 0.99}


def schema_profile(contracts: DataFrame) -> DataFrame:
    rows = [(f.name, f.dataType.simpleString(), f.nullable) for f in contracts.schema.fields]
    return contracts.sparkSession.createDataFrame(rows, "column_name string, column_type string, nullable boolean")


def null_counts(contracts: DataFrame, columns: Sequence[str] = KEY_COLUMNS) -> DataFrame:
    nulls = [F.count_if(F.col(c).isNull()).alias(f"nulos_{c}") for c in columns]
    return contracts.agg(*nulls, F.count("*").alias("total"))


def _values(contracts: DataFrame) -> DataFrame:
    return contracts.select(to_double_or_null(F.col("valor_contrato")).alias("v")).filter(F.col("v").isNotNull())


def _quantiles(rows: DataFrame, column: str) -> dict[str, Column]:
    """Discrete quantiles by name, exact; NULL on an empty table."""
    n = rows.count()
    ranks = [quantile_rank(q, n) for q in QUANTILES.values()]
    values = [v for v, _, _ in values_at_ranks(rows, F.col(column), ranks)] if n else [None] * len(ranks)
    return {name: F.lit(v).cast(rows.schema[column].dataType) for name, v in zip(QUANTILES, values)}


def value_range(contracts: DataFrame) -> DataFrame:
    """Number, least, mean and largest of the amounts, in one pass."""
    return _values(contracts).agg(
        F.count("*").alias("n"), F.min("v").alias("minimo"), F.avg("v").alias("promedio"), F.max("v").alias("maximo")
    )


def value_distribution(contracts: DataFrame) -> DataFrame:
    values = _values(contracts)
    return value_range(contracts).withColumns(_quantiles(values, "v")).select("n", "minimo", "mediana", "promedio", "p95", "p99", "maximo")


def in_range_share(contracts: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    inside = F.count_if(F.col("v").between(float(settings.value_min), float(settings.value_max)))
    return (
        _values(contracts)
        .agg(F.count("*").alias("total_con_valor"), inside.alias("dentro_del_rango"))
        .withColumn("pct_dentro_del_rango", F.round(F.try_divide(100.0 * F.col("dentro_del_rango"), F.col("total_con_valor")), 2))
    )


def value_histogram(contracts: DataFrame, settings: Settings = DEFAULTS, bins: int = 80) -> DataFrame:
    """Counts per equal-width bin over the value range, on all rows; the last bin includes its upper bound."""
    low, high = float(settings.value_min), float(settings.value_max)
    bin_number = F.least(F.width_bucket("v", F.lit(low), F.lit(high), F.lit(bins)), F.lit(bins).cast("bigint"))
    return _values(contracts).filter(F.col("v").between(low, high)).groupBy(bin_number.alias("bin")).agg(
        F.count("*").alias("n")
    )


def state_counts(contracts: DataFrame) -> DataFrame:
    return contracts.groupBy(F.lower("estado_del_proceso").alias("estado")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "estado")


def date_quality(contracts: DataFrame) -> DataFrame:
    dates = contracts.select(
        to_date_or_null(F.col(START_DATE)).alias("s"), to_date_or_null(F.col(END_DATE)).alias("e")
    )
    return dates.agg(
        F.count_if(F.col("s").isNull()).alias("inicio_nulo"),
        F.count_if(F.col("e").isNull()).alias("fin_nulo"),
        F.count_if(F.col("e") < F.col("s")).alias("fin_antes_de_inicio"),
        F.count("*").alias("total"),
    )


def year_profile(contracts: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    signed = contracts.select(
        year_of(to_date_or_null(F.col(SIGN_DATE))).alias("anio"), to_double_or_null(F.col("valor_contrato")).alias("v")
    ).filter(F.col("v").between(float(settings.value_min), float(settings.value_max)) & F.col("anio").isNotNull())
    return (
        signed.groupBy("anio")
        .agg(F.count("*").alias("n_contratos"), F.round(F.avg("v"), 0).alias("valor_promedio_nominal"))
        .orderBy("anio")
    )


def _per_supplier(contracts: DataFrame) -> DataFrame:
    return contracts.filter(F.col(SUPPLIER).isNotNull()).groupBy(SUPPLIER).agg(F.count("*").alias("n")).select("n")


def _count_range(per_supplier: DataFrame) -> DataFrame:
    return per_supplier.agg(
        F.min("n").alias("minimo"), F.max("n").alias("maximo"), F.count("*").alias("n_proveedores_distintos")
    )


def supplier_range(contracts: DataFrame) -> DataFrame:
    """Least and largest number of contracts of a supplier, and the number of suppliers."""
    return _count_range(_per_supplier(contracts))


def supplier_concentration(contracts: DataFrame) -> DataFrame:
    """Distribution of the number of contracts per supplier."""
    per_supplier = materialize(_per_supplier(contracts), "contracts-per-supplier")
    return _count_range(per_supplier).withColumns(_quantiles(per_supplier, "n")).select(
        "minimo", "mediana", "p95", "p99", "maximo", "n_proveedores_distintos"
    )


def cardinality(contracts: DataFrame, columns: Sequence[str] = CATEGORY_COLUMNS) -> DataFrame:
    """Distinct non-NULL values per column; values are made distinct in the map tasks before they move."""
    long = contracts.select(*columns).unpivot([], list(columns), "column_name", "value")
    return long.groupBy("column_name").agg(F.count_distinct("value").alias("n_valores"))


def profile_contracts(contracts: DataFrame, settings: Settings = DEFAULTS) -> dict[str, DataFrame]:
    """All profile tables by name."""
    return {
        "schema": schema_profile(contracts),
        "nulls": null_counts(contracts),
        "value_distribution": value_distribution(contracts),
        "in_range_share": in_range_share(contracts, settings),
        "value_histogram": value_histogram(contracts, settings),
        "states": state_counts(contracts),
        "date_quality": date_quality(contracts),
        "years": year_profile(contracts, settings),
        "supplier_concentration": supplier_concentration(contracts),
        "cardinality": cardinality(contracts),
    }
