"""Business filter and alert features of contracts."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pactlens.config import (
    CATEGORICAL,
    DEFAULTS,
    END_DATE,
    FEATURE_COLUMNS,
    IDENTIFIERS,
    RENAMES,
    SIGN_DATE,
    SIGN_YEAR,
    START_DATE,
    SUPPLIER,
    Settings,
)
from pactlens.functions.calendar import days_between, month_of, weekday_of, year_of
from pactlens.functions.casts import to_date_or_null, to_double_or_null
from pactlens.functions.hashing import exact_mean, exact_sum
from pactlens.operators.lookup import attach_counts, attach_small
from pactlens.session import materialize

_RAW_CATEGORICAL = tuple({v: k for k, v in RENAMES.items()}.get(c, c) for c in CATEGORICAL)


def needed_columns(settings: Settings = DEFAULTS) -> list[str]:
    """Raw columns the features read; long free text stays out, apart from the one which tells items apart."""
    wanted = (
        "estado_del_proceso",
        "valor_contrato",
        SIGN_DATE,
        START_DATE,
        END_DATE,
        SUPPLIER,
        *(k for k in settings.category_keys if k != SIGN_YEAR),
        *_RAW_CATEGORICAL,
        *IDENTIFIERS,
    )
    return list(dict.fromkeys(wanted))


def _evaluated_once(rows: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """Replace columns by costly expressions, evaluated once per row.

    Catalyst would copy them into every later filter and projection; it does not look through a generator, here one
    which always gives one row.
    """
    one = F.array(F.struct(*[expression.alias(name) for name, expression in columns.items()]))
    generated = rows.withColumn("_once", F.explode(one))
    return generated.withColumns({name: F.col(f"_once.{name}") for name in columns}).drop("_once")


def typed_contracts(contracts: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """The needed columns, with the amount as double and the three dates as dates."""
    filtered_by = {
        "valor_contrato": to_double_or_null(F.col("valor_contrato")),
        **{c: to_date_or_null(F.col(c)) for c in (START_DATE, END_DATE)},
    }
    typed = _evaluated_once(contracts.select(*needed_columns(settings)), filtered_by).withColumn(
        SIGN_DATE, to_date_or_null(F.col(SIGN_DATE))
    )
    if SIGN_YEAR in settings.category_keys:
        typed = typed.withColumn(SIGN_YEAR, year_of(F.col(SIGN_DATE)))
    return typed


def business_filter(typed: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """Valid state, value in range (bounds included), both execution dates known and in order.

    The comparison of the dates is NULL, so the row is dropped, when one of them is.
    """
    return typed.filter(
        F.lower("estado_del_proceso").isin(*settings.valid_states)
        & F.col("valor_contrato").between(F.lit(float(settings.value_min)), F.lit(float(settings.value_max)))
        & (F.col(END_DATE) >= F.col(START_DATE))
    )


def eligible_contracts(contracts: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    return business_filter(typed_contracts(contracts, settings), settings)


def group_totals(eligible: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """Sum and count per category and supplier: one scan feeds both the category means and the supplier counts."""
    return eligible.groupBy(*settings.category_keys, SUPPLIER).agg(
        exact_sum(F.col("valor_contrato")).alias("total"), F.count("*").alias("n")
    )


def category_means(totals: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    return totals.groupBy(*keys).agg(exact_mean(F.sum("total"), F.sum("n")).alias("promedio_categoria"))


def supplier_counts(totals: DataFrame) -> DataFrame:
    return totals.groupBy(SUPPLIER).agg(F.sum("n").alias("concentracion_proveedor"))


def build_features(contracts: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """The 19-column features table."""
    return features_with_totals(contracts, settings)[0]


def features_with_totals(contracts: DataFrame, settings: Settings = DEFAULTS) -> tuple[DataFrame, DataFrame]:
    """Features, and the written group totals behind them.

    The inner lookups drop rows whose category keys or supplier are NULL.  The totals are written once: their
    measured row counts decide between a broadcast and a shuffle join.
    """
    eligible = eligible_contracts(contracts, settings)
    totals = materialize(group_totals(eligible, settings), "group-totals")
    means = category_means(totals, settings.category_keys)
    counts = materialize(supplier_counts(totals), "supplier-counts")
    with_mean = attach_small(eligible, means, settings.category_keys, "inner", settings.broadcast_rows)
    joined = attach_counts(with_mean, counts, SUPPLIER, "concentracion_proveedor", "inner", settings.broadcast_rows)
    features = joined.withColumns(
        {
            "valor_vs_promedio_categoria": F.try_divide("valor_contrato", "promedio_categoria"),
            "duracion_dias": days_between(F.col(START_DATE), F.col(END_DATE)),
            "mes_firma": month_of(F.col(SIGN_DATE)),
            "dia_semana_firma": weekday_of(F.col(SIGN_DATE)),
        }
    )
    return features.withColumnsRenamed(RENAMES).select(*FEATURE_COLUMNS), totals


def features_summary(totals: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """One row from the group totals: rows which pass the filter, rows lost to a NULL key, rows of the features."""
    no_null_key = reduce(and_, [F.col(k).isNotNull() for k in (*settings.category_keys, SUPPLIER)])
    kept = F.coalesce(F.sum(F.when(no_null_key, F.col("n"))), F.lit(0))
    passed = F.coalesce(F.sum("n"), F.lit(0))
    return totals.agg(passed.alias("input_rows"), kept.alias("output_rows"), (passed - kept).alias("null_key_rows"))
