"""Registered queries over the driver's tables, each with the SQL it must agree with."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

import driver_tables as tables
from driver_tables import (
    CONTRACTS_SQL,
    ELIGIBLE_SQL,
    NEW_SQL,
    RAW_SQL,
    SETTINGS,
    features_sql,
    with_contracts,
    with_eligible,
    with_features,
)
from pactlens.config import CATEGORICAL, NUMERIC, RAW_COLUMNS, SIGN_YEAR, SUPPLIER
from pactlens.functions.calendar import iso_timestamp, text_bound, year_of
from pactlens.functions.hashing import exact_mean, exact_sum
from pactlens.operators import dedup, drift, encode, features, kept, monitor, profile, reference, sampling, summaries
from pactlens.operators.forest import evaluate, explain, fit, score
from pactlens.operators.forest.tree import average_path
from pactlens.session import materialize, new_path
from pactlens.sources import bronze, landing, windows
from pactlens.streaming import contracts as streams

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None):
    """Register the function under its own name, with its SQL twin if there is one."""

    def register(build):
        QUERIES[build.__name__] = build
        if sql is not None:
            ORACLE[build.__name__] = sql
        return build

    return register


def r6(column: str) -> Column:
    return F.round(column, 6).alias(column)


# --- business filter and features -------------------------------------------------------------------------------

_TYPED = "valor_contrato, fecha_de_firma_del_contrato, fecha_inicio_ejecuci_n, fecha_fin_ejecuci_n"


@query(with_eligible(f"SELECT url_contrato, numero_del_contrato, estado_del_proceso, {_TYPED} FROM eligible"))
def business_filter(spark, sf):
    return features.eligible_contracts(tables.contracts(spark, sf), SETTINGS).select(
        "url_contrato", "numero_del_contrato", "estado_del_proceso", *_TYPED.split(", ")
    )


@query(with_features("SELECT * REPLACE (ROUND(valor_vs_promedio_categoria, 6) AS valor_vs_promedio_categoria) FROM features"))
def features_full(spark, sf):
    table = features.build_features(tables.contracts(spark, sf), SETTINGS)
    return table.withColumn("valor_vs_promedio_categoria", F.round("valor_vs_promedio_categoria", 6))


@query(
    f"WITH {CONTRACTS_SQL},{ELIGIBLE_SQL}, dated AS (SELECT *, YEAR(fecha_de_firma_del_contrato) AS anio_firma FROM eligible),"
    + features_sql("by_year", "dated", "modalidad_de_contrataci_n, departamento_entidad, anio_firma")
    + "SELECT url_contrato, ROUND(valor_vs_promedio_categoria, 6) AS valor_vs_promedio_categoria FROM by_year"
)
def features_year_normalised(spark, sf):
    by_year = SETTINGS.with_(category_keys=(*SETTINGS.category_keys, SIGN_YEAR))
    table = features.build_features(tables.contracts(spark, sf), by_year)
    return table.select("url_contrato", r6("valor_vs_promedio_categoria"))


@query(
    with_features(
        """SELECT (SELECT COUNT(*) FROM eligible) AS input_rows, (SELECT COUNT(*) FROM features) AS output_rows,
        (SELECT COUNT(*) FROM eligible WHERE modalidad_de_contrataci_n IS NULL OR departamento_entidad IS NULL
          OR documento_proveedor IS NULL) AS null_key_rows"""
    )
)
def features_summary(spark, sf):
    return features.features_summary(features.features_with_totals(tables.contracts(spark, sf), SETTINGS)[1], SETTINGS)


# --- deduplication ----------------------------------------------------------------------------------------------

_DEDUP = "SELECT * EXCLUDE (ingestion_date), MAX(ingestion_date) AS ingestion_date FROM raw GROUP BY ALL"


@query(f"WITH {CONTRACTS_SQL},{RAW_SQL} {_DEDUP}")
def dedup_full_row(spark, sf):
    return dedup.dedup_rows(tables.raw_sightings(spark, sf))


def _kept_root(spark, sf):
    """The kept table after both ingestion runs, the later one first, and the first of them once more."""
    key = (spark.sparkContext.applicationId, sf, "kept")
    if key not in _forests:
        root = new_path(spark, "kept")
        raw = tables.raw_sightings(spark, sf)
        for day in ("1998-02-01", "1998-01-01", "1998-02-01"):
            kept.add_partition(raw.filter(F.col("ingestion_date") == day), root, StructType([raw.schema[c] for c in raw.columns if c != "ingestion_date"]))
        _forests[key] = root
    return _forests[key]


@query(f"WITH {CONTRACTS_SQL},{RAW_SQL} {_DEDUP}")
def dedup_incremental(spark, sf):
    """Partition by partition into the kept table: the rows of the full run."""
    raw = tables.raw_sightings(spark, sf)
    return kept.read_kept(spark, _kept_root(spark, sf), StructType([raw.schema[c] for c in raw.columns if c != "ingestion_date"]))


@query(
    f"WITH {CONTRACTS_SQL},{RAW_SQL}, kept AS ({_DEDUP}), n AS (SELECT (SELECT COUNT(*) FROM raw) AS input_rows,"
    " (SELECT COUNT(*) FROM kept) AS output_rows) SELECT *, input_rows - output_rows AS duplicates_removed FROM n"
)
def dedup_summary(spark, sf):
    raw = tables.raw_sightings(spark, sf)
    return dedup.dedup_summary(raw, dedup.dedup_rows(raw))


# --- reference tables and new contracts -------------------------------------------------------------------------

_MEANS = """SELECT modalidad_de_contratacion, departamento_entidad,
  CAST(SUM(CAST(valor_contrato AS DECIMAL(20,2))) AS DOUBLE) / COUNT(*) AS promedio_categoria
  FROM features GROUP BY modalidad_de_contratacion, departamento_entidad"""


@query(with_features(f"SELECT * REPLACE (ROUND(promedio_categoria, 6) AS promedio_categoria) FROM ({_MEANS})"))
def category_means(spark, sf):
    return reference.reference_category_means(tables.features(spark, sf), SETTINGS).withColumn(
        "promedio_categoria", F.round("promedio_categoria", 6)
    )


@query(with_features("SELECT documento_proveedor, COUNT(*) AS concentracion_proveedor FROM features GROUP BY documento_proveedor"))
def supplier_counts(spark, sf):
    return reference.reference_supplier_counts(tables.features(spark, sf))


@query(with_features(f"SELECT ROUND(AVG(promedio_categoria), 4) AS global_mean_of_means FROM ({_MEANS})"))
def global_mean(spark, sf):
    means = reference.reference_category_means(tables.features(spark, sf), SETTINGS)
    return reference.mean_of_means(means).select(F.round("global_mean_of_means", 4).alias("global_mean_of_means"))


_REQUIRED_SQL = ", ".join(f"CASE WHEN {c} IS NULL THEN 'missing:{c}' END" for c in reference.REQUIRED_NEW)
_VIOLATIONS = f"""CONCAT_WS(',', {_REQUIRED_SQL}, CASE WHEN NOT valor_contrato > 0 OR ISNAN(valor_contrato) THEN 'value_not_positive' END,
  CASE WHEN fecha_fin_ejecucion < fecha_inicio_ejecucion THEN 'end_before_start' END)"""


@query(f"WITH {CONTRACTS_SQL},{NEW_SQL} SELECT url_contrato, {_VIOLATIONS} AS violations FROM incoming")
def validate_new(spark, sf):
    return reference.validate_new(tables.new_contracts(spark, sf)).select(
        "url_contrato", F.array_join("violations", ",").alias("violations")
    )


@query(f"WITH {CONTRACTS_SQL},{NEW_SQL} SELECT {_VIOLATIONS} = '' AS accepted, COUNT(*) AS n FROM incoming GROUP BY 1")
def quarantine_split(spark, sf):
    accepted, rejected = reference.split_valid(tables.new_contracts(spark, sf))
    sides = accepted.select(F.lit(True).alias("accepted")).unionAll(rejected.select(F.lit(False).alias("accepted")))
    return sides.groupBy("accepted").agg(F.count("*").alias("n"))


_HISTORY = "history AS (SELECT * FROM features WHERE YEAR(fecha_de_firma_del_contrato) < 2001)"
_NEW_FEATURES = f"""
m AS ({_MEANS.replace("FROM features", "FROM history")}),
s AS (SELECT documento_proveedor, COUNT(*) AS seen FROM history GROUP BY documento_proveedor),
accepted AS (SELECT * FROM incoming WHERE {_VIOLATIONS} = ''),
fresh AS (
  SELECT url_contrato, valor_contrato, COALESCE(valor_contrato / NULLIF(COALESCE(promedio_categoria,
      (SELECT AVG(promedio_categoria) FROM m)), 0), 0.0) AS valor_vs_promedio_categoria,
    DATE_DIFF('day', fecha_inicio_ejecucion, fecha_fin_ejecucion) AS duracion_dias,
    MONTH(fecha_de_firma_del_contrato) AS mes_firma, DAYOFWEEK(fecha_de_firma_del_contrato) AS dia_semana_firma,
    COALESCE(seen + 1, 1) AS concentracion_proveedor, modalidad_de_contratacion, departamento_entidad, nivel_entidad,
    tipo_de_contrato, origen, tipo_documento_proveedor, numero_del_contrato
  FROM accepted LEFT JOIN m USING (modalidad_de_contratacion, departamento_entidad) LEFT JOIN s USING (documento_proveedor)
)"""


def history_references(spark, sf):
    """Reference tables of the contracts signed before the new ones."""
    past = tables.features(spark, sf).filter(year_of(F.col("fecha_de_firma_del_contrato")) < tables.NEW_FROM)
    means = tables.written_once(spark, sf, "means", lambda: reference.reference_category_means(past, SETTINGS))
    counts = tables.written_once(spark, sf, "counts", lambda: reference.reference_supplier_counts(past))
    return reference.reference_tables(means, counts, SETTINGS)


def fresh_features(spark, sf):
    accepted, _ = reference.split_valid(tables.new_contracts(spark, sf))
    return reference.featurize_new(accepted, history_references(spark, sf), SETTINGS)


@query(
    with_features(
        "SELECT * EXCLUDE (url_contrato) REPLACE (ROUND(valor_vs_promedio_categoria, 6) AS valor_vs_promedio_categoria) FROM fresh",
        _HISTORY, NEW_SQL, _NEW_FEATURES,
    )
)
def featurize_new(spark, sf):
    return fresh_features(spark, sf).withColumn(
        "valor_vs_promedio_categoria", F.round("valor_vs_promedio_categoria", 6)
    )


# --- profile ----------------------------------------------------------------------------------------------------

_NULLS = ", ".join(f"COUNT(*) FILTER (WHERE {c} IS NULL) AS nulos_{c}" for c in profile.KEY_COLUMNS)
_VALUES = "v AS (SELECT TRY_CAST(valor_contrato AS DOUBLE) AS v FROM contracts WHERE TRY_CAST(valor_contrato AS DOUBLE) IS NOT NULL)"
_IN_RANGE = "v BETWEEN 1000000 AND 200000000"


@query(with_contracts(f"SELECT {_NULLS}, COUNT(*) AS total FROM contracts"))
def null_counts(spark, sf):
    return profile.null_counts(tables.contracts(spark, sf))


@query(f"WITH {CONTRACTS_SQL},{_VALUES} SELECT COUNT(*) AS n, MIN(v) AS minimo, ROUND(AVG(v), 4) AS promedio, MAX(v) AS maximo FROM v")
def value_distribution_exact(spark, sf):
    return profile.value_range(tables.contracts(spark, sf)).withColumn("promedio", F.round("promedio", 4))


_QUANTILES = ", ".join(f"QUANTILE_DISC({{0}}, {q}) AS {name}" for name, q in profile.QUANTILES.items())


@query(
    f"""WITH {CONTRACTS_SQL},{_VALUES} SELECT COUNT(*) AS n, MIN(v) AS minimo, ROUND(AVG(v), 4) AS promedio, MAX(v) AS maximo,
    {_QUANTILES.format("v")} FROM v"""
)
def value_distribution(spark, sf):
    table = profile.value_distribution(tables.contracts(spark, sf))
    return table.withColumn("promedio", F.round("promedio", 4))


@query(
    f"""WITH {CONTRACTS_SQL},{_VALUES} SELECT COUNT(*) AS total_con_valor, COUNT(*) FILTER (WHERE {_IN_RANGE}) AS dentro_del_rango,
    ROUND(100.0 * COUNT(*) FILTER (WHERE {_IN_RANGE}) / COUNT(*), 2) AS pct_dentro_del_rango FROM v"""
)
def in_range_share(spark, sf):
    return profile.in_range_share(tables.contracts(spark, sf), SETTINGS)


@query(
    f"""WITH {CONTRACTS_SQL},{_VALUES} SELECT CAST(LEAST(80, FLOOR(80 * (v - 1000000) / 199000000) + 1) AS BIGINT) AS bin,
    COUNT(*) AS n FROM v WHERE {_IN_RANGE} GROUP BY 1"""
)
def value_histogram(spark, sf):
    return profile.value_histogram(tables.contracts(spark, sf), SETTINGS)


@query(with_contracts("SELECT LOWER(estado_del_proceso) AS estado, COUNT(*) AS n FROM contracts GROUP BY 1 ORDER BY n DESC"))
def state_counts(spark, sf):
    return profile.state_counts(tables.contracts(spark, sf))


@query(
    f"""WITH {CONTRACTS_SQL}, d AS (SELECT TRY_CAST(fecha_inicio_ejecuci_n AS DATE) AS s, TRY_CAST(fecha_fin_ejecuci_n AS DATE) AS e
    FROM contracts) SELECT COUNT(*) FILTER (WHERE s IS NULL) AS inicio_nulo, COUNT(*) FILTER (WHERE e IS NULL) AS fin_nulo,
    COUNT(*) FILTER (WHERE e < s) AS fin_antes_de_inicio, COUNT(*) AS total FROM d"""
)
def date_quality(spark, sf):
    return profile.date_quality(tables.contracts(spark, sf))


@query(
    f"""WITH {CONTRACTS_SQL}, v AS (SELECT YEAR(TRY_CAST(fecha_de_firma_del_contrato AS DATE)) AS anio,
    TRY_CAST(valor_contrato AS DOUBLE) AS v FROM contracts) SELECT anio, COUNT(*) AS n_contratos,
    ROUND(AVG(v), 0) AS valor_promedio_nominal FROM v WHERE {_IN_RANGE} AND anio IS NOT NULL GROUP BY anio"""
)
def year_profile(spark, sf):
    return profile.year_profile(tables.contracts(spark, sf), SETTINGS)


@query(
    f"""WITH {CONTRACTS_SQL}, per AS (SELECT documento_proveedor, COUNT(*) AS n FROM contracts WHERE documento_proveedor IS NOT NULL
    GROUP BY 1) SELECT MIN(n) AS minimo, MAX(n) AS maximo, COUNT(*) AS n_proveedores_distintos FROM per"""
)
def supplier_concentration_exact(spark, sf):
    return profile.supplier_range(tables.contracts(spark, sf))


@query(
    f"""WITH {CONTRACTS_SQL}, per AS (SELECT COUNT(*) AS n FROM contracts WHERE documento_proveedor IS NOT NULL
    GROUP BY documento_proveedor) SELECT MIN(n) AS minimo, MAX(n) AS maximo, COUNT(*) AS n_proveedores_distintos,
    {_QUANTILES.format("n")} FROM per"""
)
def supplier_concentration(spark, sf):
    return profile.supplier_concentration(tables.contracts(spark, sf))


@query(
    with_contracts(
        " UNION ALL ".join(
            f"SELECT '{c}' AS column_name, COUNT(DISTINCT {c}) AS n_valores FROM contracts" for c in profile.CATEGORY_COLUMNS
        )
    )
)
def cardinality(spark, sf):
    return profile.cardinality(tables.contracts(spark, sf))


# --- encoding ---------------------------------------------------------------------------------------------------

_CATEGORIES = " UNION ".join(f"SELECT {i} AS position, '{c}' AS \"column\", {c} AS category FROM features" for i, c in enumerate(CATEGORICAL, 1))
_INDEX = f"""idx AS (SELECT "column", category, ROW_NUMBER() OVER (ORDER BY position, category NULLS LAST) - 1 AS slot
  FROM ({_CATEGORIES}))"""


@query(with_features("SELECT \"column\", category, CAST(slot AS INTEGER) AS slot FROM idx", _INDEX))
def category_index(spark, sf):
    return encode.category_index(tables.features(spark, sf))


_HISTORY_INDEX = _INDEX.replace("FROM features", "FROM history")
_SLOT_JOINS = " ".join(
    f"LEFT JOIN idx AS i{k} ON i{k}.\"column\" = '{c}' AND i{k}.category IS NOT DISTINCT FROM n.{c}" for k, c in enumerate(CATEGORICAL)
)
_SLOT_COLUMNS = ", ".join(f"CAST(COALESCE(i{k}.slot, -1) AS INTEGER) AS slot_{c}" for k, c in enumerate(CATEGORICAL))


def history_index(spark, sf):
    past = tables.features(spark, sf).filter(year_of(F.col("fecha_de_firma_del_contrato")) < tables.NEW_FROM)
    return tables.written_once(spark, sf, "history-index", lambda: encode.fit_index(past, SETTINGS))


@query(with_features(f"SELECT url_contrato, {_SLOT_COLUMNS} FROM incoming AS n {_SLOT_JOINS}", _HISTORY, NEW_SQL, _HISTORY_INDEX))
def encoded_slots(spark, sf):
    """New contracts, accepted or not, under the categories of the history: unseen ones get no slot."""
    wide = tables.new_contracts(spark, sf).withColumns({c: F.lit(None).cast("double") for c in NUMERIC})
    return encode.encode(wide, history_index(spark, sf)).select("url_contrato", *encode.SLOTS)


_NONZERO = " + ".join(f"CAST({c} <> 0 AS INTEGER)" for c in NUMERIC)


@query(
    with_features(
        f"""SELECT COUNT(*) AS n_rows, CAST(SUM(COALESCE({_NONZERO}, 0) + 6) AS BIGINT) AS nnz, CAST(6 AS BIGINT) AS n_numeric,
        (SELECT COUNT(*) FROM idx) AS n_one_hot,
        ROUND(100.0 * SUM(COALESCE({_NONZERO}, 0) + 6) / (COUNT(*) * (6 + (SELECT COUNT(*) FROM idx))), 1) AS density_pct FROM features""",
        _INDEX,
    )
)
def matrix_stats(spark, sf):
    table = tables.features(spark, sf)
    index = encode.fit_index(table)
    return encode.matrix_stats(encode.encode(table, index), index)


@query(
    with_features(
        " UNION ALL ".join(f"SELECT CAST({i} AS INTEGER) AS feature, '{c}' AS name" for i, c in enumerate(NUMERIC))
        + " UNION ALL SELECT CAST(slot + 6 AS INTEGER), CONCAT(\"column\", '_', COALESCE(category, 'None')) FROM idx",
        _INDEX,
    )
)
def feature_names(spark, sf):
    return encode.feature_names(encode.category_index(tables.features(spark, sf)))


# --- drift ------------------------------------------------------------------------------------------------------

_MODEL_COLUMNS = ", ".join((*NUMERIC, *CATEGORICAL))
_SPLIT = f"""split AS (SELECT CASE WHEN YEAR(fecha_de_firma_del_contrato) = 1996 THEN 'reference' ELSE 'current' END AS period,
  {_MODEL_COLUMNS} FROM features WHERE YEAR(fecha_de_firma_del_contrato) IN (1996, 2000, 2001))"""


def _frequencies_sql(name, columns, kind):
    parts = " UNION ALL ".join(f"SELECT period, '{c}' AS \"column\", CAST({c} AS {kind}) AS x FROM split" for c in columns)
    return f"""{name} AS (SELECT "column", x, COUNT(*) FILTER (WHERE period = 'reference') AS n_ref,
  COUNT(*) FILTER (WHERE period = 'current') AS n_cur FROM ({parts}) WHERE x IS NOT NULL GROUP BY ALL)"""


_NUM = _frequencies_sql("num", NUMERIC, "DOUBLE")
_CAT = _frequencies_sql("cat", CATEGORICAL, "VARCHAR")
_GAPS = """tot AS (SELECT *, SUM(n_ref) OVER w AS cum_ref, SUM(n_cur) OVER w AS cum_cur, LEAD(x) OVER w AS next_x,
    SUM(n_ref) OVER (PARTITION BY "column") AS size_ref, SUM(n_cur) OVER (PARTITION BY "column") AS size_cur
  FROM num WINDOW w AS (PARTITION BY "column" ORDER BY x)),
gaps AS (SELECT *, ABS(CAST(cum_ref AS DOUBLE) / size_ref - CAST(cum_cur AS DOUBLE) / size_cur) AS gap FROM tot)"""
_NUM_STATS = """num_stats AS (SELECT "column", MAX(gap) AS ks_d, SUM(gap * (next_x - x)) AS w1 FROM gaps GROUP BY 1),
sigma AS (SELECT "column", SQRT(SUM(n_ref * POW(x - mean_ref, 2)) / SUM(n_ref)) AS sigma_ref
  FROM num JOIN (SELECT "column", SUM(x * n_ref) / SUM(n_ref) AS mean_ref FROM num GROUP BY 1) USING ("column") GROUP BY 1)"""
_SHARES = """sh AS (SELECT *, SUM(n_ref) OVER p AS size_ref, SUM(n_cur) OVER p AS size_cur, ROW_NUMBER() OVER (PARTITION BY "column" ORDER BY x) AS k
  FROM cat WINDOW p AS (PARTITION BY "column")),
sh2 AS (SELECT *, CAST(n_ref AS DOUBLE) / size_ref AS p, CAST(n_cur AS DOUBLE) / size_cur AS q,
  CAST(n_ref AS DOUBLE) * size_cur / size_ref AS expected FROM sh),
cat_stats AS (SELECT "column", SUM(POW(n_cur - expected, 2) / expected) AS chi2, COUNT(*) - 1 AS dof,
  SQRT(SUM(CASE WHEN p > 0 THEN p * LN(2 * p / (p + q)) ELSE 0 END + CASE WHEN q > 0 THEN q * LN(2 * q / (p + q)) ELSE 0 END) / 2) AS js_distance
  FROM sh2 GROUP BY 1)"""


def split(spark, sf):
    return drift.split_by_year(tables.features_by_year(spark, sf), SETTINGS)


def numeric_frequencies(spark, sf):
    return tables.written_once(
        spark, sf, "numeric-frequencies", lambda: drift.frequencies(split(spark, sf), NUMERIC, "double")
    )


def category_frequencies(spark, sf):
    return tables.written_once(
        spark, sf, "category-frequencies", lambda: drift.frequencies(split(spark, sf), CATEGORICAL, "string")
    )


@query(
    with_features(
        "SELECT * REPLACE (ROUND(valor_vs_promedio_categoria, 6) AS valor_vs_promedio_categoria) FROM split", _SPLIT
    )
)
def split_by_year(spark, sf):
    return split(spark, sf).withColumn("valor_vs_promedio_categoria", F.round("valor_vs_promedio_categoria", 6))


@query(with_features('SELECT "column", ROUND(ks_d, 9) AS ks_d FROM num_stats', _SPLIT, _NUM, _GAPS, _NUM_STATS))
def drift_ks(spark, sf):
    return drift.numeric_statistics(numeric_frequencies(spark, sf)).select("column", F.round("ks_d", 9).alias("ks_d"))


@query(
    with_features(
        """SELECT "column", ROUND(sigma_ref, 4) AS sigma_ref, ROUND(w1 / GREATEST(sigma_ref, 0.001), 9) AS w1_norm
        FROM num_stats JOIN sigma USING ("column")""",
        _SPLIT, _NUM, _GAPS, _NUM_STATS,
    )
)
def drift_wasserstein(spark, sf):
    return drift.numeric_statistics(numeric_frequencies(spark, sf)).select(
        "column", F.round("sigma_ref", 4).alias("sigma_ref"), F.round("w1_norm", 9).alias("w1_norm")
    )


@query(with_features('SELECT "column", ROUND(chi2, 6) AS chi2, dof FROM cat_stats', _SPLIT, _CAT, _SHARES))
def drift_chi2(spark, sf):
    return drift.categorical_statistics(category_frequencies(spark, sf)).select("column", r6("chi2"), "dof")


@query(with_features('SELECT "column", ROUND(js_distance, 9) AS js_distance FROM cat_stats', _SPLIT, _CAT, _SHARES))
def drift_js(spark, sf):
    return drift.categorical_statistics(category_frequencies(spark, sf)).select(
        "column", F.round("js_distance", 9).alias("js_distance")
    )


@query(
    with_features(
        """SELECT "column", ROUND((p - q) / SQRT((n_ref + n_cur) / (size_ref + size_cur) * (1 - (n_ref + n_cur) / (size_ref + size_cur))
          * (1 / size_ref + 1 / size_cur)), 6) AS z FROM sh2 WHERE k = 1""",
        _SPLIT, _CAT, _SHARES,
    )
)
def drift_ztest(spark, sf):
    return drift.categorical_statistics(category_frequencies(spark, sf)).select("column", r6("z"))


_LARGE = """large AS (
  SELECT "column", 'Wasserstein distance (normed)' AS method, w1 / GREATEST(sigma_ref, 0.001) AS value
  FROM num_stats JOIN sigma USING ("column")
  UNION ALL SELECT "column", 'Jensen-Shannon distance', js_distance FROM cat_stats),
flags AS (SELECT *, value > 0.1 AS drifted FROM large)"""


def distances(spark, sf):
    """The report of a large reference period, whatever the size of the test data."""
    return drift.column_drift(split(spark, sf), SETTINGS.with_(drift_method="distances"))


@query(
    with_features(
        'SELECT "column", method, ROUND(value, 9) AS value, drifted FROM flags', _SPLIT, _NUM, _CAT, _GAPS, _NUM_STATS, _SHARES, _LARGE
    )
)
def drift_flags(spark, sf):
    return distances(spark, sf).select("column", "method", F.round("value", 9).alias("value"), "drifted")


@query(with_features('SELECT "column", method, drifted FROM flags', _SPLIT, _NUM, _CAT, _GAPS, _NUM_STATS, _SHARES, _LARGE))
def drift_flags_sketched(spark, sf):
    """The verdicts again, the wide numeric columns from mergeable sketches."""
    settings = SETTINGS.with_(drift_method="distances", drift_sketch_k=summaries.KLL_K)
    return drift.column_drift(split(spark, sf), settings).select("column", "method", "drifted")


_SUMMARY_SQL = " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", COUNT({c}) AS n, COUNT(*) - COUNT({c}) AS nulls, TRUE AS distinct_holds, {'TRUE' if c in NUMERIC else 'CAST(NULL AS BOOLEAN)'} AS quantiles_hold FROM features"
    for c in (*NUMERIC, *CATEGORICAL)
)


@query(with_features(_SUMMARY_SQL))
def partition_summaries(spark, sf):
    """Summaries by signing year, merged: counts, and whether estimates stay within the stated errors of the exact values."""
    table = tables.features(spark, sf)
    by_year = tables.written_once(
        spark, sf, "year-summaries", lambda: summaries.summarise(table.withColumn("year", year_of(F.col("fecha_de_firma_del_contrato"))), ["year"], NUMERIC, CATEGORICAL)
    )
    shares = (0.01, 0.25, 0.5, 0.75, 0.99)
    found = summaries.quantiles(by_year, shares).groupBy("column").agg(F.map_from_entries(F.collect_list(F.struct("share", "value"))).alias("q"))
    counts = summaries.distinct_counts(by_year).join(found, "column", "left").collect()  # a row for each column
    checks = []
    for r in counts:
        value = F.col(r["column"])
        exact = F.count_distinct(value)
        close = F.abs(F.lit(r["n_distinct"]) - exact) <= F.greatest(exact * 0.03, F.lit(0))
        holds = F.lit(None).cast("boolean")
        if r["q"]:
            e = summaries.rank_error() * 1.5
            holds = F.lit(True)
            for share, at in r["q"].items():
                holds = holds & (F.count_if(value <= at) / F.count(value) >= share - e) & (F.count_if(value < at) / F.count(value) <= share + e)
        checks.append(F.struct(F.lit(r["column"]).alias("column"), F.lit(r["n"]).alias("n"), F.lit(r["nulls"]).alias("nulls"), close.alias("distinct_holds"), holds.alias("quantiles_hold")).alias(r["column"]))
    packed = table.agg(*checks)
    return packed.select(F.explode(F.array(*packed.columns)).alias("x")).select("x.*")


@query()
def drift_tests(spark, sf):
    """The report of a small reference period: p-values."""
    return drift.column_drift(split(spark, sf), SETTINGS.with_(drift_method="tests"))


@query(
    with_features(
        """SELECT COUNT(*) AS n_columns_evaluated, COUNT(*) FILTER (WHERE drifted) AS n_drifted_columns,
        COUNT(*) FILTER (WHERE drifted) / COUNT(*) AS drifted_share, COUNT(*) FILTER (WHERE drifted) / COUNT(*) >= 0.5 AS dataset_drift_detected,
        COALESCE(STRING_AGG("column", ',' ORDER BY "column") FILTER (WHERE drifted), '') AS drifted_columns FROM flags""",
        _SPLIT, _NUM, _CAT, _GAPS, _NUM_STATS, _SHARES, _LARGE,
    )
)
def dataset_drift(spark, sf):
    return drift.dataset_drift(distances(spark, sf), SETTINGS).withColumn(
        "drifted_columns", F.array_join("drifted_columns", ",")
    )


@query(
    with_features(
        """SELECT AVG(CASE WHEN period = 'reference' THEN CAST(drift AS INTEGER) END) AS reference_rate,
        AVG(CASE WHEN period = 'current' THEN CAST(drift AS INTEGER) END) AS current_rate,
        ROUND((AVG(CASE WHEN period = 'current' THEN CAST(drift AS INTEGER) END) / AVG(CASE WHEN period = 'reference' THEN CAST(drift AS INTEGER) END) - 1)
          * 100, 6) AS change_pct FROM (SELECT period, valor_vs_promedio_categoria > 1.5 AS drift FROM split)""",
        _SPLIT,
    )
)
def rate_change(spark, sf):
    """Rate of a flag by period; here the flag is a value of more than 1.5 times the mean of its category."""
    flagged = split(spark, sf).select("period", (F.col("valor_vs_promedio_categoria") > 1.5).alias("is_anomaly"))
    return drift.rate_change(flagged).withColumn("change_pct", F.round("change_pct", 6))


@query(
    with_features(
        """SELECT 'history_growth' AS signal, ROUND(CAST(c AS DOUBLE) / r, 6) AS value, CAST(0.05 AS DOUBLE) AS threshold, CAST(c AS DOUBLE) / r > 0.05 AS fired
          FROM (SELECT COUNT(*) FILTER (WHERE period = 'reference') AS r, COUNT(*) FILTER (WHERE period = 'current') AS c FROM split)
        UNION ALL SELECT 'drifted_share', ROUND(COUNT(*) FILTER (WHERE drifted) / COUNT(*), 6), 0.5, COUNT(*) FILTER (WHERE drifted) / COUNT(*) >= 0.5 FROM flags
        UNION ALL SELECT 'anomaly_rate_change_pct', ROUND(ABS(q / p - 1) * 100, 6), 30.0, ABS(q / p - 1) * 100 > 30
          FROM (SELECT AVG(CAST(valor_vs_promedio_categoria > 1.5 AS INTEGER)) FILTER (WHERE period = 'reference') AS p,
                       AVG(CAST(valor_vs_promedio_categoria > 1.5 AS INTEGER)) FILTER (WHERE period = 'current') AS q FROM split)""",
        _SPLIT, _NUM, _CAT, _GAPS, _NUM_STATS, _SHARES, _LARGE,
    )
)
def retrain_signals(spark, sf):
    history, fresh = drift.period_sizes(split(spark, sf))
    share = drift.dataset_drift(distances(spark, sf), SETTINGS).first()["drifted_share"]
    flagged = split(spark, sf).select("period", (F.col("valor_vs_promedio_categoria") > 1.5).alias("is_anomaly"))
    change = drift.rate_change(flagged).first()["change_pct"]
    return drift.retrain_signals(history, fresh, share, change, spark, SETTINGS).withColumn("value", F.round("value", 6))


# --- samples and top sets ---------------------------------------------------------------------------------------


@query(
    with_features(
        """SELECT url_contrato, valor_contrato FROM (SELECT url_contrato, valor_contrato,
          ROW_NUMBER() OVER (ORDER BY valor_contrato DESC) AS k, COUNT(*) OVER () AS n FROM features) WHERE k <= GREATEST(1, CAST(FLOOR(n * 0.01) AS BIGINT))"""
    )
)
def top_fraction(spark, sf):
    """The highest percent of the contracts by value."""
    rows = tables.features(spark, sf).select("url_contrato", "valor_contrato")
    return sampling.top_fraction(rows, "valor_contrato", 0.01)


@query(
    with_features(
        """SELECT COUNT(*) AS detected, (SELECT COUNT(*) FROM ids) AS planted,
          ROUND(CAST(COUNT(*) AS DOUBLE) / (SELECT COUNT(*) FROM ids), 9) AS recall FROM ids WHERE numero_del_contrato IN (
            SELECT numero_del_contrato FROM (SELECT numero_del_contrato, ROW_NUMBER() OVER (ORDER BY valor_contrato DESC) AS k, COUNT(*) OVER () AS n
            FROM features) WHERE k <= GREATEST(1, CAST(FLOOR(n * 0.01) AS BIGINT)))""",
        "ids AS (SELECT DISTINCT numero_del_contrato FROM features WHERE valor_vs_promedio_categoria > 2)",
    )
)
def recall_at_top(spark, sf):
    """How many contracts of more than twice their category mean are in the highest percent by value."""
    table = tables.features(spark, sf)
    scored = table.select("numero_del_contrato", F.col("valor_contrato").alias("anomaly_score"))
    planted = table.filter(F.col("valor_vs_promedio_categoria") > 2)
    return evaluate.recall_at_top(scored, planted, 0.01).withColumn("recall", F.round("recall", 9))


@query()
def sample_rows(spark, sf):
    """A seeded sample of 1,000 contracts, the same for any layout."""
    return sampling.sample_rows(tables.features(spark, sf), 1_000, SETTINGS.seed)


@query()
def synthetic_anomalies(spark, sf):
    return evaluate.synthetic_anomalies(tables.features(spark, sf), SETTINGS.synthetic_rows, SETTINGS.seed)


@query(
    with_features(
        """SELECT '' AS pattern, COUNT(*) AS n, CAST(SUM(duracion_dias) AS BIGINT) AS dias FROM features
        UNION ALL SELECT 'duracion_extrema', COUNT(*), CAST(SUM(duracion_dias * 20) AS BIGINT) FROM features WHERE valor_vs_promedio_categoria > 2"""
    )
)
def union_synthetic(spark, sf):
    """Rows and disturbed rows in one table; the pattern is missing in the first."""
    table = tables.features(spark, sf)
    disturbed = table.filter(F.col("valor_vs_promedio_categoria") > 2).withColumns(
        {"duracion_dias": F.col("duracion_dias") * evaluate.DURATION_FACTOR, "_synthetic_pattern": F.lit("duracion_extrema")}
    )
    return (
        table.unionByName(disturbed, allowMissingColumns=True)
        .groupBy(F.coalesce("_synthetic_pattern", F.lit("")).alias("pattern"))
        .agg(F.count("*").alias("n"), F.sum("duracion_dias").alias("dias"))
    )


# --- forest -----------------------------------------------------------------------------------------------------


_forests = {}


def forest(spark, sf):
    key = (spark.sparkContext.applicationId, sf)
    if key not in _forests:
        _forests[key] = fit.fit_forest(tables.features(spark, sf), SETTINGS)
    return _forests[key]


@query()
def forest_nodes(spark, sf):
    """Fit: the node table of 500 trees."""
    return fit.fit_forest(tables.features(spark, sf), SETTINGS).nodes


@query()
def forest_scores(spark, sf):
    return score.score_contracts(tables.features(spark, sf), forest(spark, sf))


def scored_features(spark, sf):
    return tables.written_once(
        spark, sf, "scored", lambda: score.with_scores(tables.features(spark, sf), forest(spark, sf))
    )


@query()
def scoring_summary(spark, sf):
    return score.scoring_summary(scored_features(spark, sf))


@query()
def most_atypical(spark, sf):
    return sampling.most_atypical(scored_features(spark, sf).select("numero_del_contrato", "url_contrato", "objeto_a_contratar", "anomaly_score", "is_anomaly"))


@query()
def score_new(spark, sf):
    """New contracts through validation, lookups and the stored model."""
    scored = score.with_scores(fresh_features(spark, sf), forest(spark, sf))
    return scored.select("numero_del_contrato", "anomaly_score", "is_anomaly")


@query()
def model_drift(spark, sf):
    return monitor.model_drift(tables.features_by_year(spark, sf), forest(spark, sf), SETTINGS)


@query()
def compare_models(spark, sf):
    """The fitted model against one of fewer trees."""
    other = fit.fit_forest(tables.features(spark, sf), SETTINGS.with_(n_trees=100, seed=7))
    return monitor.compare_models(tables.features(spark, sf), other, forest(spark, sf), SETTINGS)


@query()
def attribution(spark, sf):
    """Mean absolute attribution per feature over atypical and normal examples."""
    return explain.explain_forest(scored_features(spark, sf), forest(spark, sf), SETTINGS)[1]


@query(with_features(f"SELECT COUNT(*) AS explained, CAST(0 AS BIGINT) AS not_adding_up FROM features WHERE {' AND '.join(f'{c} IS NOT NULL' for c in NUMERIC)}"))
def attribution_checks(spark, sf):
    """Every scored row explained: its attributions and the expected path length add up to its own."""
    model = forest(spark, sf)
    rows = scored_features(spark, sf).where("anomaly_score IS NOT NULL").withColumn("row_id", F.monotonically_increasing_id())
    rows = materialize(rows.select("row_id", "anomaly_score", *NUMERIC, *CATEGORICAL), "explained-rows")
    found = explain.attributions(model, rows).groupBy("row_id").agg(F.sum("attribution").alias("total"))
    expected = model.nodes.where("feature < 0").agg((F.sum(F.col("value") * F.col("n_samples")) / F.lit(model.sample_size * model.n_trees)).alias("e"))
    path = -F.log2(F.col("anomaly_score") + 0.5) * float(average_path(model.sample_size))
    error = F.abs(F.coalesce("total", F.lit(0.0)) + expected.scalar() - path)
    return rows.join(found, "row_id", "left").agg(F.count("*").alias("explained"), F.count_if(error > 1e-6).alias("not_adding_up"))


TRIALS = evaluate.trial_design(SETTINGS.n_trials, SETTINGS.seed)


def trial_scores(spark, sf):
    """The search table under every trial of the design."""
    return tables.written_once(spark, sf, "trial-scores", lambda: evaluate.score_search(tables.features(spark, sf), SETTINGS, TRIALS))


@query()
def tuning_trials(spark, sf):
    """All trials of the design over the whole features table."""
    recalls = evaluate.trial_recalls(trial_scores(spark, sf), TRIALS, SETTINGS.top_fraction)
    return recalls.select("trial_id", "n_trees", "max_samples", "max_features", "recall_at_top")


_COMPLETE = " AND ".join(f"{c} IS NOT NULL" for c in NUMERIC)
_DESIGN = ", ".join(f"({k}, {t['n_trees']}, {t['max_samples']}, CAST('{t['max_features']!r}' AS DOUBLE))" for k, t in enumerate(TRIALS))


@query(
    with_features(
        f"""SELECT trial_id, n_trees, max_samples, max_features, n + {SETTINGS.synthetic_rows} AS scored_rows,
        CAST({SETTINGS.synthetic_rows} AS BIGINT) AS planted, TRUE AS cut_holds, TRUE AS recall_holds
        FROM (SELECT COUNT(*) AS n FROM features WHERE {_COMPLETE}), (VALUES {_DESIGN}) AS d(trial_id, n_trees, max_samples, max_features)"""
    )
)
def tuning_checks(spark, sf):
    """What must hold for each trial, counted over the written scores: the cut leaves fewer rows above than the top holds and
    as many at least from it on, and recall lies between the planted rows above the cut and those from it on."""
    scored = trial_scores(spark, sf)
    recalls = evaluate.trial_recalls(scored, TRIALS, SETTINGS.top_fraction)
    each = scored.select("planted", F.posexplode("scores").alias("trial_id", "score")).join(F.broadcast(recalls), "trial_id")
    above, reached = F.col("score") > F.col("cut"), F.col("score") >= F.col("cut")
    counted = each.groupBy("trial_id", "n_trees", "max_samples", "max_features", "recall_at_top").agg(
        F.count("*").alias("scored_rows"), F.count_if("planted").alias("planted"), F.count_if(above).alias("n_above"), F.count_if(reached).alias("n_reached"),
        F.count_if(above & F.col("planted")).alias("least"), F.count_if(reached & F.col("planted")).alias("most"),
    )
    top = F.greatest(F.lit(1), F.floor(F.col("scored_rows") * SETTINGS.top_fraction))
    hits = F.round(F.col("recall_at_top") * F.col("planted"))
    return counted.select(
        "trial_id", "n_trees", "max_samples", "max_features", "scored_rows", "planted",
        ((F.col("n_above") < top) & (F.col("n_reached") >= top)).alias("cut_holds"),
        ((F.col("least") <= hits) & (hits <= F.col("most"))).alias("recall_holds"),
    )


@query(
    with_features(
        f"""SELECT CAST({SETTINGS.n_trees} AS BIGINT) AS trees, {SETTINGS.n_trees} * LEAST(256, n) AS root_rows, {SETTINGS.n_trees} * LEAST(256, n) AS leaf_rows,
        CAST(0 AS BIGINT) AS unbalanced FROM (SELECT COUNT(*) AS n FROM features WHERE {_COMPLETE})"""
    )
)
def forest_checks(spark, sf):
    """What must hold for fitted trees: full sub-samples at the roots, all of them in the leaves, and children that add up."""
    nodes = forest(spark, sf).nodes
    children = nodes.where("node_id > 0").groupBy("tree_id", F.expr("(node_id - 1) DIV 2").alias("node_id")).agg(F.sum("n_samples").alias("below"))
    joined = nodes.join(children, ["tree_id", "node_id"], "left")
    inner = F.col("feature") >= 0
    return joined.agg(
        F.count_distinct("tree_id").alias("trees"),
        F.sum(F.when(F.col("node_id") == 0, F.col("n_samples")).otherwise(0)).alias("root_rows"),
        F.sum(F.when(inner, 0).otherwise(F.col("n_samples"))).alias("leaf_rows"),
        F.count_if((inner & ~F.col("below").eqNullSafe(F.col("n_samples").cast("long"))) | (~inner & F.col("below").isNotNull())).alias("unbalanced"),
    )


@query(
    with_features(
        f"""SELECT COUNT(*) AS rows, COUNT(*) FILTER ({_COMPLETE}) AS scored, COUNT(*) FILTER ({_COMPLETE}) AS in_range,
        CAST(0 AS BIGINT) AS wrong_flags FROM features"""
    )
)
def score_checks(spark, sf):
    """What must hold for scores: one for each complete row, between -0.5 and 0.5, and flagged when above 0."""
    value = F.col("anomaly_score")
    return scored_features(spark, sf).agg(
        F.count("*").alias("rows"),
        F.count("anomaly_score").alias("scored"),
        F.count_if((value > -0.5) & (value < 0.5)).alias("in_range"),
        F.count_if(~F.col("is_anomaly").eqNullSafe(value > 0)).alias("wrong_flags"),
    )


# --- extract ----------------------------------------------------------------------------------------------------

_PRESENT = ("nivel_entidad", "departamento_entidad", "estado_del_proceso", "modalidad_de_contrataci_n", "objeto_a_contratar",
            "tipo_de_contrato", "fecha_de_firma_del_contrato", "fecha_inicio_ejecuci_n", "fecha_fin_ejecuci_n",
            "numero_del_contrato", "valor_contrato", "url_contrato", "origen", "tipo_documento_proveedor", "documento_proveedor")
_LANDED = ", ".join(c if c in _PRESENT else f"CAST(NULL AS VARCHAR) AS {c}" for c in RAW_COLUMNS)


@query(with_contracts(f"SELECT {_LANDED} FROM contracts"))
def raw_landing_22(spark, sf):
    return landing.land(tables.contracts(spark, sf))


_RANGE = """span AS (SELECT GREATEST(MAX(CAST(o_orderdate AS TIMESTAMP)) - INTERVAL 5 DAY, TIMESTAMP '1995-01-01') AS lo,
  DATE_TRUNC('day', TIMESTAMP '2001-12-03 15:30:00' + INTERVAL 1 DAY) AS hi FROM orders)"""


def _span(spark, sf):
    """The checkpoint is the latest signing date of the data."""
    seen = spark.read.parquet(f"{sf}/orders.parquet").agg(F.max("o_orderdate").cast("timestamp").alias("last_extraction_end"))
    settings = SETTINGS.with_(history_start="1995-01-01")
    return windows.extract_range(seen, F.lit("2001-12-03 15:30:00").cast("timestamp"), settings)


def _iso(column):
    return iso_timestamp(F.col(column)).alias(column)


@query(f"WITH {_RANGE} SELECT STRFTIME(lo, '%Y-%m-%dT%H:%M:%S') AS lo, STRFTIME(hi, '%Y-%m-%dT%H:%M:%S') AS hi FROM span")
def range_plan(spark, sf):
    return _span(spark, sf).select(_iso("lo"), _iso("hi"))


@query(
    f"""WITH {_RANGE} SELECT STRFTIME(s, '%Y-%m-%dT%H:%M:%S') AS window_start, STRFTIME(LEAST(s + INTERVAL 15 DAY, hi), '%Y-%m-%dT%H:%M:%S') AS window_end
    FROM span, UNNEST(GENERATE_SERIES(lo, hi - INTERVAL 1 MICROSECOND, INTERVAL 15 DAY)) AS g(s)"""
)
def window_plan(spark, sf):
    return windows.date_windows(_span(spark, sf)).select(_iso("window_start"), _iso("window_end"))


@query(
    with_contracts(
        """SELECT url_contrato, fecha_de_firma_del_contrato FROM contracts WHERE CAST(fecha_de_firma_del_contrato AS TIMESTAMP) >= TIMESTAMP '1998-01-01'
        AND CAST(fecha_de_firma_del_contrato AS TIMESTAMP) < TIMESTAMP '1998-01-16'"""
    )
)
def extract_window(spark, sf):
    """One half-open window of the extract."""
    day = F.col("fecha_de_firma_del_contrato")
    rows = tables.contracts(spark, sf).filter(windows.within(day, *[text_bound(F.lit(t).cast("timestamp")) for t in ("1998-01-01", "1998-01-16")]))
    return rows.select("url_contrato", "fecha_de_firma_del_contrato")


@query(
    f"""WITH {CONTRACTS_SQL},{RAW_SQL} SELECT CASE ingestion_date WHEN '1998-01-01' THEN '1998-01-05' ELSE '2001-12-03' END AS ingestion_date,
    COUNT(*) AS n, COUNT(DISTINCT url_contrato) AS n_urls FROM raw GROUP BY ALL"""
)
def incremental_extract(spark, sf):
    """Two runs over all contracts; the second starts five days before the checkpoint of the first."""
    root, checkpoint = new_path(spark, "extract"), new_path(spark, "extract-checkpoint")
    settings = SETTINGS.with_(history_start="1995-01-01")
    for now in (datetime(1998, 1, 5, 12, tzinfo=timezone.utc), datetime(2001, 12, 3, 12, tzinfo=timezone.utc)):
        landing.extract(tables.contracts(spark, sf), root, checkpoint, now, settings=settings)
    return bronze.read_raw(spark, root).groupBy("ingestion_date").agg(
        F.count("*").alias("n"), F.count_distinct("url_contrato").alias("n_urls")
    )


@query(
    f"WITH {CONTRACTS_SQL},{RAW_SQL} SELECT ingestion_date, COUNT(*) AS n FROM raw GROUP BY ingestion_date"
)
def partition_inventory(spark, sf):
    """Raw sightings written by ingestion date and read back with the date as text."""
    root = new_path(spark, "raw")
    sightings = tables.raw_sightings(spark, sf)
    for day in ("1998-01-01", "1998-02-01"):
        landing.write_raw(landing.land(sightings.filter(F.col("ingestion_date") == day)), root, day)
    return bronze.partition_inventory(bronze.read_raw(spark, root))


# --- streams ----------------------------------------------------------------------------------------------------


def contract_files(spark, sf):
    """The contracts as JSON files in two drops by signing date, the second with the overlap again."""
    key = (spark.sparkContext.applicationId, sf, "json")
    if key not in _forests:
        root = new_path(spark, "json")
        landed = landing.land(tables.contracts(spark, sf))
        day = F.col("fecha_de_firma_del_contrato")
        landed.filter(day < "1998-01-06").write.mode("append").json(root)
        landed.filter(day >= "1998-01-01").write.mode("append").json(root)
        _forests[key] = root
    return _forests[key]


@query(f"WITH {CONTRACTS_SQL},{RAW_SQL} SELECT COUNT(*) AS n, COUNT(DISTINCT url_contrato) AS n_urls FROM raw")
def stream_landing(spark, sf):
    root = new_path(spark, "landed")
    pages = streams.read_json_stream(spark, contract_files(spark, sf))
    streams.land_stream(pages, root, new_path(spark, "checkpoint")).awaitTermination()
    return bronze.read_raw(spark, root).agg(F.count("*").alias("n"), F.count_distinct("url_contrato").alias("n_urls"))


@query(f"WITH {CONTRACTS_SQL},{RAW_SQL}, kept AS ({_DEDUP}) SELECT url_contrato, ingestion_date FROM kept")
def stream_upsert(spark, sf):
    """The two ingestion runs as two micro-batches into the table of latest sightings."""
    root, latest = new_path(spark, "runs"), new_path(spark, "latest")
    sightings = tables.raw_sightings(spark, sf)
    for day in ("1998-02-01", "1998-01-01"):
        part = sightings.filter(F.col("ingestion_date") == day)
        landing.land(part).withColumn("ingestion_date", F.lit(day)).write.mode("append").parquet(root)
        # A checkpoint of its own each time, so the second stream sees the first run again.
        source = spark.readStream.schema(streams.SIGHTING_SCHEMA).option("maxFilesPerTrigger", 4).parquet(root)
        streams.upsert_stream(source, latest, new_path(spark, "checkpoint")).awaitTermination()
    return streams.read_latest(spark, latest).select("url_contrato", "ingestion_date")


_SIGNED = "TRY_CAST(fecha_de_firma_del_contrato AS TIMESTAMP)"


@query(
    f"""WITH {CONTRACTS_SQL} SELECT url_contrato, 'kept' AS side FROM contracts WHERE {_SIGNED} < TIMESTAMP '1998-01-01'
    UNION ALL SELECT url_contrato, 'late' FROM contracts WHERE {_SIGNED} >= TIMESTAMP '1995-06-01' AND {_SIGNED} < TIMESTAMP '1995-07-01'
    UNION ALL SELECT url_contrato, CASE WHEN {_SIGNED} IS NULL THEN 'undated' ELSE 'after_bound' END FROM contracts
    WHERE {_SIGNED} IS NULL OR {_SIGNED} >= TIMESTAMP '1998-01-01'"""
)
def stream_dedup(spark, sf):
    """Three drops out of date order through the stateful deduplication, with the overlap of five days: repeats inside it
    collapse, a month of an earlier year comes late, and what is signed after the bound or not at all is left to the batch."""
    source, path, left, checkpoint = (new_path(spark, f"stream-{x}") for x in ("source", "dedup", "left", "checkpoint"))
    landed = landing.land(tables.contracts(spark, sf))
    day = F.col("fecha_de_firma_del_contrato")
    drops = (
        day.isNull() | (day < "1996-01-01"),
        (day >= "1995-12-28") & (day < "1997-06-01"),
        (day >= "1997-05-29") | ((day >= "1995-06-01") & (day < "1995-07-01")),
    )
    pages = None
    for drop in drops:
        landed.filter(drop).write.mode("append").json(source)
        pages = streams.read_json_stream(spark, source)
        streams.append_stream(streams.dedup_sides(pages, "1998-01-01", SETTINGS), path, checkpoint).awaitTermination()
    streams.append_stream(streams.left_to_batch(pages, "1998-01-01"), left, new_path(spark, "checkpoint")).awaitTermination()
    sides = spark.read.parquet(path).select("url_contrato", "side")
    return sides.unionByName(spark.read.parquet(left).select("url_contrato", F.col("reason").alias("side")))


@query()
def score_stream(spark, sf):
    """New contracts as a stream through validation, lookups and the fitted model."""
    source = new_path(spark, "incoming")
    incoming = tables.new_contracts(spark, sf)
    incoming.write.parquet(source)
    stream = spark.readStream.schema(incoming.schema).parquet(source)
    scored, rejected = streams.score_stream(stream, history_references(spark, sf), forest(spark, sf), SETTINGS)
    path, quarantine = new_path(spark, "stream-scores"), new_path(spark, "stream-quarantine")
    streams.append_stream(scored, path, new_path(spark, "checkpoint")).awaitTermination()
    streams.append_stream(rejected, quarantine, new_path(spark, "checkpoint")).awaitTermination()
    none = [F.lit(None).cast(t).alias(c) for c, t in scored.dtypes if c != "numero_del_contrato"]
    sides = spark.read.parquet(path).withColumn("violations", F.array().cast("array<string>"))
    return sides.unionByName(spark.read.parquet(quarantine).select("numero_del_contrato", *none, "violations"))
