"""The driver's order tables seen as contracts, in Spark and in DuckDB.

The mapping plants the dirty cases on purpose: NULL modalities, unparseable amounts and dates, reversed dates.
Each derived table is written once per session and folder, as the jobs of the library do, and read from there.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pactlens.config import DEFAULTS, RENAMES, Settings
from pactlens.functions.casts import to_date_or_null, to_double_or_null
from pactlens.operators.features import build_features
from pactlens.session import materialize, new_path, spread
from pactlens.sources.tables import write_by_year

#: The order dates of the driver run from 1995 to 2001.
SETTINGS: Settings = DEFAULTS.with_(reference_years=(1996,), current_years=(2000, 2001))
#: Contracts of this year and later count as new, earlier ones as history.
NEW_FROM = 2001

_written: dict[tuple[str, str, str], DataFrame] = {}


def written_once(spark: SparkSession, sf_dir: str, label: str, build) -> DataFrame:
    key = (spark.sparkContext.applicationId, sf_dir, label)
    if key not in _written:
        _written[key] = materialize(build(), label)
    return _written[key]


def contracts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return written_once(spark, sf_dir, "contracts", lambda: contracts_view(spark, sf_dir))


def features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return written_once(
        spark, sf_dir, "features", lambda: build_features(contracts(spark, sf_dir), SETTINGS)
    )


def features_by_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The features in folders by signing year, for queries that compare years."""
    key = (spark.sparkContext.applicationId, sf_dir, "features-by-year")
    if key not in _written:
        path = new_path(spark, "features-by-year")
        write_by_year(features(spark, sf_dir), path)
        _written[key] = spark.read.parquet(path)
    return _written[key]


def contracts_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders, customer, nation, region, lineitem = (
        spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("orders", "customer", "nation", "region", "lineitem")
    )
    items = lineitem.groupBy("l_orderkey").agg(
        F.min("l_shipdate").alias("first_day"),
        F.max("l_shipdate").alias("last_day"),
        F.min("l_suppkey").alias("supplier"),
        F.min("l_returnflag").alias("flag"),
    )
    key = F.col("o_orderkey")

    def text(day: str):
        return F.date_format(day, "yyyy-MM-dd")

    status = F.col("o_orderstatus")
    return (
        spread(orders)
        .join(customer, F.col("o_custkey") == customer.c_custkey)
        .join(nation, F.col("c_nationkey") == nation.n_nationkey)
        .join(region, F.col("n_regionkey") == region.r_regionkey)
        .join(items, key == items.l_orderkey, "left")
        .select(
            F.col("r_name").alias("nivel_entidad"),
            F.col("n_name").alias("departamento_entidad"),
            F.when(status == "F", "Liquidado").when(status == "O", "EN EJECUCIÓN").otherwise("Cancelado").alias("estado_del_proceso"),
            F.when(key % 97 != 0, F.col("o_orderpriority")).alias("modalidad_de_contrataci_n"),
            F.concat(F.lit("objeto "), (key % 7).cast("string")).alias("objeto_a_contratar"),
            F.col("c_mktsegment").alias("tipo_de_contrato"),
            text("o_orderdate").alias("fecha_de_firma_del_contrato"),
            F.when(key % 101 == 0, text("last_day")).otherwise(text("first_day")).alias("fecha_inicio_ejecuci_n"),
            F.when(key % 101 == 0, text("first_day"))
            .when(key % 103 == 0, "no-es-una-fecha")
            .otherwise(text("last_day"))
            .alias("fecha_fin_ejecuci_n"),
            F.concat(F.lit("CTO-"), F.floor(key / 2).cast("bigint").cast("string")).alias("numero_del_contrato"),
            F.when(key % 89 == 0, "n/d")
            .otherwise((F.col("o_totalprice") * 400).cast("decimal(18,2)").cast("string"))
            .alias("valor_contrato"),
            F.concat(F.lit("https://example.org/"), key.cast("string")).alias("url_contrato"),
            F.when(key % 2 == 0, "A").otherwise("B").alias("origen"),
            F.col("flag").alias("tipo_documento_proveedor"),
            F.col("supplier").cast("string").alias("documento_proveedor"),
        )
    )


CONTRACTS_SQL = """
li AS (
  SELECT l_orderkey, MIN(l_shipdate) AS first_day, MAX(l_shipdate) AS last_day,
         MIN(l_suppkey) AS supplier, MIN(l_returnflag) AS flag
  FROM lineitem GROUP BY l_orderkey
),
contracts AS (
  SELECT r_name AS nivel_entidad, n_name AS departamento_entidad,
    CASE o_orderstatus WHEN 'F' THEN 'Liquidado' WHEN 'O' THEN 'EN EJECUCIÓN' ELSE 'Cancelado' END AS estado_del_proceso,
    CASE WHEN o_orderkey % 97 = 0 THEN NULL ELSE o_orderpriority END AS modalidad_de_contrataci_n,
    CONCAT('objeto ', CAST(o_orderkey % 7 AS VARCHAR)) AS objeto_a_contratar,
    c_mktsegment AS tipo_de_contrato,
    STRFTIME(o_orderdate, '%Y-%m-%d') AS fecha_de_firma_del_contrato,
    STRFTIME(CASE WHEN o_orderkey % 101 = 0 THEN last_day ELSE first_day END, '%Y-%m-%d') AS fecha_inicio_ejecuci_n,
    CASE WHEN o_orderkey % 101 = 0 THEN STRFTIME(first_day, '%Y-%m-%d')
         WHEN o_orderkey % 103 = 0 THEN 'no-es-una-fecha'
         ELSE STRFTIME(last_day, '%Y-%m-%d') END AS fecha_fin_ejecuci_n,
    CONCAT('CTO-', CAST(o_orderkey // 2 AS VARCHAR)) AS numero_del_contrato,
    CASE WHEN o_orderkey % 89 = 0 THEN 'n/d'
         ELSE CAST(CAST(o_totalprice * 400 AS DECIMAL(18,2)) AS VARCHAR) END AS valor_contrato,
    CONCAT('https://example.org/', CAST(o_orderkey AS VARCHAR)) AS url_contrato,
    CASE WHEN o_orderkey % 2 = 0 THEN 'A' ELSE 'B' END AS origen,
    flag AS tipo_documento_proveedor, CAST(supplier AS VARCHAR) AS documento_proveedor
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
       JOIN region ON n_regionkey = r_regionkey LEFT JOIN li ON l_orderkey = o_orderkey
)"""

ELIGIBLE_SQL = """
typed AS (
  SELECT * REPLACE (TRY_CAST(valor_contrato AS DOUBLE) AS valor_contrato,
                    TRY_CAST(fecha_de_firma_del_contrato AS DATE) AS fecha_de_firma_del_contrato,
                    TRY_CAST(fecha_inicio_ejecuci_n AS DATE) AS fecha_inicio_ejecuci_n,
                    TRY_CAST(fecha_fin_ejecuci_n AS DATE) AS fecha_fin_ejecuci_n)
  FROM contracts
),
eligible AS (
  SELECT * FROM typed
  WHERE LOWER(estado_del_proceso) IN ('celebrado', 'adjudicado', 'en ejecución', 'liquidado', 'terminado',
                                      'terminado sin liquidar', 'modificado', 'cerrado')
    AND valor_contrato BETWEEN 1000000 AND 200000000
    AND fecha_inicio_ejecuci_n IS NOT NULL AND fecha_fin_ejecuci_n IS NOT NULL
    AND fecha_fin_ejecuci_n >= fecha_inicio_ejecuci_n
)"""


def features_sql(name: str, source: str, keys: str) -> str:
    """CTE ``name`` with the features of the eligible contracts in ``source``."""
    return f"""
{name} AS (
  WITH means AS (SELECT {keys}, CAST(SUM(CAST(valor_contrato AS DECIMAL(20,2))) AS DOUBLE) / COUNT(*) AS promedio_categoria
                 FROM {source} GROUP BY {keys}),
       counts AS (SELECT documento_proveedor, COUNT(*) AS concentracion_proveedor FROM {source} GROUP BY documento_proveedor)
  SELECT numero_del_contrato, url_contrato, objeto_a_contratar, documento_proveedor, departamento_entidad, nivel_entidad,
    tipo_de_contrato, origen, tipo_documento_proveedor, valor_contrato, fecha_de_firma_del_contrato,
    valor_contrato / NULLIF(promedio_categoria, 0) AS valor_vs_promedio_categoria,
    DATE_DIFF('day', fecha_inicio_ejecuci_n, fecha_fin_ejecuci_n) AS duracion_dias,
    MONTH(fecha_de_firma_del_contrato) AS mes_firma, DAYOFWEEK(fecha_de_firma_del_contrato) AS dia_semana_firma,
    concentracion_proveedor, modalidad_de_contrataci_n AS modalidad_de_contratacion,
    fecha_inicio_ejecuci_n AS fecha_inicio_ejecucion, fecha_fin_ejecuci_n AS fecha_fin_ejecucion
  FROM {source} JOIN means USING ({keys}) JOIN counts USING (documento_proveedor)
)"""


FEATURES_SQL = features_sql("features", "eligible", "modalidad_de_contrataci_n, departamento_entidad")


def with_contracts(query: str) -> str:
    return f"WITH {CONTRACTS_SQL}\n{query}"


def with_eligible(query: str) -> str:
    return f"WITH {CONTRACTS_SQL},{ELIGIBLE_SQL}\n{query}"


def with_features(query: str, *more: str) -> str:
    return "WITH " + ",".join([CONTRACTS_SQL, ELIGIBLE_SQL, FEATURES_SQL, *more]) + f"\n{query}"


def raw_sightings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two ingestion runs over the contracts; the days of the overlap are in both."""
    table = contracts(spark, sf_dir)
    day = F.col("fecha_de_firma_del_contrato")
    first = table.filter(day < "1998-01-06").withColumn("ingestion_date", F.lit("1998-01-01"))
    second = table.filter(day >= "1998-01-01").withColumn("ingestion_date", F.lit("1998-02-01"))
    return first.unionByName(second)


RAW_SQL = """
raw AS (
  SELECT *, '1998-01-01' AS ingestion_date FROM contracts WHERE fecha_de_firma_del_contrato < '1998-01-06'
  UNION ALL
  SELECT *, '1998-02-01' FROM contracts WHERE fecha_de_firma_del_contrato >= '1998-01-01'
)"""


def new_contracts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All contracts in the form of a new-contract message, before any filter."""
    return contracts(spark, sf_dir).select(
        "numero_del_contrato",
        "url_contrato",
        to_double_or_null(F.col("valor_contrato")).alias("valor_contrato"),
        *[
            to_date_or_null(F.col(c)).alias(RENAMES.get(c, c))
            for c in ("fecha_de_firma_del_contrato", "fecha_inicio_ejecuci_n", "fecha_fin_ejecuci_n")
        ],
        "documento_proveedor",
        F.col("modalidad_de_contrataci_n").alias("modalidad_de_contratacion"),
        "departamento_entidad",
        "nivel_entidad",
        "tipo_de_contrato",
        "origen",
        "tipo_documento_proveedor",
    )


NEW_SQL = """
incoming AS (
  SELECT numero_del_contrato, url_contrato, TRY_CAST(valor_contrato AS DOUBLE) AS valor_contrato,
    TRY_CAST(fecha_de_firma_del_contrato AS DATE) AS fecha_de_firma_del_contrato,
    TRY_CAST(fecha_inicio_ejecuci_n AS DATE) AS fecha_inicio_ejecucion, TRY_CAST(fecha_fin_ejecuci_n AS DATE) AS fecha_fin_ejecucion,
    documento_proveedor, modalidad_de_contrataci_n AS modalidad_de_contratacion, departamento_entidad, nivel_entidad,
    tipo_de_contrato, origen, tipo_documento_proveedor
  FROM contracts
)"""
