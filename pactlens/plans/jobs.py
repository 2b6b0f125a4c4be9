"""The batch jobs: tables in, tables out, and a one-row summary of each."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pactlens.config import CATEGORICAL, DEFAULTS, IDENTIFIERS, NUMERIC, Settings
from pactlens.operators import drift, monitor
from pactlens.operators.dedup import dedup_rows
from pactlens.operators.kept import add_partition
from pactlens.operators.features import features_summary, features_with_totals
from pactlens.operators.forest.evaluate import best_trial, tune
from pactlens.operators.forest.explain import explain_forest
from pactlens.operators.forest.fit import fit_forest
from pactlens.operators.forest.score import scoring_summary, with_scores
from pactlens.operators.forest.store import load_forest, save_forest
from pactlens.operators.profile import profile_contracts
from pactlens.operators.reference import (
    featurize_new,
    load_reference_tables,
    reference_category_means,
    reference_supplier_counts,
    split_valid,
)
from pactlens.operators.sampling import most_atypical
from pactlens.session import materialize
from pactlens.sources import landing
from pactlens.sources.bronze import empty_partitions, read_raw, warn_empty_folders
from pactlens.sources.tables import write_by_year, write_csv, write_table
from pactlens.streaming import contracts as streams


def _summary(spark: SparkSession, **values) -> DataFrame:
    return spark.createDataFrame([tuple(values.values())], list(values))


def extract(spark: SparkSession, source_path: str, raw_root: str, checkpoint: str, settings: Settings = DEFAULTS) -> DataFrame:
    """One incremental extract from a Parquet source with the signing date as ISO text, up to tomorrow."""
    return landing.extract(spark.read.parquet(source_path), raw_root, checkpoint, settings=settings)


def land(spark: SparkSession, pages_path: str, raw_root: str, ingestion_date: str) -> DataFrame:
    """JSON pages to the raw partition of a date."""
    rows = landing.write_raw(landing.read_json_pages(spark, pages_path), raw_root, ingestion_date)
    return _summary(spark, total_rows=rows, output_dir=f"{raw_root}/ingestion_date={ingestion_date}")


def land_stream(spark: SparkSession, pages_folder: str, raw_root: str, checkpoint: str) -> DataFrame:
    """All JSON pages that have come in since the last run, exactly once, to the raw partition of today."""
    query = streams.land_stream(streams.read_json_stream(spark, pages_folder), raw_root, checkpoint)
    query.awaitTermination()
    return _summary(spark, total_rows=sum(p["numInputRows"] for p in query.recentProgress), output_dir=raw_root)


def process_new(spark: SparkSession, raw_root: str, kept_root: str, ingestion_date: str) -> DataFrame:
    """One raw partition into the kept table, without the others."""
    return add_partition(read_raw(spark, raw_root).where(F.col("ingestion_date") == ingestion_date), kept_root)


def process(spark: SparkSession, raw_root: str, contracts_path: str, expected_dates: str = "") -> DataFrame:
    """Raw partitions to distinct contracts, with a warning for every partition folder without a data file, and for every
    day of ``expected_dates`` that has no rows."""
    warn_empty_folders(spark, raw_root)
    raw = read_raw(spark, raw_root)
    if expected_dates:
        empty_partitions(raw, spark.createDataFrame([(d,) for d in expected_dates.split(",")], "ingestion_date string"))
    rows_in = raw.count()
    rows_out = write_table(dedup_rows(raw), contracts_path)
    return _summary(
        spark, input_rows=rows_in, output_rows=rows_out, duplicates_removed=rows_in - rows_out, output_path=contracts_path
    )


def features(spark: SparkSession, contracts_path: str, features_path: str, settings: Settings = DEFAULTS) -> DataFrame:
    """Contracts to the features table, in folders by signing year."""
    table, totals = features_with_totals(spark.read.parquet(contracts_path), settings)
    rows = write_by_year(table, features_path)
    return features_summary(totals, settings).withColumns({"output_rows": F.lit(rows), "output_path": F.lit(features_path)})


def profile(spark: SparkSession, contracts_path: str, folder: str, settings: Settings = DEFAULTS) -> DataFrame:
    """Every profile table as a table of its own."""
    tables = profile_contracts(spark.read.parquet(contracts_path), settings)
    written = [(name, write_table(table, f"{folder}/{name}")) for name, table in tables.items()]
    return spark.createDataFrame(written, "table string, n_rows bigint")


def reference_tables(spark: SparkSession, features_path: str, folder: str, settings: Settings = DEFAULTS) -> DataFrame:
    table = spark.read.parquet(features_path)
    means = write_table(reference_category_means(table, settings), f"{folder}/categoria_promedios")
    counts = write_table(reference_supplier_counts(table), f"{folder}/proveedor_conteos")
    return _summary(spark, n_combinaciones_categoria=means, n_proveedores_distintos=counts, path=folder)


def train(
    spark: SparkSession,
    features_path: str,
    model_folder: str,
    scores_path: str,
    settings: Settings = DEFAULTS,
    explain: bool = False,
) -> DataFrame:
    """Fit, store, score every row once, and append the metrics to the run table of the model folder."""
    table = spark.read.parquet(features_path)
    forest = fit_forest(table, settings)
    save_forest(forest, model_folder)
    columns = [*IDENTIFIERS, *NUMERIC, *CATEGORICAL]
    write_table(with_scores(table.select(*columns), forest), scores_path)
    scored = spark.read.parquet(scores_path)
    if explain:
        rows, importance = explain_forest(scored, forest, settings)
        write_table(rows, f"{model_folder}/attributions")
        write_csv(importance, f"{model_folder}/feature_importance")
    run = scoring_summary(scored).withColumns(
        {
            "run_at": F.current_timestamp(),
            "n_trees": F.lit(settings.n_trees),
            "max_samples": F.lit(str(settings.max_samples)),
            "max_features": F.lit(float(settings.max_features)),
            "seed": F.lit(settings.seed),
        }
    )
    run = materialize(run, "run")
    run.write.mode("append").parquet(f"{model_folder}/runs")
    return run


def score(
    spark: SparkSession, new_path: str, reference_folder: str, model_folder: str, scores_path: str, quarantine_path: str,
    settings: Settings = DEFAULTS,
) -> DataFrame:
    """New contracts through validation, the stored reference tables and the stored model: scores, and a quarantine of
    those that break a rule."""
    accepted, rejected = split_valid(spark.read.parquet(new_path))
    made = featurize_new(accepted, load_reference_tables(spark, reference_folder, settings), settings)
    scored = with_scores(made, load_forest(spark, model_folder)).select("numero_del_contrato", "anomaly_score", "is_anomaly")
    n_scored, n_rejected = write_table(scored, scores_path), write_table(rejected, quarantine_path)
    return _summary(spark, scored=n_scored, rejected=n_rejected, scores_path=scores_path, quarantine_path=quarantine_path)


def top_report(spark: SparkSession, scores_path: str, n: int = 10) -> DataFrame:
    return most_atypical(spark.read.parquet(scores_path).select(*IDENTIFIERS, "anomaly_score", "is_anomaly"), n)


def search(spark: SparkSession, features_path: str, trials_path: str, settings: Settings = DEFAULTS) -> DataFrame:
    """Exploratory search; its best trial is reported, not promoted."""
    write_table(tune(spark.read.parquet(features_path), settings), trials_path)
    return best_trial(spark.read.parquet(trials_path))


def data_drift(spark: SparkSession, features_path: str, report_path: str, settings: Settings = DEFAULTS) -> DataFrame:
    split = drift.split_by_year(spark.read.parquet(features_path), settings)
    write_table(drift.column_drift(split, settings), report_path)
    return drift.dataset_drift(spark.read.parquet(report_path), settings)


def model_drift(
    spark: SparkSession, features_path: str, model_folder: str, report_path: str, settings: Settings = DEFAULTS
) -> DataFrame:
    forest = load_forest(spark, model_folder)
    write_table(monitor.model_drift(spark.read.parquet(features_path), forest, settings), report_path)
    return spark.read.parquet(report_path)


def retrain_signals(
    spark: SparkSession, features_path: str, model_folder: str, report_path: str, settings: Settings = DEFAULTS
) -> DataFrame:
    """Reasons to review the model: growth of the history, share of drifted columns, change of the anomaly rate."""
    table = spark.read.parquet(features_path)
    split = drift.split_by_year(table, settings)
    history, new = drift.period_sizes(split)
    share = drift.dataset_drift(drift.column_drift(split, settings), settings).first()["drifted_share"]
    change = monitor.model_drift(table, load_forest(spark, model_folder), settings).first()["anomaly_rate_change_pct"]
    write_table(drift.retrain_signals(history, new, share, change, spark, settings), report_path)
    return spark.read.parquet(report_path)


def compare_models(
    spark: SparkSession, features_path: str, old_folder: str, new_folder: str, report_path: str, settings: Settings = DEFAULTS
) -> DataFrame:
    """Scores of an old and a new model on the same contracts."""
    old, new = load_forest(spark, old_folder), load_forest(spark, new_folder)
    write_table(monitor.compare_models(spark.read.parquet(features_path), old, new, settings), report_path)
    return spark.read.parquet(report_path)
