"""Drift of a model's output: between two periods under one model, or between two models on the same rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pactlens.config import CATEGORICAL, DEFAULTS, NUMERIC, Settings
from pactlens.operators.drift import CURRENT, REFERENCE, column_drift, period_sizes, rate_change, split_by_year
from pactlens.operators.encode import encode
from pactlens.operators.forest.fit import Forest
from pactlens.operators.forest.score import score_encoded, with_scores
from pactlens.session import materialize, spread

RESULT = ("period", "anomaly_score", "is_anomaly")


def _score_report(scored: DataFrame, settings: Settings) -> DataFrame:
    """One row from rows of (period, score, flag)."""
    drift = column_drift(scored, settings, numeric=("anomaly_score",), categorical=()).select(
        "method", F.col("value").alias("score_drift_value"), F.col("drifted").alias("score_drift_detected")
    )
    sizes = scored.agg(
        F.count_if(F.col("period") == REFERENCE).alias("reference_rows"),
        F.count_if(F.col("period") == CURRENT).alias("current_rows"),
    )
    rates = rate_change(scored).select(
        F.col("reference_rate").alias("reference_anomaly_rate"),
        F.col("current_rate").alias("current_anomaly_rate"),
        F.col("change_pct").alias("anomaly_rate_change_pct"),
    )
    return _beside(_beside(sizes, rates), drift)


def _beside(row: DataFrame, other: DataFrame) -> DataFrame:
    """Two one-row tables as one row; the second is read as a scalar."""
    found = other.select(F.struct(*other.columns)).scalar()
    return row.withColumn("_other", found).select(*row.columns, "_other.*")


def model_drift(features: DataFrame, forest: Forest, settings: Settings = DEFAULTS) -> DataFrame:
    """Score both periods with the same fitted model and compare scores and anomaly rates."""
    split = split_by_year(features, settings)
    period_sizes(split)
    scored = materialize(with_scores(split, forest).select(*RESULT), "period-scores")
    return _score_report(scored, settings)


def score_both(features: DataFrame, old: Forest, new: Forest) -> DataFrame:
    """(``old``, ``new``): structs of score and flag of each row under two models, from one scan.

    Each model has its own category index, so the rows are encoded twice, but read and moved once.
    """
    first = score_encoded(encode(spread(features), old.index), old)
    packed = first.select(*features.columns, F.struct("anomaly_score", "is_anomaly").alias("old"))
    second = score_encoded(encode(packed, new.index), new)
    return second.select("old", F.struct("anomaly_score", "is_anomaly").alias("new"))


def compare_models(features: DataFrame, old: Forest, new: Forest, settings: Settings = DEFAULTS) -> DataFrame:
    """The same rows under the old model (reference) and the new one (current), before a promotion."""
    sides = F.array(*[F.struct(F.lit(period).alias("period"), f"{side}.*") for side, period in (("old", REFERENCE), ("new", CURRENT))])
    both = score_both(features.select(*NUMERIC, *CATEGORICAL), old, new).select(F.explode(sides).alias("x")).select("x.*")
    return _score_report(materialize(both, "model-scores"), settings)
