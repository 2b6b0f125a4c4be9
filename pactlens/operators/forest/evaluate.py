"""Planted anomalies, recall at the top, and the exploratory search over forest parameters."""

from __future__ import annotations

import random

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pactlens.config import CATEGORICAL, DEFAULTS, IDENTIFIERS, NUMERIC, Settings
from pactlens.functions.hashing import content_hash
from pactlens.operators.encode import complete, encode, fit_index
from pactlens.operators.forest.fit import POINT, resolve_samples, tree_samples
from pactlens.operators.forest.trials import detected, grow_trials, score_trials, top_cuts
from pactlens.operators.sampling import sample_rows, top_count, top_fraction
from pactlens.session import materialize, spread

# Pattern names, factors and the search space.
PATTERNS = ("valor_extremo", "duracion_extrema", "concentracion_extrema")
VALUE_FACTOR, DURATION_FACTOR, CONCENTRATION_FACTOR = 50.0, 20, 5
TREES = range(100, 801, 50)
SAMPLES = range(256, 4097, 256)
FEATURE_SHARE = (0.5, 1.0)
FIRST_TRIAL = {"n_trees": 500, "max_samples": 4096, "max_features": 1.0}


def synthetic_anomalies(features: DataFrame, n: int, seed: int) -> DataFrame:
    """``n`` sampled rows with one of three disturbances each and ids ``SYNTH-0000`` onwards."""
    base = sample_rows(features, n, seed)
    # The sample has the n rows asked for: numbering it is one small window.
    order = Window.orderBy(content_hash(features.columns, seed, 2))
    numbered = base.withColumn("_i", F.row_number().over(order) - 1)
    pattern = F.element_at(
        F.array(*[F.lit(p) for p in PATTERNS]), (F.pmod(F.xxhash64("_i", F.lit(seed)), F.lit(3)) + 1).cast("int")
    )
    cap = features.agg((F.max("concentracion_proveedor") * CONCENTRATION_FACTOR).alias("cap")).scalar()
    value, duration, concentration = (F.col("_synthetic_pattern") == p for p in PATTERNS)

    def where(hit, column, changed):
        return F.when(hit, changed).otherwise(F.col(column))

    return (
        numbered.withColumn("_synthetic_pattern", pattern)
        .withColumns(
            {
                "numero_del_contrato": F.format_string("SYNTH-%04d", "_i"),
                **{c: where(value, c, F.col(c) * VALUE_FACTOR) for c in ("valor_contrato", "valor_vs_promedio_categoria")},
                "duracion_dias": where(duration, "duracion_dias", F.col("duracion_dias") * DURATION_FACTOR),
                "concentracion_proveedor": where(concentration, "concentracion_proveedor", cap),
            }
        )
        .drop("_i")
    )


def recall_at_top(scored: DataFrame, planted: DataFrame, fraction: float) -> DataFrame:
    """One row: share of the planted ids found among the top fraction by score."""
    top = top_fraction(scored.select("numero_del_contrato", "anomaly_score"), "anomaly_score", fraction)
    ids = planted.select("numero_del_contrato").distinct()
    found = ids.join(top.select("numero_del_contrato"), "numero_del_contrato", "left_semi")
    return found.agg(F.count("*").alias("detected")).select(
        "detected",
        ids.agg(F.count("*").alias("n")).scalar().alias("planted"),
        F.try_divide("detected", ids.agg(F.count("*").alias("n")).scalar()).alias("recall"),
    )


def trial_design(n_trials: int, seed: int) -> list[dict]:
    """The known setting first, then seeded draws from the search space."""
    rng = random.Random(seed)
    drawn = [
        {"n_trees": rng.choice(TREES), "max_samples": rng.choice(SAMPLES), "max_features": rng.uniform(*FEATURE_SHARE)}
        for _ in range(n_trials - 1)
    ]
    return [FIRST_TRIAL, *drawn]


def search_table(features: DataFrame, settings: Settings = DEFAULTS) -> tuple[DataFrame, DataFrame]:
    """All rows, or a sample if ``tuning_rows`` asks for one, plus planted ones, and the planted ones alone; both written."""
    columns = [*IDENTIFIERS, *NUMERIC, *CATEGORICAL]
    rows = features.select(*columns).filter(complete())
    sample = rows if settings.tuning_rows is None else sample_rows(rows, settings.tuning_rows, settings.seed)
    sample = materialize(sample, "tuning-sample")
    planted = materialize(synthetic_anomalies(sample, settings.synthetic_rows, settings.seed), "tuning-planted")
    return materialize(sample.unionByName(planted, allowMissingColumns=True), "tuning-search"), planted


def score_search(features: DataFrame, settings: Settings, trials: list[dict]) -> DataFrame:
    """Rows of the search table with their identifiers, ``planted`` and, as array ``scores``, the score of every trial."""
    search, _ = search_table(features, settings)
    index = fit_index(search, settings)
    n_slots, rows = index.count(), search.count()
    encoded = materialize(spread(encode(search, index)), "tuning-encoded")
    sizes = [resolve_samples(t["max_samples"], rows) for t in trials]
    samples = tree_samples(encoded, rows, max(t["n_trees"] for t in trials), max(sizes), settings.seed)
    packed = materialize(grow_trials(samples, trials, sizes, n_slots, settings.seed), "tuning-trees")
    planted = F.col("_synthetic_pattern").isNotNull().alias("planted")
    table = encoded.select(*IDENTIFIERS, *POINT, planted)
    return score_trials(table, packed, sizes, n_slots).select(*IDENTIFIERS, "planted", "scores")


def trial_recalls(scored: DataFrame, trials: list[dict], fraction: float) -> DataFrame:
    """One row per trial: parameters, rows above the cut and at it, planted rows found among the top, and their share."""
    total, planted = scored.agg(F.count("*"), F.count_if("planted")).head()
    k = top_count(total, fraction)
    cuts = top_cuts(scored, len(trials), k)
    found = detected(scored, cuts, k, "numero_del_contrato", "planted")
    rows = [
        (n, t["n_trees"], int(t["max_samples"]), float(t["max_features"]), cut.score, cut.above, cut.equal, hits, hits / planted if planted else None)
        for n, (t, cut, hits) in enumerate(zip(trials, cuts, found, strict=True))
    ]
    return scored.sparkSession.createDataFrame(
        rows,
        "trial_id int, n_trees int, max_samples int, max_features double, cut double, above long, equal long, detected long, recall_at_top double",
    )


def tune(features: DataFrame, settings: Settings = DEFAULTS, trials: list[dict] | None = None) -> DataFrame:
    """One row per trial with its parameters and recall.

    All trees of all trials grow in one job and score the search table together.  The result is exploratory: the final
    model keeps the parameters of ``Settings``.
    """
    trials = trial_design(settings.n_trials, settings.seed) if trials is None else trials
    recalls = trial_recalls(score_search(features, settings, trials), trials, settings.top_fraction)
    return recalls.select("trial_id", "n_trees", "max_samples", "max_features", "recall_at_top")


def best_trial(trials: DataFrame) -> DataFrame:
    """The first of the trials with the highest recall."""
    best = F.max_by(F.struct(*trials.columns), F.struct("recall_at_top", -F.col("trial_id"))).alias("best")
    return trials.agg(best).select("best.*")
