"""Drift between a reference period and a current one: statistics, direction rules and reports."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pactlens.config import CATEGORICAL, DEFAULTS, NUMERIC, SIGN_DATE, SIGN_YEAR, Settings
from pactlens.functions.calendar import year_of
from pactlens.functions.casts import to_date_or_null
from pactlens.functions.pvalues import p_value
from pactlens.operators.ranks import running_totals
from pactlens.operators.summaries import atoms, merge, summarise
from pactlens.session import materialize

REFERENCE, CURRENT = "reference", "current"
SIGMA_FLOOR = 0.001


def split_by_year(features: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """Model columns of the two periods with their ``period``; other years and the split column are left out."""
    if dict(features.dtypes)[SIGN_DATE] == "string":
        features = features.withColumn(SIGN_DATE, to_date_or_null(F.col(SIGN_DATE)))
    year = year_of(F.col(SIGN_DATE))
    period = F.when(year.isin(*settings.reference_years), REFERENCE).when(year.isin(*settings.current_years), CURRENT)
    # Ranges of dates, unlike years, reach the scan.
    asked = F.lit(False)
    if SIGN_YEAR in features.columns:
        # A table in folders by year: those of other years are not opened.
        features = features.filter(F.col(SIGN_YEAR).isin(*settings.reference_years, *settings.current_years))
    for y in (*settings.reference_years, *settings.current_years):
        asked = asked | ((F.col(SIGN_DATE) >= F.lit(date(y, 1, 1))) & (F.col(SIGN_DATE) < F.lit(date(y + 1, 1, 1))))
    return features.filter(asked).select(period.alias("period"), *NUMERIC, *CATEGORICAL)


def period_sizes(split: DataFrame) -> tuple[int, int]:
    """Rows of the two periods; an empty one is an error."""
    sizes = split.agg(
        F.count_if(F.col("period") == REFERENCE).alias("r"), F.count_if(F.col("period") == CURRENT).alias("c")
    ).first()
    if not sizes["r"] or not sizes["c"]:
        raise ValueError(f"a period is empty (reference={sizes['r']}, current={sizes['c']}): check the years")
    return sizes["r"], sizes["c"]


def frequencies(split: DataFrame, columns: Sequence[str], value_type: str) -> DataFrame:
    """(column, value, n_ref, n_cur) without NULLs.  Equal values are counted in the map tasks first."""
    long = split.select("period", *[F.col(c).cast(value_type).alias(c) for c in columns]).unpivot(
        ["period"], list(columns), "column", "value"
    )
    return (
        long.filter(F.col("value").isNotNull())
        .groupBy("column", "value")
        .agg(
            F.count_if(F.col("period") == REFERENCE).alias("n_ref"),
            F.count_if(F.col("period") == CURRENT).alias("n_cur"),
        )
    )


def _sizes(freq: DataFrame) -> DataFrame:
    """One row per column: sizes of the periods and distinct values of the reference."""
    return freq.groupBy("column").agg(
        F.sum("n_ref").alias("size_ref"),
        F.sum("n_cur").alias("size_cur"),
        F.count_if(F.col("n_ref") > 0).alias("distinct_ref"),
    )


def numeric_statistics(freq: DataFrame) -> DataFrame:
    """Per column the Kolmogorov-Smirnov D and the Wasserstein-1 distance, also in reference deviations.

    ``freq`` is a written table of ``frequencies`` over doubles; both statistics come from one pass over the
    running totals.
    """
    sizes = _sizes(freq)
    totals = running_totals(freq, "value", ["n_ref", "n_cur"], ["column"]).join(F.broadcast(sizes), "column")
    gap = F.abs(F.col("cum_n_ref") / F.col("size_ref") - F.col("cum_n_cur") / F.col("size_cur"))
    distances = totals.groupBy("column").agg(
        F.max(gap).alias("ks_d"), F.coalesce(F.sum(gap * (F.col("next_value") - F.col("value"))), F.lit(0.0)).alias("w1")
    )
    # Two passes, mean first: squares of raw amounts would cancel.
    means = freq.groupBy("column").agg((F.sum(F.col("value") * F.col("n_ref")) / F.sum("n_ref")).alias("mean_ref"))
    squares = F.sum(F.col("n_ref") * F.pow(F.col("value") - F.col("mean_ref"), F.lit(2)))
    sigma = (
        freq.join(F.broadcast(means), "column").groupBy("column").agg(F.sqrt(squares / F.sum("n_ref")).alias("sigma_ref"))
    )
    return (
        sizes.join(F.broadcast(distances), "column")
        .join(F.broadcast(sigma), "column")
        .withColumn("w1_norm", F.col("w1") / F.greatest("sigma_ref", F.lit(SIGMA_FLOOR)))
    )


def categorical_statistics(freq: DataFrame) -> DataFrame:
    """Per column the chi-square of the current counts, the Jensen-Shannon distance and the Z of two proportions."""
    sized = freq.join(F.broadcast(_sizes(freq)), "column")
    expected = F.col("n_ref") * F.col("size_cur") / F.col("size_ref")
    p, q = F.col("n_ref") / F.col("size_ref"), F.col("n_cur") / F.col("size_cur")
    middle = (p + q) / 2

    def relative_entropy(share: Column) -> Column:
        return F.when(share > 0, share * F.ln(share / middle)).otherwise(0.0)

    unexpected = F.when(expected == 0, F.lit(float("inf")))
    terms = sized.select(
        "column",
        "size_ref",
        "size_cur",
        "distinct_ref",
        "value",
        "n_ref",
        "n_cur",
        F.coalesce(unexpected, F.try_divide(F.pow(F.col("n_cur") - expected, F.lit(2)), expected)).alias("chi"),
        ((relative_entropy(p) + relative_entropy(q)) / 2).alias("js"),
    )
    first = F.min_by(F.struct("n_ref", "n_cur"), "value")
    per_column = terms.groupBy("column", "size_ref", "size_cur", "distinct_ref").agg(
        F.sum("chi").alias("chi2"),
        (F.count("*") - 1).alias("dof"),
        F.sqrt(F.greatest(F.sum("js"), F.lit(0.0))).alias("js_distance"),
        first.alias("first"),
    )
    return per_column.withColumn("z", _two_proportions()).drop("first")


def _two_proportions() -> Column:
    """Z of the share of the first category; 0 where it is all or nothing in both periods."""
    n, m = F.col("size_ref"), F.col("size_cur")
    pooled = (F.col("first.n_ref") + F.col("first.n_cur")) / (n + m)
    spread = F.sqrt(pooled * (1 - pooled) * (1 / n + 1 / m))
    return F.coalesce(F.try_divide(F.col("first.n_ref") / n - F.col("first.n_cur") / m, spread), F.lit(0.0))


def sketched_statistics(by_period: DataFrame) -> DataFrame:
    """What ``numeric_statistics`` says, from written summaries by ``period``.

    The Kolmogorov-Smirnov D is off by at most twice the sketches' ``rank_error`` and a step of the grid, and the
    Wasserstein-1 distance by at most that times the range of the values.  Sizes and deviations are exact.
    """
    values = atoms(by_period, ["period"])
    freq = values.groupBy("column", "value").agg(
        F.count_if(F.col("period") == REFERENCE).alias("n_ref"), F.count_if(F.col("period") == CURRENT).alias("n_cur")
    )
    found = numeric_statistics(materialize(freq, "sketch-atoms")).select("column", "ks_d", "w1")
    known = merge(by_period, ["period"]).where(F.col("mean").isNotNull())
    known = known.groupBy("column").agg(
        F.max(F.when(F.col("period") == REFERENCE, F.col("n"))).alias("size_ref"),
        F.max(F.when(F.col("period") == CURRENT, F.col("n"))).alias("size_cur"),
        F.max(F.when(F.col("period") == REFERENCE, F.hll_sketch_estimate("distinct"))).alias("distinct_ref"),
        F.max(F.when(F.col("period") == REFERENCE, F.sqrt(F.col("m2") / F.col("n")))).alias("sigma_ref"),
    )
    return known.join(found, "column").withColumn("w1_norm", F.col("w1") / F.greatest("sigma_ref", F.lit(SIGMA_FLOOR)))


def _sketched(split: DataFrame, settings: Settings, numeric: Sequence[str]) -> tuple[DataFrame, list[str]]:
    """Statistics of the numeric columns with many values from sketches, and the names of the others."""
    by_period = materialize(summarise(split, ["period"], numeric, k=settings.drift_sketch_k), "period-summaries")
    found = materialize(sketched_statistics(by_period), "sketched-statistics")
    few = F.col("distinct_ref") <= settings.low_cardinality
    return found.filter(~few), [r["column"] for r in found.filter(few).select("column").collect()]


def _no_frequencies(split: DataFrame) -> DataFrame:
    return split.sparkSession.createDataFrame([], "column string, value double, n_ref long, n_cur long")


def is_drifted(method: Column, value: Column, threshold: Column) -> Column:
    """A p-value drifts below its threshold, a distance above it; both strictly."""
    return F.when(method.rlike("(?i)p[_-]value"), value < threshold).otherwise(value > threshold)


def column_drift(split: DataFrame, settings: Settings = DEFAULTS, numeric=NUMERIC, categorical=CATEGORICAL) -> DataFrame:
    """One row per column: the method for its kind, its value, threshold and verdict.

    ``drift_method`` says whether hypothesis tests or distances are taken; numeric columns with few distinct values
    (``low_cardinality``) are treated as categorical, as the column ``kind`` shows.  With ``drift_sketch_k`` the statistics
    of the other numeric columns are estimated from mergeable sketches of this size, and no distinct value is shuffled.
    """
    if settings.drift_method not in ("distances", "tests"):
        raise ValueError(f"unknown drift method: {settings.drift_method}")
    period_sizes(split)
    small = F.lit(settings.drift_method == "tests")
    few = F.col("distinct_ref") <= settings.low_cardinality
    if settings.drift_sketch_k:
        wide, narrow_columns = _sketched(split, settings, numeric)
        counted = narrow_columns
    else:
        wide, counted = None, numeric
    numbers = materialize(frequencies(split, counted, "double") if counted else _no_frequencies(split), "numeric-frequencies")
    narrow = numbers.join(F.broadcast(_sizes(numbers).filter(few).select("column")), "column").select(
        "column", F.col("value").cast("string").alias("value"), "n_ref", "n_cur"
    )
    groups = narrow
    if categorical:
        groups = narrow.unionByName(frequencies(split, categorical, "string"))

    continuous = (numeric_statistics(numbers).filter(~few) if wide is None else wide).select(
        "column",
        F.lit("numeric").alias("kind"),
        F.when(small, "K-S p_value").otherwise("Wasserstein distance (normed)").alias("method"),
        F.when(small, F.col("ks_d")).otherwise(F.col("w1_norm")).alias("statistic"),
        "size_ref",
        "size_cur",
        F.lit(None).cast("bigint").alias("dof"),
    )
    test = F.when(F.col("distinct_ref") > 2, "chi-square p_value").otherwise("Z-test p_value")
    method = F.when(small, test).otherwise("Jensen-Shannon distance")
    statistic = (
        F.when(method == "chi-square p_value", F.col("chi2"))
        .when(method == "Z-test p_value", F.col("z"))
        .otherwise(F.col("js_distance"))
    )
    discrete = categorical_statistics(materialize(groups, "category-frequencies")).select(
        "column", F.lit("categorical").alias("kind"), method.alias("method"), statistic.alias("statistic"),
        "size_ref", "size_cur", "dof",
    )
    tail = p_value("method", "statistic", F.col("size_ref").cast("double"), F.col("size_cur").cast("double"), F.col("dof").cast("double"))
    threshold = F.when(small, settings.p_value_threshold).otherwise(settings.distance_threshold)
    return (
        continuous.unionByName(discrete)
        .withColumn("value", F.when(small, tail).otherwise(F.col("statistic")))
        .withColumn("threshold", threshold)
        .withColumn("drifted", is_drifted(F.col("method"), F.col("value"), F.col("threshold")))
        .select("column", "kind", "size_ref", "size_cur", "method", "statistic", "value", "threshold", "drifted")
    )


def dataset_drift(report: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """One row over a column report: drifted columns, their number and share, and the verdict (share at least the limit)."""
    return report.agg(
        F.count("*").alias("n_columns_evaluated"),
        F.count_if("drifted").alias("n_drifted_columns"),
        F.array_sort(F.collect_list(F.when(F.col("drifted"), F.col("column")))).alias("drifted_columns"),
    ).select(
        "n_columns_evaluated",
        "n_drifted_columns",
        F.coalesce(F.try_divide("n_drifted_columns", "n_columns_evaluated"), F.lit(0.0)).alias("drifted_share"),
        (F.coalesce(F.try_divide("n_drifted_columns", "n_columns_evaluated"), F.lit(0.0)) >= settings.drift_share).alias(
            "dataset_drift_detected"
        ),
        "drifted_columns",
    )


def rate_change(split: DataFrame, flag: str = "is_anomaly") -> DataFrame:
    """One row: rate of a flag in both periods and its relative change in %, NULL when the first is 0."""
    rate = F.col(flag).cast("int")
    return split.agg(
        F.avg(F.when(F.col("period") == REFERENCE, rate)).alias("reference_rate"),
        F.avg(F.when(F.col("period") == CURRENT, rate)).alias("current_rate"),
    ).withColumn("change_pct", F.try_divide(F.col("current_rate") - F.col("reference_rate"), F.col("reference_rate")) * 100)


def retrain_signals(
    history_rows: int, new_rows: int, drifted_share: float, change_pct: float | None, spark, settings: Settings = DEFAULTS
) -> DataFrame:
    """(signal, value, threshold, fired): reasons to review the model.  They never start a training by themselves."""
    growth = new_rows / history_rows if history_rows else None
    change = abs(change_pct) if change_pct is not None else None
    rows = [
        ("history_growth", growth, settings.growth_share, growth is not None and growth > settings.growth_share),
        ("drifted_share", drifted_share, settings.drift_share, drifted_share >= settings.drift_share),
        ("anomaly_rate_change_pct", change, settings.rate_change_pct, change is not None and change > settings.rate_change_pct),
    ]
    return spark.createDataFrame(rows, "signal string, value double, threshold double, fired boolean")
