import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from pactlens.config import DEFAULTS, NUMERIC
from pactlens.functions import pvalues
from pactlens.operators import drift, summaries
from pactlens.session import materialize
from tests.conftest import feature_row, plan_of


def periods(make_features, shift=1.4, sizes=((2022, 100), (2023, 500), (2025, 250), (2026, 250))):
    rng = np.random.default_rng(11)
    rows = []
    for year, n in sizes:
        for i in range(n):
            value = float(rng.uniform(1e6, 2e8)) * (shift if year > 2023 else 1.0)
            rows.append(feature_row(len(rows), rng, year, valor_contrato=value))
    return make_features(rows)


def test_split_sizes_and_text_dates(make_features):
    table = periods(make_features)
    for features in (table, table.withColumn("fecha_de_firma_del_contrato", F.col("fecha_de_firma_del_contrato").cast("string"))):
        split = drift.split_by_year(features)
        assert drift.period_sizes(split) == (500, 500)
        assert "fecha_de_firma_del_contrato" not in split.columns


def test_planted_shift_is_found_and_the_baseline_is_not(make_features):
    def value_row(shift):
        report = drift.column_drift(drift.split_by_year(periods(make_features, shift)), DEFAULTS.with_(drift_method="tests"))
        return report.filter("column = 'valor_contrato'").first()

    shifted, same = value_row(1.4), value_row(1.0)
    assert shifted["method"] == "K-S p_value" and shifted["drifted"] and not same["drifted"]


@pytest.mark.parametrize("small", [True, False])
def test_report_covers_all_columns(make_features, small):
    settings = DEFAULTS.with_(drift_method="tests" if small else "distances")
    report = drift.column_drift(drift.split_by_year(periods(make_features)), settings)
    rows = report.collect()
    assert len(rows) == 12 and all(r["value"] is not None for r in rows)
    assert all(("p_value" in r["method"]) is small for r in rows)
    summary = drift.dataset_drift(report).first()
    assert summary["n_columns_evaluated"] == 12
    assert summary["drifted_columns"] == sorted(r["column"] for r in rows if r["drifted"])
    assert summary["dataset_drift_detected"] == (summary["drifted_share"] >= 0.5)


def test_unknown_method(make_features):
    with pytest.raises(ValueError, match="unknown drift method"):
        drift.column_drift(drift.split_by_year(periods(make_features)), DEFAULTS.with_(drift_method="auto"))


def test_dates_reach_the_scan(make_features, spark, tmp_path):
    periods(make_features).write.parquet(str(tmp_path / "f"))
    plan = plan_of(drift.split_by_year(spark.read.parquet(str(tmp_path / "f"))))
    assert "PushedFilters: [Or(" in plan and "2023-01-01" in plan


def test_folders_of_other_years_are_not_opened(make_features, spark, tmp_path):
    from pactlens.sources.tables import write_by_year

    table = periods(make_features, sizes=((2020, 40), (2023, 50), (2025, 30)))
    assert write_by_year(table, str(tmp_path / "f")) == 120
    split = drift.split_by_year(spark.read.parquet(str(tmp_path / "f")))
    plan = plan_of(split)
    assert "PartitionFilters: [anio_firma" in plan or "PartitionFilters: [isnotnull(anio_firma" in plan
    assert sorted(map(tuple, split.collect())) == sorted(map(tuple, drift.split_by_year(table).collect()))


def test_empty_period(make_features):
    with pytest.raises(ValueError, match="reference=0, current=0"):
        drift.period_sizes(drift.split_by_year(periods(make_features, sizes=((2024, 5),))))


def test_statistics_against_numpy(spark):
    rng = np.random.default_rng(2)
    a, b = rng.normal(0, 1, 400).round(2), rng.normal(0.3, 1.5, 700).round(2)
    rows = [("reference", float(x)) for x in a] + [("current", float(x)) for x in b]
    split = spark.createDataFrame(rows, "period string, x double")
    got = drift.numeric_statistics(drift.frequencies(split, ["x"], "double")).first()
    grid = np.unique(np.concatenate([a, b]))
    f = np.searchsorted(np.sort(a), grid, "right") / len(a)
    g = np.searchsorted(np.sort(b), grid, "right") / len(b)
    assert got["ks_d"] == pytest.approx(np.abs(f - g).max(), abs=1e-12)
    w1 = (np.abs(f - g)[:-1] * np.diff(grid)).sum()
    assert got["w1"] == pytest.approx(w1, rel=1e-12)
    assert got["w1_norm"] == pytest.approx(w1 / a.std(), rel=1e-12)


def test_unseen_category_and_two_proportions(spark):
    rows = [("reference", "a")] * 60 + [("reference", "b")] * 40 + [("current", "a")] * 30 + [("current", "b")] * 70
    freq = drift.frequencies(spark.createDataFrame(rows, "period string, x string"), ["x"], "string")
    got = drift.categorical_statistics(freq).first()
    z = (0.6 - 0.3) / math.sqrt(0.45 * 0.55 * (2 / 100))
    assert got["z"] == pytest.approx(z) and got["dof"] == 1
    assert got["chi2"] == pytest.approx(30**2 / 60 + 30**2 / 40)
    unseen = drift.frequencies(spark.createDataFrame(rows + [("current", "c")], "period string, x string"), ["x"], "string")
    assert drift.categorical_statistics(unseen).first()["chi2"] == math.inf


def test_constant_column_has_no_drift(spark):
    rows = [("reference", 5.0)] * 10 + [("current", 5.0)] * 20
    freq = drift.frequencies(spark.createDataFrame(rows, "period string, x double"), ["x"], "double")
    got = drift.numeric_statistics(freq).first()
    assert (got["ks_d"], got["w1_norm"]) == (0.0, 0.0)
    same = freq.withColumn("value", F.col("value").cast("string"))
    assert drift.categorical_statistics(same).first()["z"] == 0.0


def test_direction(spark):
    rows = [("K-S p_value", 0.01, 0.05), ("K-S p_value", 0.05, 0.05), ("Wasserstein distance", 0.2, 0.1), ("Wasserstein distance", 0.1, 0.1)]
    df = spark.createDataFrame(rows, "m string, v double, t double").repartition(1)
    assert [r[0] for r in df.select(drift.is_drifted(F.col("m"), F.col("v"), F.col("t"))).collect()] == [True, False, True, False]


def test_rate_change(spark):
    def change(ref, cur):
        rows = [("reference", x) for x in ref] + [("current", x) for x in cur]
        return drift.rate_change(spark.createDataFrame(rows, "period string, is_anomaly boolean")).first()["change_pct"]

    assert change([True, False], [True, True]) == 100.0
    assert change([False], [True]) is None


def test_retrain_signals(spark):
    fired = {r["signal"]: r["fired"] for r in drift.retrain_signals(100, 6, 0.5, -31.0, spark).collect()}
    assert fired == {"history_growth": True, "drifted_share": True, "anomaly_rate_change_pct": True}
    calm = {r["signal"]: r["fired"] for r in drift.retrain_signals(100, 5, 0.49, None, spark).collect()}
    assert calm == dict.fromkeys(fired, False)


def test_tail_probabilities():
    # Known values of the distributions.
    assert pvalues.normal_two_sided(1.959963984540054) == pytest.approx(0.05)
    assert pvalues.chi_square_tail(3.841458820694124, 1) == pytest.approx(0.05)
    assert pvalues.chi_square_tail(18.307038053275146, 10) == pytest.approx(0.05)
    assert pvalues.chi_square_tail(0.0, 3) == 1.0 and pvalues.chi_square_tail(math.inf, 3) == 0.0
    big = 1e9
    assert pvalues.kolmogorov_two_sample(1.3580986393225505 / math.sqrt(big / 2), big, big) == pytest.approx(0.05, abs=1e-4)


def test_exact_tail_against_all_orders():
    from itertools import combinations

    for n, m in [(a, b) for a in range(1, 6) for b in range(1, 7)] + [(7, 7), (8, 8)]:
        gaps = []
        for mine in combinations(range(n + m), n):
            mine, i, gap = set(mine), 0, 0
            for k in range(n + m):
                i += k in mine
                gap = max(gap, abs(i * m - (k + 1 - i) * n))
            gaps.append(gap)
        for reach in sorted(set(gaps)):
            want = sum(g >= reach for g in gaps) / len(gaps)
            assert pvalues.kolmogorov_exact(reach / (n * m), n, m) == pytest.approx(want, abs=1e-12)
            assert pvalues.kolmogorov_exact(reach / (n * m), m, n) == pytest.approx(want, abs=1e-12)
    assert pvalues.kolmogorov_exact(0.0, 5, 9) == 1.0
    # Large groups: exact and asymptotic agree.
    assert pvalues.kolmogorov(0.02, 9_000, 10_000) == pytest.approx(pvalues.kolmogorov_two_sample(0.02, 9_000, 10_000), abs=2e-3)


@pytest.mark.parametrize("parts", [1, 7])
def test_summaries_merge_like_their_rows(spark, parts):
    rng = np.random.default_rng(3)
    values = np.concatenate([rng.lognormal(10, 2, 30_000), np.full(15_000, 7.0)])
    rows = [(i % parts, float(v), f"c{int(v) % 900}") for i, v in enumerate(values)] + [(0, None, None), (0, float("nan"), "c1")]
    table = spark.createDataFrame(rows, "p int, x double, c string")
    whole = {r["column"]: r for r in summaries.merge(summaries.summarise(table, ["p"], ["x"], ["c"])).collect()}
    assert (whole["x"]["n"], whole["x"]["nulls"], whole["c"]["n"], whole["c"]["nulls"]) == (45_000, 2, 45_001, 1)
    assert whole["x"]["mean"] == pytest.approx(values.mean()) and whole["x"]["m2"] == pytest.approx(values.var() * len(values))
    assert whole["c"]["mean"] is None and whole["c"]["quantiles"] is None
    counts = {r["column"]: r["n_distinct"] for r in summaries.distinct_counts(summaries.summarise(table, ["p"], ["x"], ["c"])).collect()}
    assert abs(counts["c"] / 900 - 1) < 0.03 and abs(counts["x"] / 30_001 - 1) < 0.03
    ordered = np.sort(values)
    for r in summaries.quantiles(summaries.summarise(table, ["p"], ["x"], ["c"]), (0.0, 0.1, 0.5, 0.9, 1.0)).collect():
        below, upto = np.searchsorted(ordered, r["value"], "left") / len(ordered), np.searchsorted(ordered, r["value"], "right") / len(ordered)
        assert below - 1.5 * summaries.rank_error() <= r["share"] <= upto + 1.5 * summaries.rank_error()


def test_sketched_statistics_within_the_stated_error(spark):
    rng = np.random.default_rng(4)
    a, b = rng.normal(0, 1, 20_000), np.concatenate([rng.normal(0.3, 1.5, 15_000), np.zeros(5_000)])
    rows = [("reference", float(x), 1.0) for x in a] + [("current", float(x), 1.0) for x in b]
    split = spark.createDataFrame(rows, "period string, x double, constant double")
    exact = {r["column"]: r for r in drift.numeric_statistics(drift.frequencies(split, ["x", "constant"], "double")).collect()}
    both = summaries.summarise(split, ["period"], ["x", "constant"])
    got = {r["column"]: r for r in drift.sketched_statistics(materialize(both, "both")).collect()}
    error = 2 * summaries.rank_error() + 1 / summaries.GRID
    assert abs(got["x"]["ks_d"] - exact["x"]["ks_d"]) <= error
    assert abs(got["x"]["w1"] - exact["x"]["w1"]) <= error * (max(a.max(), b.max()) - min(a.min(), b.min()))
    assert got["x"]["sigma_ref"] == pytest.approx(a.std()) and got["x"]["size_cur"] == 20_000
    assert (got["constant"]["ks_d"], got["constant"]["w1"], got["constant"]["distinct_ref"]) == (0.0, 0.0, 1)


def test_sketched_report_has_the_same_verdicts(make_features):
    split = drift.split_by_year(periods(make_features))
    reports = [drift.column_drift(split, DEFAULTS.with_(drift_sketch_k=k)).select("column", "kind", "method", "drifted") for k in (None, 1_000)]
    assert sorted(map(tuple, reports[0].collect())) == sorted(map(tuple, reports[1].collect()))
    plan = plan_of(summaries.summarise(split, ["period"], NUMERIC))
    assert plan.count("Exchange hashpartitioning(period") == 1 and "Expand" not in plan


def test_every_numeric_column_is_known():
    assert len(NUMERIC) == 6
