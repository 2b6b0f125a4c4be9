import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from pactlens.operators import ranks, sampling
from pactlens.operators.forest import evaluate
from tests.conftest import plan_of


@pytest.mark.parametrize("buckets", [2, 7, 64, 1_024])
def test_running_totals_against_cumsum(spark, buckets):
    rng = np.random.default_rng(buckets)
    rows = [(g, float(v), int(c)) for g in "ab" for v, c in zip(np.unique(rng.lognormal(0, 2, 300).round(2)), rng.integers(0, 9, 300))]
    freq = spark.createDataFrame(rows, "g string, v double, n bigint").repartition(5)
    got = ranks.running_totals(freq, "v", ["n"], ["g"], buckets).orderBy("g", "v").collect()
    for g in "ab":
        mine = sorted((v, n) for k, v, n in rows if k == g)
        theirs = [r for r in got if r["g"] == g]
        assert [r["cum_n"] for r in theirs] == np.cumsum([n for _, n in mine]).tolist()
        assert [r["next_value"] for r in theirs] == [v for v, _ in mine[1:]] + [None]


def test_running_totals_never_gather_in_one_task(spark):
    freq = spark.range(100).select(F.col("id").cast("double").alias("v"), (F.col("id") + 1).alias("n"))
    plan = plan_of(ranks.running_totals(freq, "v", ["n"]))
    windows = [line for line in plan.splitlines() if "Window [sum(n#" in line]
    assert windows and all("_bucket" in line for line in windows)


@settings(max_examples=6, deadline=None)
@given(st.lists(st.integers(0, 5), min_size=1, max_size=40), st.integers(0, 45))
def test_first_rows_is_exact_with_ties_and_copies(spark, values, n):
    rows = spark.createDataFrame([(v,) for v in values], "v int")
    for in_one_task in (0, 10_000):
        got = sorted(r["v"] for r in ranks.first_rows(rows, F.col("v"), n, in_one_task=in_one_task).collect())
        assert got == sorted(values)[:n]


def test_both_ways_to_the_first_rows_agree(spark):
    rows = spark.range(500).select("id", F.when(F.col("id") % 9 != 0, F.col("id") % 5).alias("v"))
    ways = [ranks.first_rows(rows, F.col("v"), 180, in_one_task=k) for k in (0, 10_000)]
    assert sorted(map(tuple, ways[0].collect())) == sorted(map(tuple, ways[1].collect()))
    assert ranks.first_rows(rows, F.col("v"), 499, in_one_task=0).filter("v IS NULL").count() == 0


def test_sample_is_exact_seeded_and_free_of_layout(spark):
    rows = spark.range(2_000).select("id", (F.col("id") % 7).alias("k"))
    one = sorted(map(tuple, sampling.sample_rows(rows.coalesce(1), 100, 42).collect()))
    many = sorted(map(tuple, sampling.sample_rows(rows.repartition(13), 100, 42).collect()))
    assert one == many and len(set(one)) == 100
    assert one != sorted(map(tuple, sampling.sample_rows(rows, 100, 43).collect()))
    assert sampling.sample_rows(rows, 5_000, 1).count() == 2_000


def test_sample_draws_copies_in_proportion(spark):
    rows = spark.range(30_000).select(F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).alias("v"))
    got = [r["v"] for r in sampling.sample_rows(rows, 3_000, 5).collect()]
    assert len(got) == 3_000 and abs(got.count(-1) - 1_000) < 150


def test_top_fraction_and_recall(spark):
    scored = spark.createDataFrame([(f"C{i}", float(s)) for i, s in enumerate((9, 8, 3, 2, 1))], "numero_del_contrato string, anomaly_score double")

    def recall(ids, fraction):
        planted = spark.createDataFrame([(i,) for i in ids], "numero_del_contrato string")
        return evaluate.recall_at_top(scored, planted, fraction).first()["recall"]

    assert sampling.top_fraction(scored, "anomaly_score", 0.001).count() == 1
    assert recall(["C0", "C1"], 0.4) == 1.0
    assert recall(["C4"], 0.34) == 0.0
    assert recall(["C1", "C4"], 0.4) == 0.5


def test_repeat_rows_in_chunks(spark):
    rows = spark.createDataFrame([("a", 25_000), ("b", 0), ("c", 1)], "k string, n bigint")
    got = {r["k"]: (r["n"], r["lo"], r["hi"]) for r in sampling.repeat_rows(rows, "n", "i").groupBy("k").agg(
        F.count_distinct("i").alias("n"), F.min("i").alias("lo"), F.max("i").alias("hi")).collect()}
    assert got == {"a": (25_000, 1, 25_000), "c": (1, 1, 1)}


@settings(max_examples=5, deadline=None)
@given(st.lists(st.one_of(st.floats(allow_nan=False), st.floats(-1e-3, 1e-3), st.just(float("inf"))), min_size=1, max_size=60))
def test_values_at_ranks_against_sorted(spark, values):
    rows = spark.createDataFrame([(v,) for v in values] + [(None,)], "v double")
    order = sorted(values)
    wanted = sorted({1, len(order), len(order) // 2 + 1})
    got = ranks.values_at_ranks(rows, F.col("v"), wanted)
    assert [v for v, _, _ in got] == [order[r - 1] for r in wanted]
    for (v, before, equal), rank in zip(got, wanted):
        assert before == sum(x < v for x in order) and equal == order.count(v) and before < rank <= before + equal


def test_values_at_ranks_of_hashes(spark):
    rows = spark.range(5_000).select(F.xxhash64("id").alias("h"))
    order = sorted(r["h"] for r in rows.collect())
    got = ranks.values_at_ranks(rows, F.col("h"), [1, 777, 2_500, 5_000])
    assert [v for v, _, _ in got] == [order[r - 1] for r in (1, 777, 2_500, 5_000)]
