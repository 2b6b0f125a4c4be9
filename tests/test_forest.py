import numpy as np
import pytest
from pyspark.sql import functions as F

from pactlens.config import DEFAULTS, NUMERIC
from pactlens.operators import encode, monitor
from pactlens.operators.forest import evaluate, explain, fit, score, store, tree, trials
from pactlens.operators.sampling import most_atypical
from pactlens.plans import jobs
from pactlens.session import materialize
from pactlens.sources.tables import write_table
from pactlens.streaming import contracts as streams
from tests.conftest import feature_row, plan_of

SMALL = DEFAULTS.with_(n_trees=60)


def planted_rows(n=1_980, planted=20, years=(2024,)):
    rng = np.random.default_rng(42)
    rows = [feature_row(i, rng, years[i % len(years)]) for i in range(n)]
    for i in range(n, n + planted):
        rows.append(
            feature_row(
                i, rng, years[i % len(years)], numero_del_contrato=f"OUT-{i}", concentracion_proveedor=1,
                valor_vs_promedio_categoria=float(rng.uniform(11, 19)), duracion_dias=int(rng.integers(1300, 2600)),
            )
        )
    return rows


@pytest.fixture(scope="module")
def table(spark, tmp_path_factory):
    from tests.conftest import FEATURE_SCHEMA

    path = str(tmp_path_factory.mktemp("features"))
    spark.createDataFrame(planted_rows(), FEATURE_SCHEMA).write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="module")
def forest(table):
    return fit.fit_forest(table, SMALL)


def scores(df):
    return {r["url_contrato"]: r["anomaly_score"] for r in df.select("url_contrato", "anomaly_score").collect()}


def walk(nodes, numbers, slots):
    """Path length of one row, node by node."""
    node = 0
    while nodes[node]["feature"] >= 0:
        f = nodes[node]["feature"]
        value = numbers[f] if f < 6 else float((f - 6) in slots)
        node = 2 * node + (2 if value > nodes[node]["threshold"] else 1)
    return nodes[node]["value"]


def test_average_path():
    assert tree.average_path([0, 1, 2]).tolist() == [0.0, 0.0, 1.0]
    assert float(tree.average_path(256)) == pytest.approx(10.2448, abs=1e-3)


def test_trees_are_complete(forest):
    nodes = forest.nodes.toPandas()
    assert nodes["tree_id"].nunique() == 60 and forest.sample_size == 256
    for _, one in nodes.groupby("tree_id"):
        by_id = one.set_index("node_id")
        assert by_id.loc[0, "n_samples"] == 256
        for node, row in by_id.iterrows():
            if row["feature"] >= 0:
                children = by_id.loc[[2 * node + 1, 2 * node + 2], "n_samples"]
                assert children.min() >= 1 and children.sum() == row["n_samples"]
        assert by_id.index.max() < 2**9 - 1


def test_scores_agree_with_a_walk_of_the_node_table(table, forest):
    encoded = encode.encode(table, forest.index).limit(25).toPandas()
    trees = [{r["node_id"]: r for r in g.to_dict("records")} for _, g in forest.nodes.toPandas().groupby("tree_id")]
    got = scores(score.with_scores(table, forest))
    for row in encoded.to_dict("records"):
        numbers, slots = [row[c] for c in NUMERIC], {row[c] for c in encode.SLOTS}
        mean = np.mean([walk(t, numbers, slots) for t in trees])
        want = 2.0 ** (-mean / float(tree.average_path(256))) - 0.5
        assert got[row["url_contrato"]] == pytest.approx(want, abs=1e-12)


def test_planted_outliers_rank_high(table, forest):
    ranked = [r["numero_del_contrato"] for r in score.score_contracts(table, forest).collect()]
    assert sum(n.startswith("OUT-") for n in ranked[: int(len(ranked) * 0.3)]) >= 10
    assert sum(n.startswith("OUT-") for n in ranked[:100]) >= 10


def test_flag_order_and_summary(table, forest):
    rows = score.score_contracts(table, forest).collect()
    values = [r["anomaly_score"] for r in rows]
    assert values == sorted(values, reverse=True)
    assert all(r["is_anomaly"] == (r["anomaly_score"] > 0) for r in rows)
    summary = score.scoring_summary(score.with_scores(table, forest)).first()
    assert summary["total_contratos"] == 2_000 and summary["not_scored"] == 0
    assert most_atypical(score.with_scores(table, forest)).count() == 10


def test_sorted_scores_are_worked_out_once(table, forest):
    assert "EvalPython" not in plan_of(score.score_contracts(table, forest))


@pytest.mark.parametrize("parts", [1, 4, 17])
def test_layout_does_not_change_scores(table, forest, parts):
    spread = table.repartition(parts)
    assert scores(score.with_scores(spread, fit.fit_forest(spread, SMALL))) == scores(score.with_scores(table, forest))


def test_rows_with_a_missing_number_are_not_scored(table, forest, make_features):
    rng = np.random.default_rng(1)
    rows = make_features([feature_row(0, rng, mes_firma=None), feature_row(1, rng)])
    got = score.with_scores(rows, forest).orderBy("url_contrato").collect()
    assert got[0]["anomaly_score"] is None and got[1]["anomaly_score"] is not None
    with_gap = table.unionByName(rows)
    assert fit.fit_forest(with_gap, SMALL.with_(n_trees=5)).nodes.filter("node_id = 0").first()["n_samples"] == 256


@pytest.mark.parametrize("rows, trees, size", [(50_000, 40, 128), (600, 40, 128), (100, 10, 100)])
def test_sample_sizes_and_uniformity(spark, rows, trees, size):
    numbers = [F.col("id").cast("double").alias(c) for c in NUMERIC]
    encoded = spark.range(rows).select(*numbers, *[F.lit(0).alias(c) for c in encode.SLOTS])
    samples = fit.tree_samples(encoded, rows, trees, size, 1)
    per_tree = samples.groupBy("tree_id").agg(F.count("*").alias("n"), F.avg(NUMERIC[0]).alias("m")).collect()
    assert len(per_tree) == trees
    for r in per_tree:
        assert size <= r["n"] <= 4 * size + 100
        assert abs(r["m"] / rows - 0.5) < 6 * 0.29 / np.sqrt(size) + 0.01


def test_copies_enter_the_trees_as_often_as_they_occur(spark):
    rows = 60_000
    hot = F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).cast("double")
    encoded = spark.range(rows).select(*[hot.alias(c) for c in NUMERIC], *[F.lit(0).alias(c) for c in encode.SLOTS])
    samples = fit.tree_samples(encoded, rows, 30, 256, 1)
    share = samples.groupBy("tree_id").agg(F.avg((F.col(NUMERIC[0]) == -1).cast("int")).alias("s")).collect()
    assert len(share) == 30 and all(abs(r["s"] - 1 / 3) < 0.13 for r in share)
    nodes = fit.grow_trees(samples, 30, 256, 1.0, 0, 1)
    assert {r["n_samples"] for r in nodes.filter("node_id = 0").collect()} == {256}


def test_max_features_limits_each_tree(table):
    model = fit.fit_forest(table, SMALL.with_(n_trees=20, max_features=0.2))
    allowed = max(1, int(0.2 * (6 + model.n_slots)))
    used = model.nodes.filter("feature >= 0").groupBy("tree_id").agg(F.count_distinct("feature").alias("n"))
    assert max(r["n"] for r in used.collect()) <= allowed


def test_sample_size_forms():
    assert fit.resolve_samples("auto", 10_000) == 256 and fit.resolve_samples("auto", 100) == 100
    assert fit.resolve_samples(0.5, 1_000) == 500 and fit.resolve_samples(4096, 1_000) == 1_000
    with pytest.raises(ValueError):
        fit.resolve_samples(0.9, 10**9)


def test_contamination_moves_the_cut(table):
    model = fit.fit_forest(table, SMALL.with_(contamination=0.05))
    values = np.array(list(scores(score.with_scores(table, model)).values()))
    assert (values > 0).sum() == 100
    raw = values - model.offset
    assert -model.offset == pytest.approx(np.percentile(raw, 95), abs=1e-12)


def test_round_trip(spark, table, forest, tmp_path):
    store.save_forest(forest, str(tmp_path / "m"))
    assert scores(score.with_scores(table, store.load_forest(spark, str(tmp_path / "m")))) == scores(score.with_scores(table, forest))
    with pytest.raises(store.ModelNotAvailable):
        store.load_forest(spark, str(tmp_path / "none"))


def test_synthetic_anomalies(table):
    made = evaluate.synthetic_anomalies(table, 30, 42).toPandas()
    assert sorted(made["numero_del_contrato"]) == [f"SYNTH-{i:04d}" for i in range(30)]
    assert set(made["_synthetic_pattern"]) == set(evaluate.PATTERNS)
    top = table.agg(F.max("concentracion_proveedor")).first()[0]
    hit = made["_synthetic_pattern"] == "concentracion_extrema"
    assert (made.loc[hit, "concentracion_proveedor"] == 5 * top).all()
    originals = table.toPandas().set_index("url_contrato")
    for _, row in made.iterrows():
        base = originals.loc[row["url_contrato"]]
        value = 50.0 if row["_synthetic_pattern"] == "valor_extremo" else 1.0
        days = 20 if row["_synthetic_pattern"] == "duracion_extrema" else 1
        assert row["valor_contrato"] == base["valor_contrato"] * value
        assert row["duracion_dias"] == base["duracion_dias"] * days


def test_tuning(table):
    settings = DEFAULTS.with_(tuning_rows=400, synthetic_rows=20, top_fraction=0.1)
    trials = [{"n_trees": 20, "max_samples": 64, "max_features": 1.0}, {"n_trees": 10, "max_samples": 4096, "max_features": 0.5}]
    result = evaluate.tune(table, settings, trials)
    rows = result.orderBy("trial_id").collect()
    assert [r["n_trees"] for r in rows] == [20, 10] and all(0 <= r["recall_at_top"] <= 1 for r in rows)
    assert evaluate.best_trial(result).first()["recall_at_top"] == max(r["recall_at_top"] for r in rows)


def test_draws_are_even_at_any_rate():
    keys = np.arange(20_000, dtype=np.uint64)
    for rate in (0.001, 0.04, 0.6, 1.0):
        rows, trees = fit.draws(keys, 30, rate)
        assert len(set(zip(rows.tolist(), trees.tolist()))) == len(rows)
        per_tree = np.bincount(trees, minlength=30) / 20_000
        assert np.abs(per_tree - rate).max() <= 5 * (rate * (1 - rate) / 20_000) ** 0.5
        both = np.intersect1d(rows[trees == 3], rows[trees == 4])
        assert abs(len(both) / 20_000 - rate**2) < 0.02


def test_only_drawn_rows_move(table):
    encoded = encode.encode(table, encode.fit_index(table))
    samples = fit.tree_samples(encoded, 2_000, 10, 64, 1)
    assert "Exchange hashpartitioning" not in samples._jdf.queryExecution().executedPlan().toString()
    once = sorted(map(tuple, samples.collect()))
    for parts in (1, 4, 17):
        moved = fit.tree_samples(encode.encode(table.repartition(parts), encode.fit_index(table)), 2_000, 10, 64, 1)
        assert sorted(map(tuple, moved.collect())) == once


def test_stacked_trials_score_like_a_forest_each(spark, table):
    design = [{"n_trees": 20, "max_samples": 64, "max_features": 1.0}, {"n_trees": 9, "max_samples": 500, "max_features": 0.6}]
    sizes = [64, 500]
    index = encode.fit_index(table)
    encoded = materialize(encode.encode(table, index), "encoded")
    n_slots = index.count()
    samples = fit.tree_samples(encoded, 2_000, 20, 500, 3)
    packed = materialize(trials.grow_trials(samples, design, sizes, n_slots, 3), "packed")
    assert packed.groupBy("trial_id").count().orderBy("trial_id").collect() == [(0, 20), (1, 9)]
    together = trials.score_trials(encoded, packed, sizes, n_slots)
    apart = trials.score_trials(encoded, packed, sizes, n_slots, most=packed.agg(F.max("n_nodes") * 20).head()[0])
    got = {r["url_contrato"]: r["scores"] for r in together.collect()}
    assert got == {r["url_contrato"]: r["scores"] for r in apart.collect()} and all(len(x) == 2 for x in got.values())
    rows = packed.collect()
    for e in encoded.limit(30).collect():
        numbers, slots = [e[c] for c in NUMERIC], [e[c] for c in encode.SLOTS]
        for k, size in enumerate(sizes):
            lengths = []
            for r in rows:
                if r["trial_id"] == k:
                    feature, left = np.frombuffer(r["feature"], np.int32), np.frombuffer(r["left"], np.int32)
                    threshold, path = np.frombuffer(r["threshold"]), np.frombuffer(r["path"])
                    node = 0
                    while left[node] != node:
                        f = feature[node]
                        value = numbers[f] if f < 6 else float((f - 6) in slots)
                        node = left[node] + (value > threshold[node])
                    lengths.append(path[node])
            want = 2.0 ** (-np.mean(lengths) / float(tree.average_path(size))) - 0.5
            assert got[e["url_contrato"]][k] == pytest.approx(want, abs=1e-12)
    with pytest.raises(ValueError):
        trials.passes([5, 9, 7], 8)
    assert trials.passes([5, 3, 7, 1], 8) == [[0, 1], [2, 3]]


def test_masks_answer_for_all_rows_at_once():
    rng = np.random.default_rng(8)
    numbers, slots = np.round(rng.normal(size=(131, 6)), 1), rng.integers(-1, 9, size=(131, 6))
    numbers[5, 0], numbers[6, 1], numbers[7, 1], numbers[:, 2] = np.nan, np.inf, -np.inf, 3.0
    masks = trials.Masks(numbers, slots)

    def rows(line):
        return np.unpackbits(masks.lines[line].view(np.uint8), bitorder="little")[:131].astype(bool)

    cuts = np.sort(np.r_[np.unique(numbers[~np.isnan(numbers)])[1:-1], -9.0, 0.05, 0.05, 9.0, np.nan])
    for f in range(6):
        for cut, line in zip(cuts, masks.above(f, cuts), strict=True):
            assert (rows(line) == (numbers[:, f] > cut)).all()
    for slot, line in zip(range(12), masks.having(np.arange(12)), strict=True):
        assert (rows(line) == (slots == slot).any(axis=1)).all()


def test_rows_in_blocks_and_trees_in_blocks_score_like_a_walk(spark, monkeypatch):
    rng = np.random.default_rng(9)
    sizes, n_trees = [200, 1, 64], [11, 2, 8]
    numbers, slots = rng.normal(size=(200, 6)), rng.integers(0, 7, size=(200, 6))
    packed = [(k, t, tree.pack(tree.grow(numbers[:n], slots[:n], tree.depth_limit(n), 7, 1.0, rng))) for k, n in enumerate(sizes) for t in range(n_trees[k])]
    rows = [(k, t, len(p["left"]), *(p[c].tobytes() for c in ("feature", "threshold", "left", "path"))) for k, t, p in packed]
    stack = trials.Stack.of(spark.createDataFrame(rows, trials.PACKED), range(3), sizes)
    points, own = rng.normal(size=(150, 6)), rng.integers(-1, 9, size=(150, 6))
    points[3, 4] = np.nan
    got = stack.scores(points, own)
    for i in range(150):
        for k, size in enumerate(sizes):
            lengths = []
            for p in (p for trial, _, p in packed if trial == k):
                node = 0
                while p["left"][node] != node:
                    f = p["feature"][node]
                    value = points[i, f] if f < 6 else float((f - 6) in own[i])
                    node = p["left"][node] + (value > p["threshold"][node])
                lengths.append(p["path"][node])
            assert got[i, k] == pytest.approx(2.0 ** (-np.mean(lengths) / (float(tree.average_path(size)) or 1.0)) - 0.5, abs=1e-12)
    # Blocks of rows change nothing, nor does a bound on their masks.
    for name, bound in (("BLOCK_ROWS", 64), ("BLOCK_BYTES", 1)):
        monkeypatch.setattr(trials, name, bound)
        assert (stack.scores(points, own) == got).all()
    assert stack.scores(points[:0], own[:0]).shape == (0, 3)


@pytest.mark.parametrize("bins", [2, 1024])
def test_cuts_and_detected_against_sorting(spark, bins):
    rng = np.random.default_rng(bins)
    values = np.round(rng.normal(0, 0.1, (600, 4)), 3)
    values[:, 1] = np.round(values[:, 1], 1)
    values[:, 2] = 0.25
    planted = rng.random(600) < 0.1
    rows = [(f"id{i % 590:04d}", bool(p), [float(x) for x in v]) for i, (p, v) in enumerate(zip(planted, values))]
    scored = spark.createDataFrame(rows, "id string, planted boolean, scores array<double>").repartition(5)
    for k in (1, 30, 599, 600):
        cuts = trials.top_cuts(scored, 4, k, bins)
        found = trials.detected(scored, cuts, k, "id", "planted")
        for t in range(4):
            ranked = sorted(values[:, t], reverse=True)
            assert cuts[t] == trials.Cut(ranked[k - 1], sum(x > ranked[k - 1] for x in ranked), ranked.count(ranked[k - 1]))
            order = sorted(rows, key=lambda r: (-r[2][t], r[0]))
            hits = sum(r[1] for r in order[:k])
            # Rows of one identifier and score are equal to the cut.
            assert abs(found[t] - hits) <= (order[k - 1][0] == order[min(k, 599)][0])


def test_trial_design():
    design = evaluate.trial_design(40, 42)
    assert design[0] == evaluate.FIRST_TRIAL and design == evaluate.trial_design(40, 42) and len(design) == 40
    assert all(100 <= t["n_trees"] <= 800 and 256 <= t["max_samples"] <= 4096 and 0.5 <= t["max_features"] <= 1 for t in design)


def test_attributions_add_up(table, forest):
    examples = score.with_scores(table, forest).limit(6).withColumn("row_id", F.monotonically_increasing_id().cast("int"))
    examples = materialize(examples, "examples")
    got = explain.attributions(forest, examples).groupBy("row_id").agg(F.sum("attribution").alias("s")).collect()
    nodes = forest.nodes.toPandas()
    leaves = nodes[nodes["feature"] < 0]
    expected = (leaves["value"] * leaves["n_samples"]).sum() / 256 / 60
    wanted = {r["row_id"]: -np.log2(r["anomaly_score"] + 0.5) * float(tree.average_path(256)) - expected for r in examples.collect()}
    assert {r["row_id"]: pytest.approx(r["s"], abs=1e-9) for r in got} == wanted


def test_one_tree_against_the_definition_of_shapley_values():
    from itertools import combinations
    from math import factorial

    rng = np.random.default_rng(5)
    numbers, slots = rng.normal(size=(40, 6)), rng.integers(0, 3, size=(40, 6))
    import pandas as pd

    nodes = pd.DataFrame(tree.grow(numbers, slots, 4, 3, 1.0, rng))
    by_id = {r["node_id"]: r for r in nodes.to_dict("records")}
    row, row_slots = rng.normal(size=6), rng.integers(0, 3, size=6)

    def value(known, node=0):
        r = by_id[node]
        f = r["feature"]
        if f < 0:
            return r["value"]
        left, right = 2 * node + 1, 2 * node + 2
        if f in known:
            x = row[f] if f < 6 else float((f - 6) in row_slots)
            return value(known, right if x > r["threshold"] else left)
        return sum(by_id[c]["n_samples"] * value(known, c) for c in (left, right)) / r["n_samples"]

    got = explain.explain_tree(nodes, row[None, :], row_slots[None, :], 9)[0]
    for f in range(9):
        others = [g for g in range(9) if g != f]
        want = sum(
            factorial(k) * factorial(8 - k) / factorial(9) * (value({*s, f}) - value(set(s)))
            for k in range(9) for s in combinations(others, k)
        )
        assert got[f] == pytest.approx(want, abs=1e-9)


@pytest.mark.parametrize("limit, bits, rows", [(4, 10, 1 << 14), (7, 7, 50), (8, 8, 64), (8, 13, 1 << 14), (1, 10, 7)])
def test_attributions_by_tables_equal_those_leaf_by_leaf(monkeypatch, limit, bits, rows):
    import pandas as pd

    rng = np.random.default_rng(limit + bits)
    numbers, slots = np.round(rng.normal(size=(300, 6)), 1), rng.integers(0, 3, size=(300, 6)) + 3 * np.arange(6)
    trees = [pd.DataFrame(tree.grow(numbers[i:][:n], slots[i:][:n], limit, 18, 1.0, rng)) for i, n in ((0, 256), (20, 200), (9, 90), (0, 1), (7, 2))]
    points, own = np.round(rng.normal(size=(130, 6)), 1), rng.integers(0, 3, size=(130, 6)) + 3 * np.arange(6)
    points[4, 2], own[5], own[6, 3] = np.nan, -1, 99
    want = sum(explain.explain_tree(t, points, own, 24) for t in trees)
    monkeypatch.setattr(explain, "BLOCK_ROWS", rows)
    got = explain._explain_block([explain._plan(t, bits) for t in trees], points, own, 24)
    assert np.abs(got.T - want).max() < 1e-12


def test_attributions_of_small_batches_and_of_deep_trees(spark, table, forest, monkeypatch):
    examples = score.with_scores(table, forest).limit(40).withColumn("row_id", F.monotonically_increasing_id())
    examples = materialize(examples, "examples")

    def found():
        return {(r["row_id"], r["feature"]): r["attribution"] for r in explain.attributions(forest, examples).collect()}

    at_once = found()
    # A few rows at a time, from batches of other sizes, and leaf by leaf.
    monkeypatch.setattr(explain, "MAX_CELLS", 7 * (6 + forest.n_slots))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "5")
    in_blocks = found()
    spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    monkeypatch.setattr(explain, "MAX_DEPTH", 2)
    by_leaf = found()
    assert len({row for row, _ in at_once}) == 40
    for some in (in_blocks, by_leaf):
        assert max(abs(at_once.get(k, 0) - some.get(k, 0)) for k in {*at_once, *some}) < 1e-12


def test_explain_forest(table, forest):
    scored = score.with_scores(table, forest)
    rows, importance = explain.explain_forest(scored, forest, DEFAULTS.with_(examples=5))
    assert rows.select("row_id").distinct().count() == 10
    values = [r["mean_abs_attribution"] for r in importance.collect()]
    assert len(values) == 6 + forest.n_slots and values == sorted(values, reverse=True)


def test_model_drift_and_comparison(spark, forest, make_features):
    rows = make_features(planted_rows(600, 0, (2023, 2025, 2023, 2026)))
    report = monitor.model_drift(rows, forest).first()
    assert (report["reference_rows"], report["current_rows"]) == (300, 300)
    assert 0 <= report["reference_anomaly_rate"] <= 1 and 0 <= report["current_anomaly_rate"] <= 1
    both = monitor.score_both(rows, forest, forest).collect()
    assert len(both) == 600 and all(r["old"] == r["new"] for r in both)
    assert sorted(r["old"]["anomaly_score"] for r in both) == sorted(scores(score.with_scores(rows, forest)).values())
    same = monitor.compare_models(rows, forest, forest).first()
    assert same["score_drift_detected"] is False and same["reference_anomaly_rate"] == same["current_anomaly_rate"]
    with pytest.raises(ValueError):
        monitor.model_drift(rows.filter("year(fecha_de_firma_del_contrato) = 2023"), forest)


def test_jobs_end_to_end(spark, table, tmp_path):
    features, model, scored = (str(tmp_path / p) for p in ("features", "model", "scores"))
    write_table(table, features)
    settings = SMALL.with_(n_trees=20, examples=3, reference_years=(2024,), current_years=(2024,))
    assert jobs.reference_tables(spark, features, str(tmp_path / "refs")).first()["n_proveedores_distintos"] == 200
    run = jobs.train(spark, features, model, scored, settings, explain=True).first()
    assert run["total_contratos"] == 2_000 and run["n_trees"] == 20
    new = spark.read.parquet(features).limit(30).withColumn("valor_contrato", F.when(F.col("mes_firma") > 6, F.col("valor_contrato")).otherwise(-1.0))
    new.write.parquet(str(tmp_path / "new"))
    row = jobs.score(spark, str(tmp_path / "new"), str(tmp_path / "refs"), model, str(tmp_path / "out"), str(tmp_path / "quarantine")).first()
    assert row["scored"] + row["rejected"] == 30 and row["rejected"] == spark.read.parquet(str(tmp_path / "quarantine")).filter("valor_contrato = -1").count() > 0
    assert jobs.top_report(spark, scored).count() == 10
    assert spark.read.option("header", True).csv(f"{model}/feature_importance").columns == ["feature", "mean_abs_attribution"]
    assert spark.read.parquet(f"{model}/runs").count() == 1
    both = settings.with_(reference_years=(2023,), current_years=(2025, 2026))
    write_table(table.sparkSession.createDataFrame(planted_rows(400, 0, (2023, 2025)), table.schema), features)
    assert jobs.data_drift(spark, features, str(tmp_path / "drift"), both).first()["n_columns_evaluated"] == 12
    assert jobs.model_drift(spark, features, model, str(tmp_path / "mdrift"), both).first()["reference_rows"] == 200
    signals = jobs.retrain_signals(spark, features, model, str(tmp_path / "signals"), both).collect()
    assert {r["signal"] for r in signals} == {"history_growth", "drifted_share", "anomaly_rate_change_pct"}
    assert jobs.compare_models(spark, features, model, model, str(tmp_path / "compare"), both).first()["score_drift_value"] == 0


def test_scoring_a_stream_equals_scoring_a_table(spark, table, forest, tmp_path):
    from pactlens.operators.reference import reference_category_means, reference_supplier_counts, reference_tables

    refs = reference_tables(reference_category_means(table), reference_supplier_counts(table))
    new = table.drop("valor_vs_promedio_categoria", "duracion_dias", "mes_firma", "dia_semana_firma", "concentracion_proveedor")
    new = new.limit(50).unionByName(new.limit(1).withColumn("valor_contrato", F.lit(0.0)))
    source = str(tmp_path / "in")
    new.write.parquet(source)
    batch, rejected = streams.score_stream(spark.read.parquet(source), refs, forest)
    assert rejected.count() == 1
    live, quarantine = streams.score_stream(spark.readStream.schema(new.schema).parquet(source), refs, forest)
    streams.append_stream(live, str(tmp_path / "out"), str(tmp_path / "c1")).awaitTermination()
    streams.append_stream(quarantine, str(tmp_path / "bad"), str(tmp_path / "c2")).awaitTermination()
    got = sorted(map(tuple, spark.read.parquet(str(tmp_path / "out")).collect()))
    assert got == sorted(map(tuple, batch.collect())) and len(got) == 50
    assert spark.read.parquet(str(tmp_path / "bad")).first()["violations"] == ["value_not_positive"]
