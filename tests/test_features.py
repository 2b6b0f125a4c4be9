from datetime import date

import numpy as np
import pytest
from pyspark.sql import functions as F

from pactlens.config import DEFAULTS, FEATURE_COLUMNS, SIGN_YEAR
from pactlens.operators import features, lookup, reference
from tests.conftest import FEATURE_TYPES, feature_row, plan_of


def build(contracts, settings=DEFAULTS):
    return features.build_features(contracts, settings)


def test_columns_and_types(make_contracts):
    table = build(make_contracts({}))
    assert table.columns == list(FEATURE_COLUMNS)
    assert dict(table.dtypes) == {c: FEATURE_TYPES.get(c, "string") for c in FEATURE_COLUMNS}


def test_identifiers_and_items_of_one_contract_stay(make_contracts):
    table = build(make_contracts({"objeto_a_contratar": "PUENTE"}, {"objeto_a_contratar": "TEJADO"}))
    assert sorted(r["objeto_a_contratar"] for r in table.collect()) == ["PUENTE", "TEJADO"]
    assert {r["numero_del_contrato"] for r in table.collect()} == {"obra-17"}


@pytest.mark.parametrize(
    "change, kept",
    [
        ({"fecha_inicio_ejecuci_n": "2024-03-01", "fecha_fin_ejecuci_n": "2024-02-01"}, False),
        ({"fecha_inicio_ejecuci_n": "2024-03-01", "fecha_fin_ejecuci_n": "2024-03-01"}, True),
        ({"fecha_fin_ejecuci_n": "no-es-una-fecha"}, False),
        ({"fecha_inicio_ejecuci_n": None}, False),
        ({"estado_del_proceso": "Borrador"}, False),
        ({"estado_del_proceso": None}, False),
        ({"estado_del_proceso": "TERMINADO"}, True),
        ({"estado_del_proceso": "EN EJECUCIÓN"}, True),
        ({"estado_del_proceso": "en ejecucion"}, False),
        ({"valor_contrato": "999999"}, False),
        ({"valor_contrato": "1000000"}, True),
        ({"valor_contrato": "200000000"}, True),
        ({"valor_contrato": "200000000.01"}, False),
        ({"valor_contrato": "NaN"}, False),
        ({"valor_contrato": "Infinity"}, False),
        ({"valor_contrato": "n/d"}, False),
        ({"modalidad_de_contrataci_n": None}, False),
        ({"documento_proveedor": None}, False),
        ({"fecha_de_firma_del_contrato": None}, True),
    ],
)
def test_filter_rules(make_contracts, change, kept):
    table = build(make_contracts({"numero_del_contrato": "other"}, {"numero_del_contrato": "it", **change}))
    assert (table.filter("numero_del_contrato = 'it'").count() == 1) is kept


def test_ratio_to_category_mean(make_contracts):
    table = build(make_contracts(*[{"valor_contrato": str(v)} for v in (1_000_000, 2_000_000, 3_000_000)]))
    assert sorted(r["valor_vs_promedio_categoria"] for r in table.collect()) == [0.5, 1.0, 1.5]


def test_year_normalised_mean(make_contracts):
    rows = [{"valor_contrato": v, "fecha_de_firma_del_contrato": d} for v, d in (("1000000", "2023-01-01"), ("4000000", "2024-01-01"))]
    by_year = DEFAULTS.with_(category_keys=(*DEFAULTS.category_keys, SIGN_YEAR))
    assert [r[0] for r in build(make_contracts(*rows), by_year).select("valor_vs_promedio_categoria").collect()] == [1.0, 1.0]


def test_duration_calendar_and_concentration(make_contracts):
    rows = [{"documento_proveedor": "A"}] * 3 + [{"documento_proveedor": "B"}]
    dates = {"fecha_inicio_ejecuci_n": "2024-01-01", "fecha_fin_ejecuci_n": "2024-01-31", "fecha_de_firma_del_contrato": "2024-01-14"}
    got = build(make_contracts(*[{**r, **dates} for r in rows])).collect()
    assert {r["duracion_dias"] for r in got} == {30}
    assert {(r["mes_firma"], r["dia_semana_firma"]) for r in got} == {(1, 0)}  # a Sunday
    assert {(r["documento_proveedor"], r["concentracion_proveedor"]) for r in got} == {("A", 3), ("B", 1)}


def test_summary_counts_rows_lost_to_null_keys(make_contracts):
    contracts = make_contracts({}, {"departamento_entidad": None}, {"valor_contrato": "1"})
    row = features.features_summary(features.features_with_totals(contracts)[1]).first()
    assert (row["input_rows"], row["output_rows"], row["null_key_rows"]) == (2, 1, 1)


def test_small_lookups_are_broadcast(make_contracts):
    plan = plan_of(build(make_contracts({})))
    assert plan.count("BroadcastHashJoin") == 2 and "SortMergeJoin" not in plan


def test_casts_run_once_and_after_the_state_filter(make_contracts):
    plan = plan_of(features.eligible_contracts(make_contracts({})))
    assert plan.count("fecha_fin_ejecuci_n") and plan.index("Generate") < plan.index("lower(estado_del_proceso")
    above = plan[: plan.index("Generate")]
    assert "try_cast(fecha_fin_ejecuci_n" not in above and "try_cast(valor_contrato" not in above


@pytest.mark.parametrize("how", ["inner", "left"])
def test_lookup_of_a_hot_key_without_broadcast(spark, how):
    rows = spark.createDataFrame([(i, "hot" if i % 3 else f"k{i}") for i in range(300)] + [(300, None)], "i int, k string")
    counts = rows.groupBy("k").agg(F.count("*").alias("n"))
    got = lookup._split_hot(rows, counts, "k", "n", how, 50)
    want = rows.join(counts, "k", how).select("i", "k", "n")
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, want.collect()), key=str)
    assert got.columns == ["i", "k", "n"]


def test_large_lookup_path_gives_the_same_table(make_contracts):
    rows = [{"documento_proveedor": f"s{i % 7}", "valor_contrato": str(1_000_000 + i)} for i in range(40)]
    contracts = make_contracts(*rows)
    shuffled = build(contracts, DEFAULTS.with_(broadcast_rows=0))
    assert sorted(map(tuple, shuffled.collect())) == sorted(map(tuple, build(contracts).collect()))


# --- reference tables and new contracts


@pytest.fixture
def history(make_features):
    rng = np.random.default_rng(0)
    rows = [("A", "X", 10.0, "p1"), ("A", "X", 20.0, "p1"), ("A", "Y", 100.0, "p2"), ("B", "X", 5.0, "p3"),
            ("B", "X", 15.0, "p3"), ("B", "X", 25.0, "p3"), ("B", "Y", 200.0, "p4")]
    return make_features(
        [feature_row(i, rng, modalidad_de_contratacion=m, departamento_entidad=d, valor_contrato=v, documento_proveedor=p)
         for i, (m, d, v, p) in enumerate(rows)]
    )


def bind(history):
    return reference.reference_tables(reference.reference_category_means(history), reference.reference_supplier_counts(history))


def test_reference_tables(history):
    tables = bind(history)
    assert {tuple(r) for r in tables.means.collect()} == {("A", "X", 15.0), ("A", "Y", 100.0), ("B", "X", 15.0), ("B", "Y", 200.0)}
    assert {tuple(r) for r in tables.counts.collect()} == {("p1", 2), ("p2", 1), ("p3", 3), ("p4", 1)}
    assert tables.global_mean == 82.5


def new_contract(spark, **changes):
    row = {
        "numero_del_contrato": "N", "valor_contrato": 30.0, "fecha_de_firma_del_contrato": date(2026, 3, 10),
        "fecha_inicio_ejecucion": date(2026, 3, 15), "fecha_fin_ejecucion": date(2026, 3, 25), "documento_proveedor": "p3",
        "modalidad_de_contratacion": "A", "departamento_entidad": "X", "nivel_entidad": "N0", "tipo_de_contrato": "T0",
        "origen": "O0", "tipo_documento_proveedor": "X0", **changes,
    }
    schema = ", ".join(f"{c} {FEATURE_TYPES.get(c, 'string')}" for c in row)
    return spark.createDataFrame([tuple(row.values())], schema)


def test_new_contract_with_known_keys(spark, history):
    row = reference.featurize_new(new_contract(spark), bind(history)).first()
    assert (row["valor_vs_promedio_categoria"], row["duracion_dias"], row["mes_firma"], row["dia_semana_firma"]) == (2.0, 10, 3, 2)
    assert row["concentracion_proveedor"] == 4


def test_new_contract_with_unseen_keys(spark, history):
    new = new_contract(spark, documento_proveedor="unseen", departamento_entidad="unseen", valor_contrato=165.0)
    row = reference.featurize_new(new, bind(history)).first()
    assert (row["valor_vs_promedio_categoria"], row["concentracion_proveedor"]) == (2.0, 1)


def test_zero_mean_gives_ratio_zero(spark, history):
    tables = bind(history.withColumn("valor_contrato", F.lit(0.0)))
    assert reference.featurize_new(new_contract(spark), tables).first()["valor_vs_promedio_categoria"] == 0.0


@pytest.mark.parametrize(
    "change, codes",
    [
        ({}, []),
        ({"valor_contrato": 0.0}, ["value_not_positive"]),
        ({"valor_contrato": float("nan")}, ["value_not_positive"]),
        ({"fecha_fin_ejecucion": date(2026, 3, 14)}, ["end_before_start"]),
        ({"origen": None, "valor_contrato": -1.0}, ["missing:origen", "value_not_positive"]),
    ],
)
def test_input_rules(spark, change, codes):
    new = new_contract(spark, **change)
    assert reference.validate_new(new).first()["violations"] == codes
    accepted, rejected = reference.split_valid(new)
    assert (accepted.count(), rejected.count()) == ((0, 1) if codes else (1, 0))


def test_large_lookup_is_joined_in_parts(spark):
    from pactlens.operators.lookup import attach_small

    rows = spark.createDataFrame([("a" if i % 3 else None, i) for i in range(200)] + [("b", 1), ("c", 2)], "k string, i int")
    table = spark.createDataFrame([("a", 1.0), ("b", 2.0)], "k string, m double")
    for how in ("inner", "left"):
        few, many = (sorted(map(str, attach_small(rows, table, ["k"], how, bound).select("k", "i", "m").collect())) for bound in (10, 1))
        assert few == many and len(few) == (134 if how == "inner" else 202)
