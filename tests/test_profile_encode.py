import numpy as np
import pytest
from pyspark.sql import functions as F

from pactlens.config import CATEGORICAL, DEFAULTS, NUMERIC
from pactlens.operators import encode, profile
from tests.conftest import feature_row


@pytest.fixture
def table(make_features):
    rng = np.random.default_rng(3)
    rows = [feature_row(i, rng) for i in range(60)]
    rows.append(feature_row(60, rng, modalidad_de_contratacion=None))
    return make_features(rows)


def test_index_matches_sorted_categories(table):
    rows = table.select(*CATEGORICAL).collect()
    want, slot = {}, 0
    for c in CATEGORICAL:
        for v in sorted({r[c] for r in rows if r[c] is not None}) + ([None] if any(r[c] is None for r in rows) else []):
            want[(c, v)] = slot
            slot += 1
    got = {(r["column"], r["category"]): r["slot"] for r in encode.category_index(table).collect()}
    assert got == want


def test_unseen_category_has_no_slot(table, make_features):
    index = encode.fit_index(table)
    new = make_features([feature_row(0, np.random.default_rng(1), origen="unseen", modalidad_de_contratacion=None)])
    row = encode.encode(new, index).first()
    assert row["slot_origen"] == -1
    assert row["slot_modalidad_de_contratacion"] == 10  # NULL is the last category of its column
    assert index.count() == encode.category_index(table).count()


def test_matrix_stats_and_names(table):
    index = encode.category_index(table)
    encoded = encode.encode(table, index)
    stats = encode.matrix_stats(encoded, index).first()
    rows = table.select(*NUMERIC).collect()
    nnz = sum(v != 0 for r in rows for v in r) + 6 * len(rows)
    assert (stats["n_rows"], stats["nnz"], stats["n_one_hot"]) == (61, nnz, index.count())
    names = {r["feature"]: r["name"] for r in encode.feature_names(index).collect()}
    assert names[0] == "valor_contrato" and "modalidad_de_contratacion_None" in names.values()
    assert len(names) == 6 + index.count()


def test_too_many_categories(table):
    with pytest.raises(ValueError):
        encode.fit_index(table, DEFAULTS.with_(max_categories=3))


def test_profile(make_contracts):
    contracts = make_contracts(
        {"valor_contrato": "1000000"}, {"valor_contrato": "200000000", "estado_del_proceso": "CELEBRADO"},
        {"valor_contrato": "n/d", "fecha_fin_ejecuci_n": "2023-01-01"}, {"valor_contrato": "5", "documento_proveedor": None},
    )
    assert profile.null_counts(contracts).first()["nulos_documento_proveedor"] == 1
    share = profile.in_range_share(contracts).first()
    assert tuple(share) == (3, 2, 66.67)
    assert sorted(map(tuple, profile.value_histogram(contracts).collect())) == [(1, 1), (80, 1)]
    assert [tuple(r) for r in profile.state_counts(contracts).collect()] == [("celebrado", 4)]
    assert profile.date_quality(contracts).first()["fin_antes_de_inicio"] == 1
    assert [tuple(r) for r in profile.year_profile(contracts).collect()] == [(2024, 2, 100500000.0)]
    assert {tuple(r) for r in profile.cardinality(contracts).collect()} == {(c, 1) for c in profile.CATEGORY_COLUMNS}
    concentration = profile.supplier_concentration(contracts).first()
    assert (concentration["minimo"], concentration["maximo"], concentration["n_proveedores_distintos"]) == (3, 3, 1)
    assert profile.schema_profile(contracts).count() == len(contracts.columns)


def test_quantiles_are_exact(spark):
    values = np.random.default_rng(0).lognormal(17, 1, 5_001).round(2)
    contracts = spark.createDataFrame([(f"{v:.2f}",) for v in values] + [("n/d",)], "valor_contrato string")
    row = profile.value_distribution(contracts).first()
    want = np.quantile(values, [0.5, 0.95, 0.99], method="inverted_cdf").tolist()
    assert [row["mediana"], row["p95"], row["p99"]] == want and row["n"] == 5_001


def test_quantiles_of_nothing(spark):
    row = profile.value_distribution(spark.createDataFrame([("n/d",)], "valor_contrato string")).first()
    assert row["n"] == 0 and row["mediana"] is None
