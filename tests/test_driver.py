"""The driver contract: every query with a SQL twin agrees with DuckDB on the smallest tables."""

import os
import subprocess
import sys
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry
from check import rows_of
from pactlens.config import DEFAULTS
from pactlens.operators.forest import evaluate
from tests.conftest import plan_of

SF = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="driver tables are not here")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for path in Path(SF).glob("*.parquet"):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    return con


def test_flagship(spark):
    rows = entry.entry(spark)
    assert rows.first()["valor_vs_promedio_categoria"] > 1


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_query(spark, duck, name):
    got = entry.queries()[name](spark, SF)
    rows = got.collect()
    sql = entry.oracle_sql().get(name)
    if sql is None:
        assert rows
        return
    relation = duck.execute(sql)
    names = [d[0] for d in relation.description]
    assert sorted(got.columns) == sorted(names)
    assert rows_of(rows, got.columns) == rows_of(relation.fetchall(), names)


def test_tuning_runs_the_whole_design(spark):
    rows = entry.queries()["tuning_trials"](spark, SF).orderBy("trial_id").collect()
    got = [{c: r[c] for c in ("n_trees", "max_samples", "max_features")} for r in rows]
    assert got == evaluate.trial_design(DEFAULTS.n_trials, DEFAULTS.seed) and len(got) == 40


@pytest.mark.parametrize("name", ["features_full", "featurize_new", "model_drift", "drift_flags", "forest_scores", "top_fraction"])
def test_no_cross_join(spark, name):
    plan = plan_of(entry.queries()[name](spark, SF))
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan


def test_workers_find_the_package_from_any_folder(tmp_path):
    root = Path(entry.__file__).resolve().parent
    script = tmp_path / "elsewhere.py"
    script.write_text(
        "import importlib.util\n"
        "from pyspark.sql import SparkSession\n"
        "spark = SparkSession.builder.master('local[2]').config('spark.sql.shuffle.partitions', '2').getOrCreate()\n"
        f"spec = importlib.util.spec_from_file_location('entry', {str(root / '__spark_entry__.py')!r})\n"
        "module = importlib.util.module_from_spec(spec)\n"
        "spec.loader.exec_module(module)\n"
        f"assert module.queries()['score_new'](spark, {SF!r}).count() > 0\n"
    )
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    subprocess.run([sys.executable, str(script)], cwd=tmp_path, env=env, check=True, timeout=300)
