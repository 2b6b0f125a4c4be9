import logging

import pytest
from pyspark.sql.types import StringType, StructField, StructType

from pactlens.operators.dedup import dedup_rows
from pactlens.operators.kept import add_partition, read_kept
from pactlens.plans import jobs
from pactlens.sources.bronze import NoPartitions, warn_empty_folders
from pactlens.sources.landing import RAW_SCHEMA, land
from tests.conftest import plan_of

NARROW = StructType([StructField(c, StringType()) for c in ("a", "b")])


def sightings(spark, day, rows):
    return spark.createDataFrame([(*r, day) for r in rows], "a string, b string, ingestion_date string")


def test_three_partitions_equal_the_full_run(spark, tmp_path):
    root = str(tmp_path / "kept")
    parts = [
        sightings(spark, "2024-02-01", [(f"r{i}", None if i % 7 else "x") for i in range(200)] + [("r1", None), (None, "r1"), ("r1", "")]),
        sightings(spark, "2024-01-01", [(f"r{i}", None if i % 7 else "x") for i in range(150, 260)]),
        sightings(spark, "2024-03-01", [("r1", None), ("only", "new")]),
    ]
    summaries = [add_partition(p, root, NARROW, 16).first() for p in parts]
    assert [(s["input_rows"], s["new_rows"], s["seen_before"]) for s in summaries] == [(203, 202, 0), (110, 60, 50), (2, 1, 1)]
    assert summaries[2]["buckets_touched"] <= 2
    want = sorted(map(tuple, dedup_rows(parts[0].unionAll(parts[1]).unionAll(parts[2])).collect()), key=repr)
    assert sorted(map(tuple, read_kept(spark, root, NARROW).collect()), key=repr) == want
    # A run that is repeated changes nothing.
    again = add_partition(parts[1], root, NARROW, 16).first()
    assert (again["new_rows"], again["seen_before"]) == (0, 110)
    assert sorted(map(tuple, read_kept(spark, root, NARROW).collect()), key=repr) == want


def test_only_touched_buckets_and_digests_are_read(spark, tmp_path, monkeypatch):
    from pactlens.operators import kept

    root, plans = str(tmp_path / "kept"), []
    add_partition(sightings(spark, "2024-01-01", [(f"r{i}", "x") for i in range(300)]), root, NARROW, 8)
    real = kept.materialize
    monkeypatch.setattr(kept, "materialize", lambda df, label: plans.append((label, plan_of(df))) or real(df, label))
    add_partition(sightings(spark, "2024-01-02", [("r5", "x")]), root, NARROW, 8)
    plan = dict(plans)["marked-sightings"]
    assert "PartitionFilters: [isnotnull(bucket" in plan or "PartitionFilters: [(bucket" in plan or "bucket#" in plan.split("PartitionFilters: [")[1][:80]
    assert "ReadSchema: struct<_d1:bigint,_d2:bigint>" in plan


@pytest.mark.parametrize("most", [0, 10_000])
def test_rows_seen_before_do_not_move_whole(spark, tmp_path, monkeypatch, most):
    from pactlens.operators import kept

    root, wide = str(tmp_path / "kept"), []
    monkeypatch.setattr(kept, "MOST_COPIES", most)
    real = kept.materialize
    monkeypatch.setattr(kept, "materialize", lambda df, label: wide.append("a" in df.columns) or real(df, label))
    rows = [(f"r{i % 40}", "x" if i % 3 else None) for i in range(200)]
    for day in ("2024-01-01", "2024-01-03", "2024-01-02"):
        add_partition(sightings(spark, day, rows), root, NARROW, 8)
    assert not any(wide)
    got = sorted(map(tuple, read_kept(spark, root, NARROW).collect()), key=repr)
    assert got == sorted(((*r, "2024-01-03") for r in set(rows)), key=repr)


def test_empty_partition_and_empty_table(spark, tmp_path):
    root = str(tmp_path / "kept")
    assert add_partition(sightings(spark, "2024-01-01", []), root, NARROW).first()["new_rows"] == 0
    assert read_kept(spark, root, NARROW).count() == 0


def test_jobs_land_extract_and_process_new(spark, tmp_path, caplog):
    raw, kept_root = str(tmp_path / "raw"), str(tmp_path / "kept")
    pages = tmp_path / "pages"
    pages.mkdir()
    (pages / "a.json").write_text('{"numero_del_contrato": "1", "fecha_de_firma_del_contrato": "2024-01-01T00:00:00.000"}\n')
    assert jobs.land(spark, str(pages), raw, "2024-01-02").first()["total_rows"] == 1
    source = land(spark.read.json(str(pages)))
    source.write.parquet(str(tmp_path / "source"))
    assert jobs.extract(spark, str(tmp_path / "source"), str(tmp_path / "raw2"), str(tmp_path / "check")).first()["total_rows"] == 1
    assert jobs.land_stream(spark, str(pages), str(tmp_path / "raw3"), str(tmp_path / "c")).first()["total_rows"] == 1
    assert jobs.process_new(spark, raw, kept_root, "2024-01-02").first()["new_rows"] == 1
    assert read_kept(spark, kept_root).columns == [*RAW_SCHEMA.names, "ingestion_date"]
    (tmp_path / "raw" / "ingestion_date=2024-01-03").mkdir()
    with caplog.at_level(logging.WARNING):
        assert jobs.process(spark, raw, str(tmp_path / "contracts")).first()["output_rows"] == 1
    assert "ingestion_date=2024-01-03" in caplog.text
    with pytest.raises(NoPartitions):
        warn_empty_folders(spark, str(tmp_path / "nothing"))
