from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from pactlens.config import CATEGORICAL, DEFAULTS, IDENTIFIERS, NUMERIC, RAW_COLUMNS
from pactlens.operators.dedup import dedup_rows, dedup_summary
from pactlens.plans import jobs
from pactlens.sources import bronze, landing, windows
from pactlens.sources.tables import load_features
from tests.conftest import plan_of

RAW3 = "numero_del_contrato string, nit_de_la_entidad string, valor_contrato string, ingestion_date string"


def raw(spark, *rows):
    return spark.createDataFrame(rows, RAW3)


def test_equal_rows_collapse(spark):
    assert dedup_rows(raw(spark, *[("1", "9", "5", "2026-09-01")] * 2)).count() == 1


def test_same_number_other_value_stays(spark):
    assert dedup_rows(raw(spark, ("1", "9", "5", "2026-09-01"), ("1", "9", "6", "2026-09-01"))).count() == 2


def test_latest_sighting_is_kept_as_text_and_nulls_are_equal(spark):
    got = dedup_rows(raw(spark, ("1", None, "5", "2026-09-02"), ("1", None, "5", "2026-09-01"))).collect()
    assert [tuple(r) for r in got] == [("1", None, "5", "2026-09-02")]


def test_summary(spark):
    rows = raw(spark, ("1", "9", "5", "2026-09-01"), ("1", "9", "5", "2026-09-02"), ("2", "9", "5", "2026-09-02"))
    row = dedup_summary(rows, dedup_rows(rows)).first()
    assert tuple(row) == (3, 2, 1)


def test_dedup_hashes_and_does_not_sort(spark):
    plan = plan_of(dedup_rows(raw(spark, ("1", "9", "5", "2026-09-01"))))
    assert "HashAggregate" in plan and "SortAggregate" not in plan


def test_process_job(spark, tmp_path):
    root = str(tmp_path / "raw")
    rows = spark.createDataFrame([("1",), ("2",)], "numero_del_contrato string")
    landing.write_raw(landing.land(rows), root, "2026-09-01")
    landing.write_raw(landing.land(rows.limit(1)), root, "2026-09-02")
    (tmp_path / "raw" / "_checkpoints").mkdir()
    summary = jobs.process(spark, root, str(tmp_path / "contracts")).first()
    assert (summary["input_rows"], summary["output_rows"], summary["duplicates_removed"]) == (3, 2, 1)
    contracts = spark.read.parquet(str(tmp_path / "contracts"))
    assert set(contracts.columns) == {*RAW_COLUMNS, "ingestion_date"}
    assert dict(contracts.dtypes)["ingestion_date"] == "string"


def test_no_partitions(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        bronze.read_raw(spark, str(tmp_path / "nothing"))


def test_empty_partitions_are_reported(spark):
    rows = raw(spark, ("1", "9", "5", "2026-09-01"))
    expected = spark.createDataFrame([("2026-09-01",), ("2026-09-02",)], "ingestion_date string")
    assert [r[0] for r in bronze.empty_partitions(rows, expected).collect()] == ["2026-09-02"]


def test_landing_keeps_22_text_columns(spark, tmp_path):
    path = tmp_path / "page.json"
    path.write_text('{"nivel_entidad": "Nacional", "valor_contrato": "1000000", "otra": 1}\n')
    for rows in (landing.read_json_pages(spark, str(path)), landing.land(spark.read.json(str(path)))):
        assert rows.columns == list(RAW_COLUMNS) and {t for _, t in rows.dtypes} == {"string"}
        row = rows.first()
        assert (row["nivel_entidad"], row["valor_contrato"], row["origen"]) == ("Nacional", "1000000", None)


def utc(text):
    return datetime.fromisoformat(text).replace(tzinfo=timezone.utc)


def span(spark, checkpoint, now="2024-06-10 13:00:00"):
    rows = [(utc(checkpoint), None)] if checkpoint else []
    table = spark.createDataFrame(rows, windows.CHECKPOINT_SCHEMA)
    row = windows.extract_range(table, F.lit(now).cast("timestamp")).select(F.col("lo").cast("string"), F.col("hi").cast("string")).first()
    return tuple(row)


@pytest.mark.parametrize(
    "checkpoint, start",
    [
        (None, "2022-01-01 00:00:00"),
        ("2024-06-01", "2024-05-27 00:00:00"),
        ("2019-01-01", "2022-01-01 00:00:00"),
        ("2022-01-03", "2022-01-01 00:00:00"),
    ],
)
def test_range(spark, checkpoint, start):
    assert span(spark, checkpoint) == (start, "2024-06-11 00:00:00")


def window_rows(spark, lo, hi):
    table = spark.createDataFrame([(utc(lo), utc(hi))], "lo timestamp, hi timestamp")
    got = windows.date_windows(table).select(*[F.date_format(c, "yyyy-MM-dd").alias(c) for c in ("window_start", "window_end")])
    return [tuple(r) for r in got.orderBy("window_start").collect()]


def test_windows(spark):
    assert window_rows(spark, "2024-01-01", "2024-02-05") == [
        ("2024-01-01", "2024-01-16"), ("2024-01-16", "2024-01-31"), ("2024-01-31", "2024-02-05"),
    ]
    assert window_rows(spark, "2024-01-01", "2024-01-16") == [("2024-01-01", "2024-01-16")]
    assert window_rows(spark, "2024-01-01", "2024-01-01") == []


def test_extract_twice(spark, tmp_path):
    root, checkpoint = str(tmp_path / "raw"), str(tmp_path / "checkpoint")
    source = spark.createDataFrame(
        [("1", "2021-12-31T00:00:00.000"), ("2", "2022-01-01T00:00:00.000"), ("3", "2022-01-20T00:00:00.000"), ("4", "2022-02-11T00:00:00.000")],
        "numero_del_contrato string, fecha_de_firma_del_contrato string",
    )
    first = landing.extract(source, root, checkpoint, utc("2022-01-22 10:00"), windows_per_commit=1).first()
    assert (first["n_windows"], first["total_rows"]) == (2, 2)
    # The second run re-reads the five days before the checkpoint of 2022-01-23.
    second = landing.extract(source, root, checkpoint, utc("2022-02-11 10:00")).first()
    assert second["total_rows"] == 2
    rows = bronze.read_raw(spark, root).select("ingestion_date", "numero_del_contrato").collect()
    assert sorted(map(tuple, rows)) == [("2022-01-22", "2"), ("2022-01-22", "3"), ("2022-02-11", "3"), ("2022-02-11", "4")]


def test_checkpoint_moves_without_rows_and_a_day_may_run_twice(spark, tmp_path):
    root, checkpoint = str(tmp_path / "raw"), str(tmp_path / "checkpoint")
    source = spark.createDataFrame([("1", "2022-01-02")], "numero_del_contrato string, fecha_de_firma_del_contrato string")
    settings = DEFAULTS.with_(history_start="2022-01-02")
    landing.extract(source.limit(0), root, checkpoint, utc("2022-01-01 10:00"), settings=settings)
    assert windows.read_checkpoint(spark, checkpoint).count() == 0  # an empty range has no window
    landing.extract(source.limit(0), root, checkpoint, utc("2022-01-02 10:00"), settings=settings)
    assert windows.read_checkpoint(spark, checkpoint).select(F.col("last_extraction_end").cast("string")).first()[0] == "2022-01-03 00:00:00"
    for _ in range(2):
        landing.extract(source, root, checkpoint, utc("2022-01-02 10:00"), settings=settings)
    assert bronze.read_raw(spark, root).count() == 2


def test_features_and_profile_jobs(spark, make_contracts, tmp_path):
    contracts, table = str(tmp_path / "contracts"), str(tmp_path / "features")
    make_contracts({}, {"departamento_entidad": None}, {"valor_contrato": "1"}).write.parquet(contracts)
    row = jobs.features(spark, contracts, table).first()
    assert (row["input_rows"], row["output_rows"], row["null_key_rows"]) == (2, 1, 1)
    assert load_features(spark, table).columns == [*IDENTIFIERS, *NUMERIC, *CATEGORICAL]
    written = {r["table"]: r["n_rows"] for r in jobs.profile(spark, contracts, str(tmp_path / "profile")).collect()}
    assert written["nulls"] == 1 and written["schema"] == 15


def test_checkpoint_is_only_added_to(spark, tmp_path):
    from datetime import datetime, timezone

    from pactlens.sources.windows import read_checkpoint, write_checkpoint

    path = str(tmp_path / "checkpoint")
    for day in (3, 9, 5):
        write_checkpoint(spark, path, datetime(2024, 1, day, tzinfo=timezone.utc))
    (tmp_path / "checkpoint" / "_temporary").mkdir()
    (tmp_path / "checkpoint" / "_temporary" / "part-0.json").write_text('{"last_extr')  # a write that did not end
    ends = read_checkpoint(spark, path)
    assert ends.count() == 3 and ends.agg({"last_extraction_end": "max"}).first()[0].day == 9
