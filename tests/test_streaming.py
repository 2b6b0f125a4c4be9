import json

from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from pactlens.operators.dedup import dedup_rows
from pactlens.sources.bronze import read_raw
from pactlens.sources.landing import RAW_SCHEMA
from pactlens.streaming import contracts as streams


def drop_file(folder, name, *records):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("".join(json.dumps(r) + "\n" for r in records))


def contract(number, day, **more):
    return {"numero_del_contrato": number, "fecha_de_firma_del_contrato": f"{day}T00:00:00.000", **more}


def test_landing_is_exactly_once_over_restarts(spark, tmp_path):
    source, root, checkpoint = tmp_path / "in", str(tmp_path / "raw"), str(tmp_path / "c")
    drop_file(source, "a.json", contract("1", "2024-01-01", extra="x"), contract("2", "2024-01-02"))
    for name in (None, "b.json", None):
        if name:
            drop_file(source, name, contract("3", "2024-01-03"))
        pages = streams.read_json_stream(spark, str(source))
        streams.land_stream(pages, root, checkpoint).awaitTermination()
    rows = read_raw(spark, root)
    assert sorted(r["numero_del_contrato"] for r in rows.collect()) == ["1", "2", "3"]
    assert rows.columns == [*RAW_SCHEMA.names, "ingestion_date"] and {t for _, t in rows.dtypes} == {"string"}


def test_dedup_within_the_overlap(spark, tmp_path):
    source, out, checkpoint = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "c")
    drops = [
        [contract("1", "2024-01-10"), contract("2", "2024-01-10"), contract("far", "2999-01-01")],
        [contract("1", "2024-01-10"), contract("3", "2024-01-12"), contract("2", "2024-01-10", valor_contrato="1")],
        [contract("4", "2024-02-01")],
        [contract("late", "2024-01-11"), contract("5", "2024-01-30"), contract("4", "2024-02-01"), contract("bad", "x")],
    ]
    for i, records in enumerate(drops):
        drop_file(source, f"{i}.json", *records)
        pages = streams.read_json_stream(spark, str(source))
        streams.append_stream(streams.dedup_stream(pages, "2024-06-01"), out, checkpoint).awaitTermination()
    got = sorted((r[0], r[1]) for r in spark.read.parquet(out).select("numero_del_contrato", F.coalesce("valor_contrato", F.lit(""))).collect())
    # The far future, the undated and the too late row are left to the batch run.
    assert got == [("1", ""), ("2", ""), ("2", "1"), ("3", ""), ("4", ""), ("5", "")]


def test_every_row_is_kept_repeated_late_or_left(spark, tmp_path):
    source, out, checkpoint = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "c")
    days = [f"2024-01-{d:02d}" for d in range(1, 29)]
    drops = [days[:20], days[14:28], days[2:9] + ["x", "2030-01-01"], days[24:28] + [None]]
    for i, drop in enumerate(drops):
        records = [contract(f"{d}-{n}", d) if d else {"numero_del_contrato": "none"} for d in drop for n in range(3)]
        drop_file(source, f"{i}.json", *records, *records[:3])
        pages = streams.read_json_stream(spark, str(source))
        query = streams.append_stream(streams.dedup_sides(pages, "2024-06-01"), out, checkpoint)
        query.awaitTermination()
    # Days behind the watermark hold no state any more.
    states = [o for p in query.recentProgress for o in p["stateOperators"]]
    assert 0 < states[-1]["numRowsTotal"] <= 6 * streams.BUCKETS * 2
    left = streams.left_to_batch(pages, "2024-06-01")
    streams.append_stream(left, str(tmp_path / "left"), str(tmp_path / "c2")).awaitTermination()
    sides = {r["side"]: r["count"] for r in spark.read.parquet(out).groupBy("side").count().collect()}
    # The first drop repeats three of its own rows; the second and fourth repeat six and four days inside the overlap.
    assert sides["kept"] == 28 * 3 and sides["late"] == 7 * 3 + 3
    repeats = 3 + (6 * 3 + 3) + (4 * 3 + 3)
    n_left = spark.read.parquet(str(tmp_path / "left")).count()
    total = spark.read.json(str(source)).count()
    assert sides["kept"] + sides["late"] + repeats + n_left == total and n_left == 2 * 3 + 3


def sightings(spark, *rows):
    data = [tuple({**dict.fromkeys(RAW_SCHEMA.names), "numero_del_contrato": n, "fecha_de_firma_del_contrato": d}.values()) + (seen,) for n, d, seen in rows]
    schema = StructType([*RAW_SCHEMA.fields, StructField("ingestion_date", StringType())])
    return spark.createDataFrame(data, schema)


def latest(spark, root):
    return sorted((r["numero_del_contrato"], r["ingestion_date"]) for r in streams.read_latest(spark, root).collect())


def test_upsert_keeps_the_latest_sighting(spark, tmp_path):
    root = str(tmp_path / "t")
    batches = [
        sightings(spark, ("1", "2024-01-01", "2024-01-05"), ("1", "2024-01-01", "2024-01-04"), ("2", "2024-02-01", "2024-02-05")),
        sightings(spark, ("1", "2024-01-01", "2024-01-20"), ("3", "bad date", "2024-01-20")),
        sightings(spark, ("1", "2024-01-01", "2024-01-02")),
    ]
    for batch in batches:
        streams.append_sightings(batch, root)
        streams.append_sightings(batch, root)  # a repeated batch changes nothing
    want = [("1", "2024-01-20"), ("2", "2024-02-05"), ("3", "2024-01-20")]
    assert latest(spark, root) == want
    assert streams.compact_latest(spark, root, str(tmp_path / "compact")) == 3
    assert latest(spark, str(tmp_path / "compact")) == want


def test_upsert_streams_lose_nothing_with_new_checkpoints(spark, tmp_path):
    source, root = str(tmp_path / "in"), str(tmp_path / "t")
    for n, seen in enumerate(("2024-01-05", "2024-01-06", "2024-01-04")):
        sightings(spark, ("1", "2024-01-01", seen), (seen, "2024-01-02", seen)).coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(streams.SIGHTING_SCHEMA).parquet(source)
        streams.upsert_stream(stream, root, str(tmp_path / f"c{n}")).awaitTermination()
    other = str(tmp_path / "other")
    sightings(spark, ("9", "2024-01-02", "2024-01-07")).write.parquet(other)
    streams.upsert_stream(spark.readStream.schema(streams.SIGHTING_SCHEMA).parquet(other), root, str(tmp_path / "c9")).awaitTermination()
    assert latest(spark, root) == [("1", "2024-01-06"), ("2024-01-04", "2024-01-04"), ("2024-01-05", "2024-01-05"), ("2024-01-06", "2024-01-06"), ("9", "2024-01-07")]


def test_rows_left_to_the_batch(spark, tmp_path):
    drop_file(tmp_path / "in", "a.json", contract("1", "2024-01-10"), contract("far", "2999-01-01"), contract("bad", "x"))
    pages = streams.read_json_stream(spark, str(tmp_path / "in"))
    streams.append_stream(streams.left_to_batch(pages, "2024-06-01"), str(tmp_path / "left"), str(tmp_path / "c")).awaitTermination()
    got = sorted((r["numero_del_contrato"], r["reason"]) for r in spark.read.parquet(str(tmp_path / "left")).collect())
    assert got == [("bad", "undated"), ("far", "after_bound")]
