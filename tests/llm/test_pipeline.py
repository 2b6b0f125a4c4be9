import corpus_pipeline
import pandas as pd
import pytest

from pactlens.llm.queries import ORACLE, QUERIES
from pactlens.session import BATCH_BYTES, bound_batches

from .conftest import ODD


def test_every_operator_is_registered():
    assert [n.split("_")[0] for n in QUERIES] == [f"op{i}" for i in range(1, 14)]
    assert set(ORACLE) <= set(QUERIES)


def test_stages_on_odd_rows(spark, documents, tmp_path):
    rng_words = [f"word{i}" for i in range(400)]
    clean = [(100 + i, " ".join(rng_words[(i * 7 + j * j) % 400] for j in range(120)) + ".", f"s{i % 4}") for i in range(30)]
    rows = ODD + clean + [(900, clean[0][1], "s1"), (901, clean[1][1].replace("word7 ", "changed "), "s2")]
    documents(rows, clash=False).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    columns, seen = docs.columns, []
    for n, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, str(tmp_path)).write.parquet(str(tmp_path / f"out{n}"))
        docs = spark.read.parquet(str(tmp_path / f"out{n}"))
        seen.append(docs.count())
        if n < len(corpus_pipeline.STAGES) - 1:
            assert docs.columns == columns
    assert seen[0] == len(rows)  # no labels: nothing is rejected
    assert seen[1] == seen[0]
    deduped = {r["doc_id"] for r in spark.read.parquet(str(tmp_path / "out2")).collect()}
    assert {100 + i for i in range(30)} <= deduped and not {900, 901} & deduped
    assert seen[4] == seen[3]
    mixed = spark.read.parquet(str(tmp_path / "out3")).collect()
    assert {r["doc_id"] for r in mixed} <= deduped


def test_long_texts_come_in_batches_of_bounded_bytes(spark, documents, tmp_path):
    docs = documents([(i, str(i % 10) * 200_000, "s") for i in range(100)], clash=False).repartition(1)
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    key = "spark.sql.execution.arrow.maxBytesPerBatch"

    def sizes(batches):
        for batch in batches:
            yield pd.DataFrame({"n": [int(batch["text"].str.len().sum())]})

    try:
        for _, stage in corpus_pipeline.STAGES:
            spark.conf.unset(key)
            stage(spark, docs, str(tmp_path))
            found = [r["n"] for r in docs.select("text").mapInPandas(sizes, "n long").collect()]
            assert sum(found) == 20_000_000 and max(found) <= BATCH_BYTES + 200_000
        spark.conf.set(key, "1000000")
        bound_batches(spark)
        assert spark.conf.get(key).startswith("1000000")
    finally:
        spark.conf.unset(key)


def test_run_of_no_documents(spark, documents, tmp_path):
    documents([], clash=False).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


@pytest.mark.parametrize("name", list(QUERIES))
def test_code_reads_no_ids_or_limits_of_its_own(name):
    assert QUERIES[name].__module__.startswith("pactlens.llm.")
