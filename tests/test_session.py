import pytest
from pyspark.sql import functions as F

from pactlens import session


class FakeConf(dict):
    def get(self, key, default=None):
        return super().get(key, default)


class FakeSpark:
    """A session of a cluster, as far as the shared folder is concerned."""

    def __init__(self, master, conf):
        self.conf = FakeConf()
        self.sparkContext = self
        self.master = master
        self.settings = FakeConf(conf)

    def getConf(self):
        return self.settings

    def getCheckpointDir(self):
        return None


def test_the_named_folder_is_used():
    spark = FakeSpark("spark://host:7077", {"spark.checkpoint.dir": "hdfs://shared/checkpoints/"})
    assert session.shared_folder(spark) == "hdfs://shared/checkpoints"


def test_a_cluster_must_name_a_folder():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.shared_folder(FakeSpark("yarn", {}))


def test_written_tables_survive_their_plan(spark):
    table = session.materialize(spark.range(10).selectExpr("id", "id % 3 AS k"), "test")
    assert table.count() == 10
    assert session.shared_folder(spark).removeprefix("file:") + "/pactlens/" in table.inputFiles()[0]


def test_small_tables_use_every_core(spark):
    table = session.materialize(spark.range(10).coalesce(1), "test")
    assert session.spread(table).rdd.getNumPartitions() == spark.sparkContext.defaultParallelism


def test_rows_are_dealt_in_tasks_of_one_size(spark, monkeypatch):
    monkeypatch.setattr(session, "LEAST_ROWS", 100)
    cores = spark.sparkContext.defaultParallelism
    # One split more than cores would take twice the time.
    rows = 1_000 * (cores + 1)
    dealt = session.deal(spark.range(0, rows, 1, cores + 1), rows)
    sizes = [r["n"] for r in dealt.groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n")).collect()]
    assert len(sizes) == cores * session.TASKS_PER_CORE and sum(sizes) == rows
    assert max(sizes) - min(sizes) <= cores + 1
    assert session.deal(spark.range(10), 10).rdd.getNumPartitions() == cores
    monkeypatch.setattr(session, "MOST_ROWS", 50)
    assert session.deal(spark.range(cores * 1_000), cores * 1_000).rdd.getNumPartitions() == cores * 20
