"""Session settings and the shared folder for intermediate tables."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Give the Python workers this package, as ``--py-files`` would; once per application."""
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    package = Path(__file__).resolve().parent
    archive = Path(tempfile.mkdtemp(prefix="pactlens-package-")) / "pactlens.zip"
    with zipfile.ZipFile(archive, "w") as bundle:
        for source in sorted(package.rglob("*.py")):
            bundle.write(source, source.relative_to(package.parent))
    sc.addPyFile(str(archive))
    _shipped.add(sc.applicationId)


def build_session(app: str = "pactlens", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SESSION_CONF, **conf}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    ship_package(spark)
    return spark


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local session may fall back to a folder of its own; a cluster must name one.
    """
    sc = spark.sparkContext
    folder = sc.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    folder = folder or sc.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    folder = tempfile.mkdtemp(prefix="pactlens-")
    sc.setCheckpointDir(folder)
    return sc.getCheckpointDir()


def new_path(spark: SparkSession, label: str) -> str:
    app = spark.sparkContext.applicationId
    return f"{shared_folder(spark)}/pactlens/{app}/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write an intermediate table once and go on from its files.

    Later plans read the files, so a lost executor costs a re-read instead of the whole lineage, and Catalyst
    plans joins from the measured size.
    """
    path = new_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Rows up to which a table is dealt anew for costly work; more have enough splits, and are not moved.
SPREAD_ROWS = 2_000_000


def spread(df: DataFrame) -> DataFrame:
    """Use every core for costly per-row work on a small table; a large one has enough splits already."""
    if df.isStreaming or df.limit(SPREAD_ROWS + 1).count() > SPREAD_ROWS:
        return df
    return df.repartition(df.sparkSession.sparkContext.defaultParallelism)


#: Tasks a core for costly work, so that the last ones leave few cores idle, and rows for one at least and at most.
TASKS_PER_CORE, LEAST_ROWS, MOST_ROWS = 4, 40_000, 500_000


def deal(df: DataFrame, rows: int) -> DataFrame:
    """The ``rows`` of a table for work of which a row costs far more than to move it, in tasks of the same size, some for each
    core.  Splits of files are about as many as cores: one more than these takes twice the time."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    each = min(TASKS_PER_CORE, max(1, rows // (cores * LEAST_ROWS)))
    return df.repartition(max(cores * each, -(-rows // MOST_ROWS)))


#: Bytes of rows that one Arrow batch brings to Python, about.
BATCH_BYTES = 4 << 20


def bound_batches(spark: SparkSession) -> None:
    """Bound Arrow batches by bytes as well as by rows: of long texts the usual 10,000 rows are tens of MB, held in several
    copies by every worker, which an executor then keeps.  A bound that the session has of its own stays."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(key, None) is None:
        spark.conf.set(key, str(BATCH_BYTES))


def one_task_per_group(df: DataFrame, groups: int, *keys: str) -> DataFrame:
    """Partition by key for costly work on few, small groups.

    A fixed number of partitions is kept as it is; adaptive execution would merge them by their few bytes.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(max(1, min(groups, 2 * cores)), *keys)
