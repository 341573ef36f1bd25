"""Session defaults and the shared staging folder."""

from __future__ import annotations

import contextlib
import contextvars
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = 8, app: str = "mailtriage", **conf) -> SparkSession:
    """Session for tests and the benchmark.  A cluster brings its own settings."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]").appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.files.maxPartitionBytes", "4m")  # the test tables are small
        .config("spark.driver.memory", "12g")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def staging_dir(spark: SparkSession) -> str:
    """Folder for staged tables: ``spark.checkpoint.dir``.

    Only a local session without that setting gets a folder of its own, because a
    machine-local path is not shared between executors; a cluster session must set it.
    """
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if found is None:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        found = tempfile.mkdtemp(prefix="mailtriage-")
        spark.sparkContext.setCheckpointDir(found)
    return found


_scope: contextvars.ContextVar[str] = contextvars.ContextVar("scope", default="")


@contextlib.contextmanager
def staging_scope(spark: SparkSession, name: str) -> Iterator[None]:
    """Tables staged inside the block share a folder, which is deleted at its end: for jobs
    that repeat, such as micro-batches.  Results must be written inside the block."""
    folder = f"{name}-{uuid.uuid4().hex}"
    token = _scope.set(f"{folder}/")
    try:
        yield
    finally:
        _scope.reset(token)
        path = spark._jvm.org.apache.hadoop.fs.Path(f"{staging_dir(spark).rstrip('/')}/{folder}")
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


BATCH_CONF = "spark.sql.execution.arrow.maxBytesPerBatch"
BATCH_BYTES = "8m"
ROW_GROUP_BYTES = 16 << 20  # readers and writers of a staged table hold whole row groups


@contextlib.contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """Inside the block, Python functions of planned queries get their rows in batches of a few megabytes: the buffers of a
    batch are held several times over, by the executor and by its workers, in every task."""
    before = spark.conf.get(BATCH_CONF, None)
    spark.conf.set(BATCH_CONF, BATCH_BYTES)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(BATCH_CONF)
        else:
            spark.conf.set(BATCH_CONF, before)


def staged_table(df: DataFrame, name: str, row_group: int = ROW_GROUP_BYTES) -> DataFrame:
    """Write a frame to the staging folder and read it back.

    Cuts lineage so that lost executors do not redo what came before, computes the frame
    once for all its readers, and gives the planner real file sizes, by which it decides
    whether a side is small enough to broadcast.
    """
    spark = df.sparkSession
    path = f"{staging_dir(spark).rstrip('/')}/{_scope.get()}{name}-{uuid.uuid4().hex}"
    with small_batches(spark):
        df.write.option("parquet.block.size", row_group).parquet(path)
    return spark.read.schema(df.schema).parquet(path)
