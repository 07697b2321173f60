"""Tables kept in the folder that the driver and all executors share: written once a session, read by many queries."""

from __future__ import annotations

import hashlib
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

ARROW_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"
#: Bytes of a batch that a Python worker gets while a table is built; a longer row is a batch of its own.
BATCH_BYTES = 2 << 20
_own: list[str] = []
_held: dict[tuple[str, str], str] = {}


def shared_folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``; a session on one machine may do without and gets a temporary folder."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base:
        return base.rstrip("/")
    if spark.sparkContext.master != "local" and not spark.sparkContext.master.startswith("local["):
        raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    if not _own:
        _own.append(tempfile.mkdtemp(prefix="corvidex-"))
    return _own[0]


def state_of(df: DataFrame) -> str:
    """A digest of the files a table is read from: their paths, sizes and times of change."""
    spark = df.sparkSession
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    seen = hashlib.sha256()
    for name in sorted(df.inputFiles()):
        path = jvm.org.apache.hadoop.fs.Path(name)
        status = path.getFileSystem(conf).getFileStatus(path)
        seen.update(f"{name}|{status.getLen()}|{status.getModificationTime()}\n".encode())
    return seen.hexdigest()[:24]


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """Bounds batches by their bytes, so that a worker holds the results of few texts at a time; a bound that is set already stands."""
    unset = spark.conf.get(ARROW_BYTES, None) is None
    if unset:
        spark.conf.set(ARROW_BYTES, BATCH_BYTES)
    try:
        yield
    finally:
        if unset:
            spark.conf.unset(ARROW_BYTES)


def kept(source: DataFrame, tag: str, build: Callable[[], DataFrame]) -> DataFrame:
    """The table that ``build`` makes from ``source``: built once for a state of its files, then read from the shared folder.

    The JVM deletes the table when it ends.
    """
    spark = source.sparkSession
    key = (spark.sparkContext.applicationId, f"{tag}-{state_of(source)}")
    if key not in _held:
        path = f"{shared_folder(spark)}/{key[0]}-{key[1]}"
        with small_batches(spark):
            build().write.mode("overwrite").parquet(path)
        jvm = spark.sparkContext._jvm
        target = jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(target)
        _held[key] = path
    return spark.read.parquet(_held[key])


def written(df: DataFrame, tag: str) -> DataFrame:
    """``df`` written to the shared folder and read back, which cuts its lineage; the JVM deletes the table when it ends."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{tag}-{uuid.uuid4().hex}"
    with small_batches(spark):
        df.write.parquet(path)
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(target)
    return spark.read.schema(df.schema).parquet(path)
