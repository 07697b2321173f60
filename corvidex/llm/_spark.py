"""Session helpers shared by the operators: scratch tables in the shared folder, bounded samples."""

from __future__ import annotations

import ctypes
import tempfile
import uuid

import pyarrow as pa
from py4j.protocol import Py4JError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_own_base: str | None = None


def scratch_base(spark: SparkSession) -> str:
    """The folder all executors share (``spark.checkpoint.dir``); a session on one machine may do without and gets a temporary one."""
    global _own_base
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base:
        return base.rstrip("/")
    if spark.sparkContext.master != "local" and not spark.sparkContext.master.startswith("local["):
        raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    if _own_base is None:
        _own_base = tempfile.mkdtemp(prefix="corvidex-")
    return _own_base


#: Texts of a batch are held at once by the JVM and by a Python worker.
ARROW_ROWS, BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch", 2000
#: Bytes of a row group of stored tables: a task that writes texts holds one.
ROW_GROUP = 32 << 20


def stored(df: DataFrame, tag: str) -> DataFrame:
    """Write ``df`` as a Parquet table in the shared folder and read it back.

    This cuts the lineage without tying data to one executor, and lets several
    consumers share one computation.  The JVM deletes the table when it ends.  Python workers get at most ``BATCH_ROWS``
    rows at a time meanwhile.  The driver's JVM then gives back what planning and running it has freed outside the heap.
    """
    spark = df.sparkSession
    path = f"{scratch_base(spark)}/{tag}-{uuid.uuid4().hex}"
    held = spark.conf.get(ARROW_ROWS)
    spark.conf.set(ARROW_ROWS, min(int(held), BATCH_ROWS) if int(held) > 0 else BATCH_ROWS)
    try:
        df.write.option("parquet.block.size", ROW_GROUP).parquet(path)
    finally:
        spark.conf.set(ARROW_ROWS, held)
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(target)
    give_back_driver_memory(spark)
    return spark.read.schema(df.schema).parquet(path)


#: A key is hot if it has more than 1 / HOT_SHARE of the rows, so there are never more than HOT_SHARE of them; SPREAD tasks share it.
HOT_SHARE, SPREAD = 1000, 32
#: One task may well take this many rows of a join, so smaller tables are joined plainly.
ONE_TASK = 2_000_000


def spread_join(many: DataFrame, one: DataFrame, key: str, count: str, rows: int, how: str = "inner") -> DataFrame:
    """``many`` of ``rows`` rows joined with ``one`` on ``key``, where ``one`` has each key once and says in ``count`` how many rows of ``many`` have it.

    The rows of a hot key are dealt over ``SPREAD`` tasks by a hash of the row, and its row of ``one`` is repeated for each
    of them.  Only the hot keys are broadcast, at most ``HOT_SHARE``.
    """
    if rows <= ONE_TASK:
        return many.join(one.drop(count), key, how)
    total = F.broadcast(one.agg(F.sum(count).alias("__total")))
    hot = one.crossJoin(total).where(F.col(count) * HOT_SHARE > F.col("__total")).select(key, F.lit(True).alias("__hot"))
    left = many.join(F.broadcast(hot), key, "left").withColumn("__salt", F.when(F.col("__hot"), F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in many.columns]), F.lit(SPREAD))).otherwise(0)).drop("__hot")
    salts = F.when(F.col("__hot"), F.sequence(F.lit(0), F.lit(SPREAD - 1))).otherwise(F.array(F.lit(0)))
    right = one.join(F.broadcast(hot), key, "left").withColumn("__salt", F.explode(salts)).drop("__hot", count)
    return left.join(right, [key, "__salt"], how).drop("__salt")


def fold_of(key: Column) -> Column:
    """crc32 of the key as text, modulo 5; null keys count as the empty string."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % 5


def ascii_words(text: Column) -> Column:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a text as an array; null gives an empty array."""
    parts = F.split(F.coalesce(text, F.lit("")), "[\\x20\\x09-\\x0D]+")
    return F.filter(parts, lambda w: w != "")


def let(value: Column, body) -> Column:
    """Bind ``value`` once and evaluate ``body`` on it, so that lambdas inside do not recompute it."""
    return F.transform(F.array(value), body)[0]


def give_back_memory() -> None:
    """Return freed memory to the system: Arrow's, and the C library's where it can."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def give_back_driver_memory(spark: SparkSession) -> bool:
    """Whether the driver's JVM could return freed native memory to the system: Java 17.0.9 on Linux, or later.

    Compilers and the threads that wait for shuffles and broadcasts leave it in the C library's arenas, which keep it otherwise.
    """
    jvm, array = spark.sparkContext._jvm, spark.sparkContext._gateway.new_array
    named = jvm.java.lang.Class.forName
    kinds, args = array(jvm.java.lang.Class, 4), array(jvm.java.lang.Object, 4)
    for i, kind in enumerate(("javax.management.ObjectName", "java.lang.String", "[Ljava.lang.Object;", "[Ljava.lang.String;")):
        kinds[i] = named(kind)
    args[0], args[1] = jvm.javax.management.ObjectName("com.sun.management:type=DiagnosticCommand"), "systemTrimNativeHeap"
    try:
        # by its interface, as the server's own class is not open to callers
        named("javax.management.MBeanServer").getMethod("invoke", kinds).invoke(jvm.java.lang.management.ManagementFactory.getPlatformMBeanServer(), args)
    except Py4JError:
        return False
    return True
