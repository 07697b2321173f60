"""Numbered artefacts of a pipeline's stages: written as JSON tables, and read back in order."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Stages in order
STAGES = ("text", "chunks", "embeddings", "index", "search", "prompt", "answer")


def folder(base: str, stage: str) -> str:
    return f"{base.rstrip('/')}/{STAGES.index(stage) + 1:02d}_{stage}"


def save(df: DataFrame, base: str, stage: str) -> None:
    """Write one stage's rows; a second run replaces them."""
    df.write.mode("overwrite").json(folder(base, stage))


def view(spark: SparkSession, base: str, stage: str) -> DataFrame:
    return spark.read.json(folder(base, stage))


def saved(spark: SparkSession, base: str) -> list[str]:
    """Stages that have an artefact, in order; any store that Spark reads will do."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    paths = {s: jvm.org.apache.hadoop.fs.Path(folder(base, s)) for s in STAGES}
    return [s for s, p in paths.items() if p.getFileSystem(conf).exists(p)]
