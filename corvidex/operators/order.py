"""Running sums and places over a whole table, without one ordered task."""

from __future__ import annotations

import math

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Ranges that the order is cut into; a value that fills whole ranges is spread over ``SPREAD`` blocks.
RANGES, SPREAD = 256, 64


def running_sum(rows: DataFrame, order: str, amount: Column, out: str) -> DataFrame:
    """``rows`` with the sum of ``amount`` over the rows up to and with each one, in ascending order of a numeric column; NaN, then nulls come last.

    Equal values go by a hash of the row's columns of simple types.  Ranges are cut at quantiles, so an outlying value makes none of them large, and rows of a value
    that is common enough to be a cut itself are spread by their hash.  The driver sees the ``RANGES`` cuts alone; the sums of the blocks, as
    many as there are ranges and spread parts, are broadcast.
    """
    value = F.col(order).cast("double")
    cuts = rows.agg(F.percentile_approx(value, [i / RANGES for i in range(RANGES)], 10_000)).first()[0] or []
    cuts = sorted({c for c in cuts if math.isfinite(c)})
    simple = [f.name for f in rows.schema if f.dataType.typeName() not in ("map", "array", "struct", "variant")]
    held = rows.withColumn("__h", F.xxhash64(*[F.col(f"`{c}`") for c in simple])).withColumn("__v", value)
    held = Bucketizer(splits=[-math.inf, *cuts, math.inf], inputCol="__v", outputCol="__r", handleInvalid="keep").transform(held) if cuts else held.withColumn("__r", F.lit(0.0))
    held = held.withColumn("__r", F.when(F.col("__v").isNull(), float(RANGES + 9)).when(F.isnan("__v"), float(RANGES + 8)).otherwise(F.col("__r")))
    at_cut = (F.col("__r") >= RANGES + 8) | (F.array_contains(F.array(*[F.lit(c) for c in cuts]), F.col("__v")) if cuts else F.lit(False))
    # a value at a cut is the smallest of its range
    held = held.withColumn("__s", F.when(at_cut, F.shiftright("__h", 58) + SPREAD // 2).otherwise(SPREAD)).drop("__v")
    ties = [F.col(order).asc_nulls_last(), F.col("__h")]
    if dict(rows.dtypes)[order] in ("bigint", "decimal(38,0)"):  # integers beyond 2 ** 53 share a double with their neighbours
        held = held.withColumn("__s", F.when(F.abs(F.col(order)) >= 1 << 53, SPREAD).otherwise(F.col("__s")))
    block = ["__r", "__s"]
    sums = held.groupBy(*block).agg(F.sum(amount).alias("__n"))
    before = sums.withColumn("__base", F.sum("__n").over(Window.orderBy(*block).rowsBetween(Window.unboundedPreceding, -1))).drop("__n")  # one row a block
    inside = F.sum(amount).over(Window.partitionBy(*block).orderBy(*ties).rowsBetween(Window.unboundedPreceding, 0))
    return held.withColumn("__i", inside).join(F.broadcast(before), block).withColumn(out, F.coalesce("__base", F.lit(0)) + F.col("__i")).drop(*block, "__h", "__i", "__base")


def places(rows: DataFrame, order: str) -> DataFrame:
    """``rows`` with ``place`` from 1 in the order of a numeric column, nulls last: every row has one, no two the same."""
    return running_sum(rows, order, F.lit(1).cast("long"), "place")
