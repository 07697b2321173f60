"""Deterministic sampling: where a draw is wanted, rows are ordered by the md5 of their id and a seed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def draw(id_col: str = "doc_id", seed: int = 0) -> Column:
    return F.md5(F.concat_ws("|", F.col(id_col).cast("string"), F.lit(str(seed))).cast("binary"))


def length_bucket(text: Column) -> Column:
    return F.when(F.length(text) < 500, "short").when(F.length(text) < 1500, "medium").otherwise("long")


def first_of_prefix(df: DataFrame, text: str = "text", length: int = 100, order: str = "doc_id") -> DataFrame:
    """One row for each stripped prefix; blank prefixes count only on texts that hold something."""
    prefix = F.trim(F.substring(text, 1, length))
    rows = df.where((prefix != "") | (F.trim(F.col(text)) != "")).withColumn("__p", prefix)
    return rows.withColumn("__n", F.row_number().over(Window.partitionBy("__p").orderBy(order))).where("__n = 1").drop("__p", "__n")


def round_robin(df: DataFrame, n: int, group: str = "source", order: str = "doc_id") -> DataFrame:
    """One row of each group a round until ``n``; groups take turns in order of their first row."""
    w = Window.partitionBy(group)
    rows = df.withColumn("round", F.row_number().over(w.orderBy(order))).where(F.col("round") <= n)
    rows = rows.withColumn("first_pos", F.min(order).over(w))
    return rows.orderBy("round", "first_pos").limit(n)


def by_type(df: DataFrame, quota: int, kind: str = "type", order: str = "doc_id") -> DataFrame:
    """The first ``quota`` rows of each type."""
    return df.withColumn("n", F.row_number().over(Window.partitionBy(kind).orderBy(order))).where(F.col("n") <= quota)


def batch(df: DataFrame, i: int, batches: int, n: int, order: str = "pos") -> DataFrame:
    """Contiguous batch ``i`` of ``batches``; the last takes the remainder."""
    high = n if i == batches - 1 else (i + 1) * (n // batches)
    return df.where((F.col(order) >= i * (n // batches)) & (F.col(order) < high))


def batch_of(pos: Column, batches: int, n: int) -> Column:
    """The contiguous batch that a position is in, as ``batch`` cuts them."""
    return F.least(F.floor(pos / F.lit(max(1, n // batches))), F.lit(batches - 1)).cast("int") if n >= batches else F.lit(batches - 1)


def assign_types(df: DataFrame, types: list[str], quota: int, order: str = "doc_id") -> DataFrame:
    """Rows take types in turn; each type keeps ``quota`` rows."""
    rows = df.orderBy(order).limit(len(types) * quota)
    rows = rows.withColumn("rn", F.row_number().over(Window.orderBy(order)) - 1)  # bounded by types x quota rows
    return rows.withColumn("type", F.element_at(F.array(*[F.lit(t) for t in types]), (F.pmod("rn", F.lit(len(types))) + 1).cast("int")))


def thirds(df: DataFrame, n: int, group: str = "source", order: str = "doc_id", seed: int = 0) -> DataFrame:
    """``n // 3`` rows from the first, middle and last third of each group."""
    w = Window.partitionBy(group)
    rows = df.withColumn("i", F.row_number().over(w.orderBy(order)) - 1).withColumn("m", F.floor(F.count(F.lit(1)).over(w) / 3))
    rows = rows.withColumn("third", F.when(F.col("i") < F.col("m"), 0).when(F.col("i") < 2 * F.col("m"), 1).otherwise(2))
    pick = F.row_number().over(Window.partitionBy(group, "third").orderBy(draw(order, seed)))
    return rows.withColumn("k", pick).where(F.col("k") <= max(1, n // 3)).drop("i", "m", "k")


def diverse(df: DataFrame, n: int, per_group: int = 2, group: str = "source", order: str = "doc_id", text: str = "text", seed: int = 0) -> DataFrame:
    """A minimum of each group first, then length buckets in turn, prefixes distinct, ``n`` rows in all."""
    rows = first_of_prefix(df, text, order=order).withColumn("__d", draw(order, seed)).withColumn("bucket", length_bucket(F.col(text)))
    rows = rows.withColumn("__g", F.row_number().over(Window.partitionBy(group).orderBy("__d")))
    rows = rows.withColumn("__b", F.row_number().over(Window.partitionBy("bucket").orderBy("__d")))
    return rows.orderBy(F.col("__g") > per_group, "__b", "__d").limit(n).drop("__d", "__g", "__b")
