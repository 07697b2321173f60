"""Score normalisers and fusion of ranked lists ``(query_id, doc_id, score, rank)``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corvidex.operators.bm25 import ranked


def each():
    """Rows of one query."""
    return Window.partitionBy("query_id")


def min_max(s: Column, w=None) -> Column:
    """0 to 1 within a list; 0.5 where all are equal."""
    w = w or each()
    low, high = F.min(s).over(w), F.max(s).over(w)
    return F.when(high == low, 0.5).otherwise((s - low) / (high - low))


def by_rank(s: Column, w=None, tie: str = "doc_id") -> Column:
    return 1.0 / F.row_number().over((w or each()).orderBy(s.desc(), F.col(tie)))


def soft_max(s: Column, w=None, temperature: float = 1.0) -> Column:
    w = w or each()
    e = F.exp((s - F.max(s).over(w)) / temperature)
    return e / F.sum(e).over(w)


def z_sigmoid(s: Column, w=None) -> Column:
    """Sigmoid of the z-score; 0.5 where there is no spread."""
    w = w or each()
    dev = F.stddev_pop(s).over(w)
    return F.when(dev == 0, 0.5).otherwise(1 / (1 + F.exp(-(s - F.avg(s).over(w)) / dev)))


def sigmoid(s: Column, w=None) -> Column:
    return 1 / (1 + F.exp(-s))


NORMALISERS = {"minmax": min_max, "rank": by_rank, "softmax": soft_max, "zscore": z_sigmoid, "sigmoid": sigmoid}


def normalised(found: DataFrame, how: str = "minmax") -> DataFrame:
    return found.withColumn("score", NORMALISERS[how](F.col("score")))


def hybrid(sparse: DataFrame, dense: DataFrame, k: int = 5, weights: tuple[float, float] = (0.5, 0.5), how: str = "minmax") -> DataFrame:
    """Full outer join of two normalised lists; a missing side counts 0; weights are brought to sum 1."""
    a, b = (w / sum(weights) for w in weights)
    s = normalised(sparse, how).select("query_id", "doc_id", F.col("score").alias("bm25_score"))
    d = normalised(dense, how).select("query_id", "doc_id", F.col("score").alias("vector_score"))
    both = s.join(d, ["query_id", "doc_id"], "full_outer")
    methods = F.array_compact(F.array(F.when(F.col("bm25_score").isNotNull(), "bm25"), F.when(F.col("vector_score").isNotNull(), "vector")))
    zero = lambda c: F.round(F.coalesce(F.col(c), F.lit(0.0)), 6)
    total = F.round(a * F.coalesce("bm25_score", F.lit(0.0)) + b * F.coalesce("vector_score", F.lit(0.0)), 6)
    return ranked(both.select("query_id", "doc_id", total.alias("score"), zero("bm25_score").alias("bm25_score"), zero("vector_score").alias("vector_score"), methods.alias("methods")), k)


def additive(sparse: DataFrame, dense: DataFrame, k: int = 5, dense_weight: float = 0.7, scale: float = 10.0) -> DataFrame:
    """``0.7 dense + 0.3 min(bm25 / 10, 1)`` over the union of both lists."""
    parts = dense.select("query_id", "doc_id", (dense_weight * F.col("score")).alias("s")).unionByName(sparse.select("query_id", "doc_id", ((1 - dense_weight) * F.least(F.col("score") / scale, F.lit(1.0))).alias("s")))
    return ranked(parts.groupBy("query_id", "doc_id").agg(F.round(F.sum("s"), 6).alias("score")), k)


def reciprocal_rank(lists: list[DataFrame], k: int = 5, constant: int = 60, weights: list[float] | None = None) -> DataFrame:
    """Sum of ``weight / (constant + rank)`` with ranks from 1."""
    weights = weights or [1.0] * len(lists)
    parts = [f.select("query_id", "doc_id", (F.lit(w) / (constant + F.col("rank"))).alias("s")) for f, w in zip(lists, weights, strict=True)]
    both = parts[0]
    for p in parts[1:]:
        both = both.unionByName(p)
    return ranked(both.groupBy("query_id", "doc_id").agg(F.round(F.sum("s"), 6).alias("score")), k)


def rank_cosine(found: DataFrame, cosine: Column, k: int = 5) -> DataFrame:
    """``0.3 / rank + 0.7 cosine``, to eight places: of a cosine of six, no sum stands on the half between two of them."""
    return ranked(found.withColumn("score", F.round(0.3 / F.col("rank") + 0.7 * cosine, 8)).drop("rank"), k)


def combined(sparse: DataFrame, dense: DataFrame) -> DataFrame:
    """Both lists one after the other, duplicates kept: (query_id, pos, source, doc_id, score)."""
    both = sparse.select("query_id", "doc_id", "score", F.lit("bm25").alias("source"), "rank").unionByName(dense.select("query_id", "doc_id", "score", F.lit("vector").alias("source"), "rank"))
    pos = F.row_number().over(each().orderBy("source", "rank"))
    return both.select("query_id", pos.cast("long").alias("pos"), "source", "doc_id", "score")


def distinct_content(found: DataFrame, text: str = "text", length: int = 500) -> DataFrame:
    """The first row of each query for each text prefix."""
    w = Window.partitionBy("query_id", F.substring(text, 1, length)).orderBy("pos")
    return found.withColumn("__n", F.row_number().over(w)).where("__n = 1").drop("__n")


def explain(sparse: DataFrame, dense: DataFrame, fused: DataFrame, docs: DataFrame, preview: int = 100) -> DataFrame:
    """The three lists of a query with text previews."""
    rows = None
    for name, f in (("bm25", sparse), ("vector", dense), ("hybrid", fused)):
        part = f.select("query_id", F.lit(name).alias("list"), "rank", "doc_id", "score")
        rows = part if rows is None else rows.unionByName(part)
    return rows.join(docs.select("doc_id", F.substring("text", 1, preview).alias("preview")), "doc_id", "left")


def agreement(a: DataFrame, b: DataFrame) -> DataFrame:
    """Share of equal answers of two methods, overall and by question type: ``(question_id, type, answer)``."""
    same = a.alias("a").join(b.alias("b"), "question_id").select(F.col("a.type").alias("type"), (F.col("a.answer") == F.col("b.answer")).cast("double").alias("same"))
    return same.rollup("type").agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("same"), 6).alias("rate"))
