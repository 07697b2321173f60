"""Retrieval around a reranker: over-fetching, falling back, and the fields of what is returned."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corvidex.operators.bm25 import ranked


def over_fetch(k: int, factor: int = 3, most: int = 100) -> int:
    """How many rows to search for where ``k`` are wanted after reranking."""
    return min(k * factor, most)


def retrieve(search: Callable[[int], DataFrame], score: Column | None, k: int = 5, first: int = 30, threshold: float = 0.0) -> DataFrame:
    """``first`` rows a query by ``search(first)``, those of at least ``threshold`` after that, reranked to ``k``.

    Only lists longer than ``k`` are reranked; the others keep their order and scores.  A null ``score`` of a pair (a scorer
    that failed) falls back to the search's own, and without any scorer the search asks for ``k`` rows at once.
    """
    if score is None:
        found = search(k)
        return ranked(found.where(F.col("score") >= threshold) if threshold > 0 else found, k)
    found = search(first)
    found = found.where(F.col("score") >= threshold) if threshold > 0 else found
    n = F.count(F.lit(1)).over(Window.partitionBy("query_id"))
    scored = found.withColumn("original_score", F.col("score")).withColumn("score", F.when(n > k, F.coalesce(score, F.col("score"))).otherwise(F.col("score")))
    return ranked(scored.drop("rank"), k)


def with_reranking(search: Callable[[int], DataFrame], score: Column, k: int = 5, factor: int = 3, fallback: bool = True) -> DataFrame:
    """An over-fetched search reranked to ``k``; where any pair of a query has no new score, the whole list falls back to the
    search's order, or, without ``fallback``, the query fails."""
    found = search(over_fetch(k, factor)).withColumn("rerank_score", score)
    failed = F.max(F.col("rerank_score").isNull()).over(Window.partitionBy("query_id"))
    if fallback:
        new = F.when(failed, F.col("score")).otherwise(F.col("rerank_score"))
    else:
        new = F.coalesce(F.col("rerank_score"), F.raise_error(F.lit("the pair scorer failed")).cast("double"))
    return ranked(found.withColumn("original_score", F.col("score")).withColumn("score", new).drop("rank"), k)


def merge_metadata(found: DataFrame, more: DataFrame, on: list[str]) -> DataFrame:
    """Columns of ``more`` replace those of the same name; the old ``score`` stays as ``original_score``, unless there is one."""
    if "original_score" not in found.columns and "original_score" not in more.columns and "score" in found.columns:
        found = found.withColumn("original_score", F.col("score"))
    new = [c for c in more.columns if c not in on]
    return found.drop(*new).join(more, on, "left")


def formatted(found: DataFrame, fields: tuple[str, ...] = ("content", "score", "rerank_score", "metadata")) -> DataFrame:
    """Rank and those of the fields that there are."""
    return found.select("query_id", "rank", *[f for f in fields if f in found.columns])
