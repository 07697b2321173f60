"""Reranking, memo tables and near-duplicate filters of result lists."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corvidex.functions.text import one_space
from corvidex.functions.tokenize import simple
from corvidex.operators.bm25 import ranked
from corvidex.operators.fusion import min_max


def jaccard(a: Column, b: Column) -> Column:
    """Of two token arrays; 0 for two empty ones."""
    both = F.size(F.array_union(a, b))
    return F.when(both == 0, 0.0).otherwise(F.size(F.array_intersect(a, b)) / both)


def overlap_score(query: Column, doc: Column) -> Column:
    """Share of a query's distinct tokens that a text holds: the offline pair scorer."""
    q = F.array_distinct(simple(query))
    return F.when(F.size(q) == 0, 0.0).otherwise(F.size(F.array_intersect(q, simple(doc))) / F.size(q))


def rerank(found: DataFrame, score: Column, k: int = 5, alpha: float = 0.7, threshold: float | None = None) -> DataFrame:
    """Blend ``alpha`` of the new score with the old one, each brought to 0..1 within its list; best ``k``.

    The old score takes part only where it is positive somewhere in the list; lists no longer than ``k`` keep their order.
    """
    w = Window.partitionBy("query_id")
    kept = found if threshold is None else found.where(F.col("score") >= threshold)
    scored = kept.withColumn("rerank_score", score).withColumn("original_score", F.col("score"))
    blend = F.when(F.max("original_score").over(w) > 0, alpha * min_max(F.col("rerank_score"), w) + (1 - alpha) * min_max(F.col("original_score"), w)).otherwise(F.col("rerank_score"))
    return ranked(scored.withColumn("score", F.round(blend, 6)).drop("rank"), k)


def cache_key(query: Column, doc: Column) -> Column:
    """md5 of the normal forms of a query and of the first 1000 characters of a text."""
    normal = lambda c: F.regexp_replace(F.lower(one_space(c)), "[.,!?;:]+$", "")
    return F.md5(F.concat(normal(query), F.lit("||"), normal(F.substring(doc, 1, 1000))).cast("binary"))


def cache_split(pairs: DataFrame, memo: DataFrame, now: Column, ttl: float = 3600.0) -> tuple[DataFrame, DataFrame]:
    """(hits with their score, misses) of ``pairs(key, ..)`` against ``memo(key, score, ts)``; old entries miss."""
    fresh = memo.where(now - F.col("ts") <= ttl).select("key", "score")
    return pairs.join(fresh, "key"), pairs.join(fresh, "key", "left_anti")


def cache_evict(memo: DataFrame, now: Column, most: int = 10_000, ttl: float = 3600.0) -> DataFrame:
    """Entries within their time, the ``most`` last used of them."""
    return memo.where(now - F.col("ts") <= ttl).orderBy(F.col("ts").desc(), "key").limit(most)


def query_cache_key(query: Column, docs: Column, k: int) -> Column:
    """md5 of the lower-case query, the sorted hashes of its texts and k."""
    hashes = F.array_sort(F.transform(docs, lambda d: F.md5(d.cast("binary"))))
    return F.md5(F.to_json(F.struct(F.lower(query).alias("q"), hashes.alias("d"), F.lit(k).alias("k"))).cast("binary"))


def drop_near_duplicates(found: DataFrame, text_col: str = "text", threshold: float = 0.9) -> DataFrame:
    """Greedy in rank order: a text goes if its tokens overlap ``threshold`` or more with one already kept.

    Lists are as long as a search's k, so each folds within one row.
    """
    item = F.struct("rank", "doc_id", F.array_distinct(simple(F.col(text_col))).alias("t"))
    lists = found.groupBy("query_id").agg(F.array_sort(F.collect_list(item)).alias("items"))
    empty = F.slice("items", 1, 0)
    kept = F.aggregate("items", empty, lambda held, x: F.when(F.exists(held, lambda h: jaccard(h["t"], x["t"]) >= threshold), held).otherwise(F.concat(held, F.array(x))))
    return lists.select("query_id", F.explode(kept).alias("e")).select("query_id", "e.rank", "e.doc_id")


def diversity(found: DataFrame, text_col: str = "text") -> DataFrame:
    """Mean of 1 - Jaccard over the pairs of each list; 1 for lists of one."""
    lists = found.groupBy("query_id").agg(F.collect_list(F.struct("doc_id", F.array_distinct(simple(F.col(text_col))).alias("t"))).alias("items"))
    pairs = F.flatten(F.transform("items", lambda a: F.transform(F.filter("items", lambda b: b["doc_id"] > a["doc_id"]), lambda b: 1 - jaccard(a["t"], b["t"]))))
    return lists.select("query_id", pairs.alias("p")).select("query_id", F.round(F.when(F.size("p") == 0, 1.0).otherwise(F.aggregate("p", F.lit(0.0), lambda s, x: s + x) / F.size("p")), 6).alias("diversity"))


def save_cache(memo: DataFrame, path: str) -> None:
    memo.write.mode("overwrite").parquet(path)


def load_cache(spark, path: str, now: Column, ttl: float = 3600.0, most: int = 10_000) -> DataFrame:
    """A saved memo without the entries whose time is over."""
    return cache_evict(spark.read.parquet(path), now, most, ttl)


@dataclass(frozen=True)
class RerankSettings:
    """What a reranker is run with; the presets differ in model, batch and length."""

    model: str = "default"
    batch_size: int = 8
    max_length: int = 512
    factor: int = 3
    alpha: float = 0.7
    cache: bool = True
    fallback: bool = True

    def checked(self) -> RerankSettings:
        if self.batch_size < 1 or self.max_length < 1 or self.factor < 1 or not 0 <= self.alpha <= 1:
            raise ValueError("settings out of range")
        return self


PRESETS = {"default": RerankSettings(), "long": RerankSettings(max_length=2048, batch_size=4), "fast": RerankSettings(max_length=256, batch_size=32, factor=2), "debug": RerankSettings(batch_size=1, cache=False, fallback=False)}
