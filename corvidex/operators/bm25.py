"""BM25 as tables: postings, document frequencies and corpus statistics; any number of queries at a time.

The index is built in one pass over the texts, without a shuffle of postings.  Whoever searches more than once keeps
the three tables (``Index.save``, or :mod:`corvidex.sources.store`).  A search sends the queries' terms to the postings where
they are few enough, so a common word is no hot key; else both meet on the term and a share of the documents.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corvidex.functions.tokenize import TOKENIZERS


#: Up to this many (query, term) rows are sent to every executor; more meet the postings in ``SHARES`` shares of the documents.
BROADCAST_TERMS = 200_000
SHARES = 32


@dataclass
class Index:
    """``postings(term, doc_id, tf, dl)``, ``terms(term, df)`` and one row ``stats(n, avgdl)``."""

    postings: DataFrame
    terms: DataFrame
    stats: DataFrame
    tokenizer: str = "simple"

    def save(self, path: str) -> None:
        """Postings are clustered by term, so that a search reads few row groups."""
        self.postings.repartitionByRange("term").sortWithinPartitions("term").write.mode("overwrite").parquet(f"{path}/postings")
        self.terms.write.mode("overwrite").parquet(f"{path}/terms")
        self.stats.withColumn("tokenizer", F.lit(self.tokenizer)).write.mode("overwrite").parquet(f"{path}/stats")


def load(spark, path: str) -> Index:
    stats = spark.read.parquet(f"{path}/stats")
    return Index(spark.read.parquet(f"{path}/postings"), spark.read.parquet(f"{path}/terms"), stats.drop("tokenizer"), stats.first()["tokenizer"])


def postings_of(docs: DataFrame, tokenizer: str = "simple", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Term counts, row by row: a document's tokens are sorted in place, so nothing is shuffled."""
    held = docs.select(F.col(id_col).alias("doc_id"), F.array_sort(TOKENIZERS[tokenizer](F.coalesce(F.col(text_col), F.lit("")))).alias("t"))
    held = held.select("doc_id", F.size("t").alias("dl"), "t")
    # in a sorted array a term begins where its predecessor differs; its count is the distance to the next begin
    begins = F.filter(F.transform("t", lambda x, i: F.struct(x.alias("term"), i.alias("i"), F.get("t", i - 1).alias("p"))), lambda e: e["p"].isNull() | (e["p"] != e["term"]))
    held = held.withColumn("b", begins)
    counted = F.transform("b", lambda e, i: F.struct(e["term"].alias("term"), (F.coalesce(F.get("b", i + 1)["i"], F.col("dl")) - e["i"]).alias("tf")))
    return held.select("doc_id", "dl", F.explode(counted).alias("e")).select("e.term", "doc_id", "e.tf", "dl")


def build(docs: DataFrame, tokenizer: str = "simple", id_col: str = "doc_id", text_col: str = "text", keep=lambda name, df: df) -> Index:
    """The index of a table; ``keep`` may store postings and terms (name, table) -> table, so that they are computed once."""
    postings = keep("postings", postings_of(docs, tokenizer, id_col, text_col))
    terms = keep("terms", postings.groupBy("term").agg(F.count(F.lit(1)).alias("df")))
    words = postings.agg(F.coalesce(F.sum("tf"), F.lit(0)).alias("words"))
    stats = docs.agg(F.count(F.lit(1)).alias("n")).crossJoin(F.broadcast(words)).select("n", F.try_divide(F.col("words"), F.col("n")).alias("avgdl"))  # one row each
    return Index(postings, terms, stats, tokenizer)


def append(index: Index, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> Index:
    """The index over old and new documents; equals a rebuild over both."""
    new = build(docs, index.tokenizer, id_col, text_col)
    terms = index.terms.unionByName(new.terms).groupBy("term").agg(F.sum("df").alias("df"))
    stats = index.stats.unionByName(new.stats).agg(F.sum("n").alias("n"), (F.sum(F.col("n") * F.col("avgdl")) / F.sum("n")).alias("avgdl"))
    return Index(index.postings.unionByName(new.postings), terms, stats, index.tokenizer)


def weights(index: Index, formula: str = "lucene", epsilon: float = 0.25) -> DataFrame:
    """(term, idf); ``okapi`` lifts negative values to ``epsilon`` times the mean over all terms."""
    t = index.terms.crossJoin(F.broadcast(index.stats))  # stats is one row
    if formula == "lucene":
        return t.select("term", "df", F.log(1 + (F.col("n") - F.col("df") + 0.5) / (F.col("df") + 0.5)).alias("idf"))
    raw = t.select("term", "df", (F.log(F.col("n") - F.col("df") + 0.5) - F.log(F.col("df") + 0.5)).alias("raw"))
    mean = raw.agg(F.avg("raw").alias("mean"))
    return raw.crossJoin(F.broadcast(mean)).select("term", "df", F.when(F.col("raw") < 0, epsilon * F.col("mean")).otherwise(F.col("raw")).alias("idf"))


def _asked(index: Index, queries: DataFrame, id_col: str = "query_id", text_col: str = "query") -> tuple[DataFrame, bool]:
    """(query_id, term, qtf), and whether they are few enough to go to every executor."""
    asked = queries.select(F.col(id_col).alias("query_id"), F.explode_outer(TOKENIZERS[index.tokenizer](F.col(text_col))).alias("term")).where(F.col("term").isNotNull()).groupBy("query_id", "term").agg(F.count(F.lit(1)).alias("qtf"))
    return asked, asked.limit(BROADCAST_TERMS + 1).count() <= BROADCAST_TERMS


def scores(index: Index, queries: DataFrame, formula: str = "lucene", k1: float = 1.5, b: float = 0.75, id_col: str = "query_id", text_col: str = "query") -> DataFrame:
    """(query_id, doc_id, score) of all documents that share a term with a query; scores rounded to 6 places."""
    asked, few = _asked(index, queries, id_col, text_col)
    known = weights(index, formula).join(F.broadcast(asked) if few else asked, "term")
    top = F.col("tf") * (k1 + 1 if formula == "okapi" else 1)
    part = F.col("qtf") * F.col("idf") * top / (F.col("tf") + k1 * (1 - b + b * F.col("dl") / F.col("avgdl")))
    if few:
        hits = index.postings.join(F.broadcast(known), "term")
    else:
        share = F.pmod(F.xxhash64("doc_id"), F.lit(SHARES)).cast("int")
        hits = index.postings.withColumn("__s", share).join(known.withColumn("__s", F.explode(F.sequence(F.lit(0), F.lit(SHARES - 1)))), ["term", "__s"])
    hits = hits.crossJoin(F.broadcast(index.stats))
    return hits.groupBy("query_id", "doc_id").agg(F.round(F.sum(part), 6).alias("score"))


def ranked(scored: DataFrame, k: int, by: str = "query_id", tie: str = "doc_id") -> DataFrame:
    """The ``k`` best rows of each query with their rank; ties to smaller ids."""
    w = Window.partitionBy(by).orderBy(F.col("score").desc(), F.col(tie))
    return scored.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k).withColumn("rank", F.col("rank").cast("long"))


def _local_best(index: Index, asked: DataFrame, k: int, formula: str, k1: float = 1.5, b: float = 0.75) -> DataFrame:
    """(query_id, doc_id, score): each task's ``k`` best documents of every query.

    Of the postings only those of asked terms are shuffled, to one row a document; scores of a share of documents and all queries are summed in an array,
    so no row is made of a query and a document that is not among its best.
    """
    from corvidex.operators.dense import from_arrow, keep_best

    known = weights(index, formula).join(F.broadcast(asked), "term").select("term", "query_id", (F.col("qtf") * F.col("idf")).alias("w")).toArrow()
    names, places = np.unique(np.array(known["term"].to_pylist(), dtype=object), return_inverse=True) if len(known) else (np.zeros(0, object), np.zeros(0, np.int64))
    asking = known["query_id"].combine_chunks().dictionary_encode("encode")
    who, ids_of, w = asking.indices.to_numpy(zero_copy_only=False), asking.dictionary, known["w"].to_numpy()
    order = np.argsort(places, kind="stable")
    who, w = who[order], w[order]
    begins = np.searchsorted(places[order], np.arange(len(names) + 1))
    spark = index.postings.sparkSession
    numbered = spark.createDataFrame([(t, i) for i, t in enumerate(names.tolist())], "term string, t int")
    top = F.col("tf") * (k1 + 1 if formula == "okapi" else 1)
    part = top / (F.col("tf") + k1 * (1 - b + b * F.col("dl") / F.col("avgdl")))
    hits = index.postings.join(F.broadcast(numbered), "term").crossJoin(F.broadcast(index.stats)).select("doc_id", "t", part.alias("x"))
    docs = hits.groupBy("doc_id").agg(F.collect_list(F.struct("t", "x")).alias("e")).select("doc_id", F.col("e.t").alias("t"), F.col("e.x").alias("x"))
    out = asked.select("query_id").schema.add("doc_id", index.postings.schema["doc_id"].dataType).add("score", "double")
    kind, n = from_arrow(docs, "doc_id"), len(ids_of)
    share = max(1, 100_000 // max(n, 1))  # documents at a time

    def rows_of(at, ids, scores):
        return pa.RecordBatch.from_arrays([ids_of.take(pa.array(at)), ids, pa.array(scores)], names=["query_id", "doc_id", "score"])

    def work(batches):
        best, found, values, least = np.zeros(0, np.int64), None, np.zeros(0), np.full(n, -np.inf)
        for whole in batches:
            for lo in range(0, len(whole), share):
                batch = whole.slice(lo, share)
                ids, size = batch.column(0), len(batch)
                lists, x = batch.column(1), batch.column(2).flatten().to_numpy(zero_copy_only=False)
                t = lists.flatten().to_numpy(zero_copy_only=False)
                doc = np.repeat(np.arange(size), np.asarray(lists.value_lengths(), dtype=np.int64))
                many = begins[t + 1] - begins[t]
                entry = np.repeat(begins[t] - np.cumsum(many) + many, many) + np.arange(many.sum())
                cell = np.repeat(doc, many) * n + who[entry]
                s = np.bincount(cell, w[entry] * np.repeat(x, many), size * n).round(6) + 0.0
                s[np.bincount(cell, minlength=size * n) == 0] = -np.inf
                s = s.reshape(size, n)
                for i in np.flatnonzero(ids.is_null().to_numpy(zero_copy_only=False)):  # the group of documents without an id, one row at most
                    at = np.flatnonzero(s[i] > -np.inf)
                    yield rows_of(at, pa.nulls(len(at), kind), s[i, at])
                    s[i] = -np.inf
                col, at = np.nonzero((s >= least) & (s > -np.inf))
                own = ids.take(pa.array(col)).to_numpy(zero_copy_only=False)
                best, values, found = np.concatenate([best, at]), np.concatenate([values, s[col, at]]), own if found is None else np.concatenate([found, own])
                keep = keep_best(best, values, found, k)
                best, values, found = best[keep], values[keep], found[keep]
                worst = np.full(n, np.inf)
                np.minimum.at(worst, best, values)
                least = np.where(np.bincount(best, minlength=n) >= k, worst, -np.inf)
        if found is not None:
            yield rows_of(best, pa.array(found, kind), values)

    return docs.mapInArrow(work, out)


def search(index: Index, queries: DataFrame, k: int = 3, formula: str = "lucene", min_score: float | None = None, **names) -> DataFrame:
    weighed = {n: names[n] for n in ("k1", "b") if n in names}
    asked, few = _asked(index, queries, **{n: v for n, v in names.items() if n not in weighed})
    found = _local_best(index, asked, k, formula, **weighed) if few and k > 0 else scores(index, queries, formula, **names)
    return ranked(found if min_score is None else found.where(F.col("score") > min_score), k)


def batch_search(index: Index, queries: DataFrame, k: int = 3, formula: str = "lucene", **names) -> DataFrame:
    """As ``search``, with a row of nulls for a query that finds nothing, so every query keeps its slot."""
    found = search(index, queries, k, formula, **names)
    return queries.select(F.col(names.get("id_col", "query_id")).alias("query_id")).distinct().join(found, "query_id", "left")


def padded(index: Index, queries: DataFrame, docs: DataFrame, n: int = 3, formula: str = "okapi", id_col: str = "query_id") -> DataFrame:
    """Exactly ``n`` documents a query: those without a hit follow with score 0, in order of their ids.

    At most ``n`` ids can be needed for padding beyond ``n`` that are hits, so ``2 n`` of the smallest are enough.
    """
    hits = search(index, queries, n, formula).drop("rank")
    spare = docs.select("doc_id").orderBy("doc_id").limit(2 * n)
    pad = queries.select(F.col(id_col).alias("query_id")).crossJoin(F.broadcast(spare)).join(hits, ["query_id", "doc_id"], "left_anti").withColumn("score", F.lit(0.0))
    return ranked(hits.unionByName(pad.select("query_id", "doc_id", "score")), n)


def query_terms(c: Column, tokenizer: str = "simple") -> Column:
    return TOKENIZERS[tokenizer](c)
