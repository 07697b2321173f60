"""Queries over sparse and dense retrieval, fusion and reranking, with their SQL."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from corvidex.functions import prompts, text
from corvidex.functions.tokenize import TOKENIZERS, dot, normalise, simple
from corvidex.operators import bm25, dense, fusion, rerank
from corvidex.plans.base import bm25_sql, close, documents, graph_index, index, questions, ranked_sql, sparse, table, tokens, vector_sql, vectors
from corvidex.sources.store import shared_folder
from corvidex.streaming.knowledge import KnowledgeBase, Snapshot

QUERIES, SQL = {}, {}


def query(sql: str | None = None):
    def register(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return register


@query(f"""SELECT doc_id, CAST(len({tokens("text")}) AS BIGINT) AS simple_tokens,
        CAST(len(regexp_extract_all(lower(text), '[\\p{{L}}\\p{{N}}_]+')) AS BIGINT) AS word_tokens,
        CAST(len(list_filter(regexp_split_to_array(text, '[\\s]+'), lambda t: t <> '')) AS BIGINT) AS blank_tokens FROM documents""")
def token_counts(spark, d):
    return documents(spark, d).select("doc_id", *[F.size(TOKENIZERS[n](F.col("text"))).cast("long").alias(f"{n}_tokens") for n in ("simple", "word", "blank")])


@query(f"""WITH d AS (SELECT term, count(*) AS df FROM (SELECT unnest(list_distinct({tokens("text")})) AS term FROM documents) GROUP BY term), s AS (SELECT count(*) AS n FROM documents)
        SELECT term, df, round(ln(1 + (n - df + 0.5) / (df + 0.5)), 6) AS idf FROM d, s""")
def vocab_df_idf(spark, d):
    return bm25.weights(index(spark, d)).select("term", "df", F.round("idf", 6).alias("idf"))


@query(f"WITH {bm25_sql()} SELECT n, round(avgdl, 6) AS avgdl FROM stats")
def bm25_stats(spark, d):
    return index(spark, d).stats.select("n", F.round("avgdl", 6).alias("avgdl"))


@query(f"WITH {bm25_sql()}, {ranked_sql('r', 'scored', 3)} SELECT query_id, doc_id, score, rank FROM r")
def bm25_lucene_top3(spark, d):
    return sparse(spark, d, 3).select("query_id", "doc_id", "score", "rank")


@query(f"WITH {bm25_sql('okapi')}, {ranked_sql('r', 'scored', 3)} SELECT query_id, doc_id, score, rank FROM r")
def bm25_okapi_top3(spark, d):
    return sparse(spark, d, 3, "okapi").select("query_id", "doc_id", "score", "rank")


@query(f"""WITH {bm25_sql("okapi")}, allp AS (SELECT b.item_id AS query_id, doc_id, 0.0 AS score FROM benchmark b, (SELECT doc_id FROM documents ORDER BY doc_id LIMIT 6) d
        WHERE NOT EXISTS (SELECT 1 FROM scored s WHERE s.query_id = b.item_id AND s.doc_id = d.doc_id) UNION ALL SELECT query_id, doc_id, score FROM scored),
        {ranked_sql("r", "allp", 3)} SELECT query_id, doc_id, score, rank FROM r""")
def bm25_padded_topn(spark, d):
    docs = documents(spark, d)
    return bm25.padded(index(spark, d), questions(spark, d), docs).select("query_id", "doc_id", "score", "rank")


@query(f"WITH {bm25_sql()}, {ranked_sql('r', 'scored', 3)} SELECT query_id, doc_id, score, rank FROM r")
def bm25_append_top3(spark, d):
    """The index of odd documents with the even ones appended equals the index of all."""
    docs = documents(spark, d)
    odd, even = docs.where("doc_id % 2 <> 0"), docs.where("doc_id % 2 = 0")
    return bm25.search(bm25.append(bm25.build(odd), even), questions(spark, d), 3).select("query_id", "doc_id", "score", "rank")


@query(f"WITH {bm25_sql()}, p AS (SELECT * FROM scored WHERE score > 5), {ranked_sql('r', 'p', 5)} SELECT query_id, doc_id, score, rank FROM r")
def bm25_min_score(spark, d):
    return bm25.search(index(spark, d), questions(spark, d), 5, min_score=5.0).select("query_id", "doc_id", "score", "rank")


@query("""WITH u AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS e FROM embeddings),
        n AS (SELECT vec_id, list_transform(e, lambda x: x / sqrt(list_inner_product(e, e))) AS v FROM u),
        s AS (SELECT q.vec_id AS query_id, d.vec_id AS doc_id, round(list_inner_product(q.v, d.v), 6) AS score FROM n q, n d WHERE q.vec_id % 50 = 0)
        SELECT query_id, doc_id, score, rank FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id) AS rank FROM s) WHERE rank <= 5""")
def cosine_topk(spark, d):
    e = table(spark, d, "embeddings")
    q = e.where("vec_id % 50 = 0").select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("qv"))
    return dense.top_k(q, e.select(F.col("vec_id").alias("doc_id"), F.col("embedding").alias("dv")), 5).select("query_id", "doc_id", "score", "rank")


@query(f"WITH {vector_sql()}, {ranked_sql('r', 'vscored', 3)} SELECT query_id, doc_id, score, rank FROM r")
def text_vector_top3(spark, d):
    return close(spark, d, 3).select("query_id", "doc_id", "score", "rank")


@query("SELECT vec_id, round(sqrt(list_sum(list_transform(embedding, lambda x: CAST(x AS DOUBLE) * x))), 4) AS norm, 1.0 AS unit FROM embeddings")
def l2_normalise(spark, d):
    v = F.col("embedding")
    unit = normalise(v)
    return table(spark, d, "embeddings").select("vec_id", F.round(F.sqrt(dot(v, v)), 4).alias("norm"), F.round(F.sqrt(dot(unit, unit)), 4).alias("unit"))


@query("""WITH c AS (SELECT label, list_transform(range(1, 65), lambda i: 0) AS z, count(*) AS n FROM embeddings GROUP BY label),
        m AS (SELECT label, i, avg(CAST(embedding[i] AS DOUBLE)) AS x FROM embeddings, range(1, 65) r(i) GROUP BY ALL),
        v AS (SELECT label, list(x ORDER BY i) AS e FROM m GROUP BY label)
        SELECT a.label AS a, b.label AS b, round(list_inner_product(a.e, b.e) / sqrt(list_inner_product(a.e, a.e) * list_inner_product(b.e, b.e)), 6) AS score FROM v a JOIN v b ON a.label < b.label""")
def similarity_matrix(spark, d):
    """Similarities of all pairs of label centres."""
    e = table(spark, d, "embeddings").select("label", F.posexplode("embedding").alias("i", "x")).groupBy("label", "i").agg(F.avg(F.col("x").cast("double")).alias("x"))
    centres = e.groupBy("label").agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "x"))), lambda s: s["x"]).alias("dv")).withColumnRenamed("label", "doc_id")
    return dense.similarity_pairs(centres)


@query()
def ivf_topk(spark, d):
    """Approximate search over trained cells; 14 of 16 cells are searched, for a recall of 0.9 or more (README)."""
    e = table(spark, d, "embeddings").select(F.col("vec_id").alias("doc_id"), F.col("embedding").alias("dv"))
    q = e.where("doc_id % 50 = 0").select(F.col("doc_id").alias("query_id"), F.col("dv").alias("qv"))
    return dense.ivf_top_k(q, e, 5, cells=16, probes=14)


@query()
def graph_topk(spark, d):
    """Approximate search for every passage of ``benchmark`` over proximity graphs of the documents' vectors."""
    return graph_index(spark, d).search(vectors(spark, d)[0], 5).select("query_id", "doc_id", "score", "rank")


@query()
def graph_work(spark, d):
    """How many similarities that search computes for each passage."""
    return graph_index(spark, d).work(vectors(spark, d)[0], 5)


@query()
def graph_layers(spark, d):
    """Nodes, links and vectors of each layer of the graphs."""
    return graph_index(spark, d).stats()


_NORMS = {
    "minmax": "CASE WHEN max(score) OVER w = min(score) OVER w THEN 0.5 ELSE (score - min(score) OVER w) / (max(score) OVER w - min(score) OVER w) END",
    "rank": "1.0 / row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id)",
    "softmax": "exp(score - max(score) OVER w) / (sum(e) OVER w)",
    "zscore": "CASE WHEN stddev_pop(score) OVER w = 0 THEN 0.5 ELSE 1 / (1 + exp(-(score - avg(score) OVER w) / stddev_pop(score) OVER w)) END",
}


def _fused_sql(how: str, sparse: str, dense: str, k: int, a: float = 0.5, b: float = 0.5) -> str:
    """CTEs up to ``r``: two ranked lists, normalised and joined."""
    norm = lambda src: f"(SELECT query_id, doc_id, {_NORMS[how]} AS s FROM (SELECT *, exp(score - max(score) OVER (PARTITION BY query_id)) AS e FROM {src}) WINDOW w AS (PARTITION BY query_id))"
    return f"""f AS (SELECT query_id, doc_id, round({a} * coalesce(x.s, 0) + {b} * coalesce(y.s, 0), 6) AS score, round(coalesce(x.s, 0), 6) AS bm25_score, round(coalesce(y.s, 0), 6) AS vector_score,
              CASE WHEN y.s IS NULL THEN 'bm25' WHEN x.s IS NULL THEN 'vector' ELSE 'bm25,vector' END AS methods
              FROM {norm(sparse)} x FULL OUTER JOIN {norm(dense)} y USING (query_id, doc_id)), {ranked_sql("r", "f", k)}"""


def _hybrid_sql(how: str, a: float = 0.5, b: float = 0.5) -> str:
    return f"""WITH {bm25_sql()}, {ranked_sql("bm", "scored", 15)}, {vector_sql()}, {ranked_sql("ve", "vscored", 15)}, {_fused_sql(how, "bm", "ve", 5, a, b)}
        SELECT query_id, doc_id, score, bm25_score, vector_score, methods, rank FROM r"""


def _hybrid(spark, d, how, weights=(0.5, 0.5)):
    return fusion.hybrid(sparse(spark, d, 15), close(spark, d, 15), 5, weights, how).withColumn("methods", F.array_join("methods", ",")).select("query_id", "doc_id", "score", "bm25_score", "vector_score", "methods", "rank")


@query(_hybrid_sql("minmax"))
def hybrid_minmax_top5(spark, d):
    return _hybrid(spark, d, "minmax")


@query(_hybrid_sql("rank"))
def hybrid_rank_top5(spark, d):
    return _hybrid(spark, d, "rank")


@query(_hybrid_sql("softmax"))
def hybrid_softmax_top5(spark, d):
    return _hybrid(spark, d, "softmax")


@query(_hybrid_sql("zscore"))
def hybrid_zscore_top5(spark, d):
    return _hybrid(spark, d, "zscore")


@query(_hybrid_sql("minmax", 1.0, 0.0))
def hybrid_sparse_only(spark, d):
    """Single-method ablation by weights."""
    return _hybrid(spark, d, "minmax", (1.0, 0.0))


_BOTH = f"WITH {bm25_sql()}, {ranked_sql('bm', 'scored', 10)}, {vector_sql()}, {ranked_sql('ve', 'vscored', 10)}"


@query(f"""{_BOTH}, u AS (SELECT query_id, doc_id, 1.0 / (60 + rank) AS s FROM bm UNION ALL SELECT query_id, doc_id, 1.0 / (60 + rank) FROM ve),
        f AS (SELECT query_id, doc_id, round(sum(s), 6) AS score FROM u GROUP BY ALL), {ranked_sql("r", "f", 5)} SELECT query_id, doc_id, score, rank FROM r""")
def rrf_top5(spark, d):
    return fusion.reciprocal_rank([sparse(spark, d, 10), close(spark, d, 10)], 5).select("query_id", "doc_id", "score", "rank")


@query(f"""{_BOTH}, u AS (SELECT query_id, doc_id, 0.3 * least(score / 10, 1) AS s FROM bm UNION ALL SELECT query_id, doc_id, 0.7 * score FROM ve),
        f AS (SELECT query_id, doc_id, round(sum(s), 6) AS score FROM u GROUP BY ALL), {ranked_sql("r", "f", 5)} SELECT query_id, doc_id, score, rank FROM r""")
def weighted_additive_top5(spark, d):
    return fusion.additive(sparse(spark, d, 10), close(spark, d, 10), 5).select("query_id", "doc_id", "score", "rank")


_UNION = f"""WITH {bm25_sql()}, {ranked_sql("bm", "scored", 3)}, {vector_sql()}, {ranked_sql("ve", "vscored", 3)},
        u AS (SELECT query_id, doc_id, score, 'bm25' AS source, rank FROM bm UNION ALL SELECT query_id, doc_id, score, 'vector', rank FROM ve),
        c AS (SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY source, rank) AS pos, source, doc_id, score FROM u)"""


def _combined(spark, d):
    return fusion.combined(sparse(spark, d, 3), close(spark, d, 3))


@query(f"{_UNION} SELECT * FROM c")
def combined_top3_union(spark, d):
    return _combined(spark, d)


@query(f"""{_UNION}, t AS (SELECT c.*, row_number() OVER (PARTITION BY query_id, substr(text, 1, 500) ORDER BY pos) AS n FROM c JOIN documents USING (doc_id))
        SELECT query_id, pos, source, doc_id, score FROM t WHERE n = 1""")
def combined_top3_dedup(spark, d):
    return fusion.distinct_content(_combined(spark, d).join(documents(spark, d).select("doc_id", "text"), "doc_id")).select("query_id", "pos", "source", "doc_id", "score")


_PACK = f"""{_UNION}, l AS (SELECT query_id, pos, '[문서 ' || pos || ']' || chr(10) || text || chr(10) AS line FROM c JOIN documents USING (doc_id)),
        p AS (SELECT *, sum(length(line)) OVER (PARTITION BY query_id ORDER BY pos) AS upto FROM l)"""


@query(f"{_PACK} SELECT query_id, string_agg(line, '' ORDER BY pos) AS context, count(*) AS docs FROM p WHERE upto <= 1200 GROUP BY query_id")
def context_pack(spark, d):
    """As ``context_pack_whole``, with a budget of 1200."""
    found = _combined(spark, d).withColumnRenamed("pos", "rank").join(documents(spark, d).select("doc_id", "text"), "doc_id")
    return prompts.pack(found, 1200)


@query(f"""{_UNION}, l AS (SELECT query_id, pos, '[문서 ' || pos || ']' || chr(10) || text || chr(10) AS line FROM c JOIN documents USING (doc_id)),
        p AS (SELECT *, sum(length(line)) OVER (PARTITION BY query_id ORDER BY pos) AS upto FROM l)
        SELECT query_id, string_agg(line, '' ORDER BY pos) AS context, count(*) AS docs FROM p WHERE upto <= 2000 GROUP BY query_id""")
def context_pack_whole(spark, d):
    """The flagship: sparse and dense top 3, joined, and whole texts packed into one context a query by the operator's budget."""
    found = _combined(spark, d).withColumnRenamed("pos", "rank").join(documents(spark, d).select("doc_id", "text"), "doc_id")
    return prompts.pack(found)


@query(f"""{_UNION}, t AS (SELECT query_id, pos, doc_id, text, sum(length(text)) OVER (PARTITION BY query_id ORDER BY pos) AS upto FROM c JOIN documents USING (doc_id)),
        k AS (SELECT query_id, pos AS rank, doc_id, CASE WHEN upto <= 6000 THEN text WHEN 6000 - upto + length(text) > 100 THEN left(text, CAST(6000 - upto + length(text) AS BIGINT)) || '...' END AS kept FROM t)
        SELECT query_id, rank, doc_id, md5(kept) AS kept_md5, length(kept) AS kept_length FROM k WHERE kept IS NOT NULL""")
def context_truncate(spark, d):
    found = _combined(spark, d).withColumnRenamed("pos", "rank").join(documents(spark, d).select("doc_id", "text"), "doc_id")
    return prompts.truncated(found, 2000).select("query_id", "rank", "doc_id", F.md5("kept").alias("kept_md5"), F.length("kept").cast("long").alias("kept_length"))


_OVER = f"CASE WHEN len(list_distinct({tokens('b.text')})) = 0 THEN 0.0 ELSE len(list_intersect(list_distinct({tokens('b.text')}), {tokens('d.text')})) / len(list_distinct({tokens('b.text')})) END"


@query(f"""WITH {bm25_sql()}, {ranked_sql("bm", "scored", 15)}, o AS (SELECT bm.query_id, bm.doc_id, bm.score AS os, {_OVER} AS rs FROM bm JOIN benchmark b ON b.item_id = bm.query_id JOIN documents d ON d.doc_id = bm.doc_id),
        f AS (SELECT query_id, doc_id, round(0.7 * (CASE WHEN max(rs) OVER w = min(rs) OVER w THEN 0.5 ELSE (rs - min(rs) OVER w) / (max(rs) OVER w - min(rs) OVER w) END)
              + 0.3 * (CASE WHEN max(os) OVER w = min(os) OVER w THEN 0.5 ELSE (os - min(os) OVER w) / (max(os) OVER w - min(os) OVER w) END), 6) AS score FROM o WINDOW w AS (PARTITION BY query_id)),
        {ranked_sql("r", "f", 5)} SELECT query_id, doc_id, score, rank FROM r""")
def rerank_blend(spark, d):
    found = sparse(spark, d, 15).join(documents(spark, d).select("doc_id", "text"), "doc_id").join(questions(spark, d), "query_id")
    return rerank.rerank(found, rerank.overlap_score(F.col("query"), F.col("text")), 5).select("query_id", "doc_id", "score", "rank")


@query(f"""WITH {bm25_sql()}, {ranked_sql("bm", "scored", 10)}, t AS (SELECT query_id, doc_id, list_distinct({tokens("text")}) AS t FROM bm JOIN documents USING (doc_id)),
        p AS (SELECT a.query_id, 1 - CASE WHEN len(list_distinct(list_concat(a.t, b.t))) = 0 THEN 0.0 ELSE len(list_intersect(a.t, b.t)) / len(list_distinct(list_concat(a.t, b.t))) END AS s FROM t a JOIN t b ON a.query_id = b.query_id AND a.doc_id < b.doc_id)
        SELECT query_id, round(coalesce((SELECT avg(s) FROM p WHERE p.query_id = q.query_id), 1.0), 6) AS diversity FROM (SELECT DISTINCT query_id FROM bm) q""")
def jaccard_diversity(spark, d):
    return rerank.diversity(sparse(spark, d, 10).join(documents(spark, d).select("doc_id", "text"), "doc_id"))


@query()
def near_duplicate_filter(spark, d):
    """Greedy in rank order; an order-dependent fold that SQL does not express."""
    return rerank.drop_near_duplicates(sparse(spark, d, 10).join(documents(spark, d).select("doc_id", "text"), "doc_id"))


@query(f"""WITH {bm25_sql()}, {ranked_sql("bm", "scored", 3)} SELECT bm.query_id, bm.doc_id, md5(regexp_replace(lower(trim(regexp_replace(b.text, '\\s+', ' ', 'g'))), '[.,!?;:]+$', '') || '||' ||
        regexp_replace(lower(trim(regexp_replace(substr(d.text, 1, 1000), '\\s+', ' ', 'g'))), '[.,!?;:]+$', '')) AS key FROM bm JOIN benchmark b ON b.item_id = bm.query_id JOIN documents d ON d.doc_id = bm.doc_id""")
def cache_keys(spark, d):
    found = sparse(spark, d, 3).join(documents(spark, d).select("doc_id", "text"), "doc_id").join(questions(spark, d), "query_id")
    return found.select("query_id", "doc_id", rerank.cache_key(F.col("query"), F.col("text")).alias("key"))


@query("""WITH p AS (SELECT event_id, user_id AS key, ts FROM events), m AS (SELECT user_id AS key, max(epoch(ts)) AS ts, round(avg(value), 4) AS score FROM events WHERE event_id % 2 = 0 GROUP BY user_id),
        n AS (SELECT max(epoch(ts)) AS now FROM events) SELECT p.event_id, m.score, m.score IS NOT NULL AS hit FROM p LEFT JOIN (SELECT m.* FROM m, n WHERE now - m.ts <= 86400) m ON p.key = m.key""")
def score_cache(spark, d):
    """Hits and misses of a memo table with a lifetime."""
    e = table(spark, d, "events")
    memo = e.where("event_id % 2 = 0").groupBy(F.col("user_id").alias("key")).agg(F.max(F.col("ts").cast("timestamp").cast("double")).alias("ts"), F.round(F.avg("value"), 4).alias("score"))
    now = F.lit(e.agg(F.max(F.col("ts").cast("timestamp").cast("double"))).first()[0])
    hits, misses = rerank.cache_split(e.select("event_id", F.col("user_id").alias("key")), memo, now, 86_400)
    return hits.select("event_id", "score", F.lit(True).alias("hit")).unionByName(misses.select("event_id", F.lit(None).cast("double").alias("score"), F.lit(False).alias("hit")))


_LISTED = f"""WITH {bm25_sql()}, {ranked_sql("bm", "scored", 10)}, {vector_sql()}, {ranked_sql("ve", "vscored", 10)}, {_fused_sql("minmax", "bm", "ve", 5)}"""


@query(f"""{_LISTED}, x AS (SELECT query_id, 'bm25' AS list, rank, doc_id, score FROM bm UNION ALL SELECT query_id, 'vector', rank, doc_id, score FROM ve UNION ALL SELECT query_id, 'hybrid', rank, doc_id, score FROM r)
        SELECT query_id, list, rank, doc_id, score, substr(text, 1, 100) AS preview FROM x JOIN documents USING (doc_id)""")
def explain_search(spark, d):
    s, v = sparse(spark, d, 10), close(spark, d, 10)
    return fusion.explain(s, v, fusion.hybrid(s, v, 5), documents(spark, d)).select("query_id", "list", "rank", "doc_id", "score", "preview")


@query(f"""WITH {bm25_sql()}, {ranked_sql("bm", "scored", 5)} SELECT round(avg(CASE WHEN n > 0 THEN 1.0 ELSE 0 END), 6) AS coverage, round(avg(coalesce(n, 0)), 6) AS avg_docs, round(avg(top), 6) AS avg_top, round(avg(five), 6) AS avg_five
        FROM (SELECT item_id AS query_id FROM benchmark) LEFT JOIN (SELECT query_id, count(*) AS n, max(score) AS top, avg(score) AS five FROM bm GROUP BY query_id) USING (query_id)""")
def retrieval_quality(spark, d):
    from corvidex.operators.analytics import retrieval_summary

    return retrieval_summary(sparse(spark, d, 5), questions(spark, d))


@query(f"""WITH {bm25_sql()}, {ranked_sql("bm", "scored", 3)}, {vector_sql()}, {ranked_sql("ve", "vscored", 3)}, h AS (SELECT doc_id, 'bm25' AS m, CASE WHEN query_id % 2 = 0 THEN 'mc' ELSE 'desc' END AS k, score FROM bm UNION ALL SELECT doc_id, 'vector', CASE WHEN query_id % 2 = 0 THEN 'mc' ELSE 'desc' END, score FROM ve),
        u AS (SELECT doc_id, count(*) FILTER (m = 'bm25') AS bm25_count, count(*) FILTER (m = 'vector') AS vector_count, count(*) AS total_count, count(*) FILTER (k = 'mc') AS mc_count, count(*) FILTER (k = 'desc') AS desc_count, round(avg(score) FILTER (m = 'vector'), 6) AS avg_vector_score FROM h GROUP BY doc_id)
        SELECT doc_id AS chunk_id, coalesce(bm25_count, 0) AS bm25_count, coalesce(vector_count, 0) AS vector_count, coalesce(total_count, 0) AS total_count, coalesce(mc_count, 0) AS mc_count, coalesce(desc_count, 0) AS desc_count, coalesce(avg_vector_score, 0) AS avg_vector_score FROM (SELECT doc_id FROM documents) LEFT JOIN u USING (doc_id)""")
def usage_stats(spark, d):
    from corvidex.operators.analytics import usage

    kind = F.when(F.col("query_id") % 2 == 0, "mc").otherwise("desc").alias("kind")
    hits = [f.select(F.col("doc_id").alias("chunk_id"), F.lit(m).alias("method"), kind, "score") for m, f in (("bm25", sparse(spark, d, 3)), ("vector", close(spark, d, 3)))]
    return usage(documents(spark, d).select(F.col("doc_id").alias("chunk_id")), hits[0].unionByName(hits[1]))


@query(f"""WITH s AS ({SQL["usage_stats"]}) SELECT CAST(count(*) FILTER (total_count > 0) AS BIGINT) AS used, CAST(count(*) FILTER (total_count = 0) AS BIGINT) AS unused, round(avg(total_count), 6) AS mean_use,
        count(*) FILTER (bm25_count > 0 AND vector_count = 0) AS bm25_only, count(*) FILTER (bm25_count = 0 AND vector_count > 0) AS vector_only, count(*) FILTER (bm25_count > 0 AND vector_count > 0) AS "both",
        count(*) FILTER (mc_count > desc_count) AS mc_preferred, count(*) FILTER (desc_count > mc_count) AS desc_preferred, count(*) FILTER (vector_count > 0 AND avg_vector_score < 0.5) AS low_score, count(*) FILTER (total_count > 10) AS high_use FROM s""")
def usage_summary(spark, d):
    from corvidex.operators.analytics import usage_summary as summary

    return summary(usage_stats(spark, d))


@query(f"""WITH h AS ({_hybrid_sql("minmax")}), g AS (SELECT query_id, round(avg(bm25_score) / (avg(vector_score) + 1e-10), 4) AS ratio FROM h GROUP BY query_id)
        SELECT query_id, ratio, CASE WHEN ratio > 1.5 THEN 'bm25' WHEN ratio < 0.67 THEN 'vector' ELSE 'balanced' END AS dominant FROM g""")
def score_dominance(spark, d):
    from corvidex.operators.analytics import dominance

    return dominance(_hybrid(spark, d, "minmax"))


@query("""WITH n AS (SELECT vec_id, label, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS e FROM embeddings),
        p AS (SELECT round(list_inner_product(a.e, b.e), 6) AS score, CASE WHEN a.label = b.label THEN 1.0 ELSE 0.0 END AS gold FROM n a JOIN n b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id),
        r AS (SELECT score, gold, rank() OVER (ORDER BY score) + (count(*) OVER (PARTITION BY score) - 1) / 2.0 AS rs, rank() OVER (ORDER BY gold) + (count(*) OVER (PARTITION BY gold) - 1) / 2.0 AS rg FROM p),
        o AS (SELECT round(corr(rs, rg), 6) AS spearman, round(corr(score, gold), 6) AS pearson, round(avg((score - gold) ** 2), 6) AS mse, round(avg(abs(score - gold)), 6) AS mae, count(*) AS n FROM r)
        SELECT *, CASE WHEN spearman >= 0.8 THEN 'A' WHEN spearman >= 0.7 THEN 'B' WHEN spearman >= 0.6 THEN 'C' WHEN spearman >= 0.5 THEN 'D' ELSE 'F' END AS grade FROM o""")
def embedding_eval_corr(spark, d):
    from corvidex.operators.analytics import embedding_eval

    e = table(spark, d, "embeddings")
    q = e.where("vec_id % 50 = 0").select(F.col("vec_id").alias("query_id"), "label", F.col("embedding").alias("qv"))
    pairs = dense.pair_counts(q, e.select(F.col("vec_id").alias("doc_id"), "label", F.col("embedding").alias("dv")))
    return embedding_eval(pairs)


@query(f"SELECT term, n FROM (SELECT term, count(*) AS n FROM (SELECT unnest({tokens('text')}) AS term FROM documents) GROUP BY term) ORDER BY n DESC, term LIMIT 20")
def keyword_top20(spark, d):
    return documents(spark, d).select(F.explode(simple(F.col("text"))).alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("n")).orderBy(F.col("n").desc(), "term").limit(20)


_TERMS = "[" + ", ".join(f"'{t}'" for t in text.TERMS) + "]"
_HELD = f"len(list_filter({_TERMS}, lambda t: contains(lower(text), lower(t))))"


@query(f"SELECT doc_id, {_HELD} AS terms, round(1 + 0.2 * least({_HELD} / 10, 1), 6) AS boost FROM (SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN text || ' 금리 리스크 var' ELSE text END AS text FROM documents)")
def term_boost(spark, d):
    """The 43 terms over whole texts; a third of them get three terms at their end, as the texts hold few."""
    t = F.when(F.col("doc_id") % 3 == 0, F.concat("text", F.lit(" 금리 리스크 var"))).otherwise(F.col("text"))
    return documents(spark, d).select("doc_id", F.size(text.terms_in(t)).cast("long").alias("terms"), F.round(text.term_boost(t), 6).alias("boost"))


__all__ = ["QUERIES", "SQL", "vectors"]


def _batches(spark, d) -> Snapshot:
    """A knowledge base of ``documents`` in four batches: two thirds; the rest and every fifth anew; every seventh out; then all in one segment."""
    docs = documents(spark, d).select("doc_id", "text")
    base = KnowledgeBase(spark, f"{shared_folder(spark)}/knowledge-{uuid.uuid4().hex}")
    base.apply(docs.where("doc_id % 3 <> 0"))
    edition = F.when(F.col("doc_id") % 5 == 0, F.concat("text", F.lit(" revised edition"))).otherwise(F.col("text"))
    base.apply(docs.where("doc_id % 3 = 0 OR doc_id % 5 = 0").select("doc_id", edition.alias("text")))
    base.apply(docs.where("false"), docs.where("doc_id % 7 = 0").select("doc_id"))
    base.compact()
    base.folder.fs.deleteOnExit(base.folder.at(""))
    return base.snapshot()


_FINAL = "final AS (SELECT doc_id, CASE WHEN doc_id % 5 = 0 THEN text || ' revised edition' ELSE text END AS text FROM documents WHERE doc_id % 7 <> 0)"


@query(f"WITH {_FINAL} SELECT doc_id, sha256(coalesce(text, '')) AS digest FROM final")
def knowledge_documents(spark, d):
    """What is live after batches of additions, changes and removals."""
    return _batches(spark, d).documents().select("doc_id", "digest")


@query(f"WITH {_FINAL}, {bm25_sql().replace('FROM documents', 'FROM final')}, {ranked_sql('r', 'scored', 3)} SELECT query_id, doc_id, score, rank FROM r")
def knowledge_search(spark, d):
    """A search after those batches, whose frequencies and lengths are those of the live documents."""
    return _batches(spark, d).search(questions(spark, d), 3).select("query_id", "doc_id", "score", "rank")
