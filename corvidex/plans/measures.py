"""Queries over retrieval wrappers, pages, reports and analytics, with their SQL."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from corvidex.functions import prompts, text
from corvidex.functions.morphemes import Morphemes
from corvidex.functions.tokenize import simple, technical_terms
from corvidex.operators import analytics, bm25, chunking, fusion, order, quality, rerank, reports, retrieve, sampling
from corvidex.operators import vectors as stores
from corvidex.plans import retrieval
from corvidex.plans.base import bm25_sql, close, documents, index, quoted, ranked_sql, sparse, spread, strip, table, tokens, vector_sql, vectors
from corvidex.plans.base import questions as asked
from corvidex.plans.corpus import _clean_sql
from corvidex.sources.store import kept, shared_folder
from corvidex.streaming import score_cache

QUERIES, SQL = {}, {}


def query(sql: str | None = None):
    def register(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return register


# --- retrieval ---
@query(f"""WITH {bm25_sql()}, {ranked_sql("bm", "scored", 3)}, q AS (SELECT item_id AS query_id FROM benchmark UNION ALL SELECT -1 - item_id FROM benchmark)
        SELECT q.query_id, coalesce(doc_id, -1) AS doc_id, coalesce(score, 0) AS score, coalesce(rank, 0) AS rank FROM q LEFT JOIN bm ON bm.query_id = q.query_id""")
def bm25_batch_slots(spark, d):
    """Queries without tokens keep their slot, as a row of id -1."""
    q = asked(spark, d)
    blank = q.select((-1 - F.col("query_id")).alias("query_id"), F.lit(" ! ").alias("query"))
    return bm25.batch_search(index(spark, d), q.unionByName(blank), 3).na.fill({"doc_id": -1, "score": 0.0, "rank": 0}).select("query_id", "doc_id", "score", "rank")


@query()
def bm25_morpheme_top3(spark, d):
    """The index over morphemes of the offline analyser; tested against a plain BM25."""
    docs = documents(spark, d)
    found = bm25.search(bm25.build(docs, "morpheme", keep=lambda name, df: kept(docs, f"morpheme-{name}", lambda: df)), asked(spark, d), 3)
    return found.select("query_id", "doc_id", "score", "rank")


@query()
def morpheme_counts(spark, d):
    """Morphemes, nouns and noun pairs of whole texts by the offline analyser."""
    m = Morphemes()
    t = F.col("text")
    return documents(spark, d).select("doc_id", F.size(m.tokens(t)).alias("tokens"), F.size(m.forms(t)).alias("forms"), F.size(m.nouns(t)).alias("nouns"), F.size(m.compounds(t)).alias("compounds"), F.md5(m.spaced(t)).alias("spaced"))


@query()
def technical_term_counts(spark, d):
    return documents(spark, d).select("doc_id", F.size(technical_terms(F.col("text"))).alias("terms"))


_OVERLAP = retrieval._OVER
_PAIRED = f"""WITH {bm25_sql()}, {{first}}, p AS (SELECT f.query_id, f.doc_id, f.score AS os, f.rank, {_OVERLAP} AS rs, count(*) OVER (PARTITION BY f.query_id) AS n FROM {{name}} f JOIN benchmark b ON b.item_id = f.query_id JOIN documents d ON d.doc_id = f.doc_id {{where}})"""


def _texts(spark, d, found):
    return found.join(documents(spark, d).select("doc_id", "text"), "doc_id").join(asked(spark, d), "query_id")


@query(
    _PAIRED.replace("{first}", ranked_sql("bm", "scored", 30)).replace("{name}", "bm").replace("{where}", "WHERE f.score >= 2")
    + f", s AS (SELECT query_id, doc_id, round(CASE WHEN n > 5 THEN rs ELSE os END, 6) AS score, round(os, 6) AS original_score FROM p), {ranked_sql('r', 's', 5)} SELECT query_id, doc_id, score, original_score, rank FROM r"
)
def pipeline_retrieve(spark, d):
    """Thirty by words, those of score 2 or more, reranked to five where there are more."""
    found = retrieve.retrieve(lambda k: _texts(spark, d, sparse(spark, d, k)), rerank.overlap_score(F.col("query"), F.col("text")), 5, 30, 2.0)
    return found.select("query_id", "doc_id", F.round("score", 6).alias("score"), F.round("original_score", 6).alias("original_score"), "rank")


@query(
    _PAIRED.replace("{first}", ranked_sql("bm", "scored", 15)).replace("{name}", "bm").replace("{where}", "")
    + f", v AS (SELECT *, max(CASE WHEN doc_id % 50 = 7 THEN 1 ELSE 0 END) OVER (PARTITION BY query_id) AS failed FROM p), s AS (SELECT query_id, doc_id, round(CASE WHEN failed = 1 THEN os ELSE rs END, 6) AS score, failed = 1 AS fell_back FROM v), {ranked_sql('r', 's', 5)} SELECT query_id, doc_id, score, fell_back, rank FROM r"
)
def over_fetch_rerank(spark, d):
    """Fifteen searched for five; a query whose scorer fails on one pair falls back whole."""
    score = F.when(F.col("doc_id") % 50 != 7, rerank.overlap_score(F.col("query"), F.col("text")))
    found = retrieve.with_reranking(lambda k: _texts(spark, d, sparse(spark, d, k)), score, 5)
    # told from the whole list of fifteen
    bad = sparse(spark, d, 15).groupBy("query_id").agg(F.max(F.col("doc_id") % 50 == 7).alias("fell_back"))
    return found.join(bad, "query_id").select("query_id", "doc_id", F.round("score", 6).alias("score"), "fell_back", "rank")


@query(f"""WITH {bm25_sql()}, {ranked_sql("bm", "scored", 3)} SELECT query_id, bm.rank, score AS original_score, round(score / 2, 6) AS score, lang AS metadata FROM bm JOIN documents USING (doc_id)""")
def merged_metadata(spark, d):
    found = sparse(spark, d, 3)
    more = found.select("query_id", "doc_id", F.round(F.col("score") / 2, 6).alias("score")).join(documents(spark, d).select("doc_id", F.col("lang").alias("metadata")), "doc_id")
    merged = retrieve.merge_metadata(found, more, ["query_id", "doc_id"])
    return retrieve.formatted(merged, ("original_score", "score", "metadata", "absent"))


@query(f"""WITH {vector_sql()}, {ranked_sql("ve", "vscored", 10)}, f AS (SELECT query_id, doc_id, round(0.3 / rank + 0.7 * score, 8) AS score FROM ve), {ranked_sql("r", "f", 5)} SELECT query_id, doc_id, score, rank FROM r""")
def rank_cosine_mix(spark, d):
    return fusion.rank_cosine(close(spark, d, 10), F.col("score"), 5).select("query_id", "doc_id", "score", "rank")


@query(retrieval._hybrid_sql("minmax", 0.0, 1.0))
def hybrid_dense_only(spark, d):
    return retrieval._hybrid(spark, d, "minmax", (0.0, 1.0))


retrieval._NORMS["sigmoid"] = "1 / (1 + exp(-score))"


@query(retrieval._hybrid_sql("sigmoid"))
def hybrid_sigmoid_top5(spark, d):
    return retrieval._hybrid(spark, d, "sigmoid")


_HITS = f"""WITH {bm25_sql()}, {ranked_sql("bm", "scored", 3)}, {vector_sql()}, {ranked_sql("ve", "vscored", 3)}, h AS (SELECT query_id, 'bm25' AS method, doc_id AS chunk_id, rank, score FROM bm UNION ALL SELECT query_id, 'vector', doc_id, rank, score FROM ve)"""


@query(f"{_HITS} SELECT h.*, CASE WHEN query_id % 2 = 0 THEN 'mc' ELSE 'desc' END AS kind FROM h")
def tracked_hits(spark, d):
    kinds = asked(spark, d).select("query_id", F.when(F.col("query_id") % 2 == 0, "mc").otherwise("desc").alias("kind"))
    return analytics.tracked({"bm25": sparse(spark, d, 3), "vector": close(spark, d, 3)}, kinds)


@query(f"""{_HITS}, a AS (SELECT query_id, CASE WHEN query_id % 2 = 0 THEN 'mc' ELSE 'desc' END AS type, max(CASE WHEN method = 'bm25' THEN chunk_id END) AS x, max(CASE WHEN method = 'vector' THEN chunk_id END) AS y FROM h WHERE rank = 1 GROUP BY query_id)
        SELECT type, count(*) AS n, round(avg(CASE WHEN x = y THEN 1.0 WHEN x <> y THEN 0.0 END), 6) AS rate FROM a WHERE x IS NOT NULL AND y IS NOT NULL GROUP BY ROLLUP (type)""")
def method_agreement(spark, d):
    kind = F.when(F.col("query_id") % 2 == 0, "mc").otherwise("desc").alias("type")
    best = [f.where("rank = 1").select(F.col("query_id").alias("question_id"), kind, F.col("doc_id").alias("answer")) for f in (sparse(spark, d, 3), close(spark, d, 3))]
    return fusion.agreement(*best)


@query(f"""{_HITS.replace("scored', 3", "scored', 3")}, s AS (SELECT h.query_id, h.score, len(list_intersect(list_distinct({tokens("b.text")}), {tokens("d.text")})) / len(list_distinct({tokens("b.text")})) AS share
        FROM h JOIN benchmark b ON b.item_id = h.query_id JOIN documents d ON d.doc_id = h.chunk_id WHERE method = 'bm25')
        SELECT count(*) AS hits, count(DISTINCT query_id) AS queries, round(avg(score), 6) AS avg_score, round(stddev_pop(score), 6) AS std_score, min(score) AS min_score, max(score) AS max_score, round(avg(share), 6) AS keyword_match FROM s""")
def relevance_summary(spark, d):
    return analytics.relevance_summary(_texts(spark, d, sparse(spark, d, 3)), simple)


@query(f"""WITH h AS ({retrieval.SQL["score_dominance"]}), p AS (SELECT *, CASE WHEN query_id % 2 = 0 THEN 'multiple_choice' ELSE 'descriptive' END AS type, CASE query_id % 3 WHEN 0 THEN 'BM25 유용' WHEN 1 THEN 'Vector 신뢰' ELSE 'BM25' END AS preference FROM h),
        s AS (SELECT *, CASE WHEN contains(preference, 'BM25') AND (contains(preference, '유용') OR contains(preference, '신뢰')) THEN 'bm25' WHEN contains(preference, 'Vector') AND (contains(preference, '유용') OR contains(preference, '신뢰')) THEN 'vector' ELSE 'unclear' END AS says FROM p)
        SELECT type, {", ".join(f"count(*) FILTER (dominant = '{n}') AS {n}_dominant" for n in ("bm25", "vector", "balanced"))}, {", ".join(f"count(*) FILTER (says = '{n}') AS prefers_{n}" for n in ("bm25", "vector", "unclear"))},
        round(avg(ratio), 4) AS avg_ratio, round(stddev_pop(ratio), 4) AS std_ratio FROM s GROUP BY ROLLUP (type)""")
def dominance_by_type(spark, d):
    i = F.col("query_id")
    judged = retrieval.QUERIES["score_dominance"](spark, d).withColumn("type", F.when(i % 2 == 0, "multiple_choice").otherwise("descriptive"))
    return analytics.dominance_by_type(judged.withColumn("preference", F.when(i % 3 == 0, "BM25 유용").when(i % 3 == 1, "Vector 신뢰").otherwise("BM25")))


_TWO = """(SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN 'multiple_choice' ELSE 'descriptive' END AS type, CASE WHEN doc_id % 2 = 0 THEN CAST(doc_id % 5 AS VARCHAR) WHEN doc_id % 13 = 0 THEN '' ELSE text END AS diagnostic,
        CASE WHEN doc_id % 2 = 0 THEN ' ' || CAST(doc_id % 3 AS VARCHAR) ELSE 'the ' || left(text, 60) END AS simple, source AS thought, CASE WHEN doc_id % 3 = 0 THEN text END AS evidence FROM documents)"""


@query(f"""SELECT type, count(*) FILTER (diagnostic <> '') AS generated, count(*) FILTER (diagnostic <> '' AND simple <> '' AND CASE WHEN type = 'multiple_choice' THEN trim(diagnostic) = trim(simple)
        ELSE len(list_intersect(list_distinct(list_filter(regexp_split_to_array(diagnostic, '\\s+'), lambda w: w <> '')), list_distinct(list_filter(regexp_split_to_array(simple, '\\s+'), lambda w: w <> '')))) > 5 END) AS matches,
        count(*) FILTER (length(coalesce(thought, '')) > 10) AS with_thought, count(*) FILTER (length(coalesce(evidence, '')) > 10) AS with_evidence,
        round(avg(CASE WHEN diagnostic <> '' THEN length(diagnostic) END), 6) AS avg_diagnostic_length, round(avg(CASE WHEN simple <> '' THEN length(simple) END), 6) AS avg_simple_length FROM {_TWO} GROUP BY ROLLUP (type)""")
def answer_summary(spark, d):
    """Answers of two methods, made from whole documents."""
    i, t = F.col("doc_id"), F.col("text")
    even = i % 2 == 0
    rows = documents(spark, d).select(
        F.when(even, "multiple_choice").otherwise("descriptive").alias("type"),
        F.when(even, (i % 5).cast("string")).when(i % 13 == 0, "").otherwise(t).alias("diagnostic"),
        F.when(even, F.concat(F.lit(" "), (i % 3).cast("string"))).otherwise(F.concat(F.lit("the "), F.left(t, F.lit(60)))).alias("simple"),
        F.col("source").alias("thought"),
        F.when(i % 3 == 0, t).alias("evidence"),
    )
    return analytics.answer_summary(rows)


@query(f"SELECT doc_id AS page_id, len({tokens('text')}) AS tokens, len(list_distinct({tokens('text')})) AS types FROM documents")
def token_pages(spark, d):
    return analytics.token_pages(documents(spark, d).withColumnRenamed("doc_id", "page_id"), simple)


@query(f"SELECT term, count(*) AS n, count(DISTINCT doc_id) AS pages FROM (SELECT doc_id, unnest({tokens('text')}) AS term FROM documents) GROUP BY term")
def token_frequency(spark, d):
    return analytics.token_frequency(documents(spark, d).withColumnRenamed("doc_id", "page_id"), simple)


@query("SELECT 'model ' || p_partkey AS name, round(p_size * (4 * (1 + p_partkey % 4)) / 8 * 1.3, 6) AS memory_gb, round(p_size * (4 * (1 + p_partkey % 4)) / 8 * 1.3, 6) < 24 AS fits FROM part")
def memory_estimate(spark, d):
    p = table(spark, d, "part")
    models = p.select(F.concat(F.lit("model "), F.col("p_partkey").cast("string")).alias("name"), F.col("p_size").cast("double").alias("billions"), (4 * (1 + F.col("p_partkey") % 4)).alias("bits"))
    return analytics.memory_estimate(models)


@query("SELECT count(*) AS total, count(*) FILTER (NOT bad) AS success, count(*) FILTER (bad) AS failed, round(100.0 * count(*) FILTER (NOT bad) / count(*), 1) AS success_rate FROM (SELECT DISTINCT doc_id, doc_id % 9 = 0 AS bad FROM documents)")
def build_summary(spark, d):
    rows = documents(spark, d).select(F.col("doc_id").cast("string").alias("path"), F.when(F.col("doc_id") % 9 == 0, "unreadable").alias("error"))
    return analytics.build_summary(rows.unionByName(rows))


@query("SELECT count(*) AS vectors, CAST(max(len(embedding)) AS INT) AS dimension, 0 AS cells, false AS trained FROM embeddings")
def vector_store_stats(spark, d):
    """A store that odd vectors are put into first and even ones are added to."""
    e = table(spark, d, "embeddings").select(F.col("vec_id").alias("doc_id"), F.col("embedding").alias("dv"))
    return stores.store(e.where("doc_id % 2 = 1")).add(e.where("doc_id % 2 = 0")).stats()


@query(retrieval.SQL["cosine_topk"])
def vector_store_search(spark, d):
    e = table(spark, d, "embeddings").select(F.col("vec_id").alias("doc_id"), F.col("embedding").alias("dv"))
    store = stores.store(e.where("doc_id % 2 = 1")).add(e.where("doc_id % 2 = 0"))
    q = e.where("doc_id % 50 = 0").select(F.col("doc_id").alias("query_id"), F.col("dv").alias("qv"))
    return store.search(q, 5).select("query_id", "doc_id", "score", "rank")


@query(f"SELECT count(*) AS documents, count(*) FILTER (len({tokens('text')}) = 0) AS without_postings, 0 AS without_vector, 0 AS orphans FROM documents")
def index_health(spark, d):
    docs = documents(spark, d)
    return stores.index_health(index(spark, d).postings, vectors(spark, d)[1], docs.select("doc_id"))


# --- chunks ---
@query()
def hierarchy_stats(spark, d):
    return chunking.hierarchy_stats(chunking.hierarchical(documents(spark, d)))


@query()
def overlap_report(spark, d):
    """Three sizes of chunks side by side."""
    docs = documents(spark, d)
    return chunking.overlap_report({f"{size}/{overlap}": chunking.chunk(docs, size, overlap, clean=False) for size, overlap in ((512, 50), (1024, 100), (1536, 150))})


@query()
def page_chunk_ids(spark, d):
    rows = chunking.page_chunks(documents(spark, d).withColumnRenamed("doc_id", "page_id"))
    return rows.select("page_id", "chunk_id", "chunk_index", "total_chunks", F.md5("content").alias("content"))


@query()
def paragraph_chunks(spark, d):
    return chunking.paragraphs(documents(spark, d)).select("source_id", "chunk_index", F.md5("content").alias("content"))


def _enhanced(spark, d):
    chunks = kept(documents(spark, d), "chunks-2300", lambda: chunking.hybrid(spread(documents(spark, d))))
    return chunks, kept(documents(spark, d), "chunks-2300-cut", lambda: chunking.enhance(chunks))


@query()
def enhanced_chunks(spark, d):
    return _enhanced(spark, d)[1].select("source_id", "chunk_id", "segment", "semantic_enhanced", F.md5("content").alias("content"))


@query()
def enhancement_report(spark, d):
    return analytics.enhancement(*_enhanced(spark, d))


# --- texts and pages ---
def _rerank_sql() -> str:
    t = "regexp_replace(x, '[\\s\\x{85}\\x{A0}]+', ' ', 'g')"
    for term, to in text.RERANK_TERMS.items():
        t = f"replace({t}, '{term}', '{to}')"
    t = f"regexp_replace(regexp_replace({t}, '(\\p{{Nd}}+),(\\p{{Nd}}+)', '\\1\\2', 'g'), '[^\\p{{L}}\\p{{N}}_\\s.,!?%-]', ' ', 'g')"
    return f"SELECT doc_id, md5({strip(f'regexp_replace({t}, {quoted(chr(92) + "s+")}, {quoted(" ")}, {quoted("g")})')}) AS t FROM (SELECT doc_id, text || ' risk (VaR) 1,234,567 & ROI' AS x FROM documents)"


@query(_rerank_sql())
def rerank_text(spark, d):
    return documents(spark, d).select("doc_id", F.md5(text.for_reranking(F.concat("text", F.lit(" risk (VaR) 1,234,567 & ROI")))).alias("t"))


@query(f"SELECT doc_id, md5(CASE WHEN length(t) > 2560 THEN left(t, 1280) || ' ... ' || right(t, 1280) ELSE t END) AS t FROM (SELECT doc_id, {strip(f'regexp_replace(text, {quoted(chr(92) + "s+")}, {quoted(" ")}, {quoted("g")})')} AS t FROM documents)")
def both_ends(spark, d):
    return documents(spark, d).select("doc_id", F.md5(text.both_ends(F.col("text"))).alias("t"))


def _leaks_sql() -> str:
    t = "m"
    for p in text.LEAKS:
        t = f"regexp_replace({t}, {quoted('(?is)' + p)}, '', 'g')"
    words = " + ".join(f"CAST(contains(t, '{w}') AS INT)" for w in text.LEAK_WORDS)
    return f"""WITH l AS (SELECT doc_id, CASE doc_id % 4 WHEN 0 THEN text || '{text.LEAK_START} x {text.LEAK_END} tail' WHEN 1 THEN '이 문서 페이지에서 ' || text || ' 추출해주세요. **1순위: a** ' || text || chr(10) || '### 헤더 b' || chr(10) || chr(10) || 'end' WHEN 2 THEN '우선순위 지침 변환 ' || text ELSE text || '{text.LEAK_START} y' END AS c FROM documents),
        h AS (SELECT doc_id, CASE WHEN contains(c, '{text.LEAK_START}') THEN string_split(c, '{text.LEAK_START}')[1] || coalesce(string_split(string_split(c, '{text.LEAK_START}')[2], '{text.LEAK_END}')[2], '') ELSE c END AS m FROM l),
        t AS (SELECT doc_id, {strip(t)} AS t FROM h)
        SELECT doc_id, md5(CASE WHEN length(t) < 10 OR ({words} >= 3 AND length(t) < 200) THEN '{text.NO_CONTENT}' ELSE array_to_string(list_filter(list_transform(string_split(t, chr(10)), lambda x: {strip("x")}), lambda x: x <> ''), chr(10)) END) AS t FROM t"""


@query(_leaks_sql())
def prompt_leaks(spark, d):
    i, t = F.col("doc_id"), F.col("text")
    c = F.when(i % 4 == 0, F.concat(t, F.lit(f"{text.LEAK_START} x {text.LEAK_END} tail")))
    c = c.when(i % 4 == 1, F.concat(F.lit("이 문서 페이지에서 "), t, F.lit(" 추출해주세요. **1순위: a** "), t, F.lit("\n### 헤더 b\n\nend")))
    c = c.when(i % 4 == 2, F.concat(F.lit("우선순위 지침 변환 "), t)).otherwise(F.concat(t, F.lit(f"{text.LEAK_START} y")))
    return documents(spark, d).select("doc_id", F.md5(text.drop_prompt_leaks(c)).alias("t"))


_PAGE = "'1. head' || chr(10) || text || chr(10) || '## Part ' || doc_id || chr(10) || '##### Deep'"


def _page():
    return F.concat(F.lit("1. head\n"), "text", F.lit("\n## Part "), F.col("doc_id").cast("string"), F.lit("\n##### Deep"))


@query(f"""WITH p AS (SELECT doc_id, {strip(_PAGE)} AS c FROM documents) SELECT doc_id, md5(CASE WHEN starts_with(c, '[') THEN c ELSE chr(10) || '## Page ' || doc_id || chr(10) || chr(10) || array_to_string(list_transform(list_transform(string_split(c, chr(10)), lambda x: {strip("x")}),
        lambda x: CASE WHEN regexp_matches(x, '^\\p{{Nd}}') AND regexp_matches(left(x, 10), '[.)]') AND length(x) < 100 THEN '### ' || x ELSE x END), chr(10)) END) AS page FROM p""")
def page_markdown(spark, d):
    return documents(spark, d).select("doc_id", F.md5(text.page_markdown(_page(), F.col("doc_id"), "\n")).alias("page"))


@query(f"""WITH l AS (SELECT doc_id, generate_subscripts(string_split({_PAGE}, chr(10)), 1) AS line_number, unnest(list_transform(string_split({_PAGE}, chr(10)), lambda x: {strip("x")})) AS t FROM documents),
        h AS (SELECT doc_id, line_number, least(length(t) - length(replace(t, '#', '')) - 1, 3) AS level, {strip("replace(t, '#', '')")} AS title FROM l WHERE starts_with(t, '##'))
        SELECT doc_id, CAST(line_number AS INT) AS line_number, CAST(level AS INT) AS level, title FROM h WHERE title <> '' AND NOT starts_with(title, 'Page')""")
def page_contents(spark, d):
    return documents(spark, d).select("doc_id", F.explode(text.page_contents(_page(), "\n")).alias("e")).select("doc_id", "e.line_number", "e.level", "e.title")


@query()
def page_tables(spark, d):
    """Possessive patterns are not in the oracle's pattern language."""
    made = F.concat(F.col("text"), F.lit("\n| a | b |\n| 1 | 2 |\nrow\n\n"), F.col("text"), F.lit("\nend"))
    return documents(spark, d).select("doc_id", F.posexplode(text.page_tables(made)).alias("table", "e")).select("doc_id", "table", "e.rows", F.md5("e.content").alias("content"))


@query(f"""WITH p AS (SELECT doc_id, doc_id // 10 AS doc, doc_id % 10 AS page, string_split({strip("CASE WHEN doc_id % 3 = 0 THEN '# H' || doc_id || chr(10) || text ELSE text END")}, chr(10)) AS l FROM documents),
        q AS (SELECT *, list_filter(l, lambda x: regexp_matches(x, '^#{{1,4}}\\s'))[-1] AS head, {strip("l[-1]")} AS last FROM p)
        SELECT doc, page, last_value(head IGNORE NULLS) OVER (PARTITION BY doc ORDER BY page ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS last_header, md5(lag(last) OVER w) AS last_sentence,
        coalesce(lag(NOT regexp_matches(last, '([.!?]|다\\.|요\\.|니다\\.)$') OR contains(last, '[다음 페이지에 계속]')) OVER w, false) AS continues FROM q WINDOW w AS (PARTITION BY doc ORDER BY page)""")
def page_carry(spark, d):
    """Ten documents in a row are the pages of one."""
    t = F.when(F.col("doc_id") % 3 == 0, F.concat(F.lit("# H"), F.col("doc_id").cast("string"), F.lit("\n"), "text")).otherwise(F.col("text"))
    pages = documents(spark, d).select(F.floor(F.col("doc_id") / 10).alias("doc"), (F.col("doc_id") % 10).alias("page"), t.alias("text"))
    return reports.page_carry(pages, "doc").select("doc", "page", "last_header", F.md5("last_sentence").alias("last_sentence"), "continues")


@query(f"SELECT doc_id, {' OR '.join(f'contains(text, {quoted(w)})' for w in text.VISUAL)} OR doc_id % 40 < 5 AS process, CASE WHEN doc_id % 10 > 8 THEN 'fp16' WHEN doc_id % 10 > 5 THEN 'int8' ELSE 'int4' END AS precision FROM documents")
def vision_routing(spark, d):
    i = F.col("doc_id")
    return documents(spark, d).select("doc_id", text.needs_vision(F.col("text"), i % 40).alias("process"), text.precision((i % 10) / 10).alias("precision"))


@query(f"""SELECT doc_id, md5({strip("regexp_replace(regexp_replace(regexp_replace(regexp_replace(t, '\\n{3,}', chr(10) || chr(10), 'g'), ' {2,}', ' ', 'g'), '\\[Page \\p{Nd}+\\]', '', 'g'), 'Page \\p{Nd}+ of \\p{Nd}+', '', 'g')")}) AS plain,
        md5({strip("regexp_replace(regexp_replace(t, '(?m)^#{1,6}[ \\t]*$', '', 'g'), '\\n{4,}', chr(10) || chr(10) || chr(10), 'g')")}) AS markdown FROM (SELECT doc_id, '[Page 3]  a' || chr(10) || '##  ' || chr(10) || 'Page 1 of 20' || text AS t FROM documents)""")
def page_post_process(spark, d):
    t = F.concat(F.lit("[Page 3]  a\n##  \nPage 1 of 20"), "text")
    return documents(spark, d).select("doc_id", F.md5(text.tidy_text(t)).alias("plain"), F.md5(text.tidy_markdown(t)).alias("markdown"))


@query()
def section_by_title(spark, d):
    """A section made of the whole document between two others; look-ahead is not in the oracle's pattern language."""
    made = F.concat(F.lit("# Intro\nx\n## My (Part)\n"), F.regexp_replace("text", "#", ""), F.lit("\n## Other\ny"))
    return documents(spark, d).select("doc_id", F.md5(text.section_by_title(made, "my (part)")).alias("section"), text.section_by_title(made, "absent").alias("absent"))


@query(f"SELECT doc_id, md5(array_to_string(list_filter(list_transform(regexp_split_to_array(c, '[.!?。]\\s+'), lambda s: {strip('s')}), lambda s: length(s) >= 10), '|')) AS sentences FROM (SELECT doc_id, {_clean_sql('text')} AS c FROM documents)")
def clean_sentences(spark, d):
    return documents(spark, d).select("doc_id", F.md5(F.array_join(text.clean_sentences(F.col("text")), "|")).alias("sentences"))


# --- questions and samples ---
@query("SELECT doc_id, CASE (row_number() OVER (ORDER BY doc_id) - 1) % 3 WHEN 0 THEN 'a' WHEN 1 THEN 'b' ELSE 'c' END AS type FROM (SELECT doc_id FROM documents ORDER BY doc_id LIMIT 60)")
def assigned_types(spark, d):
    return sampling.assign_types(documents(spark, d).select("doc_id"), ["a", "b", "c"], 20).select("doc_id", "type")


@query("WITH p AS (SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS pos, count(*) OVER () AS n FROM documents) SELECT doc_id, CAST(least(pos // (n // 7), 6) AS INT) AS batch FROM p")
def contiguous_batches(spark, d):
    """All rows in seven batches, the last with what is left over."""
    rows = order.places(documents(spark, d).select("doc_id"), "doc_id").select("doc_id", (F.col("place") - 1).alias("pos"))
    return rows.select("doc_id", sampling.batch_of(F.col("pos"), 7, documents(spark, d).count()).alias("batch"))


@query()
def cleaned_questions(spark, d):
    """Questions made from whole documents; tested against a plain version."""
    q = F.concat(F.lit("3) 질문 2: 다음 *설명*은 "), F.col("text"))
    return documents(spark, d).select("doc_id", F.md5(quality.clean_question(q, ("참고 문서",))).alias("question"))


@query()
def query_cache_keys(spark, d):
    rows = _texts(spark, d, sparse(spark, d, 3)).groupBy("query_id", "query").agg(F.collect_list("text").alias("texts"))
    return rows.select("query_id", rerank.query_cache_key(F.col("query"), F.col("texts"), 3).alias("key"))


@query()
def processed_texts(spark, d):
    """The mixed-language steps over whole texts; runs need back-references, which the oracle's patterns lack."""
    return documents(spark, d).select("doc_id", F.md5(text.process(F.col("text"))).alias("t"))


@query(f"SELECT doc_id, NOT regexp_matches({strip('text')}, '([.!?]|다\\.|요\\.|니다\\.)$') OR contains(text, '[다음 페이지에 계속]') AS incomplete FROM documents")
def incomplete_pages(spark, d):
    return documents(spark, d).select("doc_id", text.incomplete_page(F.col("text")).alias("incomplete"))


@query()
def cache_replay(spark, d):
    """``events`` as accesses to a cache of user and event type: hits, misses, evictions and expiries by shard, as stream state."""
    schema = table(spark, d, "events").schema
    events = spark.readStream.schema(schema).parquet(f"{d}/event[s].parquet")  # as a pattern, which may name a file as well as a folder
    accesses = events.select(F.col("event_id").alias("id"), F.concat_ws("|", "user_id", "event_type").alias("key"), "ts", F.col("value").alias("score"))
    place = f"{shared_folder(spark)}/cache-{uuid.uuid4().hex}"
    score_cache.follow(accesses, f"{place}/counts", f"{place}/checkpoint", most=8, ttl=86400.0, shards=16)
    return score_cache.counts_so_far(spark, f"{place}/counts")
