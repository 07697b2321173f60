"""Queries over prompts, answers and generated questions, with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from corvidex.functions import questions, templates, text
from corvidex.operators import generation, quality
from corvidex.plans.base import WS, bm25_sql, documents, quoted, ranked_sql, sparse, strip, tokens
from corvidex.plans.base import questions as asked
from corvidex.plans.corpus import _ANSWER_SQL, _KINDS, _QUESTION_SQL, answered

QUERIES, SQL = {}, {}


def query(sql: str | None = None):
    def register(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return register


# prompts: every benchmark question with its three best texts, whole
_ASKED = f"""WITH {bm25_sql()}, {ranked_sql("bm", "scored", 3)}, c AS (SELECT query_id, list(text ORDER BY rank) AS contexts FROM bm JOIN documents USING (doc_id) GROUP BY query_id),
        q AS (SELECT item_id AS query_id, text || CASE WHEN item_id % 2 = 0 THEN chr(10) || '1) 보안' || chr(10) || '2. 규제' || chr(10) || '3 else' ELSE ' 차이' END AS question, coalesce(contexts, []) AS contexts FROM benchmark LEFT JOIN c ON c.query_id = item_id),
        k AS (SELECT *, list_transform(string_split(question, chr(10)), lambda x: {strip("x")}) AS parts, query_id % 2 = 0 AS mc, {{kind}} AS kind FROM q)"""


def _asked_sql(kind: str = "''") -> str:
    return _ASKED.replace("{kind}", kind)


def _with_contexts(spark, d):
    """(query_id, question, contexts, is_mc)"""
    found = sparse(spark, d, 3).join(documents(spark, d).select("doc_id", "text"), "doc_id")
    own = found.groupBy("query_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("rank", "text"))), lambda e: e["text"]).alias("contexts"))
    even = F.col("query_id") % 2 == 0
    q = asked(spark, d).select("query_id", F.concat("query", F.when(even, "\n1) 보안\n2. 규제\n3 else").otherwise(" 차이")).alias("question"))
    return q.join(own, "query_id", "left").select("query_id", "question", F.coalesce("contexts", F.array().cast("array<string>")).alias("contexts"), even.alias("is_mc"))


def _numbered_sql(label: str = "문서", cut: str = "c") -> str:
    return f"array_to_string(list_transform(contexts, lambda c, i: '[{label} ' || i || ']' || chr(10) || {cut}), chr(10) || chr(10))"


def _table_sql(kind: str, table: dict, default: str) -> str:
    return f"CASE {kind} " + " ".join(f"WHEN '{k}' THEN {quoted(v)}" for k, v in table.items()) + f" ELSE {quoted(default)} END"


_TYPE = "CASE " + " ".join("WHEN " + " OR ".join(f"contains(lower(question), '{w}')" for w in words) + f" THEN '{n}'" for n, words in questions.TYPES.items()) + " ELSE 'analysis' END"
_CONTEXT = "CASE WHEN len(contexts) > 0 THEN '[참고 문서]' || chr(10) || array_to_string(contexts[1:3], chr(10) || chr(10)) || chr(10) || chr(10) ELSE '' END"


@query(f"""{_asked_sql(_TYPE)} SELECT query_id, kind, md5('참고 문서:' || chr(10) || {_numbered_sql()} || chr(10) || chr(10) || {_table_sql("kind", templates.INSTRUCTIONS, templates.OTHER_INSTRUCTION)} || chr(10) || chr(10) || '질문: ' || question || {quoted(chr(10) + templates.CITE + chr(10) * 2 + "답변:")}) AS prompt FROM k""")
def typed_prompt(spark, d):
    rows = _with_contexts(spark, d).withColumn("kind", questions.question_type(F.col("question")))
    return rows.select("query_id", "kind", F.md5(templates.typed(F.col("question"), F.col("contexts"), F.col("kind"))["user"]).alias("prompt"))


@query(f"""{_asked_sql()} SELECT query_id, md5('참고 문서:' || chr(10) || {_numbered_sql()} || {quoted(chr(10) * 2 + "다음 질문에 대해 단계별로 추론하여 답변하세요:" + chr(10) * 2 + "질문: ")} || question || {quoted(chr(10) * 2 + templates.STEPS)}) AS prompt,
        md5({quoted("다음은 좋은 답변의 예시입니다:" + chr(10) * 2 + "예시 1:" + chr(10) + "질문: ")} || question || {quoted(chr(10) + "답변: 하나" + chr(10) * 2 + chr(10))} || question) AS shots FROM k""")
def step_prompt(spark, d):
    rows = _with_contexts(spark, d)
    shots = templates.few_shot(F.col("question"), F.array(F.struct(F.col("question").alias("question"), F.lit("하나").alias("answer"))))
    return rows.select("query_id", F.md5(templates.step_by_step(F.col("question"), F.col("contexts"))["user"]).alias("prompt"), F.md5(shots).alias("shots"))


@query(f"""{_asked_sql()}, m AS (SELECT *, greatest(4, coalesce(list_max(list_transform(list_filter(parts, lambda x: regexp_matches(x, '^\\d{{1,2}}[.) :]')), lambda x: CAST(regexp_extract(x, '^(\\d{{1,2}})', 1) AS INT))), 4)) AS most FROM k)
        SELECT query_id, md5({quoted("<|im_start|>system" + chr(10) + templates.STRICT_SYSTEM + "<|im_end|>" + chr(10) + "<|im_start|>user" + chr(10))} || {_CONTEXT} || CASE WHEN mc THEN {quoted(templates.STRICT_MC[0])} || most || {quoted(templates.STRICT_MC[1])} || question || {quoted(templates.STRICT_MC[2])}
        ELSE {quoted(templates.STRICT_OPEN[0])} || question || {quoted(templates.STRICT_OPEN[1])} END || {quoted("<|im_end|>" + chr(10) + "<|im_start|>assistant")}) AS prompt FROM m""")
def strict_prompt(spark, d):
    return _with_contexts(spark, d).select("query_id", F.md5(templates.strict(F.col("question"), F.col("contexts"), F.col("is_mc"))).alias("prompt"))


@query(f"""{_asked_sql()} SELECT query_id, md5({_CONTEXT} || '[질문]' || chr(10) || question || CASE WHEN len(list_filter(parts, lambda x: regexp_matches(x, '{questions.MC_SECOND}'))) > 0 THEN {quoted(chr(10) * 2 + "정답 번호만 출력하세요.")} ELSE {quoted(chr(10) * 2 + "간결하고 명확한 답변을 작성하세요.")} END) AS prompt FROM k""")
def plain_prompt(spark, d):
    return _with_contexts(spark, d).select("query_id", F.md5(templates.plain(F.col("question"), F.col("contexts"))).alias("prompt"))


@query(f"""{_asked_sql()}, t AS (SELECT *, array_to_string(list_filter(list_transform(contexts, lambda c, i: CASE WHEN c <> '' THEN '[참고문서 ' || i || ']' || chr(10) || left(c, 600) || chr(10) || chr(10) END), lambda x: x IS NOT NULL), '') AS docs,
        array_to_string(list_filter(parts[2:], lambda x: regexp_matches(x, '^{questions.DIGIT}')), chr(10)) AS choices, string_split(question, chr(10))[1] AS head FROM k)
        SELECT query_id, md5(CASE WHEN mc THEN '참고 문서:' || chr(10) || docs || {quoted(chr(10) * 2 + "문제: ")} || head || {quoted(chr(10) * 2 + "선택지:" + chr(10))} || choices || {quoted(chr(10) * 2 + "지침: 참고 문서를 바탕으로 가장 정확한 답을 선택하세요. 답변은 숫자만 출력하세요." + chr(10) * 2 + "정답:")}
        ELSE '참고 문서:' || chr(10) || docs || {quoted(chr(10) * 2 + "질문: ")} || question || {quoted(chr(10) * 2 + "지침: " + chr(10) + "- 참고 문서의 핵심 내용만 추출하여 답변하세요" + chr(10) + "- 2-3문장으로 간결하게 요약하세요" + chr(10) + "- 불필요한 설명은 제외하세요" + chr(10) + "- 정확한 사실만 포함하세요" + chr(10) * 2 + "답변:")} END) AS prompt FROM t""")
def teacher_prompt(spark, d):
    return _with_contexts(spark, d).select("query_id", F.md5(templates.teacher(F.col("question"), F.col("contexts"), F.col("is_mc"))["user"]).alias("prompt"))


_SUBJECT = "[" + ", ".join(f"'{k}'" for k in (*templates.SUBJECTS, "other")) + f"][doc_id % {len(templates.SUBJECTS) + 1} + 1]"


@query(f"""WITH k AS (SELECT doc_id, text, {_SUBJECT} AS kind FROM documents) SELECT doc_id, md5({quoted("<지침>" + chr(10) + "당신은 한국 금융보안원 시험 출제위원입니다. 다음 내용을 바탕으로 ")} || {_table_sql("kind", templates.SUBJECTS, "일반")} || {quoted("에 관한 질문을 하나만 작성하세요." + chr(10) * 2 + "<좋은 질문 예시>" + chr(10))} ||
        {_table_sql("kind", templates.SAMPLES, templates.SAMPLES["definition"])} || {quoted(chr(10) * 2 + templates.MAKE_RULES + chr(10) * 2 + "<참고 내용>" + chr(10))} || left(text, 1000) || {quoted(chr(10) * 2 + "질문:")}) AS prompt FROM k""")
def question_prompt(spark, d):
    """The operator's own limit of 1000 characters a chunk."""
    kinds = (*templates.SUBJECTS, "other")
    kind = F.element_at(F.array(*[F.lit(k) for k in kinds]), (F.col("doc_id") % len(kinds) + 1).cast("int"))
    return documents(spark, d).select("doc_id", F.md5(templates.make_question(F.col("text"), kind)).alias("prompt"))


# answers: whole documents as what a model returned
_SAID = f"""WITH a AS (SELECT doc_id, doc_id % 4 = 0 AS mc, CASE doc_id % 5 WHEN 0 THEN 'user ' || text WHEN 1 THEN 'first: ' || text || ' 정답: 12, 3' WHEN 2 THEN '' WHEN 3 THEN 'assistant 漢字、 답변: ' || text || '？' ELSE text END AS t FROM documents)"""


def _said(spark, d):
    i, t = F.col("doc_id"), F.col("text")
    said = F.when(i % 5 == 0, F.concat(F.lit("user "), t)).when(i % 5 == 1, F.concat(F.lit("first: "), t, F.lit(" 정답: 12, 3"))).when(i % 5 == 2, "").when(i % 5 == 3, F.concat(F.lit("assistant 漢字、 답변: "), t, F.lit("？"))).otherwise(t)
    return documents(spark, d).select("doc_id", (i % 4 == 0).alias("is_mc"), said.alias("t"))


def _replaced(c: str) -> str:
    for mark, to in questions.MARKS.items():
        c = f"replace({c}, '{mark}', '{to}')"
    return c


_LAST = lambda c, label: strip(f"string_split({c}, '{label}')[-1]")
_ALLOWED = "[" + ", ".join(f"'{w}'" for w in questions.ALLOWED) + "]"


@query(f"""{_SAID}, b AS (SELECT *, {_replaced(f"regexp_replace(t, '{questions.FOREIGN}', '', 'g')")} AS r FROM a), c AS (SELECT *, {strip("r")} AS c FROM b),
        n AS (SELECT *, list_filter(regexp_extract_all(CASE WHEN contains(c, '정답:') THEN {_LAST("c", "정답:")} WHEN contains(c, '답변:') THEN {_LAST("c", "답변:")} ELSE c END, '\\p{{Nd}}+'), lambda x: coalesce(TRY_CAST(x AS HUGEINT), 0) BETWEEN 1 AND 4) AS nums,
              array_to_string(list_filter(regexp_split_to_array(c, '{WS}+'), lambda w: w <> '' AND (NOT regexp_matches(w, '^[A-Za-z]+$') OR list_contains({_ALLOWED}, upper(w)))), ' ') AS f FROM c),
        e AS (SELECT *, CASE WHEN contains(f, '답변:') THEN {_LAST("f", "답변:")} ELSE f END AS g FROM n)
        SELECT doc_id, md5(CASE WHEN {strip("t")} = '' THEN CASE WHEN mc THEN '1' ELSE '{questions.FAILED}' END WHEN mc THEN CASE WHEN len(nums) > 0 THEN CAST(CAST(nums[1] AS INT) AS VARCHAR) ELSE '1' END
        ELSE left(CASE WHEN starts_with(g, 'assistant') THEN {strip("substr(g, 10)")} WHEN starts_with(g, 'user') THEN {strip("substr(g, 5)")} ELSE g END, 500) END) AS answer FROM e""")
def answer_parse_strict(spark, d):
    return _said(spark, d).select("doc_id", F.md5(questions.extract_strict(F.col("t"), F.col("is_mc"), F.lit(4))).alias("answer"))


@query(f"""{_SAID}, c AS (SELECT *, {strip("regexp_replace(t, '[一-鿿぀-ゟ゠-ヿ]+', '', 'g')")} AS c FROM a), f AS (SELECT *, left(CASE WHEN contains(c, ':') THEN {strip("substr(c, position(':' IN c) + 1)")} ELSE c END, 500) AS f FROM c)
        SELECT doc_id, md5(CASE WHEN t = '' THEN CASE WHEN mc THEN '1' ELSE '{questions.NO_ANSWER}' END WHEN mc THEN coalesce(nullif(regexp_extract(c, '(\\p{{Nd}}+)', 1), ''), '1') WHEN f = '' THEN '{questions.FAILED}' ELSE f END) AS answer FROM f""")
def answer_parse_colon(spark, d):
    return _said(spark, d).select("doc_id", F.md5(questions.extract_after_colon(F.col("t"), F.col("is_mc"))).alias("answer"))


@query(f"SELECT count(*) FILTER (regexp_matches({strip('answer')}, '^{questions.DIGIT}+$')) AS multiple_choice, count(*) FILTER (NOT regexp_matches({strip('answer')}, '^{questions.DIGIT}+$')) AS open_ended FROM (SELECT {_ANSWER_SQL} AS answer FROM documents)")
def answer_counts(spark, d):
    number = questions.is_number(F.col("answer"))
    return answered(spark, d).agg(F.count_if(number).alias("multiple_choice"), F.count_if(~number).alias("open_ended"))


@query(f"""WITH a AS (SELECT doc_id, doc_id % 4 = 0 AS mc, {strip("text")} AS s FROM documents),
        b AS (SELECT doc_id, mc, {strip("string_split(s, '###')[1]")} AS e, {strip("'변' || chr(10) || string_split(s || ' 7', '###')[1]")} AS f FROM a)
        SELECT doc_id, md5(CASE WHEN mc THEN coalesce(nullif(regexp_extract(f, '(\\p{{Nd}}+)', 1), ''), '1') ELSE f END) AS final_answer, md5(e) AS evidence, '유용: BM25' AS score_preference FROM b""")
def diagnosis_parse(spark, d):
    """Responses with all sections, whose evidence and answer are whole documents; a document's own ``###`` begins a section there."""
    s = text.strip(F.col("text"))
    response = F.concat(F.lit("intro\n### 문서 관련성 분석\nBM25 vs Vector: 유용: BM25\nmore\n### 근거\n"), s, F.lit("\n### 최종 답변\n"), s, F.lit(" 7"))
    return documents(spark, d).select("doc_id", questions.diagnosis(response, F.col("doc_id") % 4 == 0).alias("r")).select("doc_id", F.md5("r.final_answer").alias("final_answer"), F.md5("r.evidence").alias("evidence"), "r.score_preference")


@query(f"""WITH l AS (SELECT doc_id, {strip(f"string_split({strip("'7. 질문: ' || text")}, chr(10))[1]")} AS t FROM documents)
        SELECT doc_id, md5(regexp_replace(regexp_replace(CASE WHEN t <> '' AND NOT ends_with(t, '?') THEN t || '?' ELSE t END, '^\\p{{Nd}}+\\.\\s*', ''), '^질문[:：]\\s*', '')) AS question FROM l""")
def first_questions(spark, d):
    return documents(spark, d).select("doc_id", F.md5(questions.first_question(F.concat(F.lit("7. 질문: "), "text"))).alias("question"))


@query(f"SELECT doc_id, left({strip("regexp_replace(list_filter(list_transform(string_split(text, chr(10)), lambda x: " + strip('x') + "), lambda x: x <> '')[1], '^#+', '')")}, 50) AS title FROM documents")
def titles(spark, d):
    return documents(spark, d).select("doc_id", questions.title(F.col("text")).alias("title"))


# generated pairs: every document is a chunk
def _draw_sql(salt: str, below: int) -> str:
    return f"(CAST('0x' || substr(md5(concat_ws('|', doc_id, pair, '0{salt}')), 1, 8) AS BIGINT) % {below})"


_PAIRS = f"""WITH c AS (SELECT doc_id, text, CAST(unnest([0, 1]) AS INT) AS pair, list_filter([{", ".join(f"'{t}'" for t in generation.TERMS)}], lambda x: contains(text, x))[1:5] AS keywords FROM documents WHERE length(text) > 0),
        k AS (SELECT *, {_draw_sql("type", 100)} >= {generation.OPEN_SHARE} AS mc, coalesce(keywords[1], '{generation.TOPIC}') AS topic, coalesce(keywords[1], '{generation.TERM}') AS term FROM c),
        q AS (SELECT *, CASE WHEN mc THEN CASE {_draw_sql("mc", 2)} {" ".join(f"WHEN {i} THEN '{a}' || topic || {quoted(b + generation.CHOICES)}" for i, (a, b) in enumerate(generation.CHOICE_TEMPLATES))} END
              ELSE CASE {_draw_sql("kind", 3)} WHEN 0 THEN CASE {_draw_sql("a", 3)} {" ".join(f"WHEN {i} THEN term || {quoted(x)}" for i, x in enumerate(generation.TERM_TEMPLATES))} END
              {" ".join(f"WHEN {j} THEN CASE {_draw_sql('b', 2)} WHEN 0 THEN {quoted(x[0])} ELSE {quoted(x[1])} END" for j, x in enumerate(generation.OTHER_TEMPLATES, 1))} END END AS question FROM k),
        p AS (SELECT *, CASE WHEN mc THEN CAST({_draw_sql("answer", 4)} + 1 AS VARCHAR) ELSE {quoted(generation.ANSWER[0])} || left(text, 200) || {quoted(generation.ANSWER[1])} END AS answer FROM q)"""
_TEMPLATE = "CASE " + " ".join("WHEN " + " OR ".join(f"contains(question, '{w}')" for w in words) + f" THEN '{n}'" for n, words in questions.TEMPLATES.items()) + " ELSE 'general' END"


@query(f"""{_PAIRS} SELECT doc_id AS source_chunk_id, pair, CASE WHEN mc THEN 'multiple_choice' ELSE 'open_ended' END AS question_type, md5(question) AS question, md5(answer) AS answer, {_TEMPLATE} AS template_type, len(keywords) AS keywords, CAST(length(text) AS INT) AS context_length,
        length(question) >= 10 AND CASE WHEN mc THEN TRY_CAST(answer AS INT) BETWEEN 1 AND 10 ELSE length(answer) BETWEEN 20 AND 512 AND len(regexp_extract_all(answer, '[가-힣]')) / length(answer) >= 0.3
        AND len(list_intersect(list_distinct({tokens("answer")}), {tokens("text")})) > 0.1 * len(list_distinct({tokens("answer")})) END AND NOT ({" OR ".join(f"contains(answer, '{w}')" for w in generation.PROHIBITED)}) AS valid FROM p""")
def generated_pairs(spark, d):
    made = generation.pairs(documents(spark, d), 2, "doc_id", "text")
    return made.select("source_chunk_id", "pair", "question_type", F.md5("question").alias("question"), F.md5("answer").alias("answer"), "template_type", F.size("keywords").cast("long").alias("keywords"), "context_length", "valid")


@query(f"{_PAIRS} SELECT count(*) AS total, count(DISTINCT question) AS unique_questions, round(100.0 * count(*) / 3000, 1) AS success_rate, round(100.0 * (count(*) - count(DISTINCT question)) / count(*), 1) AS duplicate_rate FROM p")
def generation_report(spark, d):
    return generation.generation_report(generation.pairs(documents(spark, d), 2, "doc_id", "text"), 3000)


@query(f"""{_PAIRS} SELECT CASE WHEN mc THEN 'multiple_choice' ELSE 'open_ended' END AS question_type, count(*) AS n, round(avg(length(answer)), 6) AS avg_answer_length, round(count(*) / (SELECT count(*) FROM p), 6) AS share FROM p GROUP BY ALL""")
def dataset_meta(spark, d):
    return generation.dataset_meta(generation.pairs(documents(spark, d), 2, "doc_id", "text"))


@query(f"""WITH q AS (SELECT doc_id, {_ANSWER_SQL} AS answer, {_QUESTION_SQL} AS question, [{", ".join(f"'{k}'" for k in _KINDS)}][doc_id % {len(_KINDS)} + 1] AS kind FROM documents),
        k AS (SELECT *, list_distinct(list_concat(list_filter([{", ".join(f"'{w}'" for w in quality.DOMAIN)}], lambda x: contains(question, x)), list_filter(regexp_extract_all(question, '[가-힣]+'), lambda w: length(w) >= 2)[1:5])) AS keys FROM q)
        SELECT doc_id, round(CASE WHEN len(keys) = 0 THEN 0.5 ELSE len(list_filter(keys, lambda x: contains(answer, x))) / len(keys) END, 6) AS relevance FROM k""")
def answer_relevance(spark, d):
    return answered(spark, d).select("doc_id", F.round(quality.relevance(F.col("answer"), F.col("question")), 6).alias("relevance"))


@query()
def pipeline_quality(spark, d):
    """Reports of whole documents as input, cleaned text, chunks and contexts; the repetition rule has no SQL."""
    rows = answered(spark, d).join(documents(spark, d).select("doc_id", "text"), "doc_id")
    t = F.col("text")
    chunks = F.when(F.col("doc_id") % 3 == 0, F.array().cast("array<string>")).otherwise(F.split(t, "\n"))
    report = quality.pipeline_report(t, text.clean(t, normalise=False), chunks, F.split(t, r"\. "), F.col("answer"), F.col("question"), F.col("kind"))
    return rows.select("doc_id", report.alias("r")).select("doc_id", "r.score", "r.level", "r.passed", F.array_join("r.issues", ",").alias("issues"), *[F.col(f"r.{s}").alias(f"{s}_score") for s in quality.STAGES])
