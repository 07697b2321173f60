"""Queries over text functions, questions, chunks, samples, quality and incremental processing, with their SQL."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from corvidex.functions import prompts, questions, text
from corvidex.operators import analytics, chunking, quality, reports, sampling, similar
from corvidex.plans.base import WS, documents, spread, strip, table
from corvidex.sources import files, html

QUERIES, SQL = {}, {}


def query(sql: str | None = None):
    def register(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return register


def _clean_sql(c: str) -> str:
    out = f"translate(nfc_normalize({c}), chr(160) || chr(12288) || chr(8201) || chr(8195) || chr(8194) || chr(8203) || chr(65279), '     ')"
    for p in ("[·․．.\\-_]{3,}", "={3,}", "\\*{3,}", "#{3,}", "~{3,}", WS + "{5,}"):
        out = f"regexp_replace({out}, '{p}', ' ', 'g')"
    furniture = "(?i)^(" + "|".join(text.FURNITURE) + ")"
    out = f"array_to_string(list_filter(string_split({out}, chr(10)), lambda x: NOT regexp_matches({strip('x')}, '{furniture}')), chr(10))"
    out = f"regexp_replace({out}, '([^.\\s]+)\\s*\\.{{2,}}\\s*(\\d+)', '\\1 \\2', 'g')"
    out = f"regexp_replace({out}, '([^·\\s]+)\\s*·{{2,}}\\s*(\\d+)', '\\1 \\2', 'g')"
    return strip(f"regexp_replace({out}, '{WS}+', ' ', 'g')")


@query(f"SELECT doc_id, length(text) AS original_length, length(c) AS cleaned_length, round(1 - length(c) / greatest(length(text), 1), 6) AS reduction_rate, md5(c) AS cleaned_md5 FROM (SELECT doc_id, text, {_clean_sql('text')} AS c FROM documents)")
def clean_text_stats(spark, d):
    rows = documents(spark, d).select("doc_id", "text", text.clean(F.col("text")).alias("c"))
    return rows.select("doc_id", F.length("text").cast("long").alias("original_length"), F.length("c").cast("long").alias("cleaned_length"), F.round(1 - F.length("c") / F.greatest(F.length("text"), F.lit(1)), 6).alias("reduction_rate"), F.md5("c").alias("cleaned_md5"))


@query(f"""SELECT doc_id, coalesce(len(regexp_extract_all({strip("text")}, '[^\\p{{L}}\\p{{N}}_\\s]')) > 0.5 * length({strip("text")}) OR length({strip("text")}) < 5 OR regexp_matches({strip("text")}, '^\\p{{N}}+$')
        OR regexp_matches({strip("text")}, '(?i)^({"|".join(text.FURNITURE)})'), true) AS is_metadata FROM documents""")
def likely_metadata(spark, d):
    return documents(spark, d).select("doc_id", text.likely_metadata(F.col("text")).alias("is_metadata"))


@query(f"SELECT doc_id, md5({strip("regexp_replace(regexp_replace(regexp_replace(regexp_replace(nfc_normalize(text), 'https?://[A-Za-z0-9$-_@.&+!*(),%\\\\]+', '[URL]', 'g'), '\\b[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\\.[A-Za-z|]{2,}\\b', '[EMAIL]', 'g'), '[^\\p{L}\\p{N}_\\s.,!?;:\\-()\\[\\]''\"％＆／]', ' ', 'g'), '" + WS + "+', ' ', 'g')")}) AS cleaned_md5 FROM documents")
def clean_mixed_text(spark, d):
    return documents(spark, d).select("doc_id", F.md5(text.clean_mixed(F.col("text"))).alias("cleaned_md5"))


@query("SELECT doc_id, len(regexp_extract_all(text, '[가-힣]+')) AS hangul, len(regexp_extract_all(text, '[a-zA-Z]+')) AS english, len(regexp_extract_all(text, '\\p{Nd}+')) AS numbers FROM documents")
def script_words(spark, d):
    c = F.col("text")
    return documents(spark, d).select("doc_id", *[F.size(f(c)).cast("long").alias(n) for n, f in (("hangul", text.hangul_words), ("english", text.english_words), ("numbers", text.numbers))])


@query(f"SELECT doc_id, len(list_filter(regexp_split_to_array(text, '[.!?。！？]\\s+'), lambda s: {strip('s')} <> '')) AS sentences FROM documents")
def sentence_counts(spark, d):
    return documents(spark, d).select("doc_id", F.size(text.sentences(F.col("text"))).cast("long").alias("sentences"))


@query("SELECT doc_id, md5(regexp_replace(replace(replace(replace(text, '％', '%'), '＄', '$'), '￦', '원'), '(\\d),(\\d{3})', '\\1\\2', 'g')) AS t FROM documents")
def financial_text(spark, d):
    return documents(spark, d).select("doc_id", F.md5(text.financial(F.col("text"))).alias("t"))


@query("SELECT doc_id, length(CASE WHEN length(text) <= 400 THEN text ELSE left(text, 200) || ' ... ' || right(text, 195) END) AS n, md5(CASE WHEN length(text) <= 400 THEN text ELSE left(text, 200) || ' ... ' || right(text, 195) END) AS t FROM documents")
def truncate_balanced(spark, d):
    c = text.truncate(F.col("text"), 400, "balanced")
    return documents(spark, d).select("doc_id", F.length(c).cast("long").alias("n"), F.md5(c).alias("t"))


@query(f"SELECT doc_id, md5({strip("regexp_replace(regexp_replace(regexp_replace(regexp_replace(text, '" + WS + "+', ' ', 'g'), '\\s*([.,!?;:])\\s*', '\\1 ', 'g'), '\\s*\\(\\s*', ' (', 'g'), '\\s*\\)\\s*', ') ', 'g')")}) AS t FROM documents")
def tidy_punctuation(spark, d):
    return documents(spark, d).select("doc_id", F.md5(text.tidy_punctuation(F.col("text"))).alias("t"))


@query()
def limit_runs(spark, d):
    """Back-references are not in the oracle's pattern language."""
    return documents(spark, d).select("doc_id", F.md5(text.limit_runs(F.col("text"))).alias("t"))


@query()
def markdown_structure(spark, d):
    return documents(spark, d).select("doc_id", text.markdown_structure(F.col("text")).alias("s")).select("doc_id", "s.*")


@query()
def html_pages(spark, d):
    return html.read_pages(table(spark, d, "pages")).select("page_id", "url", "title", F.length("text").alias("n_chars"), F.size("links").alias("n_links"), F.size("headings").alias("n_headings"), F.md5("text").alias("text_md5"))


# questions: every document whole, with choice lines of several forms at its end
_LINES = f"list_transform(string_split(text, chr(10)), lambda x: {strip('x')})"
_CHOICES_SQL = " OR ".join(f"regexp_matches(x, '{p}')" for p in questions.CHOICES)
_MC = {"a": questions.MC_LINE, "b": questions.MC_DIGIT, "c": questions.MC_SECOND}
_FORMS = {0: ("1 ", "2. ", "3) ", "2) again "), 1: ("① ", "A) ", "k. "), 2: ("나. ", "ㄷ) ", "⑩ ")}


def _made_questions_sql() -> str:
    cases = " ".join(f"WHEN {k} THEN text || " + " || ".join(f"chr(10) || '{form}' || text" for form in forms) for k, forms in _FORMS.items())
    return f"(SELECT doc_id, CASE doc_id % 4 {cases} ELSE text END AS text FROM documents)"


def made_questions(spark, d):
    t, kind = F.col("text"), F.col("doc_id") % 4
    q = F.when(F.lit(False), t)
    for k, forms in _FORMS.items():
        q = q.when(kind == k, F.concat(t, *[x for form in forms for x in (F.lit("\n" + form), t)]))
    return documents(spark, d).select("doc_id", q.otherwise(t).alias("q"))


def _choice_table_sql() -> str:
    """(doc_id, number, choice) with the last line of a number."""
    key = "CASE " + " ".join(f"WHEN regexp_matches(x, '{p}') THEN regexp_extract(x, '{p}', 1)" for p in questions.CHOICES) + " END"
    value = "CASE " + " ".join(f"WHEN regexp_matches(x, '{p}') THEN regexp_extract(x, '{p}', 2)" for p in questions.CHOICES) + " END"
    number = f"CASE WHEN regexp_matches(k, '^{questions.DIGIT}+$') THEN k " + " ".join(f"WHEN instr('{row}', {'upper(k)' if row[0] == 'A' else 'k'}) > 0 THEN CAST(instr('{row}', {'upper(k)' if row[0] == 'A' else 'k'}) AS VARCHAR)" for row in questions.NUMBERED) + " ELSE k END"
    return f"""(SELECT doc_id, number, choice FROM (SELECT doc_id, {number} AS number, {strip("v")} AS choice, row_number() OVER (PARTITION BY doc_id, {number} ORDER BY i DESC) AS n
        FROM (SELECT doc_id, i, {key} AS k, {value} AS v FROM (SELECT doc_id, unnest({_LINES}) AS x, generate_subscripts({_LINES}, 1) AS i FROM {_made_questions_sql()}) WHERE {_CHOICES_SQL})) WHERE n = 1)"""


@query(f"SELECT doc_id, {', '.join(f'len(list_filter({_LINES}, lambda x: regexp_matches(x, {chr(39)}{p}{chr(39)}))) >= 2 AS mc_{n}' for n, p in _MC.items())}, len(list_filter({_LINES}, lambda x: {_CHOICES_SQL})) >= 2 AS mc_d FROM {_made_questions_sql()}")
def mc_classify(spark, d):
    q = F.col("q")
    return made_questions(spark, d).select("doc_id", questions.mc_lines(q).alias("mc_a"), questions.mc_digits(q).alias("mc_b"), questions.mc_second(q).alias("mc_c"), (questions.choice_count(q) >= 2).alias("mc_d"))


@query(f"SELECT doc_id, md5(array_to_string(list_filter({_LINES}, lambda x: x <> '' AND NOT ({_CHOICES_SQL})), ' ')) AS part, CAST(len(list_filter({_LINES}, lambda x: {_CHOICES_SQL})) AS BIGINT) AS choices FROM {_made_questions_sql()}")
def question_parts(spark, d):
    return made_questions(spark, d).select("doc_id", F.md5(questions.question_part(F.col("q"))).alias("part"), questions.choice_count(F.col("q")).cast("long").alias("choices"))


@query(f"SELECT q.doc_id, number, md5(choice) AS choice FROM {_made_questions_sql()} q LEFT JOIN {_choice_table_sql()} c ON c.doc_id = q.doc_id")
def choice_extract(spark, d):
    found = made_questions(spark, d).select("doc_id", questions.choices(F.col("q")).alias("m"))
    return found.select("doc_id", F.explode_outer("m").alias("number", "choice")).select("doc_id", "number", F.md5("choice").alias("choice"))


def _words_sql(words) -> str:
    return f"least(1.0, 0.3 * ({' + '.join(f'CAST(contains(text, {chr(39)}{w}{chr(39)}) AS INT)' for w in words)}))"


@query(f"""WITH q AS (SELECT q.doc_id, text, coalesce(n, 0) AS n, {_words_sql(questions.MC_WORDS)} AS m, {_words_sql(questions.OPEN_WORDS)} AS o FROM {_made_questions_sql()} q LEFT JOIN (SELECT doc_id, count(*) AS n FROM {_choice_table_sql()} GROUP BY doc_id) c ON c.doc_id = q.doc_id)
        SELECT doc_id, CASE WHEN n >= 2 OR (n = 0 AND m > o) THEN 'multiple_choice' ELSE 'open_ended' END AS question_type,
        round(CASE WHEN text = '' THEN 0 WHEN n >= 2 THEN 0.95 WHEN n = 1 THEN 0.3 WHEN m > o THEN least(m, 0.7) WHEN o > 0 THEN least(o, 0.8) ELSE 0.6 END, 6) AS confidence FROM q""")
def classify_questions(spark, d):
    return made_questions(spark, d).select("doc_id", questions.classify(F.col("q")).alias("c")).select("doc_id", "c.*")


@query(f"SELECT doc_id, greatest(4, coalesce(list_max(list_transform(list_filter({_LINES}, lambda x: regexp_matches(x, '^\\d{{1,2}}[.) :]')), lambda x: CAST(regexp_extract(x, '^(\\d{{1,2}})', 1) AS INT))), 4)) AS most FROM {_made_questions_sql()}")
def max_choice(spark, d):
    return made_questions(spark, d).select("doc_id", questions.max_choice(F.col("q")).alias("most"))


def _first_sql(c: str, types: dict, default: str) -> str:
    return "CASE " + " ".join("WHEN " + " OR ".join(f"contains({c}, '{w}')" for w in words) + f" THEN '{n}'" for n, words in types.items()) + f" ELSE '{default}' END"


@query(f"SELECT doc_id, {_first_sql('lower(text)', questions.TYPES, 'analysis')} AS question_type, {_first_sql('text', questions.TEMPLATES, 'general')} AS template_type FROM documents")
def question_type(spark, d):
    return documents(spark, d).select("doc_id", questions.question_type(F.col("text")).alias("question_type"), questions.template_type(F.col("text")).alias("template_type"))


@query(f"""WITH a AS (SELECT doc_id, doc_id % 2 = 0 AS mc, {strip("regexp_replace(regexp_replace(regexp_replace('답변: ' || text, '!\\[.*?\\]\\(.*?\\)', '', 'g'), 'https?://[^\\s]+', '', 'g'), '[一-鿿぀-ゟ゠-ヿ]+', '', 'g')")} AS c FROM documents),
        b AS (SELECT doc_id, mc, c, regexp_matches(lower(c), 'placeholder|image|img|png|jpg') AS broken, {strip("substr(c, position('답변:' IN c) + 3)")} AS l FROM a)
        SELECT doc_id, md5(CASE WHEN broken THEN CASE WHEN mc THEN '1' ELSE '{questions.NOT_FOUND}' END WHEN mc THEN coalesce(nullif(regexp_extract(c, '(\\d+)', 1), ''), '1')
        ELSE coalesce(nullif(left({strip("string_split(l, chr(10))[1]")}, 500), ''), '{questions.FAILED}') END) AS answer FROM b""")
def answer_parse(spark, d):
    a = questions.extract_answer(F.concat(F.lit("답변: "), F.col("text")), F.col("doc_id") % 2 == 0)
    return documents(spark, d).select("doc_id", F.md5(a).alias("answer"))


@query("""WITH t AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC) AS n FROM conversations)
        SELECT conv_id, string_agg(role || ': ' || coalesce(text, ''), chr(10) ORDER BY turn) AS history, count(*) AS turns FROM t WHERE n <= 3 GROUP BY conv_id""")
def conversation_last3(spark, d):
    return prompts.last_turns(table(spark, d, "conversations"))


@query("""WITH t AS (SELECT conv_id, turn, role, text, lead(role) OVER w AS next_role, lead(text) OVER w AS next_text FROM conversations WHERE role IN ('user', 'assistant') WINDOW w AS (PARTITION BY conv_id ORDER BY turn)),
        p AS (SELECT conv_id, turn, text AS prompt, CASE WHEN next_role = 'assistant' THEN next_text END AS chosen FROM t WHERE role = 'user'), n AS (SELECT *, row_number() OVER (ORDER BY conv_id, turn) AS place, count(*) OVER () AS total FROM p)
        SELECT conv_id, turn, CASE WHEN place <= floor(0.9 * total) THEN 'train' ELSE 'test' END AS split, 'user' AS first_role, prompt AS first_content, chosen AS chosen_content FROM n""")
def preference_pairs(spark, d):
    """One pair per user turn, with the assistant turn that follows it; null where the user speaks again first or nobody answers."""
    c = table(spark, d, "conversations")
    turns = (c.agg(F.max("turn")).first()[0] or 0) + 1
    w = Window.partitionBy("conv_id").orderBy("turn")
    after = c.where(F.col("role").isin("user", "assistant")).select("*", F.lead("role").over(w).alias("next_role"), F.lead("text").over(w).alias("next_text")).where("role = 'user'")
    rows = after.select((F.col("conv_id") * turns + F.col("turn")).alias("at"), F.col("text").alias("prompt"), F.when(F.col("next_role") == "assistant", F.col("next_text")).alias("chosen"), F.lit("").alias("rejected"))
    turn = F.pmod("at", F.lit(turns).cast("long"))
    out = prompts.preference_pairs(rows, "at")
    return out.select(((F.col("at") - turn) / turns).cast("long").alias("conv_id"), turn.alias("turn"), "split", F.col("messages")[0]["role"].alias("first_role"), F.col("messages")[0]["content"].alias("first_content"), F.col("chosen")[0]["content"].alias("chosen_content"))


@query("""SELECT doc_id, substr(md5(text), 1, 16) AS whole_key, substr(md5(substr(text, 1, 200)), 1, 16) AS key_200, substr(md5(substr(text, 1, 500)), 1, 16) AS key_500,
        substr(md5(substr(md5(text), 1, 16) || '_0_' || substr(text, 1, 50)), 1, 16) AS chunk_id FROM documents""")
def chunk_ids_md5(spark, d):
    t = F.col("text")
    return documents(spark, d).select("doc_id", chunking.doc_key(t).alias("whole_key"), chunking.doc_key(t, 200).alias("key_200"), chunking.doc_key(t, 500).alias("key_500"), chunking.chunk_key(chunking.doc_key(t), F.lit(0), t).alias("chunk_id"))


_SECTIONS = "(SELECT doc_id, generate_subscripts(string_split(text, chr(10)), 1) AS i, unnest(string_split(text, chr(10))) AS content FROM documents)"


def _sections(spark, d):
    return documents(spark, d).select(F.col("doc_id").alias("source_id"), F.posexplode(F.split("text", "\n")).alias("section_index", "content"))


@query(f"""WITH s AS (SELECT doc_id, i, content, lag(content) OVER (PARTITION BY doc_id ORDER BY i) AS b FROM {_SECTIONS})
        SELECT doc_id AS source_id, CAST(i - 2 AS INT) AS from_section, CAST(i - 1 AS INT) AS to_section, md5(right(b, 300) || chr(10) || chr(10) || '---' || chr(10) || chr(10) || '[섹션 경계]' || chr(10) || chr(10) || '---' || chr(10) || chr(10) || left(content, 300)) AS content FROM s WHERE b IS NOT NULL""")
def boundary_chunks(spark, d):
    return chunking.boundaries(_sections(spark, d)).select("source_id", "from_section", "to_section", F.md5("content").alias("content"))


@query(f"SELECT count(*) AS chunks, count(DISTINCT doc_id) AS documents, round(avg(length(content)), 6) AS avg_size, min(length(content)) AS min_size, max(length(content)) AS max_size, CAST(sum(length(content)) AS BIGINT) AS total_chars FROM {_SECTIONS}")
def chunk_stats(spark, d):
    s = chunking.chunk_stats(_sections(spark, d).withColumnRenamed("section_index", "chunk_index"))
    return s.select("chunks", "documents", "avg_size", F.col("min_size").cast("long").alias("min_size"), F.col("max_size").cast("long").alias("max_size"), "total_chars")


@query()
def chunk_overlaps(spark, d):
    """Overlaps of any length between the chunks of a chunker with overlap."""
    return chunking.overlaps(chunking.chunk(documents(spark, d), clean=False))


@query()
def recursive_chunks(spark, d):
    return chunking.chunk(documents(spark, d)).select("source_id", "chunk_id", "chunk_index", "total_chunks", F.md5("content").alias("content"))


@query()
def hierarchical_chunks(spark, d):
    return chunking.hierarchical(documents(spark, d)).select("source_id", "chunk_id", "chunk_index", "total_chunks", "hierarchy_level", "hierarchy_path", "content_length")


@query()
def hybrid_chunks(spark, d):
    return chunking.hybrid(spread(documents(spark, d))).select("source_id", "chunk_id", "chunk_index", "total_chunks", "section", "is_boundary", F.md5("content").alias("content"))


@query()
def semantic_segments(spark, d):
    return chunking.semantic(spread(documents(spark, d))).select("source_id", "segment", "sentences", F.md5("content").alias("content"))


_BUCKET = "CASE WHEN length(text) < 500 THEN 'short' WHEN length(text) < 1500 THEN 'medium' ELSE 'long' END"


@query(f"SELECT {_BUCKET} AS bucket, count(*) AS n, round(count(*) / (SELECT count(*) FROM documents), 6) AS share FROM documents GROUP BY ALL")
def length_buckets(spark, d):
    docs = documents(spark, d)
    total = docs.agg(F.count(F.lit(1)).alias("t"))
    counts = docs.groupBy(sampling.length_bucket(F.col("text")).alias("bucket")).agg(F.count(F.lit(1)).alias("n"))
    return counts.crossJoin(F.broadcast(total)).select("bucket", "n", F.round(F.col("n") / F.col("t"), 6).alias("share"))


@query("""WITH r AS (SELECT doc_id, source, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS round, min(doc_id) OVER (PARTITION BY source) AS first_pos FROM documents)
        SELECT doc_id, source, CAST(round AS INT) AS round FROM r ORDER BY r.round, first_pos LIMIT 100""")
def round_robin_sample(spark, d):
    return sampling.round_robin(documents(spark, d).select("doc_id", "source"), 100).select("doc_id", "source", "round")


@query("SELECT doc_id FROM (SELECT doc_id, row_number() OVER (PARTITION BY trim(substr(text, 1, 100)) ORDER BY doc_id) AS n FROM documents WHERE trim(text) <> '') WHERE n = 1")
def prefix_dedupe(spark, d):
    return sampling.first_of_prefix(documents(spark, d).select("doc_id", "text")).select("doc_id")


@query("SELECT doc_id, lang FROM (SELECT doc_id, lang, row_number() OVER (PARTITION BY lang ORDER BY doc_id) AS n FROM documents) WHERE n <= 10")
def first_of_each_type(spark, d):
    return sampling.by_type(documents(spark, d).select("doc_id", "lang"), 10, "lang").select("doc_id", "lang")


@query("""WITH i AS (SELECT doc_id, source, row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1 AS i, floor(count(*) OVER (PARTITION BY source) / 3) AS m FROM documents),
        t AS (SELECT doc_id, source, CASE WHEN i < m THEN 0 WHEN i < 2 * m THEN 1 ELSE 2 END AS third FROM i),
        k AS (SELECT *, row_number() OVER (PARTITION BY source, third ORDER BY md5(doc_id || '|0')) AS k FROM t) SELECT doc_id, source, CAST(third AS INT) AS third FROM k WHERE k <= 2""")
def stratified_thirds(spark, d):
    return sampling.thirds(documents(spark, d).select("doc_id", "source"), 6).select("doc_id", "source", "third")


@query(f"""WITH f AS (SELECT doc_id, source, text FROM (SELECT *, row_number() OVER (PARTITION BY trim(substr(text, 1, 100)) ORDER BY doc_id) AS n FROM documents WHERE trim(text) <> '') WHERE n = 1),
        g AS (SELECT doc_id, source, md5(doc_id || '|0') AS d, {_BUCKET} AS bucket FROM f),
        h AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY d) AS g, row_number() OVER (PARTITION BY bucket ORDER BY d) AS b FROM g)
        SELECT doc_id, source, bucket FROM h ORDER BY g > 2, b, d LIMIT 100""")
def diverse_sample(spark, d):
    return sampling.diverse(documents(spark, d).select("doc_id", "source", "text"), 100).select("doc_id", "source", "bucket")


@query("SELECT d.doc_id FROM documents d ANTI JOIN labels l USING (doc_id)")
def anti_join_new_docs(spark, d):
    return files.new_files(documents(spark, d).select("doc_id"), table(spark, d, "labels"), "doc_id")


@query("""WITH h AS (SELECT doc_id AS name, CASE WHEN doc_id % 7 = 0 THEN n_chars + 1 ELSE n_chars END AS size FROM documents WHERE doc_id % 5 <> 0)
        SELECT d.doc_id AS name, d.n_chars AS size FROM documents d LEFT JOIN h ON h.name = d.doc_id WHERE h.name IS NULL OR h.size <> d.n_chars""")
def changed_docs(spark, d):
    raw = documents(spark, d).select(F.col("doc_id").alias("name"), F.col("n_chars").alias("size"))
    history = raw.where("name % 5 <> 0").withColumn("size", F.when(F.col("name") % 7 == 0, F.col("size") + 1).otherwise(F.col("size")))
    return files.changed_files(raw, history)


@query()
def text_quality_score(spark, d):
    """Back-references of the repetition rule are not in the oracle's pattern language."""
    return documents(spark, d).select("doc_id", quality.text_checks(F.col("text")).alias("c")).select("doc_id", quality.text_score(F.col("c")).alias("score"), (F.col("c.repetition") > 0).alias("repetitive_pattern"))


# answers: every document answers a question of several kinds that shares a word with it or not
_KINDS = tuple(quality.LENGTHS)
_QUESTION_SQL = "'What about ' || CASE WHEN doc_id % 3 = 0 THEN '데이터 보안' WHEN doc_id % 3 = 1 THEN '모델의 AI 규제' ELSE 'nothing' END"
_ANSWER_SQL = "CASE WHEN doc_id % 7 = 0 THEN CAST(doc_id % 120 AS VARCHAR) WHEN doc_id % 11 = 0 THEN '  ' WHEN doc_id % 3 = 0 THEN text || ' 데이터 ...' ELSE text END"


def answered(spark, d):
    """(doc_id, answer, question, kind) from whole documents."""
    i, t = F.col("doc_id"), F.col("text")
    question = F.concat(F.lit("What about "), F.when(i % 3 == 0, "데이터 보안").when(i % 3 == 1, "모델의 AI 규제").otherwise("nothing"))
    answer = F.when(i % 7 == 0, (i % 120).cast("string")).when(i % 11 == 0, "  ").when(i % 3 == 0, F.concat(t, F.lit(" 데이터 ..."))).otherwise(t)
    kind = F.element_at(F.array(*[F.lit(k) for k in _KINDS]), (i % len(_KINDS) + 1).cast("int"))
    return documents(spark, d).select("doc_id", answer.alias("answer"), question.alias("question"), kind.alias("kind"))


def _issues_sql() -> str:
    low = "CASE kind " + " ".join(f"WHEN '{k}' THEN {a}" for k, (a, _) in quality.LENGTHS.items()) + " END"
    high = "CASE kind " + " ".join(f"WHEN '{k}' THEN {b}" for k, (_, b) in quality.LENGTHS.items()) + " END"
    domain = "[" + ", ".join(f"'{w}'" for w in quality.DOMAIN) + "]"
    a = strip("answer")
    return f"""WITH q AS (SELECT doc_id, {_ANSWER_SQL} AS answer, {_QUESTION_SQL} AS question, [{", ".join(f"'{k}'" for k in _KINDS)}][doc_id % {len(_KINDS)} + 1] AS kind FROM documents),
        k AS (SELECT *, list_distinct(list_concat(list_filter({domain}, lambda x: contains(question, x)), list_filter(regexp_extract_all(question, '[가-힣]+'), lambda w: length(w) >= 2)[1:5])) AS keys FROM q),
        r AS (SELECT *, CASE WHEN len(keys) = 0 THEN 0.5 ELSE len(list_filter(keys, lambda x: contains(answer, x))) / len(keys) END AS relevance FROM k)
        SELECT doc_id, CASE WHEN {a} = '' THEN 'empty_answer' ELSE array_to_string(list_filter([CASE WHEN length({a}) < {low} THEN 'too_short' END, CASE WHEN length({a}) > {high} THEN 'too_long' END,
        CASE WHEN kind = 'multiple_choice' AND NOT (regexp_matches({a}, '^\\d{{1,2}}$') AND coalesce(TRY_CAST({a} AS INT), 0) BETWEEN 1 AND 99) THEN 'invalid_mc_answer' END, CASE WHEN relevance < 0.3 THEN 'off_topic' END,
        CASE WHEN regexp_matches(answer, '\\.{{3,}}$|등등$|기타$|미완성|작성 중|\\[.*?\\]$') THEN 'incomplete_answer' END, CASE WHEN regexp_matches(answer, '[一-鿿぀-ゟ゠-ヿ]') THEN 'language_mix' END], lambda x: x IS NOT NULL), ',') END AS issues FROM r"""


@query(_issues_sql())
def answer_quality_flags(spark, d):
    flags = quality.answer_issues(F.col("answer"), F.col("question"), F.col("kind"))
    return answered(spark, d).select("doc_id", F.array_join(flags, ",").alias("issues"))


@query()
def quality_advice(spark, d):
    """With the repetition rule in the score, so without SQL."""
    issues = quality.answer_issues(F.col("answer"), F.col("question"), F.col("kind"))
    score = quality.text_score(quality.text_checks(F.col("answer")))
    return answered(spark, d).select("doc_id", F.array_join(reports.recommendations(issues, answer=score), "; ").alias("advice"))


@query("""SELECT *, printf('Total sampled chunks: %d' || chr(10) || 'Number of documents covered: %d' || chr(10) || '  - Short (< 500): %d' || chr(10) || '  - Medium (500-1500): %d' || chr(10) || '  - Long (> 1500): %d', total, sources, short, medium, long) AS report
        FROM (SELECT count(*) AS total, count(DISTINCT coalesce(source, 'unknown')) AS sources, count(*) FILTER (n < 500) AS short, count(*) FILTER (n >= 500 AND n < 1500) AS medium, count(*) FILTER (n >= 1500) AS long,
        round(count(*) / count(DISTINCT coalesce(source, 'unknown')), 6) AS per_source FROM (SELECT source, length(coalesce(text, '')) AS n FROM documents))""")
def sampling_report(spark, d):
    return reports.sampling_statistics(documents(spark, d))


@query("""WITH c AS (SELECT coalesce(lang, 'none') AS kind, count(*) AS n FROM documents GROUP BY ALL), e AS (SELECT round(-sum(n / t * log2(n / t)), 6) AS entropy FROM c, (SELECT sum(n) AS t FROM c)),
        u AS (SELECT count(DISTINCT source) AS coverage, count(DISTINCT text) / count(*) AS uniq FROM documents),
        s AS (SELECT coverage, entropy, round(100 * (0.25 * least(coverage / 30, 1.0) + 0.30 * uniq + 0.20 * uniq + 0.25 * least(entropy / 2.5, 1.0)), 1) AS score FROM u, e)
        SELECT coverage, entropy, score, CASE WHEN score >= 80 THEN '우수한 다양성' WHEN score >= 60 THEN '양호한 다양성' WHEN score >= 40 THEN '보통 수준의 다양성' ELSE '다양성 개선 필요' END AS level FROM s""")
def diversity_report(spark, d):
    """Diversity of a set of texts: kinds, sources, and how many are unlike all others (equal texts count as alike)."""
    docs = documents(spark, d).select(F.coalesce("lang", F.lit("none")).alias("kind"), "source", "text")
    own = docs.agg(F.count_distinct("source").alias("coverage"), (F.count_distinct("text") / F.count(F.lit(1))).alias("uniq"))
    both = own.crossJoin(F.broadcast(quality.type_entropy(docs, "kind")))  # one row each
    score = quality.diversity_score(F.col("coverage"), 1 - F.col("uniq"), F.col("uniq"), F.col("entropy"))
    return both.select("coverage", "entropy", score.alias("score")).withColumn("level", reports.diversity_level(F.col("score")))


@query(f"""WITH q AS (SELECT doc_id, text || '?' AS text FROM documents), r AS (SELECT doc_id, text, CASE WHEN NOT ends_with({strip("text")}, '?') OR len(regexp_extract_all({strip("text")}, '\\.')) > 3 THEN 'format' WHEN NOT length({strip("text")}) BETWEEN 10 AND 500 THEN 'length' WHEN NOT regexp_matches({strip("text")}, '\\p{{L}}') THEN 'script' END AS reason FROM q),
        n AS (SELECT *, row_number() OVER (PARTITION BY CASE WHEN reason IS NULL THEN lower(trim(text)) ELSE '#' || doc_id END ORDER BY doc_id) AS k FROM r)
        SELECT doc_id, coalesce(reason, CASE WHEN k > 1 THEN 'duplicate' END) AS reason FROM n""")
def validator_reasons(spark, d):
    q = documents(spark, d).select("doc_id", F.concat("text", F.lit("?")).alias("text"))
    return quality.validate_questions(q, script=r"\p{L}").select("doc_id", "reason")


@query("""WITH c AS (SELECT lang, count(*) AS n FROM documents GROUP BY lang), t AS (SELECT sum(n) AS t FROM c) SELECT round(-sum(n / t * log2(n / t)), 6) AS entropy, count(*) AS types FROM c, t""")
def type_entropy(spark, d):
    return quality.type_entropy(documents(spark, d), "lang")


@query("""SELECT lang, count(*) AS n, round(avg(length(text)), 6) AS avg_length, min(length(text)) AS min_length, max(length(text)) AS max_length FROM documents GROUP BY lang""")
def corpus_profile(spark, d):
    n = F.length("text")
    return documents(spark, d).groupBy("lang").agg(F.count(F.lit(1)).alias("n"), F.round(F.avg(n), 6).alias("avg_length"), F.min(n).cast("long").alias("min_length"), F.max(n).cast("long").alias("max_length"))


@query("SELECT time_bucket(INTERVAL '60 minutes', ts) AS start, event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY ALL")
def event_windows(spark, d):
    from corvidex.streaming.ingest import event_windows as windows

    return windows(table(spark, d, "events"))


@query("SELECT doc_id, CAST(sum(CASE WHEN l.quality = 1 THEN 1 ELSE 0 END) AS BIGINT) AS good FROM documents d JOIN labels l USING (doc_id) GROUP BY doc_id")
def label_join(spark, d):
    """Gold labels beside the documents that have one."""
    return documents(spark, d).select("doc_id").join(table(spark, d, "labels"), "doc_id").groupBy("doc_id").agg(F.sum(F.when(F.col("quality") == 1, 1).otherwise(0)).alias("good"))


@query()
def question_validation(spark, d):
    """All rules of the question validator over the passages of ``benchmark``, similarity to an accepted question among them."""
    q = table(spark, d, "benchmark").select("item_id", F.concat("text", F.lit("?")).alias("text"))
    return similar.too_similar(quality.validate_questions(q, order="item_id", script=r"\p{L}"), order="item_id").select("item_id", "reason")


@query()
def question_diversity(spark, d):
    """Mean similarity of all pairs of passages, share of distinct keywords, and the score they give with one source and kind."""
    q = table(spark, d, "benchmark")
    words = q.select(F.explode(F.filter(F.split(F.trim("text"), r"\s+"), lambda w: F.length(w) > 2)).alias("w")).agg((F.count_distinct("w") / F.count(F.lit(1))).alias("unique_ratio"))
    both = similar.mean_similarity(q, order="item_id").crossJoin(F.broadcast(words))  # one row each
    score = quality.diversity_score(F.lit(1), F.col("similarity"), F.col("unique_ratio"), F.lit(0.0))
    return both.select("pairs", F.round("similarity", 6).alias("similarity"), F.round("unique_ratio", 6).alias("unique_ratio"), score.alias("score"))


@query(f"""WITH q AS (SELECT text AS q, {_first_sql('lower(text)', questions.TYPES, 'analysis')} AS type, len(list_filter({_LINES}, lambda x: regexp_matches(x, '{questions.MC_LINE}'))) >= 2 AS mc, len(list_filter({_LINES}, lambda x: {_CHOICES_SQL})) AS options FROM {_made_questions_sql()})
        SELECT type, count(*) AS total, count(*) FILTER (mc) AS multiple_choice, count(*) FILTER (NOT mc) AS open_ended, round(avg(length(q)), 6) AS avg_length, max(length(q)) AS max_length, min(length(q)) AS min_length, round(avg(options) FILTER (mc), 6) AS avg_options
        FROM q GROUP BY ROLLUP (type)""")
def question_profile(spark, d):
    """A test set's profile: by type and in all, its questions, their lengths and choices."""
    q = F.col("q")
    rows = made_questions(spark, d).select(q.alias("text"), questions.question_type(q).alias("type"), questions.mc_lines(q).alias("is_mc"), questions.choice_count(q).alias("options"))
    return analytics.question_set_profile(rows)


@query("SELECT doc_id, md5(regexp_replace(replace(replace(replace(t, '％', '%'), '＄', '$'), '￦', '원'), '(\\d),(\\d{3})', '\\1\\2', 'g')) AS t FROM (SELECT doc_id, " + strip("regexp_replace(regexp_replace(regexp_replace(regexp_replace(nfc_normalize(regexp_replace(text, '<.*?>', '', 'g')), 'https?://[A-Za-z0-9$-_@.&+!*(),%\\\\]+', '[URL]', 'g'), '\\b[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\\.[A-Za-z|]{2,}\\b', '[EMAIL]', 'g'), '[^\\p{L}\\p{N}_\\s.,!?;:\\-()\\[\\]''\"％＆／]', ' ', 'g'), '" + WS + "+', ' ', 'g')") + " AS t FROM documents)")
def composite_text(spark, d):
    """The composite processor over whole texts: tags, mixed cleaning, paragraphs, financial signs."""
    return documents(spark, d).select("doc_id", F.md5(text.composite(F.col("text"))).alias("t"))
