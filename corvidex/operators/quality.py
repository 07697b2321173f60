"""Rule-based quality scores, answer checks and validators as expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corvidex.functions.text import HANGUL, contains_any, let, strip
from corvidex.functions.tokenize import simple

# Patterns of each kind of fault
ENCODING = ("\\x{FFFD}", "[^\\x{0}-\\x{FFFF}]", "â€™|â€\"|â€˜|â€œ")
METADATA = (r"\[Page\s+\d+\]", r"목\s*차", r"참\s*고\s*문\s*헌", r"(?m)^-\s*\d+\s*-\s*$", r"\.{5,}", r"·{3,}")
REPETITION = (r"(?s)(.)\1{10,}", r"(\S+\s+)\1{5,}")
WHITESPACE = (r"\s{5,}", r"\n{4,}")
INCOMPLETE = r"\.{3,}$|등등$|기타$|미완성|작성 중|\[.*?\]$"
HAN, KANA = r"[一-鿿]", r"[぀-ゟ゠-ヿ]"
# Length bounds of answers by question type, and domain words
LENGTHS = {"multiple_choice": (1, 2), "descriptive": (50, 2000), "definition": (30, 500), "comparison": (100, 1500), "process": (100, 2000)}
DOMAIN = ("금융", "AI", "보안", "데이터", "모델", "시스템", "규제", "가이드라인", "리스크", "암호화", "인증", "감사", "컴플라이언스", "프라이버시", "알고리즘", "학습", "추론", "편향", "공격", "방어")
# Deductions by fault, weights of pipeline stages, bands
DEDUCTIONS = {"encoding_error": 30, "metadata_contamination": 20, "repetitive_pattern": 15, "excessive_whitespace": 10, "truncated_text": 25}
STAGES = {"input": 0.10, "processed": 0.15, "chunks": 0.15, "contexts": 0.25, "answer": 0.35}
ANSWER_DEDUCTIONS = {"empty_answer": 50, "too_short": 20, "too_long": 10, "off_topic": 30, "invalid_mc_answer": 40, "incomplete_answer": 25}
BANDS = ((90, "excellent"), (70, "good"), (50, "acceptable"), (30, "poor"))


def _hits(c: Column, patterns) -> Column:
    return sum((F.regexp_count(c, F.lit(p)) for p in patterns), F.lit(0))


def text_checks(c: Column, repetition: bool = True) -> Column:
    """Counts of each kind of fault; repeats need back-references, which not every engine has."""

    def checks(t: Column) -> Column:
        return F.struct(_hits(t, ENCODING).alias("encoding"), _hits(t, METADATA).alias("metadata"), (_hits(t, REPETITION) if repetition else F.lit(0)).alias("repetition"), _hits(t, WHITESPACE).alias("whitespace"), (F.length(strip(t)) < 10).alias("truncated"))

    return let(F.coalesce(c, F.lit("")), checks)


def text_score(checks: Column) -> Column:
    """100 less a deduction for each kind of fault and a little for each hit, 0 at least."""

    def scored(c: Column) -> Column:
        on = lambda test, n: F.when(test, n).otherwise(0)
        lost = on(c["encoding"] > 0, 30) + on(c["metadata"] > 0, 20) + on(c["repetition"] > 0, 15) + on(c["whitespace"] > 0, 10) + on(c["truncated"], 25)
        lost = lost + F.least(c["encoding"] * 2, F.lit(20)) + F.least(c["metadata"], F.lit(10))
        return F.greatest(F.lit(0), 100 - lost).cast("double")

    return let(checks, scored)


def relevance(answer: Column, question: Column, context: Column | None = None) -> Column:
    """Share of the question's keywords an answer holds; 0.5 without any; averaged with the overlap with a context."""
    words = F.slice(F.filter(F.regexp_extract_all(question, F.lit(f"({HANGUL}+)"), F.lit(1)), lambda w: F.length(w) >= 2), 1, 5)
    domain = F.filter(F.array(*[F.lit(d) for d in DOMAIN]), lambda d: F.contains(question, d))
    keys = F.array_union(domain, words)
    share = F.when(F.size(keys) == 0, 0.5).otherwise(F.size(F.filter(keys, lambda k: F.contains(answer, k))) / F.size(keys))
    if context is None:
        return share
    words = F.struct(*[F.array_distinct(F.split(F.lower(c), r"\s+")).alias(n) for n, c in (("a", answer), ("b", context))])
    return (share + let(words, lambda w: F.size(F.array_intersect(w["a"], w["b"])) / F.greatest(F.size(F.array_union(w["a"], w["b"])), F.lit(1)))) / 2


def answer_issues(answer: Column, question: Column, kind: Column, context: Column | None = None) -> Column:
    """Codes of what is wrong with an answer; an empty one has no other fault."""
    a = F.coalesce(answer, F.lit(""))
    low, high = F.lit(None).cast("int"), F.lit(None).cast("int")
    for name, (x, y) in LENGTHS.items():
        low, high = F.when(kind == name, x).otherwise(low), F.when(kind == name, y).otherwise(high)
    n = F.length(strip(a))
    valid = strip(a).rlike(r"^\d{1,2}$") & strip(a).try_cast("int").between(1, 99)
    found = F.array_compact(
        F.array(
            F.when(n < low, "too_short"),
            F.when(n > high, "too_long"),
            F.when((kind == "multiple_choice") & ~valid, "invalid_mc_answer"),
            F.when(relevance(a, question, context) < 0.3, "off_topic"),
            F.when(a.rlike(INCOMPLETE), "incomplete_answer"),
            F.when(a.rlike(HAN) | a.rlike(KANA), "language_mix"),
        )
    )
    return F.when(strip(a) == "", F.array(F.lit("empty_answer"))).otherwise(found)


def text_issues(checks: Column) -> Column:
    """Codes of the faults that were counted."""

    def codes(c: Column) -> Column:
        hit = {"encoding_error": c["encoding"] > 0, "metadata_contamination": c["metadata"] > 0, "repetitive_pattern": c["repetition"] > 0, "excessive_whitespace": c["whitespace"] > 0, "truncated_text": c["truncated"]}
        return F.array_compact(F.array(*[F.when(test, code) for code, test in hit.items()]))

    return let(checks, codes)


def answer_score(issues: Column) -> Column:
    """100 less a deduction for each fault of an answer, 0 at least."""
    lost = lambda own: sum((F.when(F.array_contains(own, code), n).otherwise(0) for code, n in ANSWER_DEDUCTIONS.items()), F.lit(0))
    return let(issues, lambda own: F.greatest(F.lit(0), 100 - lost(own)).cast("double"))


def mean_text_score(texts: Column, first: int) -> Column:
    """The mean score of the first texts of a list; null for an empty one."""
    scores = F.transform(F.slice(texts, 1, first), lambda t: text_score(text_checks(t)))
    return let(scores, lambda own: F.try_divide(F.aggregate(own, F.lit(0.0), lambda a, s: a + s), F.size(own)))


def pipeline_report(input_text: Column, processed: Column, chunks: Column, contexts: Column, answer: Column, question: Column, kind: Column) -> Column:
    """(score, level, passed, issues, stages): a blank text and an empty list leave their stage out, which counts 0."""
    blank = F.array().cast("array<string>")
    judge = lambda t: F.when(t != "", let(text_checks(t), lambda c: F.struct(text_score(c).alias("score"), text_issues(c).alias("issues"))))
    once = lambda c: let(F.coalesce(c, F.lit("")), judge)

    def of_contexts(own: Column) -> Column:
        none = F.size(F.coalesce(own, blank)) == 0
        found = F.when(none, answer_issues(answer, question, kind)).otherwise(let(F.array_join(own, "\n"), lambda text: answer_issues(answer, question, kind, text)))
        return F.struct(once(input_text).alias("input"), once(processed).alias("processed"), found.alias("answer"), mean_text_score(chunks, 5).alias("chunks"), mean_text_score(own, 3).alias("contexts"))

    facts = let(contexts, of_contexts)

    def report(f: Column) -> Column:
        stages = {"input": f["input"]["score"], "processed": f["processed"]["score"], "chunks": f["chunks"], "contexts": f["contexts"], "answer": answer_score(f["answer"])}
        score = F.round(pipeline_score(**stages), 6)
        issues = F.concat(F.coalesce(f["input"]["issues"], blank), F.coalesce(f["processed"]["issues"], blank), f["answer"])
        return F.struct(score.alias("score"), band(score).alias("level"), (score >= 50).alias("passed"), F.array_sort(F.array_distinct(issues)).alias("issues"), *[F.round(c, 6).alias(n) for n, c in stages.items()])

    return let(facts, report)


def pipeline_score(**stages: Column) -> Column:
    """Weighted sum of stage scores; a missing stage counts 0."""
    return sum((F.coalesce(stages.get(s, F.lit(None).cast("double")), F.lit(0.0)) * w for s, w in STAGES.items()), F.lit(0.0))


def band(score: Column) -> Column:
    out = F.when(score >= BANDS[0][0], BANDS[0][1])
    for least, name in BANDS[1:]:
        out = out.when(score >= least, name)
    return out.otherwise("unacceptable")


def question_reason(q: Column, script: str = HANGUL) -> Column:
    """The first rule a question breaks, or null."""
    t = strip(q)
    return (
        F.when(~t.endswith("?") | (F.regexp_count(t, F.lit(r"\.")) > 3), "format")
        .when(~F.length(t).between(10, 500), "length")
        .when(~t.rlike(script), "script")
    )


def validate_questions(df: DataFrame, text: str = "text", order: str = "doc_id", script: str = HANGUL) -> DataFrame:
    """``df`` with ``reason``: rules in order, then exact duplicates of an earlier row (any case)."""
    rows = df.withColumn("reason", question_reason(F.col(text), script))
    key = F.when(F.col("reason").isNull(), F.lower(F.trim(F.col(text)))).otherwise(F.concat(F.lit("#"), F.col(order).cast("string")))
    n = F.row_number().over(Window.partitionBy(key).orderBy(order))
    return rows.withColumn("reason", F.coalesce("reason", F.when(n > 1, "duplicate")))


def clean_question(c: Column, stop_phrases=(), script: str = HANGUL) -> Column:
    """The first line without numbering, labels and marks, ended by ``?``; null if it fails a check."""
    t = strip(F.substring_index(strip(c), "\n", 1))
    t = F.regexp_replace(t, r"^\d+[.)]\s*", "")
    t = F.regexp_replace(t, r"^(질문|문제|Question|Q)\s*\d*\s*[:.]\s*", "")
    t = strip(F.regexp_replace(F.regexp_replace(t, r"[*#`_]", ""), r"\s+", " "))
    bad = ~t.rlike(script) | t.rlike(HAN) | t.rlike(KANA) | ~F.length(t).between(10, 300)
    bad = bad | contains_any(t, stop_phrases) if stop_phrases else bad
    return F.when(~bad, F.when(t.endswith("?"), t).otherwise(F.concat(t, F.lit("?"))))


def valid_pair(question: Column, answer: Column, context: Column, is_mc: Column, prohibited=(), least: int = 20, most: int = 2000, script_share: float = 0.3) -> Column:
    """Checks of a question and answer pair; answers to choices are judged as numbers, not by length."""
    letters = F.regexp_count(answer, F.lit(HANGUL)) / F.greatest(F.length(answer), F.lit(1))
    a, b = F.array_distinct(simple(answer)), F.array_distinct(simple(context))
    near = F.size(F.array_intersect(a, b)) > 0.1 * F.size(a)
    number = strip(answer).rlike(r"^\d{1,2}$") & strip(answer).try_cast("int").between(1, 10)
    free = F.length(answer).between(least, most) & (letters >= script_share) & near
    ok = (F.length(question) >= 10) & F.when(is_mc, number).otherwise(free)
    return ok & ~contains_any(answer, prohibited) if prohibited else ok


def type_entropy(df: DataFrame, kind: str) -> DataFrame:
    """Shannon entropy of a column in bits, and its number of values."""
    counts = df.groupBy(kind).agg(F.count(F.lit(1)).alias("n"))
    total = counts.agg(F.sum("n").alias("t"))
    p = F.col("n") / F.col("t")
    return counts.crossJoin(F.broadcast(total)).agg(F.round(-F.sum(p * F.log2(p)), 6).alias("entropy"), F.count(F.lit(1)).alias("types"))


def diversity_score(coverage: Column, similarity: Column, unique: Column, entropy: Column) -> Column:
    return F.round(100 * (0.25 * F.least(coverage / 30, F.lit(1.0)) + 0.30 * (1 - similarity) + 0.20 * unique + 0.25 * F.least(entropy / 2.5, F.lit(1.0))), 1)
