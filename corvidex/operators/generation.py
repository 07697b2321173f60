"""Questions and answers made from chunks by template: draws are hashes of chunk and pair number, so a rerun makes the same."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corvidex.functions.questions import template_type
from corvidex.operators.quality import valid_pair

# Terms looked for, templates with what fills them, choices, words that spoil an answer
TERMS = ("AI", "보안", "금융", "시스템", "데이터", "모델", "리스크", "규제")
CHOICE_TEMPLATES = (("다음 중 ", "에 대한 설명으로 옳은 것은?"), ("", "의 특징으로 적절하지 않은 것은?"))
CHOICES = "\n1) 올바른 설명입니다\n2) 부분적으로 맞습니다\n3) 틀린 설명입니다\n4) 추가 정보가 필요합니다"
TERM_TEMPLATES = ("의 정의와 주요 특징을 설명하시오.", "이란 무엇이며, 금융 분야에서 어떻게 활용되는가?", "의 개념과 중요성을 서술하시오.")
OTHER_TEMPLATES = (("머신러닝를 금융 서비스에 적용할 때 고려사항은?", "이상 탐지의 실제 구현 방법과 주의점을 설명하시오."), ("금융 거래 시스템의 보안 취약점과 대응 방안은?", "사이버 공격에 대한 방어 전략을 제시하시오."))
TOPIC, TERM = "금융 AI", "금융 AI 시스템"
ANSWER = ("이 질문에 대한 답변은 다음과 같습니다. ", "... 따라서 금융 AI 시스템에서는 보안과 성능을 모두 고려해야 합니다.")
PROHIBITED = ("죄송", "모르", "알 수 없", "정보 부족")
OPEN_SHARE = 70


def draw(below: int, *key: Column) -> Column:
    """A number from 0 to ``below`` - 1 by the md5 of a key."""
    return F.pmod(F.conv(F.substring(F.md5(F.concat_ws("|", *[k.cast("string") for k in key]).cast("binary")), 1, 8), 16, 10).cast("long"), F.lit(below)).cast("int")


def keywords(text: Column) -> Column:
    return F.slice(F.filter(F.array(*[F.lit(t) for t in TERMS]), lambda t: F.contains(text, t)), 1, 5)


def _of(options, i: Column) -> Column:
    return F.element_at(F.array(*[F.lit(o) if not isinstance(o, Column) else o for o in options]), i + 1)


def pairs(chunks: DataFrame, n: int = 2, chunk_id: str = "chunk_id", text: str = "content", teacher: Column | None = None, seed: int = 0) -> DataFrame:
    """``n`` pairs of every chunk with text: question, answer, type, template type, keywords, whether it passes the checks.

    ``teacher`` is the answer of a model to the column ``question`` on the chunk's text; without one a fixed frame around the
    start of the chunk stands in.
    """
    t = F.col(text)
    rows = chunks.where(F.length(F.coalesce(t, F.lit(""))) > 0).withColumn("pair", F.explode(F.sequence(F.lit(0), F.lit(n - 1))))
    by = lambda salt, below: draw(below, F.col(chunk_id), F.col("pair"), F.lit(f"{seed}{salt}"))
    rows = rows.withColumn("keywords", keywords(t)).withColumn("is_mc", by("type", 100) >= OPEN_SHARE)
    key = F.get("keywords", F.lit(0))
    topic, term = F.coalesce(key, F.lit(TOPIC)), F.coalesce(key, F.lit(TERM))
    mc = _of([F.concat(F.lit(a), topic, F.lit(b + CHOICES)) for a, b in CHOICE_TEMPLATES], by("mc", 2))
    free = _of([_of([F.concat(term, F.lit(x)) for x in TERM_TEMPLATES], by("a", 3)), *[_of(x, by("b", 2)) for x in OTHER_TEMPLATES]], by("kind", 3))
    rows = rows.withColumn("question", F.when(F.col("is_mc"), mc).otherwise(free))
    frame = F.concat(F.lit(ANSWER[0]), F.left(t, F.lit(200)), F.lit(ANSWER[1]))
    answer = F.when(F.col("is_mc"), (by("answer", 4) + 1).cast("string")).otherwise(frame if teacher is None else teacher)
    rows = rows.withColumn("answer", answer)
    valid = valid_pair(F.col("question"), F.col("answer"), t, F.col("is_mc"), PROHIBITED, most=512)
    kind = F.when(F.col("is_mc"), "multiple_choice").otherwise("open_ended")
    return rows.select(F.col(chunk_id).alias("source_chunk_id"), "pair", kind.alias("question_type"), "question", "answer", template_type(F.col("question")).alias("template_type"), "keywords", F.length(t).alias("context_length"), valid.alias("valid"))


def generation_report(made: DataFrame, wanted: int, text: str = "question") -> DataFrame:
    """One row: questions, unique ones, the share of what was wanted, and the share of duplicates, in percent."""
    own = made.agg(F.count(F.lit(1)).alias("total"), F.count_distinct(text).alias("unique_questions"))
    percent = lambda top, of: F.coalesce(F.round(F.try_divide(100.0 * top, of), 1), F.lit(0.0))
    return own.select("total", "unique_questions", percent(F.col("total"), F.lit(wanted)).alias("success_rate"), percent(F.col("total") - F.col("unique_questions"), F.col("total")).alias("duplicate_rate"))


def dataset_meta(pairs_: DataFrame) -> DataFrame:
    """Counts, mean answer length and share by question type."""
    total = pairs_.agg(F.count(F.lit(1)).alias("t"))
    by = pairs_.groupBy("question_type").agg(F.count(F.lit(1)).alias("n"), F.round(F.avg(F.length("answer")), 6).alias("avg_answer_length"))
    return by.crossJoin(F.broadcast(total)).select("question_type", "n", "avg_answer_length", F.round(F.col("n") / F.col("t"), 6).alias("share"))
