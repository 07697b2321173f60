"""Recommendations and report texts over quality scores, samples and diversity, and a reader of stage logs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corvidex.operators.quality import band

# What to do about each fault, and about each stage whose score is low
ADVICE = {
    "encoding_error": "UTF-8 인코딩 설정을 확인하고 파일 재처리",
    "metadata_contamination": "텍스트 정제의 메타데이터 제거 기능 강화",
    "repetitive_pattern": "반복 패턴 제거 필터 적용",
    "excessive_whitespace": "공백 정규화 처리 강화",
    "empty_answer": "모델 생성 파라미터 조정 (temperature, max_tokens)",
    "too_short": "프롬프트에 상세 답변 요구사항 추가",
    "off_topic": "RAG 검색 정확도 개선 및 컨텍스트 품질 향상",
    "invalid_mc_answer": "객관식 답변 추출 로직 개선",
}
LOW = {
    "processed": "PDF 처리 파이프라인 개선 필요",
    "contexts": "RAG 검색 품질 개선 필요 (임베딩 모델 변경 고려)",
    "answer": "답변 생성 모델 파인튜닝 또는 프롬프트 엔지니어링 필요",
}
LOW_SCORE = 70
# Bands of the diversity score, and limits of short and medium texts
DIVERSITY = ((80, "우수한 다양성"), (60, "양호한 다양성"), (40, "보통 수준의 다양성"))
POOR_DIVERSITY = "다양성 개선 필요"
SHORT, MEDIUM = 500, 1500
PASS_SCORE = 50


def recommendations(issues: Column, **scores: Column) -> Column:
    """Advice on each fault once, in the order of ``ADVICE``, then on each stage below ``LOW_SCORE``; missing scores are fine."""
    found = [F.when(F.array_contains(issues, code), advice) for code, advice in ADVICE.items()]
    low = [F.when(scores[s] < LOW_SCORE, advice) for s, advice in LOW.items() if s in scores]
    return F.array_compact(F.array(*found, *low))


def _list(items: Column, lead) -> Column:
    return F.array_join(F.transform(items, lead), "")


def quality_report(score: Column, scores: dict[str, Column], issues: Column, advice: Column) -> Column:
    """The report of one checked pipeline run as text: score, band, verdict, stages, faults, advice."""
    parts = [F.format_string("score: %.1f/100\nlevel: %s\npassed: %s\n", score, band(score), F.when(score >= PASS_SCORE, "yes").otherwise("no"))]
    parts += [F.format_string(f"  - {name}: %.1f/100\n", c) for name, c in scores.items()]
    parts.append(F.format_string("issues: %d\n", F.size(issues)))
    parts.append(_list(issues, lambda x: F.concat(F.lit("  - "), x, F.lit("\n"))))
    parts.append(_list(advice, lambda x, i: F.concat(F.lit("  "), (i + 1).cast("string"), F.lit(". "), x, F.lit("\n"))))
    return F.concat(*parts)


def diversity_level(score: Column) -> Column:
    out = F.when(score >= DIVERSITY[0][0], DIVERSITY[0][1])
    for least, name in DIVERSITY[1:]:
        out = out.when(score >= least, name)
    return out.otherwise(POOR_DIVERSITY)


def sampling_statistics(sample: DataFrame, text: str = "text", source: str = "source") -> DataFrame:
    """One row: texts, sources covered (null counts as ``unknown``), texts a source, and texts by length, with the report text."""
    n = F.length(F.coalesce(F.col(text), F.lit("")))
    count = lambda test: F.coalesce(F.sum(F.when(test, 1).otherwise(0)), F.lit(0)).cast("long")
    own = sample.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_distinct(F.coalesce(F.col(source), F.lit("unknown"))).alias("sources"),
        count(n < SHORT).alias("short"),
        count((n >= SHORT) & (n < MEDIUM)).alias("medium"),
        count(n >= MEDIUM).alias("long"),
    ).withColumn("per_source", F.round(F.try_divide(F.col("total"), F.col("sources")), 6))
    lines = f"Total sampled chunks: %d\nNumber of documents covered: %d\n  - Short (< {SHORT}): %d\n  - Medium ({SHORT}-{MEDIUM}): %d\n  - Long (> {MEDIUM}): %d"
    return own.withColumn("report", F.format_string(lines, "total", "sources", "short", "medium", "long"))


def log_stages(lines: DataFrame, stages: list[str], text: str = "value", order: str = "line_no", log: str = "file") -> DataFrame:
    """(log, stage, order, content) of INFO and DEBUG lines, under the last stage name seen before or in them.

    Content is the fourth field between `` | ``; lines before any stage, rulers and shorter lines go.  A log is one
    sequence, so each is one group.
    """
    line = F.col(text)
    named = F.coalesce(*[F.when(F.contains(line, F.lit(s)), F.lit(s)) for s in stages])
    seen = lines.withColumn("stage", F.last(named, ignorenulls=True).over(Window.partitionBy(log).orderBy(order)))
    fields = F.split(line, r" \| ", -1)
    kept = seen.where(F.col("stage").isNotNull() & (F.contains(line, F.lit("INFO")) | F.contains(line, F.lit("DEBUG"))))
    out = kept.select(log, "stage", order, F.trim(F.get(fields, F.lit(3))).alias("content"))
    return out.where((F.col("content") != "") & ~F.contains("content", F.lit("====")))


def page_carry(pages: DataFrame, doc: str = "doc_id", page: str = "page", text: str = "text") -> DataFrame:
    """Each page with what the pages before it leave open: the last heading so far, the last line of the page before, and whether
    that page ends within a sentence."""
    from corvidex.functions.text import incomplete_page, strip

    rows = F.split(strip(F.col(text)), "\n", -1)
    heads = F.filter(rows, lambda x: x.rlike(r"^#{1,4}\s"))
    own = pages.withColumn("__head", F.when(F.size(heads) > 0, F.element_at(heads, -1))).withColumn("__last", strip(F.element_at(rows, -1)))
    w = Window.partitionBy(doc).orderBy(page)
    header = F.last("__head", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, -1))
    out = own.withColumn("last_header", header).withColumn("last_sentence", F.lag("__last").over(w)).withColumn("continues", F.coalesce(F.lag(incomplete_page(F.col("__last"))).over(w), F.lit(False)))
    return out.drop("__head", "__last")
