"""Question understanding, prompts and answers as Column expressions."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from corvidex.functions.text import WS, let, strip

# Forms of a choice line
CHOICES = (r"^\s*(\p{Nd}+)\s*[.)]\s*(.+)$", r"^\s*([①②③④⑤⑥⑦⑧⑨⑩])\s*(.+)$", r"^\s*([가나다라마바사아자차카타파하])\s*[.)]\s*(.+)$", r"^\s*([ㄱㄴㄷㄹㅁㅂㅅㅇㅈㅊㅋㅌㅍㅎ])\s*[.)]\s*(.+)$", r"^\s*([A-Za-z])\s*[.)]\s*(.+)$")
# Words of multiple-choice and of open questions
MC_WORDS = ("다음 중", "아래 중", "선택", "고르", "맞는 것", "틀린 것", "해당하는 것", "옳은 것", "올바른 것", "적절한 것")
OPEN_WORDS = ("설명하", "서술하", "논하", "분석하", "평가하", "제시하", "작성하", "기술하", "정의하", "비교하", "요약하")
# Question types in the order they are tried
TYPES = {
    "definition": ("무엇", "정의", "개념", "의미", "란"),
    "procedure": ("어떻게", "방법", "절차", "단계", "과정"),
    "comparison": ("차이", "비교", "대조", "vs", "장단점"),
    "analysis": ("분석", "평가", "검토", "영향", "효과"),
    "compliance": ("규제", "법규", "준수", "요구사항", "가이드라인"),
    "security": ("보안", "위험", "취약", "공격", "방어", "보호"),
}
# Template types in the order they are tried
TEMPLATES = {"definition": ("정의", "무엇"), "comparison": ("차이", "비교"), "application": ("적용", "구현"), "security": ("보안", "취약")}
CIRCLED = "①②③④⑤⑥⑦⑧⑨⑩"
# What numbers a choice in order, after plain digits
NUMBERED = (CIRCLED, "가나다라마바사아자차카타파하", "ㄱㄴㄷㄹㅁㅂㅅㅇㅈㅊㅋㅌㅍㅎ", "ABCDEFGHIJ")
# Fixed value: characters that count as a digit; with decimal digits these are superscript, subscript, circled and bracketed ones up to nine
DIGIT = r"[\p{Nd}²³¹⁰⁴-⁹₀-₉①-⑨⑴-⑼⒈-⒐⓪⓵-⓽⓿❶-❾➀-➈➊-➒]"
# Default answers and words that mark a broken generation
NO_ANSWER = "답변 없음"
NOT_FOUND = "해당 질문에 대한 구체적인 답변은 참고 문서에서 찾을 수 없습니다."
FAILED = "답변을 생성할 수 없습니다."
IMAGE_WORDS = ("placeholder", "image", "img", "png", "jpg")


def lines(q: Column) -> Column:
    return F.transform(F.split(q, "\n"), strip)


def _count(q: Column, pattern: str) -> Column:
    return F.size(F.filter(lines(q), lambda x: x.rlike(pattern)))


MC_LINE, MC_DIGIT, MC_SECOND = rf"(?s)^{DIGIT}([.) ]|.[.) ])", rf"(?s)^{DIGIT}.", rf"(?s)^{DIGIT}[.) :]."


def mc_lines(q: Column) -> Column:
    """Two lines or more that begin with a digit and have a dot, bracket or space among their first three characters."""
    return _count(q, MC_LINE) >= 2


def mc_digits(q: Column) -> Column:
    """Two lines or more that begin with a digit."""
    return _count(q, MC_DIGIT) >= 2


def mc_second(q: Column) -> Column:
    """Two lines or more of a digit and a dot, bracket, space or colon."""
    return _count(q, MC_SECOND) >= 2


def _is_choice(x: Column) -> Column:
    out = x.rlike(CHOICES[0])
    for p in CHOICES[1:]:
        out = out | x.rlike(p)
    return out


def choice_count(q: Column) -> Column:
    return F.size(F.filter(lines(q), _is_choice))


def keyword_score(q: Column, words) -> Column:
    return F.least(F.lit(1.0), 0.3 * F.size(F.filter(F.array(*[F.lit(w) for w in words]), lambda w: F.contains(q, w))))


def classify(q: Column) -> Column:
    """(type, confidence): by distinct choices, then by keywords; multiple choice wins only if strictly ahead; nothing is sure of a blank question."""
    t = F.coalesce(q, F.lit(""))
    n, m, o = F.size(choices(t)), keyword_score(t, MC_WORDS), keyword_score(t, OPEN_WORDS)
    kind = F.when(n >= 2, "multiple_choice").when((n == 0) & (m > o), "multiple_choice").otherwise("open_ended")
    sure = F.when(t == "", 0.0).when(n >= 2, 0.95).when(n == 1, 0.3).when(m > o, F.least(m, F.lit(0.7))).when(o > 0, F.least(o, F.lit(0.8))).otherwise(0.6)
    return F.struct(kind.alias("question_type"), F.round(sure, 6).alias("confidence"))


def choice_number(key: Column, circled: bool = False) -> Column:
    """A choice's key as a number: digits as they are, letters by their place.  Circled digits up to nine count as digits
    and stay as they are, unless they are asked for as numbers too."""
    out = F.when(key.rlike(rf"^{DIGIT}+$"), key) if not circled else F.when(key.rlike(r"^\p{Nd}+$"), key)
    for row in NUMBERED:
        at = F.instr(F.lit(row), F.upper(key) if row[0] == "A" else key)
        out = out.when(at > 0, at.cast("string"))
    return out.otherwise(key)


def choices(q: Column, circled: bool = False) -> Column:
    """Map of choice number to text; later lines replace earlier ones of the same number."""

    def entry(x: Column) -> Column:
        key, value = F.lit(None).cast("string"), F.lit(None).cast("string")
        for p in reversed(CHOICES):
            hit = x.rlike(p)
            key, value = F.when(hit, F.regexp_extract(x, p, 1)).otherwise(key), F.when(hit, F.regexp_extract(x, p, 2)).otherwise(value)
        return F.struct(choice_number(key, circled).alias("key"), strip(value).alias("value"))

    # the last line of a number wins, as in a dictionary, whatever the session's map policy
    def last(found: Column) -> Column:
        keys = F.array_distinct(F.transform(found, lambda e: e["key"]))
        return F.map_from_entries(let(F.reverse(found), lambda r: F.transform(keys, lambda k: F.get(F.filter(r, lambda e: e["key"] == k), F.lit(0)))))

    return let(F.transform(F.filter(lines(q), _is_choice), entry), last)


def question_part(q: Column) -> Column:
    return F.array_join(F.filter(lines(q), lambda x: (x != "") & ~_is_choice(x)), " ")


def max_choice(q: Column) -> Column:
    """The largest number a line begins with, 4 at least."""
    heads = F.transform(F.filter(lines(q), lambda x: x.rlike(r"^\d{1,2}[.) :]")), lambda x: F.regexp_extract(x, r"^(\d{1,2})", 1).cast("int"))
    return F.greatest(F.lit(4), F.coalesce(F.array_max(heads), F.lit(4)))


def _first_match(q: Column, table: dict, default: str) -> Column:
    def first(t: Column) -> Column:
        out = None
        for name, words in table.items():
            test = reduce(or_, [F.contains(t, F.lit(w)) for w in words])
            out = F.when(test, name) if out is None else out.when(test, name)
        return out.otherwise(default)

    return let(q, first)


def question_type(q: Column) -> Column:
    return _first_match(F.lower(q), TYPES, "analysis")


def template_type(q: Column) -> Column:
    return _first_match(q, TEMPLATES, "general")


def extract_answer(text: Column, is_mc: Column) -> Column:
    """Production parsing: strips images, links and Han or Kana; a number for choices, the first line after a label else."""
    t = F.coalesce(text, F.lit(""))
    c = F.regexp_replace(t, r"!\[.*?\]\(.*?\)", "")
    c = F.regexp_replace(c, r"https?://[^\s]+", "")
    c = strip(F.regexp_replace(c, r"[一-鿿぀-ゟ゠-ヿ]+", ""))
    broken = F.exists(F.array(*[F.lit(w) for w in IMAGE_WORDS]), lambda w: F.contains(F.lower(c), w))
    after = lambda label: strip(F.substring(c, F.instr(c, label) + len(label), F.length(c)))
    labelled = F.when(F.contains(c, F.lit("답변:")), after("답변:")).when(F.contains(c, F.lit("답:")), after("답:")).otherwise(c)
    first = F.left(strip(F.substring_index(labelled, "\n", 1)), F.lit(500))
    number = F.coalesce(F.nullif(F.regexp_extract(c, r"(\d+)", 1), F.lit("")), F.lit("1"))
    return (
        F.when(t == "", F.when(is_mc, "1").otherwise(NO_ANSWER))
        .when(broken, F.when(is_mc, "1").otherwise(NOT_FOUND))
        .when(is_mc, number)
        .otherwise(F.when(first == "", FAILED).otherwise(first))
    )


def number_within(text: Column, most: Column, default: str | None = None) -> Column:
    """The first number from 1 to ``most``; else ``default`` or, without one, the first number, else 1."""
    found = F.regexp_extract_all(text, F.lit(r"(\p{Nd}+)"), F.lit(1))
    inside = F.filter(found, lambda n: n.try_cast("decimal(38,0)").between(F.lit(1), most))
    rest = F.get(found, F.lit(0)) if default is None else F.lit(None).cast("string")
    return F.coalesce(F.get(F.transform(inside, lambda n: n.cast("int").cast("string")), F.lit(0)), rest, F.lit(default or "1"))


# English words that may stay in an answer, and Han or Kana marks with what they become
ALLOWED = ("API", "CPU", "GPU", "URL", "DNS", "SQL", "VPN", "SSL", "TLS", "HTTP", "HTTPS")
FOREIGN = r"[\x{4E00}-\x{9FFF}\x{3040}-\x{309F}\x{30A0}-\x{30FF}\x{3000}-\x{303F}]+"
MARKS = {"，": ", ", "、": ", ", "。": ". ", "：": ": ", "？": "?", "！": "!", "（": "(", "）": ")"}


def _after_last(c: Column, label: str) -> Column:
    return strip(F.element_at(F.split(c, label, -1), -1))


def extract_strict(text: Column, is_mc: Column, most: Column) -> Column:
    """Parsing B: a number within the choices or 1; else a text without other scripts, English words or echoed roles, 500 characters at most."""
    t = F.coalesce(text, F.lit(""))
    c = F.regexp_replace(t, FOREIGN, "")
    for mark, to in MARKS.items():
        c = F.replace(c, F.lit(mark), F.lit(to))
    c = strip(c)
    number = number_within(F.when(F.contains(c, F.lit("정답:")), _after_last(c, "정답:")).when(F.contains(c, F.lit("답변:")), _after_last(c, "답변:")).otherwise(c), most, "1")
    english = F.array(*[F.lit(w) for w in ALLOWED])
    words = F.filter(F.split(c, WS + "+"), lambda w: (w != "") & (~w.rlike("^[A-Za-z]+$") | F.array_contains(english, F.upper(w))))
    free = F.array_join(words, " ")
    free = F.when(F.contains(free, F.lit("답변:")), _after_last(free, "답변:")).otherwise(free)
    free = F.when(F.startswith(free, F.lit("assistant")), strip(F.substring(free, 10, 1 << 30))).when(F.startswith(free, F.lit("user")), strip(F.substring(free, 5, 1 << 30))).otherwise(free)
    return F.when(strip(t) == "", F.when(is_mc, "1").otherwise(FAILED)).when(is_mc, number).otherwise(F.left(free, F.lit(500)))


def extract_after_colon(text: Column, is_mc: Column) -> Column:
    """Parsing C: the first number or 1; else what follows the first colon, 500 characters at most."""
    t = F.coalesce(text, F.lit(""))
    c = strip(F.regexp_replace(t, r"[\x{4E00}-\x{9FFF}\x{3040}-\x{309F}\x{30A0}-\x{30FF}]+", ""))
    number = F.coalesce(F.nullif(F.regexp_extract(c, r"(\p{Nd}+)", 1), F.lit("")), F.lit("1"))
    free = F.left(F.when(F.contains(c, F.lit(":")), strip(F.substring(c, F.instr(c, ":") + 1, F.length(c)))).otherwise(c), F.lit(500))
    return F.when(t == "", F.when(is_mc, "1").otherwise(NO_ANSWER)).when(is_mc, number).otherwise(F.when(free == "", FAILED).otherwise(free))


def is_number(answer: Column) -> Column:
    """Whether an answer counts as one to a multiple-choice question."""
    return F.coalesce(strip(answer).rlike(rf"^{DIGIT}+$"), F.lit(False))


def diagnosis(response: Column, is_mc: Column) -> Column:
    """The sections of a diagnostic response, the last of a kind; the heading of the answer is read as its shorter form, so
    the longer one leaves its last syllable."""
    own = F.transform(F.split(F.coalesce(response, F.lit("")), "###", -1), strip)
    last = lambda head: F.coalesce(F.try_element_at(F.filter(own, lambda s: s.startswith(head)), F.lit(-1)), F.lit(""))
    body = lambda head: strip(F.replace(last(head), F.lit(head), F.lit("")))
    rated = F.filter(own, lambda s: s.startswith("문서 관련성 분석") & F.contains(s, F.lit("BM25 vs Vector:")))
    preference = strip(F.substring_index(F.get(F.split(F.try_element_at(rated, F.lit(-1)), "BM25 vs Vector:", -1), F.lit(1)), "\n", 1))
    answer = body("최종 답")
    final = F.when(last("최종 답") == "", "").when(is_mc, F.coalesce(F.nullif(F.regexp_extract(answer, r"(\p{Nd}+)", 1), F.lit("")), F.lit("1"))).otherwise(answer)
    return F.struct(final.alias("final_answer"), body("문서 관련성 분석").alias("document_analysis"), body("사고 과정").alias("thought_process"), body("근거").alias("evidence"), F.coalesce(preference, F.lit("")).alias("score_preference"))


def first_question(text: Column) -> Column:
    """The first line as a question; the mark is added before a number or a label goes."""
    t = strip(F.substring_index(strip(text), "\n", 1))
    t = F.when((t != "") & ~t.endswith("?"), F.concat(t, F.lit("?"))).otherwise(t)
    return F.regexp_replace(F.regexp_replace(t, r"^\p{Nd}+\.\s*", ""), r"^질문[:：]\s*", "")


def title(text: Column) -> Column:
    """The first line with text, without ``#``, 50 characters at most."""
    first = F.get(F.filter(lines(text), lambda x: x != ""), F.lit(0))
    return F.left(strip(F.regexp_replace(first, "^#+", "")), F.lit(50))


def after_heading(text: Column, heading: str) -> Column:
    """The section of a ``###`` response that a heading begins."""
    own = F.filter(F.transform(F.split(text, "###"), strip), lambda s: s.startswith(heading))
    return strip(F.substring(F.get(own, F.lit(0)), len(heading) + 1, 1_000_000))


def pack_line(i: Column, text: Column) -> Column:
    return F.concat(F.lit("[문서 "), i.cast("string"), F.lit("]\n"), text, F.lit("\n"))
