"""Cleaning and scalar text functions as Column expressions.

Patterns use Unicode classes spelled out (``\\p{L}\\p{N}_``), as Java's ``\\w`` and ``\\s`` are ASCII by default.
Null texts clean to the empty string, as falsy texts do.
"""

from __future__ import annotations

import re
import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corvidex.functions import slices

#: Unicode white space as Python's ``\s`` sees it
WS = r"[\x09-\x0D\x1C-\x20\x85\xA0\u1680\u2000-\u200A\u2028\u2029\u202F\u205F\u3000]"
HANGUL = r"[가-힣]"

# Runs of symbols that become one space, in order
REPEATED = (r"[·․．.\-_]{3,}", r"={3,}", r"\*{3,}", r"#{3,}", r"~{3,}", WS + "{5,}")
# A line that starts with one of these (after stripping, any case) is page furniture
FURNITURE = (
    r"\[\s*Page\s*\d+\s*\]",
    r"\[\s*페이지\s*\d+\s*\]",
    r"\s*\d+\s*$",
    r"\s*-\s*\d+\s*-\s*$",
    r"페이지\s*\d+\s*/\s*\d+",
    r"목\s*차$",
    r"차\s*례$",
    r"CONTENTS?$",
    r"Table\s+of\s+Contents?$",
    r"부\s*록$",
    r"참\s*고\s*문\s*헌$",
    r"색\s*인$",
    r"INDEX$",
)
# Characters deleted, and characters that become a space
DELETED, SPACED = "\u200b\ufeff", "\u00a0\u3000\u2009\u2003\u2002"
FULL_WIDTH = {"％": "%", "＄": "$", "￦": "원"}


def let(value: Column, body) -> Column:
    """``body`` of a value that is computed once; an expression named in a lambda is computed at every step else."""
    return F.transform(F.array(value), body)[0]


def _composed(form: str):
    return slices.each(T.StringType(), lambda t: None if t is None else t if t.isascii() else unicodedata.normalize(form, t))


#: Canonical and compatibility composition; Spark has no function for them
nfc, nfkc = _composed("NFC"), _composed("NFKC")

#: The characters of ``WS``, for trimming without a pattern
SPACES = "".join(chr(i) for i in (*range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000))


def strip(c: Column) -> Column:
    return F.btrim(c, F.lit(SPACES))


def one_space(c: Column) -> Column:
    return strip(F.regexp_replace(c, WS + "+", " "))


def special_spaces(c: Column) -> Column:
    """Seven special code points: two vanish, five become spaces."""
    return F.translate(c, SPACED + DELETED, " " * len(SPACED))


def repeated_symbols(c: Column) -> Column:
    for p in REPEATED:
        c = F.regexp_replace(c, p, " ")
    return c


def drop_furniture(c: Column) -> Column:
    """Lines of page furniture go; the rest is joined again."""
    pattern = "(?i)^(" + "|".join(FURNITURE) + ")"
    return F.array_join(F.filter(F.split(c, "\n"), lambda x: ~strip(x).rlike(pattern)), "\n")


def contents_leaders(c: Column) -> Column:
    """``Chapter ..... 3`` becomes ``Chapter 3``."""

    def one(mark: str, pattern: str):
        return lambda t: F.when(F.contains(t, F.lit(mark * 2)), F.regexp_replace(t, pattern, "$1 $2")).otherwise(t)

    return let(let(c, one(".", r"([^.\s]+)\s*\.{2,}\s*(\d+)")), one("·", r"([^·\s]+)\s*·{2,}\s*(\d+)"))


def join_jamo(c: Column) -> Column:
    return F.regexp_replace(c, r"([ㄱ-ㅎ])\s+([ㅏ-ㅣ])", "$1$2")


def clean(c: Column, aggressive: bool = False, normalise: bool = True) -> Column:
    """The cleaning chain; white space is collapsed before any newline rule could act, so no newline is left."""
    c = F.coalesce(c, F.lit(""))
    c = contents_leaders(drop_furniture(repeated_symbols(special_spaces(nfc(c) if normalise else c))))
    c = one_space(c)
    return strip(join_jamo(c)) if aggressive else c


def clean_for_llm(c: Column, aggressive: bool = False) -> Column:
    """Aggressive cleaning without list numbers; bracketed numbers go only where ``aggressive`` was asked for."""
    c = clean(c, aggressive=True)
    c = F.regexp_replace(c, r"(?m)^\s*\d+\.\s+", "")
    c = F.regexp_replace(c, r"(?m)^\s*[가-하]\.\s+", "")
    return F.regexp_replace(c, r"\([^)]*\d+[^)]*\)", "") if aggressive else c


def clean_for_chunking(c: Column) -> Column:
    """The cleaning chain; as that leaves no newline, blank lines need no rule of their own."""
    return clean(c)


def likely_metadata(c: Column) -> Column:
    """Short, all digits, mostly special characters, or page furniture."""
    t = strip(c)
    special = F.regexp_count(t, F.lit(r"[^\p{L}\p{N}_\s]"))
    return F.coalesce((F.length(t) < 5) | t.rlike(r"^\p{N}+$") | (special > 0.5 * F.length(t)) | t.rlike("(?i)^(" + "|".join(FURNITURE) + ")"), F.lit(True))


def clean_chunk(c: Column, least: int = 50, normalise: bool = True) -> Column:
    """The cleaned chunk, or null if it is metadata or shorter than ``least`` characters."""
    return F.when(~likely_metadata(c), let(clean(c, normalise=normalise), lambda t: F.when(F.length(t) >= least, t)))


def clean_sentences(c: Column, least: int = 10) -> Column:
    return F.filter(F.transform(F.split(clean(c), r"[.!?。]\s+"), strip), lambda s: F.length(s) >= least)


def cleaning_stats(c: Column, normalise: bool = True) -> Column:
    """Lengths before and after, the share removed, and newlines before and after."""
    newlines = lambda t: F.length(t) - F.length(F.replace(t, F.lit("\n"), F.lit("")))
    old = F.coalesce(c, F.lit(""))
    of = lambda new: F.struct(F.length(old).alias("original_length"), F.length(new).alias("cleaned_length"), (1 - F.length(new) / F.greatest(F.length(old), F.lit(1))).alias("reduction_rate"), newlines(old).alias("original_newlines"), newlines(new).alias("cleaned_newlines"))
    return let(clean(c, normalise=normalise), of)


def mask_contacts(c: Column) -> Column:
    """URLs become ``[URL]`` and e-mail addresses ``[EMAIL]``."""
    c = F.regexp_replace(c, r"https?://[A-Za-z0-9$-_@.&+!*(),%\\]+", "[URL]")
    return F.regexp_replace(c, r"\b[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z|]{2,}\b", "[EMAIL]")


def clean_mixed(c: Column, normalise: bool = True) -> Column:
    """Compatibility form, masked contacts, a list of characters that stay, single spaces."""
    c = F.coalesce(c, F.lit(""))
    c = mask_contacts(nfkc(c) if normalise else c)
    c = F.regexp_replace(c, r"[^\p{L}\p{N}_\s.,!?;:\-()\[\]'\"％＆／]", " ")
    return one_space(c)


def strip_tags(c: Column) -> Column:
    return F.regexp_replace(c, "<.*?>", "")


def normal_whitespace(c: Column) -> Column:
    return one_space(F.regexp_replace(c, r"[\x00-\x1F\x7F-\x9F]", " "))


def hangul_words(c: Column) -> Column:
    return F.regexp_extract_all(c, F.lit(f"({HANGUL}+)"), F.lit(1))


def english_words(c: Column) -> Column:
    return F.regexp_extract_all(c, F.lit("([a-zA-Z]+)"), F.lit(1))


def numbers(c: Column) -> Column:
    return F.regexp_extract_all(c, F.lit(r"(\p{Nd}+)"), F.lit(1))


def sentences(c: Column) -> Column:
    return F.filter(F.split(c, r"[.!?。！？]\s+"), lambda s: strip(s) != "")


def limit_runs(c: Column, most: int = 3) -> Column:
    """Runs of one character longer than ``most`` are cut to it."""
    return F.regexp_replace(c, f"(.)\\1{{{most},}}", "$1" * most)


def full_width(c: Column) -> Column:
    for a, b in FULL_WIDTH.items():
        c = F.replace(c, F.lit(a), F.lit(b))
    return c


def financial(c: Column) -> Column:
    """Full-width signs, and one pass over thousands separators (``1,000,000`` keeps its second comma)."""
    return F.regexp_replace(full_width(c), r"(\d),(\d{3})", "$1$2")


def process(c: Column, html: bool = True, whitespace: bool = True, runs: bool = True, money: bool = True) -> Column:
    """The mixed-text steps in their order, each with a switch."""
    for use, step in ((html, strip_tags), (whitespace, normal_whitespace), (runs, limit_runs), (money, financial)):
        c = step(c) if use else c
    return c


def composite(c: Column, space=None, html: bool = True, money: bool = True) -> Column:
    """Tags, the mixed-text cleaning, ``space`` (a column function; spacing is collapsed without one) on each paragraph that holds something, financial signs.

    A blank text gives an empty one; a text whose paragraphs a provider fails on (null) stays as it was.
    """
    own = clean_mixed(strip_tags(c) if html else c)
    paragraphs = F.filter(F.split(own, "\n\n", -1), lambda p: strip(p) != "")
    spaced = F.transform(paragraphs, space or one_space)
    whole = F.when(~F.exists(spaced, lambda p: p.isNull()), F.array_join(F.filter(spaced, lambda p: p != ""), "\n\n"))
    done = let(whole, financial) if money else whole
    return F.when(strip(F.coalesce(c, F.lit(""))) == "", "").otherwise(F.coalesce(done, c))


def tidy_punctuation(c: Column) -> Column:
    """Single spaces, one space after punctuation, spaces outside brackets."""
    c = F.regexp_replace(full_width(F.coalesce(c, F.lit(""))), WS + "+", " ")
    c = F.regexp_replace(c, r"\s*([.,!?;:])\s*", "$1 ")
    c = F.regexp_replace(F.regexp_replace(c, r"\s*\(\s*", " ("), r"\s*\)\s*", ") ")
    return strip(c)


def truncate(c: Column, most: int, how: str = "end") -> Column:
    """At most ``most`` characters: the start, the end, or both around an ellipsis."""
    half = most // 2
    cut = {"end": F.left(c, F.lit(most)), "start": F.right(c, F.lit(most)), "balanced": F.concat(F.left(c, F.lit(half)), F.lit(" ... "), F.right(c, F.lit(max(most - half - 5, 0))))}[how]
    return F.when(F.length(c) <= most, c).otherwise(cut)


def merge_pages(c: Column) -> Column:
    """Page continuation marks join what they part."""
    c = F.regexp_replace(c, r"(?s)\[다음 페이지에 계속\]\s*\n+.*?\[이전 페이지에서 계속\]\s*", " ")
    c = F.regexp_replace(c, r"\[다음 페이지에 계속\]|\[이전 페이지에서 계속\]", "")
    return F.regexp_replace(c, r"\n{3,}", "\n\n")


def markdown_to_plain(c: Column) -> Column:
    """Markdown marks removed, their text kept."""
    for pattern, to in (
        (r"(?s)```.*?```", ""),
        (r"(?m)^#{1,6}\s+", ""),
        (r"\*\*([^*]+)\*\*", "$1"),
        (r"__([^_]+)__", "$1"),
        (r"\*([^*]+)\*", "$1"),
        (r"!?\[([^\]]*)\]\([^)]*\)", "$1"),
        (r"`([^`]+)`", "$1"),
        (r"(?m)^\s*[-*+]\s+", ""),
        (r"(?m)^\s*\d+\.\s+", ""),
        (r"(?m)^[-*_]{3,}\s*$", ""),
        (r"\n{3,}", "\n\n"),
    ):
        c = F.regexp_replace(c, pattern, to)
    return strip(c)


def markdown_structure(c: Column) -> Column:
    """Which marks a text has, and a weighted score of them."""
    heads, lists, tables, more = c.rlike(r"(?m)^#{1,6}\s"), c.rlike(r"(?m)^\s*[-*+]\s|^\s*\d+\.\s"), c.rlike(r"(?m)^\|.*\|"), c.contains("페이지에 계속") | c.contains("페이지에서 계속")
    count = F.regexp_count(c, F.lit(r"(?m)^#{1,6}\s"))
    paragraphs = F.filter(F.split(c, r"\n\s*\n"), lambda p: strip(p) != "")
    average = F.coalesce(F.aggregate(paragraphs, F.lit(0.0), lambda a, p: a + F.length(p)) / F.nullif(F.size(paragraphs), F.lit(0)), F.lit(0.0))
    score = sum((F.when(x, w).otherwise(0.0) for x, w in ((heads, 0.3), (lists, 0.2), (tables, 0.2), (F.size(paragraphs) > 1, 0.1), (average > 50, 0.1), (more, 0.1))), F.lit(0.0))
    return F.struct(heads.alias("has_headers"), lists.alias("has_lists"), tables.alias("has_tables"), more.alias("has_continuity"), count.alias("header_count"), F.size(paragraphs).alias("paragraph_count"), average.alias("avg_paragraph_length"), F.least(score, F.lit(1.0)).alias("structure_score"))


def incomplete_page(c: Column) -> Column:
    """A page that ends within a sentence, or says it goes on."""
    t = strip(c)
    return ~t.rlike(r"([.!?]|다\.|요\.|니다\.)$") | t.contains("[다음 페이지에 계속]")


def hierarchy_path(*headers: Column) -> Column:
    return F.coalesce(F.nullif(F.concat_ws(" > ", *headers), F.lit("")), F.lit("Root"))


def contains_any(c: Column, phrases) -> Column:
    return F.exists(F.array(*[F.lit(p) for p in phrases]), lambda p: F.contains(c, p))


# Domain terms looked for in texts
TERMS = (
    "리스크 위험 헤지 변동성 VaR 위험가치 투자 수익 손실 포트폴리오 자산 채권 주식 규제 감독 컴플라이언스 준수 법규 감사 보안 사이버 해킹 침해 인증 암호화 "
    "이익률 수익률 ROI ROE ROA P/E 은행 예금 대출 금리 이자 신용 시장 거래 매매 상장 코스피 코스닥"
).split()


def terms_in(c: Column, terms=TERMS) -> Column:
    """The terms that a text holds, any case."""
    low = F.lower(c)
    return F.filter(F.array(*[F.lit(t) for t in terms]), lambda t: F.contains(low, F.lower(t)))


def term_boost(c: Column, terms=TERMS, weight: float = 1.2) -> Column:
    return 1 + (weight - 1) * F.least(F.size(terms_in(c, terms)) / 10, F.lit(1.0))


# Terms replaced before reranking, in order
RERANK_TERMS = {"risk": "리스크", "compliance": "컴플라이언스", "portfolio": "포트폴리오", "derivative": "파생상품", "hedge": "헤지", "VaR": "위험가치", "ROI": "투자수익률", "ROE": "자기자본이익률", "P/E": "주가수익비율"}


def for_reranking(c: Column) -> Column:
    """White space collapsed, terms translated, commas between digits dropped, other marks blanked."""
    c = one_space(c)
    for term, to in RERANK_TERMS.items():
        c = F.replace(c, F.lit(term), F.lit(to))
    c = F.regexp_replace(c, r"(\p{Nd}+),(\p{Nd}+)", "$1$2")
    return one_space(F.regexp_replace(c, r"[^\p{L}\p{N}_\s.,!?%-]", " "))


def both_ends(c: Column, length: int = 512) -> Column:
    """White space collapsed; a text over five times ``length`` keeps half of that at both ends."""
    half = length * 5 // 2
    return let(one_space(c), lambda t: F.when(F.length(t) > length * 5, F.concat(F.left(t, F.lit(half)), F.lit(" ... "), F.right(t, F.lit(half)))).otherwise(t))


# What a vision model repeats of its prompt, and what it says instead of nothing
LEAK_START, LEAK_END = "<!--PROMPT_START_MARKER_DO_NOT_INCLUDE-->", "<!--PROMPT_END_MARKER_DO_NOT_INCLUDE-->"
LEAKS = (
    r"이 문서 페이지에서.*?추출해주세요[.:]*",
    r"\*\*\d+순위:.*?\*\*",
    r"위 우선순위에 따라.*?정리해주세요[.:]*",
    r"추가 지침:.*?마크다운 형식화",
    r"헤더 레벨 지정",
    r"문단과 구조",
    r"표 형식",
    r"페이지 경계 표시",
    r"특수 콘텐츠",
    r"이러한 마크다운 형식을.*?생성해주세요[.:]*",
    r"\*\*중요\*\*:.*?출력하세요[.:]*",
    r"###\s*(헤더|문단|표|페이지|특수).*?\n",
    r"-\s*[가-힣\s]*:\s*[#`\*].*?\n",
    r"\|\s*헤더\d+\s*\|.*?\n",
    r"```\s*\n.*?\n```",
    r"위의?\s*지침",
    r"다음\s*규칙",
    r"형식으로\s*변환",
)
LEAK_WORDS = ("우선순위", "추출", "지침", "형식", "변환", "생성해주세요")
NO_CONTENT = "내용 없음"


def drop_prompt_leaks(c: Column) -> Column:
    """The text without echoes of an extraction prompt; ``NO_CONTENT`` where little or only echoes are left."""
    head = F.substring_index(c, LEAK_START, 1)
    rest = F.split(F.get(F.split(c, LEAK_START, -1), F.lit(1)), LEAK_END, -1)
    c = F.when(~F.contains(c, F.lit(LEAK_START)), c).otherwise(F.concat(head, F.coalesce(F.get(rest, F.lit(1)), F.lit(""))))
    for p in LEAKS:
        c = F.regexp_replace(c, f"(?is){p}", "")

    def judged(t: Column) -> Column:
        echoes = sum((F.contains(t, F.lit(w)).cast("int") for w in LEAK_WORDS), F.lit(0))
        kept = F.array_join(F.filter(F.transform(F.split(t, "\n"), strip), lambda x: x != ""), "\n")
        return F.when((F.length(t) < 10) | ((echoes >= 3) & (F.length(t) < 200)), NO_CONTENT).otherwise(kept)

    return let(strip(c), judged)


# Signs of a table line, and words that hint at something to see
TABLE_SIGNS = ("표", "Table", "|", "│", "┌", "└", "┬", "┴")
VISUAL = ("그림", "표", "차트", "그래프", "다이어그램", "Figure", "Table", "Chart")
#: How the page formatter tells lines apart: as the two characters backslash and n, unless told otherwise
LINE_MARK = "\\n"


def page_markdown(c: Column, page: Column, mark: str = LINE_MARK) -> Column:
    """A page heading, and numbered lines of under 100 characters as headings; texts in brackets stay as they are."""
    heading = lambda x: F.when(x.rlike(r"^\p{Nd}") & F.left(x, F.lit(10)).rlike("[.)]") & (F.length(x) < 100), F.concat(F.lit("### "), x)).otherwise(x)
    parts = F.transform(F.split(strip(c), _quoted(mark), -1), lambda x: heading(strip(x)))
    whole = F.concat(F.lit(f"{mark}## Page "), page.cast("string"), F.lit(mark * 2), F.array_join(parts, mark))
    return F.when((c == "") | F.startswith(c, F.lit("[")), c).otherwise(whole)


def _quoted(mark: str) -> str:
    return re.escape(mark)


def page_tables(c: Column) -> Column:
    """Runs of lines that look like tables: from a line with a sign on, up to ten more lines of any kind, then lines with a
    sign; a blank line ends them, and so does the end of the text, but without a table.  Two lines at least."""
    sign = r"[^\n]*(?:" + "|".join(re.escape(s) for s in TABLE_SIGNS) + r")[^\n]*"
    some = rf"[^\n]*{WS.replace('[', '[^', 1)}[^\n]*"
    runs = F.regexp_extract_all(c, F.lit(rf"(?m)(^{sign}(?:\n{some}){{0,10}}+(?:\n{sign})*+)(?=\n)"), F.lit(1))
    held = F.transform(runs, lambda r: F.transform(F.split(r, "\n"), strip))
    return F.transform(F.filter(held, lambda x: F.size(x) >= 2), lambda x: F.struct(F.size(x).alias("rows"), F.array_join(x, "\n").alias("content")))


def page_contents(c: Column, mark: str = LINE_MARK) -> Column:
    """(level, title, line_number) of headings of two marks or more, but for page headings; levels end at 3."""
    rows = F.transform(F.split(c, _quoted(mark), -1), lambda x, i: F.struct(strip(x).alias("t"), (i + 1).alias("line_number")))
    heads = F.filter(rows, lambda r: F.startswith(r["t"], F.lit("##")))
    named = F.transform(heads, lambda r: F.struct(F.least(F.length(r["t"]) - F.length(F.replace(r["t"], F.lit("#"), F.lit(""))) - 1, F.lit(3)).alias("level"), strip(F.replace(r["t"], F.lit("#"), F.lit(""))).alias("title"), r["line_number"].alias("line_number")))
    return F.filter(named, lambda r: (r["title"] != "") & ~F.startswith(r["title"], F.lit("Page")))


def needs_vision(c: Column, page: Column) -> Column:
    """Pages that hint at something to see, and the first five."""
    return contains_any(c, VISUAL) | (page < 5)


def precision(importance: Column) -> Column:
    return F.when(importance > 0.8, "fp16").when(importance > 0.5, "int8").otherwise("int4")


def tidy_text(c: Column) -> Column:
    """Runs of blank lines and spaces shortened, page marks dropped."""
    c = F.regexp_replace(F.regexp_replace(c, r"\n{3,}", "\n\n"), r" {2,}", " ")
    return strip(F.regexp_replace(F.regexp_replace(c, r"\[Page \p{Nd}+\]", ""), r"Page \p{Nd}+ of \p{Nd}+", ""))


def tidy_markdown(c: Column) -> Column:
    """Headings without a title dropped, runs of blank lines shortened."""
    return strip(F.regexp_replace(F.regexp_replace(c, r"(?m)^#{1,6}\s*$", ""), r"\n{4,}", "\n\n\n"))


def section_by_title(c: Column, title: str) -> Column:
    """The plain text of the section that a heading with this title (any case) begins, up to the next heading; empty without one."""
    pattern = rf"(?is)(#{{1,6}}\s*{re.escape(title)}.*?)(?=\n#{{1,6}}\s|\z)"
    return F.coalesce(markdown_to_plain(F.regexp_extract(c, pattern, 1)), F.lit(""))
