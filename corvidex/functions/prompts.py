"""Context packing and prompts; everything around a model call is an expression."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corvidex.functions.questions import pack_line
from corvidex.functions.text import strip
from corvidex.operators import order as order_of

# System lines of the production prompts
SYSTEM_MC = "당신은 한국 금융보안 전문가입니다. 객관식 문제의 정답 번호만 답하세요."
SYSTEM_OPEN = "당신은 한국 금융보안 전문가입니다. 텍스트로만 답변하며, 이미지, 링크, URL, 마크다운 문법을 절대 사용하지 않습니다."

# The parts of the production prompts between documents, question and choices
MC_DOCS = "참고 자료:\n"
MC_QUESTION = "\n\n문제: "
MC_CHOICES = "\n\n선택지:\n"
MC_RULE = "\n\n지침: 1부터 "
MC_END = "까지 중 하나의 숫자만 답하세요. 설명 없이 숫자만 출력하세요.\n\n정답 번호:"
OPEN_DOCS = "참고 문서:\n"
OPEN_QUESTION = "\n\n질문: "
OPEN_END = """

지침: 
- 참고 문서를 바탕으로 정확한 답변을 한국어로 작성하세요
- 순수 텍스트로만 답변하세요
- 이미지, URL, 링크, 마크다운 문법을 사용하지 마세요
- 그림이나 도표가 필요한 경우 텍스트로 설명하세요
- 핵심 내용을 2-3문장으로 설명하세요

답변:"""


def pack(found: DataFrame, most: int = 2000, text: str = "text") -> DataFrame:
    """Documents of each query in rank order until the first that would exceed ``most`` characters.

    The running length only grows, so a running sum is the stopping rule.
    """
    w = Window.partitionBy("query_id").orderBy("rank")
    line = pack_line(F.row_number().over(w), F.col(text))
    rows = found.withColumn("line", line).withColumn("upto", F.sum(F.length("line")).over(w)).where(F.col("upto") <= most)
    ordered = F.array_sort(F.collect_list(F.struct("rank", "line")))
    return rows.groupBy("query_id").agg(F.array_join(F.transform(ordered, lambda e: e["line"]), "").alias("context"), F.count(F.lit(1)).alias("docs"))


def truncated(found: DataFrame, tokens: int = 500, chars: int = 3, text: str = "text") -> DataFrame:
    """A budget of ``tokens * chars`` characters; the first document over it is cut if over 100 characters remain."""
    w = Window.partitionBy("query_id").orderBy("rank")
    rows = found.withColumn("upto", F.sum(F.length(text)).over(w)).withColumn("before", F.col("upto") - F.length(text))
    left = tokens * chars - F.col("before")
    kept = F.when(F.col("upto") <= tokens * chars, F.col(text)).when(left > 100, F.concat(F.left(F.col(text), left), F.lit("...")))
    return rows.withColumn("kept", kept).where(F.col("kept").isNotNull()).select("query_id", "rank", "doc_id", "kept")


def listed(contexts: Column, most: int | None, length: int, line) -> Column:
    """The contexts that hold something, cut to ``length``, as ``line(number, text)``; a blank one keeps its number to itself."""
    own = contexts if most is None else F.slice(contexts, 1, most)
    lines = F.transform(own, lambda c, i: F.when(c != "", line((i + 1).cast("string"), F.left(c, F.lit(length)))))
    return F.array_join(F.filter(lines, lambda x: x.isNotNull()), "")


def multiple_choice(question: Column, contexts: Column) -> Column:
    """Three contexts of 200 characters, the first line, the lines after it that begin with a digit, and how many there are."""
    parts = F.split(question, "\n", -1)
    choices = F.filter(F.transform(F.slice(parts, F.lit(2), F.size(parts)), strip), lambda x: x.rlike(r"^\p{Nd}"))
    docs = listed(contexts, 3, 200, lambda i, c: F.concat(F.lit("[참고"), i, F.lit("] "), c, F.lit("\n")))
    return F.concat(F.lit(MC_DOCS), docs, F.lit(MC_QUESTION), F.get(parts, F.lit(0)), F.lit(MC_CHOICES), F.array_join(choices, "\n"), F.lit(MC_RULE), F.size(choices).cast("string"), F.lit(MC_END))


def open_question(question: Column, contexts: Column, length: int = 300) -> Column:
    """Every context cut to ``length``, the question, and how to answer it."""
    docs = listed(contexts, None, length, lambda i, c: F.concat(F.lit("[참고문서 "), i, F.lit("]\n"), c, F.lit("\n\n")))
    return F.concat(F.lit(OPEN_DOCS), docs, F.lit(OPEN_QUESTION), question, F.lit(OPEN_END))


def chat(system: Column, user: Column) -> Column:
    """Messages as a nested column."""
    message = lambda role, c: F.struct(F.lit(role).alias("role"), c.alias("content"))
    return F.array(message("system", system), message("user", user))


def last_turns(turns: DataFrame, n: int = 3, conv: str = "conv_id", turn: str = "turn") -> DataFrame:
    """The last ``n`` turns of each conversation as one text."""
    w = Window.partitionBy(conv).orderBy(F.col(turn).desc())
    rows = turns.withColumn("__n", F.row_number().over(w)).where(F.col("__n") <= n)
    line = F.concat(F.col("role"), F.lit(": "), F.coalesce("text", F.lit("")))
    ordered = F.array_sort(F.collect_list(F.struct(F.col(turn), line.alias("line"))))
    return rows.groupBy(conv).agg(F.array_join(F.transform(ordered, lambda e: e["line"]), "\n").alias("history"), F.count(F.lit(1)).alias("turns"))


def preference_pairs(rows: DataFrame, order: str, share: float = 0.9) -> DataFrame:
    """``(messages, chosen, rejected)`` arrays of messages; the first ``floor(share n)`` rows train, the rest test.

    Rows without an order come last.  Places come from ranges of the order with sums of their own, not from one ordered task.
    """
    message = lambda role, c: F.array(F.struct(F.lit(role).alias("role"), F.col(c).alias("content")))
    total = rows.agg(F.count(F.lit(1)).alias("__total"))
    placed = order_of.places(rows, order).crossJoin(F.broadcast(total))
    split = F.when(F.col("place") <= F.floor(share * F.col("__total")), "train").otherwise("test")
    return placed.select(order, split.alias("split"), message("user", "prompt").alias("messages"), message("assistant", "chosen").alias("chosen"), message("assistant", "rejected").alias("rejected"))
