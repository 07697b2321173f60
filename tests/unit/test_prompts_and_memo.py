"""Prompts, the chunking form of cleaning, and saved memo tables on hand-made rows."""

from pyspark.sql import functions as F

from corvidex.functions import prompts, text
from corvidex.operators import rerank


def test_prompts_of_both_kinds(spark):
    """Blank contexts leave their number out; lines that begin with a digit after the first are choices."""
    rows = [("무엇인가?\n1 가\n\t2 나\n설명\n\n３ 다", ["a" * 250, "", "c", "d"])]
    df = spark.createDataFrame(rows, "q string, c array<string>")
    r = df.select(prompts.multiple_choice(F.col("q"), F.col("c")).alias("mc"), prompts.open_question(F.col("q"), F.col("c"), 5).alias("open"), prompts.chat(F.lit("s"), F.lit("u")).alias("chat")).first()
    assert r["mc"] == f"참고 자료:\n[참고1] {'a' * 200}\n[참고3] c\n\n\n문제: 무엇인가?\n\n선택지:\n1 가\n2 나\n３ 다\n\n지침: 1부터 3까지 중 하나의 숫자만 답하세요. 설명 없이 숫자만 출력하세요.\n\n정답 번호:"
    docs = "[참고문서 1]\naaaaa\n\n[참고문서 3]\nc\n\n[참고문서 4]\nd\n\n"
    assert r["open"].startswith(f"참고 문서:\n{docs}\n\n질문: {rows[0][0]}\n\n지침: \n- 참고 문서를") and r["open"].endswith("설명하세요\n\n답변:")
    assert [tuple(m) for m in r["chat"]] == [("system", "s"), ("user", "u")]


def test_cleaning_for_chunks_leaves_single_spaces(spark):
    rows = [(0, "One\n\n\n\ntwo   three.\n"), (1, None), (2, "")]
    got = {r["i"]: r["c"] for r in spark.createDataFrame(rows, "i int, t string").select("i", text.clean_for_chunking(F.col("t")).alias("c")).collect()}
    assert got == {0: "One two three.", 1: "", 2: ""}


def test_memo_is_saved_and_loaded_without_the_old(spark, tmp_path):
    memo = spark.createDataFrame([("a", 0.5, 1000.0), ("b", 0.6, 900.0), ("c", 0.7, 100.0), ("d", 0.8, 950.0)], "key string, score double, ts double")
    rerank.save_cache(memo, str(tmp_path / "m"))
    load = lambda **own: {r["key"]: r["score"] for r in rerank.load_cache(spark, str(tmp_path / "m"), F.lit(1000.0), **own).collect()}
    assert load(ttl=500.0) == {"a": 0.5, "b": 0.6, "d": 0.8}
    assert load(ttl=500.0, most=2) == {"a": 0.5, "d": 0.8}
    assert load(ttl=0.0) == {"a": 0.5}
