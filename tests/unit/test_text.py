import re
import unicodedata

from pyspark.sql import functions as F

from corvidex.functions import text as T
from corvidex.functions import tokenize as K


def one(spark, value, f):
    return spark.createDataFrame([(value,)], "c string").select(f(F.col("c"))).first()[0]


def test_special_spaces_and_newlines(spark):
    assert one(spark, "a​b c　d﻿", T.special_spaces) == "ab c d"
    assert one(spark, "x\n\n\ny  z", T.clean) == "x y z"  # white space is collapsed before newline rules
    assert one(spark, None, T.clean) == ""


def test_furniture_and_leaders(spark):
    assert one(spark, "intro text\n[Page 3] junk\n- 4 -\n12\nContents\nbody", T.clean) == "intro text body"
    assert one(spark, "Chapter.. 3", T.clean) == "Chapter 3"
    assert one(spark, "### title", T.clean) == "title"  # runs of three marks go, headings with them


def test_nfc(spark):
    assert one(spark, "é", T.nfc) == unicodedata.normalize("NFC", "é")


def test_numbers_single_pass(spark):
    assert one(spark, "1,000,000", T.financial) == re.sub(r"(\d),(\d{3})", r"\1\2", "1,000,000") == "1000,000"


def test_runs_and_truncation(spark):
    assert one(spark, "aaaaab", T.limit_runs) == "aaab"
    assert one(spark, "0123456789" * 3, lambda c: T.truncate(c, 20, "balanced")) == "0123456789 ... 56789"
    assert one(spark, "short", lambda c: T.truncate(c, 20)) == "short"


def test_metadata_and_chunks(spark):
    assert one(spark, "12", T.likely_metadata) and one(spark, "?!?!?!a", T.likely_metadata)
    assert one(spark, "too short", T.clean_chunk) is None
    assert one(spark, "long enough " * 6, T.clean_chunk).startswith("long enough")


def test_pages_join(spark):
    assert one(spark, "a [다음 페이지에 계속]\n\n---\n[이전 페이지에서 계속] b", T.merge_pages) == "a  b"


def test_tokenizers(spark):
    assert one(spark, "A bc, 금융 보 x1", K.simple) == ["bc", "금융", "x1"]
    assert one(spark, "A_b 금융", K.word) == ["a_b", "금융"]
    assert one(spark, " a B ", K.blank) == ["a", "B"]
    assert one(spark, "a b c", lambda c: K.bigrams(F.split(c, " "))) == ["a b", "b c"]


def test_unit_vectors(spark):
    v = one(spark, "one two three two", lambda c: K.bucket_vector(K.simple(c)))
    assert len(v) == 64 and abs(sum(x * x for x in v) - 1) < 1e-12
    assert one(spark, "", lambda c: K.bucket_vector(K.simple(c))) == [0.0] * 64


def test_composite_processor(spark):
    """Steps in order; blank texts are empty, and a text that the spacing provider fails on stays as it was."""
    rows = [(0, "<b>총  자산</b> 1,234,567원 ％ ￦5"), (1, " \n "), (2, None), (3, "fail <i>here</i> 1,000"), (4, "a@b.co  ok")]
    df = spark.createDataFrame(rows, "i int, t string")
    space = lambda p: F.when(~F.contains(p, F.lit("fail")), T.one_space(p))
    got = {r["i"]: r["c"] for r in df.select("i", T.composite(F.col("t"), space).alias("c")).collect()}
    assert got == {0: "총 자산 1234,567원 5", 1: "", 2: "", 3: rows[3][1], 4: "[EMAIL] ok"}
    bare = df.select("i", T.composite(F.col("t"), html=False, money=False).alias("c")).where("i = 3").first()["c"]
    assert bare == "fail i here i 1,000"
