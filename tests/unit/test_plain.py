"""Chunks cut and cleaned in plain Python against the Column expressions, and that nothing is shuffled for them."""

import random

import numpy as np
from pyspark.sql import functions as F

from corvidex.functions import plain, text
from corvidex.functions.tokenize import bucket_vector, simple
from corvidex.operators import chunking, splitting
from corvidex.plans.base import spread

ODD = ["a", "B", " ", "\n", "\n\n\n", "   ", "\t", ".", "..", "...", ". ", "! ", "12", "3", "====", "***", "####", "~~~", "-", "___", "·", "··", "·3", "[Page 3]", "\n목 차\n", "INDEX", "contents", plain.NEXT_PAGE, plain.LAST_PAGE]
ODD += ["　", " ", " ", "​", "﻿", "\x85", "\r", "\x1c", "가나", "é", "İ", "ΑΣ", "①", "Ⅷ", "²", "😀", "\0", "- ", "페이지 3/4", "ſ", "K", "x..12b..3", "٣", "\n# A\n", "\n## b c\n", "\n```\n"]


def odd_texts(n, most):
    rng = random.Random(11)
    return ["".join(rng.choices(ODD, k=rng.randrange(most))) for _ in range(n)]


def test_plain_functions_equal_the_expressions(spark):
    texts = odd_texts(3000, 40)
    t = F.col("t")
    of = {"m": text.merge_pages(t), "d": text.likely_metadata(t), "c": text.clean(t, normalise=False), "k": text.clean_chunk(t, 10, normalise=False), "v": bucket_vector(simple(t))}
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, t string").select("i", *[c.alias(n) for n, c in of.items()]).collect()
    units = splitting._units(texts)
    assert len(rows) == len(texts)
    for r in rows:
        s = texts[r["i"]]
        assert (r["m"], r["d"], r["c"], r["k"]) == (plain.merge_pages(s), plain.likely_metadata(s), plain.clean(s), plain.clean_chunk(s, 10))
        assert r["v"] == units[r["i"]].tolist()


def test_words_are_forgotten_when_there_are_many(monkeypatch):
    want = plain.counts(["alpha beta x", "", "gamma\0alpha alpha"])
    monkeypatch.setattr(plain, "MOST_WORDS", 1)
    plain._places.clear()
    assert np.array_equal(plain.counts(["alpha beta x", "", "gamma\0alpha alpha"]), want) and want.sum(axis=1).tolist() == [2, 0, 3]
    assert len(plain._places) <= 1


def test_rows_are_cut_as_by_windows_over_sentences(spark, monkeypatch):
    monkeypatch.setattr(splitting, "SENTENCES", 3)
    texts = [*odd_texts(400, 120), "", "one", *(". ".join(f"Sentence {i} {'of rates' if i % 7 < 4 else 'on cats'}" for i in range(n)) for n in (2, 3, 4, 20, 200)), None]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = lambda df: sorted(tuple(r) for r in df.select("source_id", "segment", "content", "sentences").collect())
    got = rows(chunking.semantic(docs))
    assert got == rows(chunking.semantic(docs, embed=bucket_vector(simple(F.col("sentence")))))
    assert len(got) > len(texts)  # some are cut


def test_enhancing_shuffles_nothing_and_takes_rows_by_themselves(spark):
    prose = ". ".join(f"Sentence {i} of a long prose text about {'rates and banks' if i < 12 else 'cats and dogs'}" for i in range(24)) + "."
    other = "# First\n" + prose.replace("cats", "cows") + "\n# Second\n" + prose
    docs = [(1, prose), (1, prose), (1, other), (None, other), (2, "short"), (3, None)]
    cut = lambda rows: chunking.enhance(chunking.hybrid(spark.createDataFrame(rows, "doc_id long, text string")))
    rows = lambda df: sorted((str(r["source_id"]), r["chunk_id"], r["total_chunks"], r["section"], r["is_boundary"], r["segment"], r["content"]) for r in df.collect())
    whole = cut(docs)
    plan = whole._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" not in plan and "Join" not in plan and "Aggregate" not in plan
    # rows that share an id, or have none, are documents of their own
    assert rows(whole) == sorted(r for d in docs for r in rows(cut([d])))
    assert {r["section"] for r in whole.collect() if r["is_boundary"]} == {"0-1"}


def test_rows_of_one_row_group_are_dealt_out(spark, tmp_path):
    spark.range(400).coalesce(1).write.parquet(str(tmp_path / "t"))
    one = spark.read.parquet(str(tmp_path / "t"))
    assert spread(one).select(F.spark_partition_id()).distinct().count() >= spark.sparkContext.defaultParallelism
    many = spark.range(0, 400, 1, 40)
    assert spread(many) is many
