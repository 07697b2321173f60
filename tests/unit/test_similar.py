"""The similarity join, greedy acceptance and mean similarity against plain loops."""

import random
from difflib import SequenceMatcher

import pytest

from corvidex.operators import similar
from corvidex.plans import corpus

ratio = lambda later, earlier: SequenceMatcher(None, later.lower(), earlier.lower()).ratio()


def made():
    rng = random.Random(8)
    words = "what which risk account card loan fraud bank rule law data key token user".split()
    rows = [" ".join(rng.choices(words, k=rng.randrange(1, 14))) + "?" for _ in range(60)]
    for t in rng.choices(rows, k=60):  # near copies: characters changed, dropped, words swapped
        t = list(t)
        for _ in range(rng.randrange(0, max(1, len(t) // 5) + 1)):
            i = rng.randrange(len(t)) if t else 0
            t[i : i + rng.choice([0, 1])] = rng.choice(["", "x", "Y"])
        rows.append("".join(t))
    rows += ["", "", "a", "A", "ab", "ba", "abc", None, "x" * 300, "x" * 299 + "y", "질문 하나?", "질문 하나는?", "tie?", "tie?"]
    return list(enumerate(rows))


def greedy(rows, threshold=0.85):
    kept, flags = [], {}
    for i, t in rows:
        flags[i] = not any(ratio(t or "", k) > threshold for k in kept)
        if flags[i]:
            kept.append(t or "")
    return flags


def test_join_loses_no_pair(spark, monkeypatch):
    rows = made()
    df = spark.createDataFrame(rows, "doc_id long, text string")
    want = {(i, j) for j, b in rows for i, a in rows if i < j and ratio(b or "", a or "") > 0.85}
    got = similar.similar_pairs(df).collect()
    assert {(r["a"], r["b"]) for r in got} == want and len(got) == len(want)
    monkeypatch.setattr(similar, "TOGETHER", 3)  # common bigrams in many parts
    assert {(r["a"], r["b"]) for r in similar.similar_pairs(df).collect()} == want
    with pytest.raises(ValueError):
        similar.similar_pairs(df, threshold=0.7)


def test_acceptance_is_the_greedy_loop(spark):
    rows = made()
    df = spark.createDataFrame([*rows, (None, "no order")], "doc_id long, text string")
    got = {r["doc_id"]: r["accepted"] for r in similar.reject_similar(df).collect()}
    assert got == greedy(rows) | {None: False}
    assert similar.reject_similar(df.where("false")).count() == 0
    # a chain: each text is similar to the one before it alone
    chain = [(i, "".join(chr(97 + (i // 3 * 3 + k) % 26) for k in range(12))) for i in range(20)]
    got = {r["doc_id"]: r["accepted"] for r in similar.reject_similar(spark.createDataFrame(chain, "doc_id long, text string")).collect()}
    assert got == greedy(chain)


def test_passages_of_the_benchmark(spark):
    rows = [(r["item_id"], r["text"]) for r in spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet").orderBy("item_id").collect()]
    rows += [(10_000 + i, t.replace(" the ", " a ")[: len(t) - 9]) for i, t in rows[:6]]
    df = spark.createDataFrame(rows, "item_id long, text string")
    got = {r["item_id"]: r["accepted"] for r in similar.reject_similar(df, order="item_id").collect()}
    assert got == greedy(rows) and sum(not v for v in got.values()) >= 6


def test_mean_over_blocks(spark, monkeypatch):
    rows = made()[:70]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    want = [ratio(rows[i][1] or "", rows[j][1] or "") for i in range(len(rows)) for j in range(i + 1, len(rows))]
    for block in (200, 16):
        monkeypatch.setattr(similar, "BLOCK", block)
        r = similar.mean_similarity(df).first()
        assert r["pairs"] == len(want) and abs(r["similarity"] - sum(want) / len(want)) < 1e-9
    assert similar.mean_similarity(df.where("false")).first() == (0, 0.0) == similar.mean_similarity(df.limit(1)).first()


def test_registered_diversity(spark):
    rows = [r["text"] for r in spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet").orderBy("item_id").collect()]
    want = [ratio(a, b) for i, a in enumerate(rows) for b in rows[i + 1 :]]
    got = corpus.QUERIES["question_diversity"](spark, "/root/testdata/sf0.001").first()
    assert got["pairs"] == len(want) and abs(got["similarity"] - sum(want) / len(want)) < 1e-5
    words = [w for t in rows for w in t.split() if len(w) > 2]
    assert abs(got["unique_ratio"] - len(set(words)) / len(words)) < 1e-5
