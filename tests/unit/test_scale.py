"""Steps that must not make a row of every pair or hold a whole Arrow batch's results: against plain versions, in all their paths."""

from collections import Counter

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from corvidex.operators import analytics, dense


def test_pairs_are_counted_by_score_and_none_is_lost(spark, monkeypatch):
    rng = np.random.default_rng(3)
    rows = [(i, int(rng.integers(3)) if i % 7 else None, [float(x) for x in rng.normal(size=4 if i % 5 else 3) * (1000 if i == 8 else 1)]) for i in range(60)] + [(60, 1, None), (61, 1, [1.0, None, 1.0, 1.0])]
    docs = spark.createDataFrame(rows, "doc_id long, label int, dv array<float>").repartition(3)
    queries = docs.where("doc_id % 4 = 0").select(F.col("doc_id").alias("query_id"), "label", F.col("dv").alias("qv"))
    kept = [(i, g, np.array(v, np.float32).astype(float)) for i, g, v in rows if v is not None and None not in v]
    want = Counter((round(float(np.round(a @ b, 6)), 6), float(g is not None and g == h)) for i, g, a in kept if i % 4 == 0 for j, h, b in kept if i != j and len(a) == len(b))
    for most in (dense.QUERY_BYTES, 200):
        monkeypatch.setattr(dense, "QUERY_BYTES", most)
        got = dense.pair_counts(queries, docs)
        assert {(round(r["score"], 6), r["gold"]): r["n"] for r in got.collect()} == want
    report = analytics.embedding_eval(got).first()
    flat = pd.DataFrame([(*k, n) for k, n in want.items()], columns=["score", "gold", "n"]).loc[lambda x: x.index.repeat(x["n"])]
    ranks = flat[["score", "gold"]].rank()
    assert (report["n"], report["spearman"]) == (len(flat), round(float(ranks["score"].corr(ranks["gold"])), 6))
    assert abs(report["pearson"] - flat["score"].corr(flat["gold"])) < 2e-6
    one_by_one = analytics.embedding_eval(spark.createDataFrame(flat[["score", "gold"]])).first()
    assert one_by_one == report


def test_morphemes_are_analysed_once_a_row_and_in_slices(spark, monkeypatch):
    import pyarrow as pa

    from corvidex.functions import slices
    from corvidex.functions.morphemes import Morphemes, RuleAnalyzer

    texts = ["학교에서 공부를 하다 AI 3", None, "", "은행의 금리 은행의 금리 " * 50, "x"]
    monkeypatch.setattr(slices, "SLICE_BYTES", 40)
    assert list(slices.cuts(pa.array(texts))) == [(0, 3), (3, 1), (4, 1)]
    m, t = Morphemes(), F.col("text")
    rows = spark.createDataFrame([(t,) for t in texts], "text string").coalesce(1).select("text", m.forms(t).alias("forms"), m.nouns(t).alias("nouns"), m.compounds(t).alias("compounds"), m.tokens(t).alias("tokens"), m.spaced(t).alias("spaced"))
    for r in rows.collect():
        own = RuleAnalyzer().analyse(r["text"] or "")
        assert r["forms"] == [f for f, _ in own] and r["nouns"] == [f for f, g in own if g.startswith("N")]
        assert r["spaced"] == " ".join((r["text"] or "").split())
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython ") == 1 or plan.count("+- ArrowEvalPython") == 1  # one worker a task, not one a column


def test_copies_are_cut_each_by_itself(spark):
    """Chunks of copies share their chunk_id; their sentences must not meet, nor each copy get the parts of all."""
    from corvidex.operators import chunking

    text = ". ".join(f"Sentence {i} of a long prose text about {'rates and banks' if i < 12 else 'cats and dogs'}" for i in range(24)) + "."
    once = spark.createDataFrame([(1, text)], "doc_id long, text string")
    copies = spark.createDataFrame([(i, text) for i in range(1, 6)], "doc_id long, text string")
    cut = lambda docs: [(r["source_id"], r["segment"], r["content"]) for r in chunking.enhance(chunking.hybrid(docs)).select("source_id", "segment", "content").collect()]
    alone = {(s, c) for _, s, c in cut(once)}
    assert len(alone) > 1
    got = cut(copies)
    assert len(got) == 5 * len(alone) and {(s, c) for _, s, c in got} == alone


def test_results_are_built_in_slices(spark, monkeypatch):
    """One slice's results are Python objects at a time, however many rows a batch has."""
    import pyarrow as pa
    from pyspark.sql import types as T

    from corvidex.functions import slices
    from corvidex.operators import chunking, splitting

    sizes = []
    real = pa.array
    monkeypatch.setattr(slices, "SLICE_BYTES", 1000)
    monkeypatch.setattr(pa, "array", lambda x, *a, **k: (sizes.append(len(x)), real(x, *a, **k))[1])
    texts = real(["word " * 40, None, "", "a. b. " * 400] * 20)
    out = slices.each(T.ArrayType(T.StringType()), lambda t: splitting.split_kept(t or "", 100, 20)).func(texts)
    assert out.to_pylist() == [splitting.split_kept(t or "", 100, 20) for t in texts.to_pylist()] and max(sizes) < 12
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert chunking.paragraphs(empty).count() == 0


def test_pages_and_compositions_are_built_in_slices(spark, monkeypatch):
    import unicodedata

    import pyarrow as pa

    from corvidex.functions import slices, text
    from corvidex.sources import html

    monkeypatch.setattr(slices, "SLICE_BYTES", 300)
    pages = ["<h1>A</h1><a href='x'>y</a> é" + "<p>z</p>" * i for i in range(40)] + [None, ""]
    sizes, real = [], pa.array
    monkeypatch.setattr(pa, "array", lambda x, *a, **k: (sizes.append(len(x)), real(x, *a, **k))[1])
    assert html._parsed.func(real(pages)).to_pylist() == [html.parse(p) for p in pages]
    texts = ["é ﬁ " * i for i in range(30)] + [None, "plain"]
    for f, form in ((text.nfc, "NFC"), (text.nfkc, "NFKC")):
        assert f.func(real(texts)).to_pylist() == [t if t is None else unicodedata.normalize(form, t) for t in texts]
    assert max(sizes) < 20


def test_search_shuffles_no_row_of_query_and_document(spark):
    """Equal to ranking all scores, ids null, repeated and as text among them; the plan has no group by query and document."""
    from corvidex.operators import bm25

    rng = np.random.default_rng(5)
    texts = [" ".join(f"w{int(x)}" for x in rng.zipf(1.4, int(rng.integers(0, 40))) if x < 60) for _ in range(150)]
    rows = [(None if i == 3 else i % 120, t) for i, t in enumerate(texts)]
    for kind in ("long", "string"):
        docs = spark.createDataFrame(rows, "doc_id long, text string").select(F.col("doc_id").cast(kind).alias("doc_id"), "text").repartition(5)
        queries = spark.createDataFrame([(i, f"w1 w{i} w{i} w{2 * i}") for i in range(12)] + [(99, "absent"), (None, "w2")], "query_id long, query string")
        index = bm25.build(docs)
        for formula in ("lucene", "okapi"):
            key = lambda df: sorted(((r["query_id"], r["rank"], r["doc_id"], r["score"]) for r in df.collect()), key=str)
            got, want = bm25.search(index, queries, 4, formula), bm25.ranked(bm25.scores(index, queries, formula), 4)
            assert key(got) == key(want)
    assert "MapInArrow" in got._jdf.queryExecution().executedPlan().toString()
    assert bm25.search(bm25.build(docs.where("false")), queries, 3).count() == 0


def test_cells_are_searched_without_a_row_for_each_pair(spark, monkeypatch):
    """vectors that do not fit the centres among them; queries too many to send give the same."""
    rng = np.random.default_rng(6)
    rows = [(i, [float(x) for x in rng.normal(size=8 if i % 40 else 5)]) for i in range(600)]
    docs = spark.createDataFrame(rows, "doc_id long, dv array<float>")
    asked = docs.where("doc_id % 20 = 0").select(F.col("doc_id").alias("query_id"), F.col("dv").alias("qv"))
    centres = spark.createDataFrame([(i, [float(x) for x in rng.normal(size=8)]) for i in range(4)], "cell_id int, centre array<double>")
    assigned = dense.assign_cells(docs, centres)
    found = dense.search_cells(asked, assigned, centres, 5, 2)
    assert "Join" not in found._jdf.queryExecution().optimizedPlan().toString()
    got = sorted(tuple(r) for r in found.select("query_id", "doc_id", "score", "rank").collect())
    unit = {i: np.array(v, np.float32).astype(float) / np.linalg.norm(np.array(v, np.float32).astype(float)) for i, v in rows}
    cell = {r["doc_id"]: r["cell_id"] for r in assigned.collect()}
    near = {}
    for r in dense.assign_cells(asked, centres, "qv", 2).collect():
        near.setdefault(r["query_id"], set()).add(r["cell_id"])
    want = []
    for q, cells in near.items():
        own = sorted((-round(float(unit[q] @ v), 6) + 0.0, i) for i, v in unit.items() if cell[i] in cells and len(v) == len(unit[q]))[:5]
        want += [(q, i, -s, n) for n, (s, i) in enumerate(own, 1)]
    assert [(q, i, n) for q, i, _, n in got] == [(q, i, n) for q, i, _, n in sorted(want, key=lambda x: (x[0], x[1]))]
    monkeypatch.setattr(dense, "QUERY_BYTES", 500)
    assert got == sorted(tuple(r) for r in dense.search_cells(asked, assigned, centres, 5, 2).select("query_id", "doc_id", "score", "rank").collect())


def test_texts_of_a_report_are_made_once(spark):
    """an expression named in a lambda is computed at every step."""
    from corvidex.operators import quality

    rows = spark.createDataFrame([("a", "b")], "t string, u string")
    report = quality.pipeline_report(F.col("t"), F.reverse("u"), F.split("t", "x"), F.split("t", "y"), F.col("u"), F.col("u"), F.lit("k"))
    plan = rows.select(report.alias("r"))._jdf.queryExecution().analyzed().toString()
    assert plan.count("reverse(") == 1 and plan.count(", y, -1)") == 1


def test_a_question_is_lower_case_once(spark):
    """as above."""
    from corvidex.functions import questions

    plan = spark.createDataFrame([("a",)], "t string").select(questions.question_type(F.col("t")).alias("r"))._jdf.queryExecution().analyzed().toString()
    assert plan.count("lower(") == 1


def test_kept_tables_are_built_from_batches_of_few_bytes(spark, tmp_path):
    import pyarrow as pa

    from corvidex.sources import store

    path = str(tmp_path / "long.parquet")
    spark.range(900).repartition(1).select("id", F.repeat(F.lit("x"), 10_000).alias("text")).write.parquet(path)
    docs = spark.read.parquet(path)

    @F.arrow_udf("long")
    def held(texts: pa.Array) -> pa.Array:
        return pa.array([texts.nbytes] * len(texts))

    got = store.kept(docs, "batches", lambda: docs.select("id", held("text").alias("n")))
    assert got.count() == 900 and got.agg(F.max("n")).first()[0] < 2 * store.BATCH_BYTES
    assert spark.conf.get(store.ARROW_BYTES, None) is None  # as before
