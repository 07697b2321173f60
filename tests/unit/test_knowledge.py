"""The knowledge base in snapshots: any series of batches equals a build of what is left."""

import random

import pytest
from pyspark.sql import functions as F

from corvidex.operators import bm25, dense, fusion
from corvidex.sources import versions
from corvidex.streaming import knowledge

WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa".split()
QUERIES = [(0, "alpha beta"), (1, "kappa"), (2, "gamma gamma theta"), (3, "nothing")]


def table(spark, docs: dict):
    return spark.createDataFrame(list(docs.items()), "doc_id long, text string")


def check(spark, snapshot, docs: dict):
    """The snapshot's tables and searches against those of a build over ``docs``."""
    assert {r["doc_id"]: r["text"] for r in snapshot.documents().collect()} == {i: t or "" for i, t in docs.items()}
    q = spark.createDataFrame(QUERIES, "query_id long, query string")
    tidy = lambda df: sorted((r["query_id"], r["doc_id"], round(r["score"], 5), r["rank"]) for r in df.collect())
    assert tidy(snapshot.search(q, 4)) == tidy(bm25.search(bm25.build(table(spark, docs)), q, 4))
    stats = snapshot.index().stats.first()
    assert stats["n"] == len(docs)
    assert snapshot.vectors().vectors.count() == len(docs)


def test_batches_equal_a_rebuild(spark, tmp_path):
    rng = random.Random(3)
    text = lambda: " ".join(rng.choices(WORDS, k=rng.randrange(1, 9)))
    base = knowledge.KnowledgeBase(spark, str(tmp_path / "kb"))
    check(spark, base.snapshot(), {})
    docs = {i: text() for i in range(40)} | {40: None}
    assert base.apply(table(spark, docs)) == {"snapshot": 1, "new": 41, "changed": 0, "removed": 0, "unchanged": 0, "applied": True}
    old, before = base.snapshot(), dict(docs)
    # changed, new, unchanged and removed documents at once; an id both given and removed goes; rows without an id take no part
    batch = {1: text() + " x", 2: text() + " y", 50: text(), 3: docs[3], 4: "given and gone"}
    rows = table(spark, batch).unionByName(spark.createDataFrame([(None, "no id"), (50, "a")], "doc_id long, text string"))
    batch[50] = max(batch[50], "a")
    gone = spark.createDataFrame([(4,), (5,), (5,), (77,), (None,)], "doc_id long")
    got = base.apply(rows, gone)
    assert got == {"snapshot": 2, "new": 1, "changed": 2, "removed": 2, "unchanged": 1, "applied": True}
    docs = {i: t for i, t in (docs | batch).items() if i not in (4, 5)}
    check(spark, base.snapshot(), docs)
    # a document comes back, and another is changed twice
    base.apply(table(spark, {5: "alpha again", 1: "third text kappa"}))
    docs |= {5: "alpha again", 1: "third text kappa"}
    check(spark, base.snapshot(), docs)
    check(spark, old, before)  # a reader of the first snapshot
    assert base.compact() == 4
    check(spark, base.snapshot(), docs)
    assert len(base.snapshot().segments) == 1 and base.snapshot()._all("tombstones", "doc_id long").count() == 0
    assert [r["segments"] for r in base.history().orderBy("snapshot").collect()] == [1, 2, 3, 1]
    # full: what is not given goes
    docs = {1: docs[1], 99: "delta"}
    assert base.apply(table(spark, docs), full=True)["removed"] > 30
    check(spark, base.snapshot(), docs)
    assert len(base.vacuum(1)) >= 3
    check(spark, base.snapshot(), docs)
    assert len(versions.numbers(base.folder)) == 1


def test_failed_batch_and_rival_writer(spark, tmp_path, monkeypatch):
    fail = {"on": True}

    def embed(text):
        if fail["on"]:
            raise RuntimeError("model is away")
        return F.array(F.length(text).cast("double"))

    base = knowledge.KnowledgeBase(spark, str(tmp_path / "kb"), embed=embed)
    with pytest.raises(RuntimeError):
        base.apply(table(spark, {1: "alpha"}), batch=("s", 0))
    assert base.snapshot().number == 0 and len(base.folder.names("segments")) == 1
    fail["on"] = False
    assert base.apply(table(spark, {1: "alpha"}), batch=("s", 0))["new"] == 1
    assert base.apply(table(spark, {1: "again"}), batch=("s", 0))["applied"] is False
    assert base.apply(table(spark, {1: "again"}), batch=("other", 0))["changed"] == 1
    # two writers start from one snapshot: the second must begin anew
    now = base.snapshot()
    rival = knowledge.KnowledgeBase(spark, base.folder.path, embed=embed)
    rival.apply(table(spark, {2: "beta"}))
    with pytest.raises(versions.Conflict):
        versions.switch(base.folder, now.number, {"segments": [], "batches": {}})
    assert {r["doc_id"] for r in base.snapshot().documents().collect()} == {1, 2}
    assert len(base.vacuum()) == 1  # the failed batch's leavings
    # merging by itself
    monkeypatch.setattr(knowledge, "MOST_SEGMENTS", 3)
    for i in range(3, 6):
        base.apply(table(spark, {i: "gamma"}))
    assert len(base.snapshot().segments) <= 3 and base.snapshot().documents().count() == 5


def test_following_a_folder(spark, tmp_path):
    source, checkpoint = str(tmp_path / "in"), str(tmp_path / "cp")
    base = knowledge.KnowledgeBase(spark, str(tmp_path / "kb"))
    schema = "doc_id long, text string, removed boolean"
    put = lambda rows: spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(source)
    put([(1, "alpha", None), (2, "beta", False), (3, "gamma", False)])
    base.follow(source, checkpoint, schema)
    put([(2, "beta two", False), (3, None, True)])
    base.follow(source, checkpoint, schema)
    number = base.snapshot().number
    base.follow(source, checkpoint, schema)
    assert base.snapshot().number == number == 2
    check(spark, base.snapshot(), {1: "alpha", 2: "beta two"})
    assert dense.top_k(spark.createDataFrame([], "query_id long, qv array<double>"), base.snapshot().vectors().vectors, 2).count() == 0


def test_retriever_takes_weights_and_refreshes(spark, tmp_path):
    base = knowledge.KnowledgeBase(spark, str(tmp_path / "kb"))
    docs = {1: "alpha beta", 2: "alpha alpha gamma", 3: "delta", 4: "gamma delta kappa"}
    base.apply(table(spark, docs))
    (tmp_path / "version.json").write_text('{"bm25_weight": 1.0, "vector_weight": 0.0}')
    q = spark.createDataFrame(QUERIES, "query_id long, query string")
    snapshot = base.snapshot()
    sparse = bm25.search(snapshot.index(), q, 3)
    close = dense.top_k(q.select("query_id", base.embed(F.col("query")).alias("qv")), snapshot.vectors().vectors, 3)
    tidy = lambda df: sorted((r["query_id"], r["rank"], r["doc_id"], round(r["score"], 5)) for r in df.collect())
    by_file = knowledge.Retriever(base, str(tmp_path / "version.json"))
    assert tidy(by_file.search(q, 3)) == tidy(fusion.hybrid(sparse, close, 3, (1.0, 0.0)))
    plain = knowledge.Retriever(base)
    assert tidy(plain.search(q, 3)) == tidy(fusion.hybrid(sparse, close, 3, (0.5, 0.5))) != tidy(by_file.search(q, 3))
    base.apply(table(spark, {5: "kappa kappa"}), spark.createDataFrame([(4,)], "doc_id long"))
    old = {r["doc_id"] for r in plain.search(q, 3).collect()}
    assert plain.refresh() and not plain.refresh()
    new = {r["doc_id"] for r in plain.search(q, 3).collect()}
    assert 5 not in old and 5 in new and 4 not in new
    ranked = knowledge.Retriever(base, rerank=lambda query, text: F.length(text).cast("double")).search(q, 1)
    assert {r["doc_id"] for r in ranked.where("query_id = 0").collect()} == {2}


def test_the_queries_search_one_segment(spark):
    """The registered queries' last batch merges the three segments before it, with what their tombstones hide gone."""
    from corvidex.plans import retrieval

    snapshot = retrieval._batches(spark, "/root/testdata/sf0.001")
    assert len(snapshot.segments) == 1 and snapshot._all("tombstones", "doc_id long").count() == 0
    assert [r["segments"] for r in snapshot.base.history().orderBy("snapshot").collect()] == [1, 2, 3, 1]
    stored, live = snapshot._all("postings", snapshot.base.types["postings"]), snapshot.documents()
    assert live.where("doc_id % 7 = 0").count() == 0 and live.where("doc_id % 5 = 0 AND NOT endswith(text, ' revised edition')").count() == 0
    # nothing is stored but the live documents' own postings
    assert stored.drop("segment").exceptAll(bm25.postings_of(live)).count() == 0 == bm25.postings_of(live).exceptAll(stored.drop("segment")).count()
