"""Proximity graphs against exact search: recall and counted work, and odd input."""

import numpy as np
from pyspark.sql import functions as F

from corvidex.functions.tokenize import bucket_vector, simple
from corvidex.operators import dense, graph


def recall(found, exact):
    """Found rows as good as the last exact one, of all exact rows."""
    got = {}
    for r in found.collect():
        got.setdefault(r["query_id"], []).append(r["score"])
    want = {}
    for r in exact.collect():
        want.setdefault(r["query_id"], []).append(r["score"])
    hits = sum(min(len(own), sum(s >= min(own) - 2e-6 for s in got.get(q, []))) for q, own in want.items())
    return hits / sum(map(len, want.values()))


def test_texts_of_the_largest_table(spark):
    d = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").select("doc_id", bucket_vector(simple(F.col("text"))).alias("dv"))
    q = spark.read.parquet("/root/testdata/sf0.1/benchmark.parquet").select(F.col("item_id").alias("query_id"), bucket_vector(simple(F.col("text"))).alias("qv"))
    index = graph.build(d)
    index.nodes = index.nodes.persist()
    assert recall(index.search(q, 5), dense.top_k(q, d, 5)) >= 0.9
    work = index.work(q).agg(F.sum("computed"), F.count(F.lit(1))).first()
    assert work[0] <= 0.2 * d.count() * work[1] and work[1] == q.count()
    layers = {r["layer"]: r for r in index.stats().collect()}
    assert layers[0]["vectors"] == d.count() and len(layers) >= 3 and all(layers[i + 1]["nodes"] < layers[i]["nodes"] / 5 for i in range(2))
    index.nodes.unpersist()


def test_own_vectors_of_the_largest_table(spark):
    e = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").select(F.col("vec_id").alias("doc_id"), F.col("embedding").alias("dv"))
    q = e.where("doc_id % 50 = 0").select(F.col("doc_id").alias("query_id"), F.col("dv").alias("qv"))
    index = graph.build(e)
    assert recall(index.search(q, 5, beam=16), dense.top_k(q, e, 5)) >= 0.9
    assert index.work(q, beam=16).agg(F.sum("computed")).first()[0] <= 0.2 * e.count() * q.count()


def test_shares_blocks_and_added_vectors(spark, tmp_path, monkeypatch):
    rng = np.random.default_rng(5)
    rows = [(i, [float(x) for x in rng.normal(size=6)]) for i in range(400)]
    rows += [(i, [1.0, 0.0, 0.0, 0.0, 0.0, 0.5]) for i in range(400, 560)] + [(600, None), (601, [float("nan")] * 6), (602, [None] * 6), (603, [1.0]), (None, [1.0] * 6), (3, rows[3][1]), (604, [0.0] * 6)]
    d = spark.createDataFrame(rows, "doc_id long, dv array<double>")
    q = d.where("doc_id % 40 = 0 OR doc_id >= 595").select(F.col("doc_id").alias("query_id"), F.col("dv").alias("qv"))
    exact = dense.top_k(q, d.where("size(dv) = 6").distinct(), 5)
    index = graph.build(d, share_rows=150)
    assert index.shares == 4
    found = index.search(q, 5)
    assert recall(found, exact.where("query_id <> 603")) >= 0.97
    # equal vectors: all their ids are candidates, the smallest are reported
    own = [r["doc_id"] for r in found.where("query_id = 440").orderBy("rank").collect()]
    assert own == [400, 401, 402, 403, 404]
    # a save, and vectors that come later
    first = graph.build(d.where("doc_id < 300"), share_rows=150)
    first.save(str(tmp_path / "g"))
    both = graph.load(spark, str(tmp_path / "g")).add(d.where("doc_id >= 300"))
    assert both.shares == 4 and recall(both.search(q, 5), exact.where("query_id <> 603")) >= 0.97
    monkeypatch.setattr(graph, "QUERY_NUMBERS", 40)
    assert recall(index.search(q, 5), exact.where("query_id <> 603")) >= 0.97
    assert index.search(q.where("false"), 5).count() == 0 == graph.build(d.where("false")).search(q, 5).count()


def test_parts_are_bridged():
    """Three far groups, each larger than the pool of neighbours: a search that starts in one reaches all."""
    rng = np.random.default_rng(1)
    v = graph.unit(np.concatenate([rng.normal(0, 0.05, (60, 8)) + 3 * np.eye(8)[c] for c in range(3)])).astype(np.float32)
    links = graph.neighbours(v, 8, 40)
    assert max(map(len, links)) <= 18 and all(i not in row for i, row in enumerate(links))
    share = graph.Share(v, [[row] for row in links])
    nodes, scores, work = share.search(v, 70)
    assert (nodes[:, 0] == np.arange(len(v))).mean() > 0.9 and (work <= len(v)).all()
    assert all((np.diff(s[n >= 0]) <= 0).all() for n, s in zip(nodes, scores, strict=True))
