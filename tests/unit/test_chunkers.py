"""Chunking queries without SQL against plain versions of them over the smallest tables."""

import hashlib
import json
import math
from collections import defaultdict

import regex
from pyspark.sql import functions as F

from corvidex.operators import chunking, rerank, splitting
from corvidex.plans import corpus, measures

DATA = "/root/testdata/sf0.001"
md5 = lambda t: hashlib.md5(t.encode()).hexdigest()


def texts(spark):
    return {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()}


def vector(t):
    counts = [0.0] * 64
    for w in regex.findall(r"[\p{L}\p{N}]+", t.lower()):
        if len(w) >= 2:
            counts[int(md5(w)[:4], 16) % 64] += 1
    n = math.sqrt(sum(x * x for x in counts))
    return [x / n if n else x for x in counts]


def segments(t):
    """Sentences joined until the step to the next one is above the 95th percentile of a text's steps."""
    parts = regex.split(r"(?<=[.!?])[ \t\n\x0b\f\r]+", t)
    v = [vector(p) for p in parts]
    steps = [1 - sum(a * b for a, b in zip(x, y, strict=True)) for x, y in zip(v, v[1:], strict=False)]
    if not steps:
        return [parts]
    order, at = sorted(steps), 0.95 * (len(steps) - 1)
    low, high = math.floor(at), math.ceil(at)
    cut = order[low] if low == high else (high - at) * order[low] + (at - low) * order[high]
    out = [[parts[0]]]
    for step, p in zip(steps, parts[1:], strict=True):
        if step > cut + 1e-12:
            out.append([])
        out[-1].append(p)
    return out


def test_semantic_segments(spark):
    want = {(i, k, len(own), md5(" ".join(own))) for i, t in texts(spark).items() for k, own in enumerate(segments(t))}
    got = {tuple(r[c] for c in ("source_id", "segment", "sentences", "content")) for r in corpus.QUERIES["semantic_segments"](spark, DATA).collect()}
    assert len(got ^ want) <= 0.005 * len(want)  # steps that equal the cut to the last digit may fall on either side
    assert sum(n for _, _, n, _ in got) == sum(n for _, _, n, _ in want)


def test_paragraph_chunks(spark):
    want = set()
    for i, t in texts(spark).items():
        packed: list[list[str]] = []
        for p in filter(None, (p.strip() for p in t.split("\n\n"))):
            if packed and len("\n\n".join(packed[-1])) + len(p) < 1000:
                packed[-1].append(p)
            else:
                packed.append([p])
        want |= {(i, k, md5("\n\n".join(own))) for k, own in enumerate(packed)}
    got = [(r["source_id"], r["chunk_index"], r["content"]) for r in measures.QUERIES["paragraph_chunks"](spark, DATA).collect()]
    assert set(got) == want and len(got) == len(want)


def test_page_chunk_ids(spark):
    rows = measures.QUERIES["page_chunk_ids"](spark, DATA).collect()
    own = defaultdict(list)
    for r in rows:
        assert r["chunk_id"] == f"page_{r['page_id']}_chunk_{r['chunk_index']}"
        own[r["page_id"]].append(r)
    for page in own.values():
        assert sorted(r["chunk_index"] for r in page) == list(range(len(page))) and {r["total_chunks"] for r in page} == {len(page)}
    assert len({r["chunk_id"] for r in rows}) == len(rows)


def test_query_cache_keys(spark):
    rows = [(0, "What IS risk", ["b", "a", None]), (1, "what is risk", ["a", "b"]), (2, "x", [])]
    got = {r["i"]: r["k"] for r in spark.createDataFrame(rows, "i int, q string, d array<string>").select("i", rerank.query_cache_key(F.col("q"), F.col("d"), 3).alias("k")).collect()}
    for i, q, d in rows[1:]:
        assert got[i] == md5(json.dumps({"q": q.lower(), "d": sorted(map(md5, d)), "k": 3}, separators=(",", ":")))
    keys = measures.QUERIES["query_cache_keys"](spark, DATA).collect()
    assert len({r["query_id"] for r in keys}) == len(keys) and len({r["key"] for r in keys}) == len(keys)


def test_overlap_report(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet").where("doc_id < 30")
    got = chunking.overlap_report({"200/40": chunking.chunk(docs, 200, 40, clean=False)}).first()
    chunks = {i: splitting.split_packed(t, 200, 40) for i, t in texts(spark).items() if i < 30}
    flat = [c for own in chunks.values() for c in own]

    def border(a, b):
        return next((n for n in range(min(len(a), len(b)), 0, -1) if a.endswith(b[:n])), 0)

    overlaps = [border(a, b) for own in chunks.values() for a, b in zip(own, own[1:], strict=False)]
    assert got["total_chunks"] == len(flat) and got["min_size"] == min(map(len, flat)) and got["max_size"] == max(map(len, flat))
    assert got["total_overlap"] == sum(overlaps) and abs(got["avg_regular_overlap"] - sum(overlaps) / len(overlaps)) < 1e-5 and got["boundary_chunks"] == 0
