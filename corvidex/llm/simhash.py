"""SimHash near-duplicates by the generalised pigeonhole principle.

A text's fingerprint has a bit set where over half of its shingle hashes have it.  Two fingerprints
link at ``radius`` or fewer differing bits.  Candidates come from the generalised pigeonhole principle:
the bits are split into groups, group i gets a threshold t_i, and if the t_i add up to
``radius - groups + 1``, linked fingerprints differ in at most t_i bits of some group i.

* Correlated bits share a group, so that the groups are as independent of each other as can be; the
  correlations are counted over all fingerprints.
* Thresholds are unequal: dynamic programming spreads them to minimise the candidates expected from the
  bit frequencies of all fingerprints, plus the probes.  The number of groups is chosen the same way.
* Each fingerprint probes the keys within t_i of its own in group i; hits are verified on all 64 bits.
* Buckets that many fingerprints share take another exact way: they are cut into blocks, each pair
  of blocks is compared in numpy, and only a spanning forest of the links leaves.

Linked fingerprints make components by alternating large-star and small-star steps on tables in the
shared folder.  Equal fingerprints are one node from the start, so copies never multiply.

Defined results: words are ASCII-lower-cased runs without ASCII white space; a text of fewer words than a
shingle has the whole sequence as its one shingle; null, empty and blank texts have fingerprint 0, linked
like any other.  Rows with a null id get a fingerprint and a component but never name one unless all
members' ids are null.  Repeated rows share a component.  An empty table gives no rows.  A bit set in exactly half
of the hashes is 0.  Only the id and the text are read, so other columns may have any name.
"""

from __future__ import annotations

from itertools import combinations
from math import comb

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corvidex.llm import jaccard
from corvidex.llm._graph import components
from corvidex.llm._spark import spread_join, stored
from corvidex.llm._words import slices, texts_of

BITS = 64
SEED = 42
HOT_BUCKET = 128
BLOCK = 2048
PROBE_COST = 4.0
BROADCAST_KEYS = 1_000_000


def fingerprint(text: str | None, width: int = 4) -> int:
    """Unsigned 64-bit SimHash of one text."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    if len(words) <= width:
        hashes = np.array([xxhash.xxh64_intdigest(b" ".join(words), SEED)], np.uint64)
    else:
        joined = b" ".join(words)
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
        starts = np.concatenate([[0], ends[:-1] + 1])
        digest = xxhash.xxh64_intdigest
        n = len(words) - width + 1
        hashes = np.fromiter((digest(joined[a:b], SEED) for a, b in zip(starts[:n].tolist(), ends[width - 1 :].tolist(), strict=True)), np.uint64, n)
    counts = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        counts += np.unpackbits(hashes[at : at + (1 << 16)].astype(">u8").view(np.uint8).reshape(-1, 8), axis=1).sum(0, dtype=np.int64)
    return int(np.packbits(counts * 2 > len(hashes)).view(">u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 4) -> DataFrame:
    """(id, fp) with the fingerprint as a signed long."""
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
    kind = rows.schema["id"].dataType.simpleString()

    def work(batches):
        for batch in batches:
            for lo, hi in slices(batch.column(1)):
                fps = np.fromiter((fingerprint(t.as_py(), width) for t in texts_of(batch.column(1).slice(lo, hi - lo))), np.uint64, hi - lo)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), pa.array(fps.view(np.int64))], names=["id", "fp"])

    return rows.mapInArrow(work, f"id {kind}, fp long")


def bit_statistics(fps: DataFrame) -> tuple[int, np.ndarray]:
    """(number of fingerprints, how often two bits are set together) over all of them; only 64 x 64 counts travel."""

    def work(batches):
        total, n = np.zeros((BITS, BITS), np.int64), 0
        for batch in batches:
            own = np.asarray(batch.column(0)).astype(np.uint64)
            for at in range(0, len(own), 1 << 16):
                x = (own[at : at + (1 << 16), None] >> np.arange(BITS, dtype=np.uint64) & np.uint64(1)).astype(np.float32)
                total += np.rint(x.T @ x).astype(np.int64)
            n += len(own)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(BITS * BITS + 1)), pa.array(np.append(total.ravel(), n))], names=["at", "n"])

    got = fps.select("fp").mapInArrow(work, "at long, n long").groupBy("at").agg(F.sum("n").alias("n")).collect()
    flat = np.zeros(BITS * BITS + 1, np.int64)
    for r in got:
        flat[r["at"]] = r["n"]
    return int(flat[-1]), flat[:-1].reshape(BITS, BITS)


def group_bits(n: int, together: np.ndarray, groups: int) -> list[list[int]]:
    """Split the bits into groups of near equal size; each group grows by the bit most correlated with it."""
    p = np.diag(together) / max(n, 1)
    cov = together / max(n, 1) - np.outer(p, p)
    dev = np.sqrt(np.maximum(np.diag(cov), 1e-12))
    corr = np.abs(cov / np.outer(dev, dev))
    np.fill_diagonal(corr, 0)
    left, out = set(range(BITS)), []
    for k in range(groups):
        size = len(left) // (groups - k)
        own = [max(left, key=lambda b: (corr[b, list(left)].sum(), -b))]
        left.discard(own[0])
        while len(own) < size:
            b = max(left, key=lambda b: (corr[b, own].sum(), -b))
            own.append(b)
            left.discard(b)
        out.append(sorted(own))
    return out


def expected_cost(n: int, p: np.ndarray, bits: list[int], threshold: int) -> float:
    """Candidate pairs expected of a group whose bits differ independently, plus the cost of its probes."""
    if threshold < 0:
        return 0.0
    differ = np.zeros(threshold + 1)
    differ[0] = 1.0
    for b in bits:
        q = 2 * p[b] * (1 - p[b])
        differ = differ * (1 - q) + np.concatenate([[0], differ[:-1]]) * q
    return n * n / 2 * differ.sum() + PROBE_COST * n * sum(comb(len(bits), r) for r in range(threshold + 1))


def allocate(n: int, p: np.ndarray, groups: list[list[int]], radius: int) -> tuple[float, list[int]]:
    """The thresholds of least expected cost that add up to ``radius - groups + 1``; -1 leaves a group unused."""
    best = {0: (0.0, [])}
    goal = radius - len(groups) + 1
    for bits in groups:
        cost = {t: expected_cost(n, p, bits, t) for t in range(-1, radius + 1)}
        more: dict[int, tuple[float, list[int]]] = {}
        for used, (c, own) in best.items():
            for t, d in cost.items():
                if used + t not in more or c + d < more[used + t][0]:
                    more[used + t] = (c + d, [*own, t])
        best = more
    return best[goal]


def plan(n: int, together: np.ndarray, radius: int) -> list[tuple[list[int], int]]:
    """Groups of bits and their thresholds."""
    p = np.diag(together) / max(n, 1)
    found = []
    for m in range(1, radius + 2):
        groups = group_bits(n, together, m)
        cost, thresholds = allocate(n, p, groups, radius)
        found.append((cost, m, groups, thresholds))
    _, _, groups, thresholds = min(found)
    return [(g, t) for g, t in zip(groups, thresholds, strict=True) if t >= 0]


def _masks(bits: list[int], threshold: int) -> list[int]:
    out = [0]
    for r in range(1, threshold + 1):
        out += [sum(1 << b for b in c) for c in combinations(bits, r)]
    return [m - (1 << 64) if m >= 1 << 63 else m for m in out]


def _mask(bits: list[int]) -> int:
    return _masks(bits, len(bits))[-1] if len(bits) < 2 else (lambda m: m - (1 << 64) if m >= 1 << 63 else m)(sum(1 << b for b in bits))


def _forest(radius: int):
    """Links of one pair of blocks of a hot bucket, without those that others already imply."""

    def work(pdf: pd.DataFrame) -> pd.DataFrame:
        index, probe = pdf[pdf["role"] == 0]["fp"].unique().astype(np.int64), pdf[pdf["role"] == 1]["fp"].unique().astype(np.int64)
        own, at = np.unique(np.concatenate([index, probe]), return_inverse=True)
        there, asked = at[: len(index)], at[len(index) :]
        label = np.arange(len(own))
        a, b = [], []
        for x, k in zip(probe.tolist(), asked.tolist(), strict=True):
            near = there[np.bitwise_count((np.int64(x) ^ index).view(np.uint64)) <= radius]
            # one link to each group met that is not this fingerprint's own
            groups, first = np.unique(label[near], return_index=True)
            new = groups != label[k]
            if new.any():
                a += [x] * int(new.sum())
                b += own[near[first[new]]].tolist()
                label[np.isin(label, groups)] = label[k]
        lo, hi = np.minimum(np.array(a, np.int64), np.array(b, np.int64)), np.maximum(np.array(a, np.int64), np.array(b, np.int64))
        return pd.DataFrame({"a": lo, "b": hi})

    return work


def links(fps: DataFrame, radius: int = 4) -> DataFrame:
    """(a, b), a < b: links between distinct fingerprints ``fps.fp`` that connect all that are within ``radius``."""
    n, together = bit_statistics(fps)
    spark = fps.sparkSession
    if n < 2:
        return spark.createDataFrame([], "a long, b long")
    parts = plan(n, together, radius)
    masks = F.array(*[F.struct(F.lit(i).alias("part"), F.lit(_mask(bits)).cast("long").alias("mask")) for i, (bits, _) in enumerate(parts)])
    # flips differ by group; probing itself is the flip 0
    flips = F.array(*[F.struct(F.lit(i).alias("part"), F.lit(_mask(bits)).cast("long").alias("mask"), F.array(*[F.lit(m).cast("long") for m in _masks(bits, t)]).alias("flips")) for i, (bits, t) in enumerate(parts)])
    index = fps.select("fp", F.explode(masks).alias("m")).select("fp", "m.part", (F.col("fp").bitwiseAND(F.col("m.mask"))).alias("key"))
    probe = fps.select("fp", F.explode(flips).alias("m")).select("fp", "m.part", F.explode(F.transform("m.flips", lambda x: F.col("fp").bitwiseAND(F.col("m.mask")).bitwiseXOR(x))).alias("key"))
    hot = stored(index.groupBy("part", "key").agg(F.count(F.lit(1)).alias("size")).where(F.col("size") > HOT_BUCKET), "simhash-hot")
    a, b = probe.withColumnRenamed("fp", "a"), index.withColumnRenamed("fp", "b")
    close = (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= radius) & (F.col("a") < F.col("b"))
    if hot.isEmpty():
        return a.join(b, ["part", "key"]).where(close).select("a", "b").distinct()
    cold = a.join(b.join(hot, ["part", "key"], "left_anti"), ["part", "key"]).where(close).select("a", "b")
    # a hot bucket of s fingerprints becomes blocks; each pair of an index block and a probe block is one group
    sized = hot.select("part", "key", F.ceil(F.col("size") / BLOCK).cast("int").alias("blocks"))
    block = lambda seed: F.pmod(F.xxhash64("fp", F.lit(seed)), F.col("blocks")).cast("int")
    spread = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    left = index.join(sized, ["part", "key"]).select("part", "key", block(3).alias("i"), spread.alias("j"), F.lit(0).alias("role"), "fp")
    right = probe.join(sized, ["part", "key"]).select("part", "key", spread.alias("i"), block(5).alias("j"), F.lit(1).alias("role"), "fp")
    warm = left.unionByName(right).groupBy("part", "key", "i", "j").applyInPandas(_forest(radius), "a long, b long")
    return cold.unionByName(warm.where("a < b")).distinct()


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 4, radius: int = 4) -> DataFrame:
    """(id, fingerprint, component_id): one row per document; the component is its smallest id."""
    rows = stored(fingerprints(docs, id_col, text_col, width), "simhash-fp")
    distinct = stored(rows.groupBy("fp").agg(F.min("id").alias("rep"), F.count(F.lit(1)).alias("n")), "simhash-distinct")
    found = components(links(distinct, radius))
    # a component's name is the smallest id of its fingerprints
    named = distinct.join(found, distinct["fp"] == found["node"], "left").select("fp", "rep", "n", F.coalesce("root", "fp").alias("root"))
    names = named.groupBy("root").agg(F.min("rep").alias("component_id"), F.count(F.lit(1)).alias("members"))
    total = rows.count()
    by_fp = spread_join(named, names, "root", "members", total).select("fp", "n", "component_id")
    return spread_join(rows, by_fp, "fp", "n", total).select(F.col("id").alias(id_col), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def keep_first(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5, similarity: float = 0.8, radius: int = 4) -> DataFrame:
    """The documents without near copies, all columns: of each group the row of the smallest id stays, null ids last.

    Groups join all texts whose sets of ``width``-word shingles have ``similarity`` or more of their union in common.
    Links between fingerprints propose pairs, which are verified on the whole sets; as a fingerprint misses pairs that are
    alike but not close, :mod:`corvidex.llm.jaccard` then finds every pair left between two groups.

    A row is told by its id and all its other columns, so rows that share an id but not a text are documents of
    their own.  Repeated rows are copies, of which one stays.  Maps and variants are compared as JSON.
    """
    cells = [F.col(f"`{c}`") for c in docs.columns]
    nulls = F.concat(*[c.isNull().cast("string") for c in cells])
    hashable = [F.to_json(F.struct(c.alias("c"))) if any(k in f.dataType.simpleString() for k in ("map<", "variant")) else c for c, f in zip(cells, docs.schema, strict=True)]
    hashes = [F.xxhash64(nulls, *hashable).alias("h1"), F.xxhash64(F.lit(1), nulls, *hashable).alias("h2")]
    text, name = F.col(f"`{text_col}`").alias("text"), F.col(f"`{id_col}`")
    rows = docs.select(*hashes, text)
    named = stored(jaccard.named(docs.select(name.isNull().alias("none"), name.alias("id"), *hashes, text), width), "near-named")
    key = F.struct("none", "id", "h1", "h2")
    nodes = stored(named.groupBy("node").agg(F.min(key).alias("key"), F.first("fp").alias("fp"), F.count(F.lit(1)).alias("n")), "near-nodes")
    # rows that are not their node's first
    copies = spread_join(named, nodes.select("node", "n", F.col("key.h1").alias("k1"), F.col("key.h2").alias("k2")), "node", "n", named.count())
    copies = stored(copies.where("h1 <> k1 OR h2 <> k2").select("h1", "h2").distinct(), "near-copies")
    reps = nodes.select("node", "key.h1", "key.h2")
    # nodes of one fingerprint hang on the smallest of them, and those smallest ones on each other
    by_fp = stored(nodes.groupBy("fp").agg(F.min("node").alias("low")), "near-fps")
    met = links(by_fp.select("fp"), radius)
    low = lambda c, name: by_fp.select(F.col("fp").alias(c), F.col("low").alias(name))
    proposed = met.join(low("a", "x"), "a").join(low("b", "y"), "b").select("x", "y").union(nodes.join(by_fp, "fp").where("node <> low").select("low", "node"))
    proposed = stored(proposed.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")), "near-proposed")
    one_each = lambda nodes: _rows_of(rows, stored(reps.join(nodes, "node", "left_semi").select("h1", "h2"), "near-keys"), "left_semi")
    edges = jaccard.links(_rows_of(rows, copies, "left_anti"), one_each, proposed, width, similarity)
    rooted = nodes.join(components(edges), "node", "left").select("key", F.coalesce("root", "node").alias("root"))
    # within a group all but the row of the smallest key go
    first = rooted.groupBy("root").agg(F.min("key").alias("first"))
    gone = rooted.join(first, "root").where("key <> first").select("key.h1", "key.h2").union(copies)
    kept = _rows_of(docs.select(F.struct(*cells).alias("row"), *hashes), stored(gone, "near-gone"), "left_anti")
    twice = stored(named.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("h1", "h2"), "near-twice")
    once = _rows_of(kept, twice, "left_anti").unionByName(_rows_of(kept, twice, "left_semi").dropDuplicates(["h1", "h2"]))
    return once.select("row.*")


def _rows_of(rows: DataFrame, keys: DataFrame, how: str) -> DataFrame:
    """``rows`` with (``left_semi``) or without (``left_anti``) those whose hashes are in the stored ``keys(h1, h2)``; up to
    ``BROADCAST_KEYS`` keys of sixteen bytes are sent to every task, more meet the rows in a shuffle."""
    few = keys.limit(BROADCAST_KEYS + 1).count() <= BROADCAST_KEYS
    return rows.join(F.broadcast(keys) if few else keys, ["h1", "h2"], how)
