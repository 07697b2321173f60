"""Exact top-k inner-product search by the three-phase uniform threshold method.

The score of a query and a vector is a sum over ``segments`` blocks of dimensions; each block
of vectors holds one local score list per segment.

1. *Gather*: every local list gives its best entries for a query; their whole scores are looked
   up in place and the best of them travel.  The k-th best over all lists is a lower bound on
   the true k-th score, so it is a safe cutoff ``tau``.
2. *Collect*: ``tau`` goes back to every list, which hands over all entries of at least
   ``tau / segments``.  A vector that reaches ``tau`` in total must do so in one segment at
   least, whatever the signs of the others, so nothing is missed.
3. *Resolve*: collected vectors whose upper bound (a list that did not hand a vector over
   contributes less than the uniform threshold) falls below ``tau`` go; the rest get exact scores.

Equal vectors are one class that carries only its ``k + 1`` smallest ids: a query removes itself,
ties go to smaller ids, so no more can ever be returned.  A vector that fills a third of the table
is therefore one candidate, not a third of the table.

Scale: both passes compare every (query block, vector block) cell, which the stated query set
requires; memory is one cell, what leaves a cell is ``k + 1`` rows a query, and merges are salted.

Defined results: vectors that are null, empty of ids, or hold null or non-finite components take no
part; neither do rows with a null id.  Vectors of different lengths are not compared.  A repeated
(id, vector) row counts once.  Sums are exact whatever the size of the components; a score beyond a 64-bit integer is given as the nearest one, and
such scores tie.  Equal scores go to smaller ids.  Vectors of any length are read whole.  An empty table gives no rows.  Only the id
and the vector are read, so other columns may have any name.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corvidex.llm._spark import stored

QUERY_BLOCK = 4096
VECTOR_BLOCK = 2048
CHUNK = 512
SALTS = 16
LONGEST = 2**63 - 1


def _quantised(batches, k: int, every: int, scale: float):
    """Per batch, one row for each distinct vector: its bytes, smallest ids and the ids that are queries."""
    for batch in batches:
        held: dict[bytes, tuple[set, set]] = {}
        ids = batch.column(0).to_pylist()
        lists = batch.column(1)
        counts = np.asarray(lists.value_lengths().fill_null(0), dtype=np.int64)
        values = np.asarray(lists.flatten().cast(pa.float64()).fill_null(np.nan), dtype=np.float64)
        if len(values) != counts.sum():
            raise ValueError("vector lengths do not add up")
        stops = np.cumsum(counts)
        null = np.asarray(lists.is_null())
        with np.errstate(invalid="ignore", over="ignore"):
            whole = np.nan_to_num(np.floor(values * scale)) + 0.0  # no negative zero: equal vectors have equal bytes
        bad = np.concatenate([[0], np.cumsum(~np.isfinite(values))])
        for i, (vid, stop, n) in enumerate(zip(ids, stops.tolist(), counts.tolist(), strict=True)):
            if vid is None or null[i] or bad[stop] > bad[stop - n]:
                continue
            mine = held.setdefault(whole[stop - n : stop].astype("<f8").tobytes(), (set(), set()))
            mine[0].add(vid)
            if vid % every == 0:
                mine[1].add(vid)
        rows = [(key, sorted(a)[: k + 1], sorted(b)) for key, (a, b) in held.items()]
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[0] for r in rows], pa.binary()), pa.array([r[1] for r in rows], pa.list_(pa.int64())), pa.array([r[2] for r in rows], pa.list_(pa.int64()))],
            names=["key", "ids", "qids"],
        )


def _matrix(keys) -> np.ndarray:
    flat = np.frombuffer(b"".join(keys), dtype="<f8")
    return flat.reshape(len(keys), -1) if len(flat) else np.zeros((len(keys), 0))


def _exact(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Both matrices of whole numbers in a type that holds every sum of their products: float64, int64 or Python's integers."""
    top = (int(np.abs(a).max(initial=0)) or 1) * (int(np.abs(b).max(initial=0)) or 1) * max(1, a.shape[1])
    if top < 2**53:
        return a, b
    if top < LONGEST:
        return a.astype(np.int64), b.astype(np.int64)
    whole = np.frompyfunc(int, 1, 1)
    return whole(a), whole(b)


def _best(scores: np.ndarray, ids: list, most: int) -> list[tuple[int, int]]:
    """The best ``most`` (score, id) rows of some classes; ties to smaller ids."""
    rows = [(max(-LONGEST, min(LONGEST, -int(s))), v) for s, own in zip(scores, ids, strict=True) for v in own]
    return sorted(rows)[:most]


def _top_columns(part: np.ndarray, first_ids: np.ndarray, most: int) -> np.ndarray:
    """Column numbers of the best ``most`` entries of each row, ties to smaller first ids."""
    n = part.shape[1]
    if n <= most:
        return np.broadcast_to(np.arange(n), part.shape)
    # columns come ordered by first id, so a stable order by score settles ties; the partition only narrows it
    edge = -np.partition(-part, most - 1, axis=1)[:, most - 1]
    out = np.empty((len(part), most), np.int64)
    for i, row in enumerate(part):
        own = np.flatnonzero(row >= edge[i])
        out[i] = own[np.argsort(-row[own], kind="stable")[:most]]
    return out


def _cells(vectors: pd.DataFrame, queries: pd.DataFrame):
    """Pairs of a vector matrix and a query chunk of the same length within a cell."""
    if not len(vectors) or not len(queries):
        return
    vectors = vectors.assign(n=vectors["key"].str.len(), first=vectors["ids"].str[0]).sort_values("first", kind="stable")
    queries = queries.assign(n=queries["key"].str.len())
    for n, own in queries.groupby("n", sort=True):
        there = vectors[vectors["n"] == n]
        if len(there):
            v = _matrix(list(there["key"]))
            for at in range(0, len(own), CHUNK):
                chunk = own.iloc[at : at + CHUNK]
                q = _matrix(list(chunk["key"]))
                yield chunk, *_exact(q, v), list(there["ids"]), there["first"].to_numpy()


def _segments(n: int, segments: int) -> list[slice]:
    edges = np.linspace(0, n, max(1, min(segments, n)) + 1).astype(int)
    return [slice(a, b) for a, b in zip(edges[:-1], edges[1:], strict=True)]


def _gather(segments: int, most: int):
    def cell(vectors: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        keys, found = [], []
        for chunk, q, v, ids, first in _cells(vectors, queries):
            parts = [q[:, s] @ v[:, s].T for s in _segments(q.shape[1], segments)]
            total = sum(parts)
            lists = np.concatenate([_top_columns(p, first, most) for p in parts], axis=1)
            for i, key in enumerate(chunk["key"]):
                own = np.unique(lists[i])
                keys.append(key)
                found.append([-s for s, _ in _best(total[i, own], [ids[j] for j in own], most)])
        return pd.DataFrame({"key": keys, "top": found})

    return cell


def _collect(segments: int, most: int):
    def cell(vectors: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        keys, found = [], []
        for chunk, q, v, ids, _ in _cells(vectors, queries):
            cuts = _segments(q.shape[1], segments)
            parts = [q[:, s] @ v[:, s].T for s in cuts]
            for i, (key, tau) in enumerate(zip(chunk["key"], chunk["tau"].tolist(), strict=True)):
                own = np.arange(len(ids))
                tau = None if pd.isna(tau) or int(tau) <= -LONGEST else int(tau)  # the least score of all cuts nothing off
                if tau is not None:
                    uniform = -(-tau // len(cuts))
                    passed = [p[i] >= uniform for p in parts]
                    own = np.flatnonzero(np.logical_or.reduce(passed))
                    bound = sum(np.where(h[own], p[i, own], uniform) for h, p in zip(passed, parts, strict=True))
                    own = own[bound >= tau]
                exact = sum(p[i, own] for p in parts)
                if tau is not None:
                    own, exact = own[exact >= tau], exact[exact >= tau]
                if not len(own):
                    continue
                best = np.argsort(-exact, kind="stable")[:most]  # columns are ordered by first id
                rows = _best(exact[best], [ids[j] for j in own[best]], most)
                keys.append(key)
                found.append([{"s": s, "v": v_} for s, v_ in rows])
        return pd.DataFrame({"key": keys, "top": found})

    return cell


def exact_top_k(vectors: DataFrame, k: int = 5, every: int = 50, id_col: str = "vec_id", vector_col: str = "embedding", scale: float = 256.0, segments: int = 2) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` best other rows of each row whose id is divisible by ``every``."""
    spark = vectors.sparkSession
    most = k + 1
    read = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("v"))
    rows = stored(read.mapInArrow(lambda it: _quantised(it, k, every, scale), "key binary, ids array<long>, qids array<long>"), "topk-rows")
    merged = lambda c: F.slice(F.array_sort(F.array_distinct(F.flatten(F.collect_list(c)))), 1, most)
    classes = rows.groupBy("key", F.pmod(F.xxhash64("ids"), F.lit(SALTS)).alias("salt")).agg(merged("ids").alias("ids")).groupBy("key").agg(merged("ids").alias("ids"))
    classes = stored(classes, "topk-classes")
    members = rows.select("key", F.explode("qids").alias("query_id")).distinct()
    members = stored(members, "topk-queries")
    wanted = members.select("key").distinct()
    n_vectors, n_queries = classes.count(), wanted.count()
    v_blocks, q_blocks = max(1, math.ceil(n_vectors / VECTOR_BLOCK)), max(1, math.ceil(n_queries / QUERY_BLOCK))
    block = lambda n, seed: F.pmod(F.xxhash64("key", F.lit(seed)), F.lit(n)).cast("int")
    every_of = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    held = classes.select("key", "ids", block(v_blocks, 1).alias("vb")).withColumn("qb", every_of(q_blocks))
    asked = wanted.select("key", block(q_blocks, 2).alias("qb"))

    def over_cells(queries: DataFrame, work, schema: str) -> DataFrame:
        there = queries.withColumn("vb", every_of(v_blocks))
        return held.groupBy("vb", "qb").cogroup(there.groupBy("vb", "qb")).applyInPandas(work, schema)

    def best(df: DataFrame, ascending: bool) -> DataFrame:
        top = F.slice(F.sort_array(F.flatten(F.collect_list("top")), ascending), 1, most).alias("top")
        return df.groupBy("key", F.pmod(F.xxhash64("top"), F.lit(SALTS)).alias("salt")).agg(top).groupBy("key").agg(top)

    local = best(over_cells(asked, _gather(segments, most), "key binary, top array<long>"), False)
    # fewer rows than asked for leave no cutoff: then every entry is collected; as text, as pandas would turn longs with nulls into doubles
    cut = local.select("key", F.when(F.size("top") >= most, F.get("top", F.lit(most - 1)).cast("string")).alias("tau"))
    cut = stored(wanted.join(cut, "key", "left").select("key", block(q_blocks, 2).alias("qb"), "tau"), "topk-cut")
    final = best(over_cells(cut, _collect(segments, most), "key binary, top array<struct<s:long,v:long>>"), True)
    return (
        members.join(final, "key")
        .select("query_id", F.posexplode(F.slice(F.filter("top", lambda e: e["v"] != F.col("query_id")), 1, k)).alias("at", "e"))
        .select("query_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("e.v").alias("vec_id"), (-F.col("e.s")).alias("score"))
    )
