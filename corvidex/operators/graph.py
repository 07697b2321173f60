"""Approximate vector search over layered proximity graphs, one graph a share of the vectors.

A share's vectors are nodes; each node is linked to neighbours none of which is nearer to another kept neighbour than to the node itself,
and to the nodes that chose it.  Higher layers hold ever fewer nodes, linked alike.  A query walks greedily down the layers and
keeps a beam of the nearest nodes on the lowest one; the shares' lists are merged.  Ten thousand texts' vectors and queries of other texts, beam 200: recall 0.95 of the best five for 16 %
of the similarities; two thousand random vectors, beam 24: 1.0 for 18 %.  Below a thousand vectors exact search computes hardly more.  The graph is a table with a row a node:
``(share, node, ids, vector, links)``, ``links`` holding an array of neighbours for each layer the node is on.

Shares have about ``share_rows`` vectors whatever the number of all, so a task's work is bounded, and new vectors become new
shares.  Queries are copied to every share, in blocks of ``QUERY_NUMBERS`` numbers; nothing is collected.  Vectors that are equal are one node with
all their ids.  Rows without an id or a vector, and vectors with nulls or NaN, take no part; vectors of another length than most of their share do not either.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corvidex.operators.bm25 import ranked
from corvidex.operators.dense import from_arrow, whole

#: Numbers of the query vectors that one task holds.
QUERY_NUMBERS = 1 << 21
#: One in so many nodes of a layer is on the next one too.
THIN = 12


def unit(m: np.ndarray) -> np.ndarray:
    return m / np.where((n := np.sqrt((m * m).sum(1, keepdims=True))) > 0, n, 1)


def neighbours(v: np.ndarray, degree: int, pool: int) -> list[np.ndarray]:
    """Links of one layer over unit vectors: chosen from the ``pool`` nearest by the rule above, then made mutual, at most ``2 * degree`` a node."""
    n = len(v)
    if n < 2:
        return [np.zeros(0, np.int32) for _ in range(n)]
    pool = min(pool, n - 1)
    chosen: list[np.ndarray] = []
    for lo in range(0, n, 256):
        s = v[lo : lo + 256] @ v.T
        s[np.arange(len(s)), lo + np.arange(len(s))] = -np.inf
        near = np.argpartition(s, n - pool, axis=1)[:, n - pool :]
        own = np.take_along_axis(s, near, 1)
        order = np.argsort(-own, axis=1, kind="stable")
        near, own = np.take_along_axis(near, order, 1), np.take_along_axis(own, order, 1)
        between = np.einsum("nad,nbd->nab", v[near], v[near])
        kept = np.zeros(near.shape, bool)
        for j in range(pool):
            blocked = (kept[:, :j] & (between[:, j, :j] > own[:, j, None])).any(1)
            kept[:, j] = ~blocked & (kept.sum(1) < degree)
        # slots left over go to the nearest of those passed over
        spare = ~kept & (np.cumsum(~kept, 1) <= (degree - kept.sum(1))[:, None])
        chosen += [row[k] for row, k in zip(near, kept | spare, strict=True)]
    back: list[list[int]] = [[] for _ in range(n)]
    for i, row in enumerate(chosen):
        for j in row.tolist():
            back[j].append(i)
    links = []
    for i, row in enumerate(chosen):
        more = np.setdiff1d(np.array(back[i], np.int64), row)
        more = more[np.argsort(-(v[more] @ v[i]), kind="stable")]
        links.append(np.concatenate([row, more])[: 2 * degree].astype(np.int32))
    return bridged(v, links)


def bridged(v: np.ndarray, links: list[np.ndarray]) -> list[np.ndarray]:
    """The links, with one more both ways between each part that hangs together and the node outside it that is nearest to its middle."""
    a = np.repeat(np.arange(len(v)), [len(x) for x in links])
    b = np.concatenate([np.zeros(0, np.int64), *links])
    part = np.arange(len(v))
    while True:  # the smallest number reachable, with short cuts
        low = part.copy()
        np.minimum.at(low, a, part[b])
        np.minimum.at(low, b, part[a])
        low = low[low]
        if (low == part).all():
            break
        part = low
    for p in np.unique(part)[1:]:
        own, rest = np.flatnonzero(part == p), np.flatnonzero(part != p)
        middle = v[own].mean(0)
        i, j = own[(v[own] @ middle).argmax()], rest[(v[rest] @ middle).argmax()]
        links[i], links[j] = np.append(links[i], j).astype(np.int32), np.append(links[j], i).astype(np.int32)
        part[own] = part[j]
    return links


def levels(n: int, share: int) -> np.ndarray:
    """The highest layer of each node, drawn with the share's number as the seed."""
    draw = np.random.default_rng(share).random(n)
    return np.floor(-np.log(1 - draw) / np.log(THIN)).astype(int)


def _built(degree: int, pool: int, id_type: pa.DataType):
    kind = pa.schema({"share": pa.int64(), "node": pa.int32(), "ids": pa.list_(id_type), "vector": pa.list_(pa.float32()), "links": pa.list_(pa.list_(pa.int32()))})

    def work(table: pa.Table) -> pa.Table:
        share = table.column("share")[0].as_py()
        sizes = np.asarray(table.column("dv").combine_chunks().value_lengths(), dtype=np.int64)
        usual = np.bincount(sizes).argmax()
        table = table.filter(pa.array(sizes == usual))
        lists = table.column("dv").combine_chunks()
        v = unit(np.asarray(lists.flatten(), dtype=float).reshape(len(lists), usual)).astype(np.float32)
        v, inverse = np.unique(v, axis=0, return_inverse=True)
        order = np.argsort(inverse, kind="stable")
        counts = np.bincount(inverse, minlength=len(v))
        ids = table.column("doc_id").combine_chunks().take(pa.array(order))
        ids = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(counts)]), pa.int32()), ids.cast(id_type))
        top = levels(len(v), share)
        links: list[list] = [[] for _ in range(len(v))]
        for layer in range(int(top.max()) + 1):
            members = np.flatnonzero(top >= layer)
            for i, row in zip(members.tolist(), neighbours(v[members], degree, pool), strict=True):
                links[i].append(members[row].astype(np.int32))
        flat = pa.ListArray.from_arrays(pa.array(np.arange(len(v) + 1) * usual, pa.int32()), pa.array(v.ravel(), pa.float32()))
        return pa.Table.from_arrays([pa.array([share] * len(v), pa.int64()), pa.array(np.arange(len(v)), pa.int32()), ids, flat, pa.array(links, kind.field("links").type)], schema=kind)

    return work


class Share:
    """A share's graph in arrays, searched for many queries at a time."""

    def __init__(self, vectors: np.ndarray, links: list[list]):
        self.v, self.computed = vectors, 0
        top = np.array([len(x) for x in links])
        self.layers = []
        for layer in range(int(top.max())):
            members = np.flatnonzero(top > layer)
            table = np.full((len(top), max((len(links[i][layer]) for i in members), default=0)), -1, np.int32)
            for i in members.tolist():
                table[i, : len(links[i][layer])] = links[i][layer]
            self.layers.append(table)
        self.entry = int(top.argmax())

    def search(self, q: np.ndarray, beam: int, upper: int = 4) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(nodes, similarities, similarities computed): the ``beam`` best nodes of each query, -1 beyond what was reached."""
        work = np.ones(len(q), np.int64)
        nodes = np.full((len(q), 1), self.entry, np.int64)
        scores = (q @ self.v[self.entry])[:, None]
        for layer in range(len(self.layers) - 1, -1, -1):
            nodes, scores, more = self._beam(q, self.layers[layer], nodes, scores, beam if layer == 0 else upper)
            work += more
        return nodes, scores, work

    def _beam(self, q, table, nodes, scores, beam):
        n = len(q)
        seen = np.zeros((n, len(self.v)), bool)
        rows = np.arange(n)
        np.put_along_axis(seen, np.maximum(nodes, 0), True, 1)
        wide = max(beam, nodes.shape[1])
        pad = wide - nodes.shape[1]
        nodes = np.pad(nodes, ((0, 0), (0, pad)), constant_values=-1)
        scores = np.pad(scores, ((0, 0), (0, pad)), constant_values=-np.inf)
        done = nodes < 0
        work = np.zeros(n, np.int64)
        while True:
            open_scores = np.where(done, -np.inf, scores)
            at = open_scores.argmax(1)
            active = np.flatnonzero(open_scores[rows, at] > -np.inf)
            if not len(active):
                break
            at = at[active]
            done[active, at] = True
            near = table[nodes[active, at]]
            fresh = (near >= 0) & ~seen[active[:, None], np.maximum(near, 0)]
            r, c = np.nonzero(fresh)
            if not len(r):
                continue
            found = near[r, c]
            seen[active[r], found] = True
            work[active] += fresh.sum(1)
            s = np.full(near.shape, -np.inf, scores.dtype)
            s[r, c] = np.einsum("nd,nd->n", q[active[r]], self.v[found])
            all_s = np.concatenate([scores[active], s], 1)
            all_n = np.concatenate([nodes[active], np.where(fresh, near, -1)], 1)
            all_d = np.concatenate([done[active], ~fresh], 1)
            best = np.argpartition(-all_s, wide - 1, axis=1)[:, :wide]
            scores[active], nodes[active], done[active] = (np.take_along_axis(x, best, 1) for x in (all_s, all_n, all_d))
        order = np.argsort(-scores, axis=1, kind="stable")[:, :beam]
        return np.take_along_axis(nodes, order, 1), np.take_along_axis(scores, order, 1), work


def _searched(k: int, beam: int, query_type: pa.DataType, id_type: pa.DataType):
    names = ["query_id", "doc_id", "score", "computed"]
    kinds = [query_type, id_type, pa.float64(), pa.int64()]

    def work(graph: pa.Table, asked: pa.Table) -> pa.Table:
        none = pa.Table.from_arrays([pa.array([], t) for t in kinds], names=names)
        if not len(graph) or not len(asked):
            return none
        graph = graph.sort_by("node")
        lists = graph.column("vector").combine_chunks()
        v = np.asarray(lists.flatten(), dtype=np.float32).reshape(len(lists), -1)
        sizes = np.asarray(asked.column("qv").combine_chunks().value_lengths(), dtype=np.int64)
        asked = asked.filter(pa.array(sizes == v.shape[1]))
        if not len(asked):
            return none
        share = Share(v, graph.column("links").to_pylist())
        ids = graph.column("ids").combine_chunks()
        q = unit(np.asarray(asked.column("qv").combine_chunks().flatten(), dtype=float).reshape(len(asked), -1)).astype(np.float32)
        query_ids = asked.column("query_id").combine_chunks()
        out = [none]
        block = max(1, (32 << 20) // len(v))  # a byte for each query and node
        for lo in range(0, len(q), block):
            nodes, _, computed = share.search(q[lo : lo + block], max(beam, k))
            rows, place = np.nonzero(nodes >= 0)
            found = nodes[rows, place]
            score = np.round(np.einsum("nd,nd->n", q[lo + rows].astype(float), v[found].astype(float)), 6) + 0.0
            # of a node's ids the k smallest can be wanted
            own = [sorted(x)[:k] for x in ids.take(pa.array(found)).to_pylist()]
            reps = np.array([len(x) for x in own], np.int64)
            flat = [i for x in own for i in x]
            rows, score = np.repeat(rows, reps), np.repeat(score, reps)
            order = np.lexsort((-score, rows))
            first = np.searchsorted(rows[order], rows[order], side="left")
            least = score[order][np.minimum(first + k - 1, np.searchsorted(rows[order], rows[order], side="right") - 1)]
            keep = order[score[order] >= least]
            out.append(pa.Table.from_arrays([query_ids.take(pa.array(lo + rows[keep])), pa.array([flat[i] for i in keep.tolist()], id_type), pa.array(score[keep]), pa.nulls(len(keep), pa.int64())], names=names))
            n = len(computed)
            out.append(pa.Table.from_arrays([query_ids.slice(lo, n), pa.nulls(n, id_type), pa.nulls(n, pa.float64()), pa.array(computed, pa.int64())], names=names))
        return pa.concat_tables(out)

    return work


@dataclass
class GraphIndex:
    """``nodes(share, node, ids, vector, links)`` of ``shares`` graphs."""

    nodes: DataFrame
    shares: int
    degree: int = 12
    pool: int = 48
    share_rows: int = 20_000

    def add(self, new: DataFrame) -> GraphIndex:
        """New vectors as further shares; nothing that is there changes."""
        more = build(new, self.degree, self.pool, self.share_rows, first=self.shares)
        return replace(self, nodes=self.nodes.unionByName(more.nodes), shares=more.shares)

    def save(self, path: str) -> None:
        """One folder of files, each share's rows together."""
        self.nodes.repartition("share").write.mode("overwrite").parquet(f"{path}/nodes")
        self.nodes.sparkSession.createDataFrame([(self.shares, self.degree, self.pool, self.share_rows)], "shares int, degree int, pool int, share_rows int").write.mode("overwrite").parquet(f"{path}/settings")

    def _walked(self, queries: DataFrame, k: int, beam: int) -> DataFrame:
        q = whole(queries, "query_id", "qv")
        held = q.agg(F.sum(F.size("qv") + 8)).first()[0] or 0
        blocks = 1 + held // QUERY_NUMBERS
        q = q.withColumn("block", F.pmod(F.xxhash64("query_id"), F.lit(blocks)))
        q = q.withColumn("share", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(max(0, self.shares - 1)).cast("long"))))
        g = self.nodes.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))))
        id_type = pa.list_(pa.int64()).value_type if "bigint" in dict(self.nodes.dtypes)["ids"] else pa.string()
        out = queries.select("query_id").schema.add("doc_id", self.nodes.schema["ids"].dataType.elementType).add("score", "double").add("computed", "long")
        return g.groupBy("share", "block").cogroup(q.groupBy("share", "block")).applyInArrow(_searched(k, beam, from_arrow(queries, "query_id"), id_type), out)

    def search(self, queries: DataFrame, k: int = 5, beam: int = 200) -> DataFrame:
        """(query_id, doc_id, score, rank): approximate; a wider beam finds more."""
        return ranked(self._walked(queries, k, beam).where("doc_id IS NOT NULL").drop("computed"), k)

    def work(self, queries: DataFrame, k: int = 5, beam: int = 200) -> DataFrame:
        """(query_id, computed): how many similarities a search computes for each query."""
        return self._walked(queries, k, beam).where("doc_id IS NULL").groupBy("query_id").agg(F.sum("computed").alias("computed"))

    def stats(self) -> DataFrame:
        """(layer, nodes, links, vectors) over all shares."""
        each = self.nodes.select(F.size("ids").alias("n"), F.posexplode("links").alias("layer", "own"))
        return each.groupBy("layer").agg(F.count(F.lit(1)).alias("nodes"), F.sum(F.size("own")).cast("long").alias("links"), F.sum("n").cast("long").alias("vectors"))


def build(vectors: DataFrame, degree: int = 12, pool: int = 48, share_rows: int = 20_000, first: int = 0) -> GraphIndex:
    """The index of ``vectors(doc_id, dv)``; rows are dealt to shares by a hash of id and vector."""
    rows = whole(vectors, "doc_id", "dv").dropDuplicates(["doc_id", "dv"])  # repeated rows would pile up in one share
    shares = max(1, -(-rows.count() // share_rows))
    dealt = rows.withColumn("share", F.lit(first) + F.pmod(F.xxhash64("doc_id", "dv"), F.lit(shares)))
    id_type = from_arrow(vectors, "doc_id")
    ids = f"array<{dict(vectors.dtypes)['doc_id']}>"
    nodes = dealt.groupBy("share").applyInArrow(_built(degree, pool, id_type), f"share long, node int, ids {ids}, vector array<float>, links array<array<int>>")
    return GraphIndex(nodes, first + shares, degree, pool, share_rows)


def load(spark, path: str) -> GraphIndex:
    own = spark.read.parquet(f"{path}/settings").first()
    return GraphIndex(spark.read.parquet(f"{path}/nodes"), own["shares"], own["degree"], own["pool"], own["share_rows"])
