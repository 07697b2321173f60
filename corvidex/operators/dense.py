"""Vector search over tables of ``array<float>`` columns."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from corvidex.functions.tokenize import dot, normalise
from corvidex.operators.bm25 import ranked

#: Query sides up to this many rows are sent to every executor by ``_pairs``; larger ones are joined in blocks.
BROADCAST_ROWS = 20_000
#: Query vectors up to this many bytes go to every task of ``top_k``; more meet the vectors in blocks.
QUERY_BYTES = 32 << 20
BLOCKS = 64


def _pairs(queries: DataFrame, docs: DataFrame) -> DataFrame:
    """Every query beside every document: the query side is broadcast if counted small, else both meet in blocks."""
    if queries.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:
        return docs.crossJoin(F.broadcast(queries))
    return _in_blocks(queries, docs)


def _in_blocks(queries: DataFrame, docs: DataFrame) -> DataFrame:
    q = queries.withColumn("__b", F.pmod(F.xxhash64("query_id"), F.lit(BLOCKS)))
    d = docs.withColumn("__b", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(BLOCKS - 1).cast("long"))))
    return d.join(q, "__b").drop("__b")


def whole(rows: DataFrame, key: str, vector: str, *more: str) -> DataFrame:
    """(key, vector as doubles, ``more`` columns) of the rows that can be searched: with a key, and a vector without nulls and NaN."""
    v = F.col(vector).cast("array<double>")
    return rows.where(F.col(key).isNotNull() & F.col(vector).isNotNull()).select(key, v.alias(vector), *more).where(~F.exists(vector, lambda x: x.isNull() | F.isnan(x)))


def keep_best(rows: np.ndarray, scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Which of the entries (query row, score, id) are among the ``k`` best of their row; ties to smaller ids."""
    order_of_id = np.unique(ids, return_inverse=True)[1]
    order = np.lexsort((order_of_id, -scores, rows))
    own = rows[order]
    begins = np.flatnonzero(np.diff(own, prepend=-1))
    place = np.arange(len(own)) - np.repeat(begins, np.diff(np.append(begins, len(own))))
    return order[place < k]


def _local_best(queries: DataFrame, docs: DataFrame, k: int, cosine: bool) -> DataFrame:
    """(query_id, doc_id, score): each task's ``k`` best of every query.

    Arrow batches meet the queries of their length in one matrix product; the best so far are carried from batch to batch, and each
    task gives them once.
    """
    by_size: dict[int, list] = {}
    for r in queries.collect():
        by_size.setdefault(len(r["qv"]), []).append(r)
    unit = lambda m: m / np.where((n := np.sqrt((m * m).sum(1, keepdims=True))) > 0, n, 1) if cosine else m
    held = {n: (pa.array([r["query_id"] for r in own], from_arrow(queries, "query_id")), unit(np.array([r["qv"] for r in own], float).reshape(len(own), n))) for n, own in by_size.items()}
    out = queries.select("query_id").schema.add("doc_id", docs.schema["doc_id"].dataType).add("score", "double")

    def work(batches):
        best: dict[int, list] = {}
        kind = None
        for batch in batches:
            ids, lists = batch.column(0), batch.column(1)
            kind = ids.type
            sizes = np.asarray(lists.value_lengths(), dtype=np.int64)
            for size, (_, q) in held.items():
                use = np.flatnonzero(sizes == size)
                if not len(use):
                    continue
                v = unit(np.asarray(lists.take(pa.array(use)).flatten(), dtype=float).reshape(len(use), size))
                names = ids.take(pa.array(use)).to_numpy(zero_copy_only=False)
                for lo in range(0, len(q), 1024):
                    s = np.round(q[lo : lo + 1024] @ v.T, 6) + 0.0
                    rows, scores, found, least = best.get((size, lo)) or [np.zeros(0, np.int64), np.zeros(0), names[:0], np.full(len(s), -np.inf)]
                    if s.shape[1] > k:
                        least = np.maximum(least, np.partition(s, s.shape[1] - k, axis=1)[:, s.shape[1] - k])
                    at, col = np.nonzero(s >= least[:, None])
                    rows, scores, found = np.concatenate([rows, at]), np.concatenate([scores, s[at, col]]), np.concatenate([found, names[col]])
                    keep = keep_best(rows, scores, found, k)
                    rows, scores, found = rows[keep], scores[keep], found[keep]
                    full = np.bincount(rows, minlength=len(s)) >= k
                    worst = np.full(len(s), np.inf)
                    np.minimum.at(worst, rows, scores)
                    best[size, lo] = [rows, scores, found, np.where(full, worst, -np.inf)]
        for (size, lo), (rows, scores, found, _) in best.items():
            yield pa.RecordBatch.from_arrays([held[size][0].take(pa.array(rows + lo)), pa.array(found, kind), pa.array(scores)], names=["query_id", "doc_id", "score"])

    return docs.mapInArrow(work, out)


#: Scores are counted by millionths: those within this many of 0 in an array, others by sorting.
NEAR = 1 << 21


def _counted(q_ids, q_labels, q, ids, labels, v, near) -> list:
    """Adds the pairs of two blocks of vectors to ``near`` by score and agreement; returns (score, gold, n) of the scores outside of it."""
    rest = []
    for lo in range(0, len(q), 512):
        for at in range(0, len(v), 8192):
            s = np.round(q[lo : lo + 512] @ v[at : at + 8192].T, 6) + 0.0
            other = q_ids[lo : lo + 512, None] != ids[None, at : at + 8192]
            gold = q_labels[lo : lo + 512, None] == labels[None, at : at + 8192]
            inside = np.abs(s) < NEAR / 1e6 - 1
            cells = ((np.rint(np.where(inside, s, 0.0) * 1e6).astype(np.int64) + NEAR) * 2 + gold)[other & inside]
            if len(cells):
                low = cells.min()
                n = np.bincount(cells - low)
                near[low : low + len(n)] += n
            if not inside.all():
                for g in (False, True):
                    rest.append((*np.unique(s[other & ~inside & (gold == g)], return_counts=True), float(g)))
    return rest


def _by_size(rows: pa.RecordBatch | pa.Table):
    """(length, ids, labels, vectors) of (id, label, vector) rows, for each length of a vector."""
    ids, labels, lists = (c.combine_chunks() if isinstance(c, pa.ChunkedArray) else c for c in rows.columns[:3])
    sizes = np.asarray(lists.value_lengths(), dtype=np.int64)
    for size in np.unique(sizes):
        use = pa.array(np.flatnonzero(sizes == size))
        v = np.asarray(lists.take(use).flatten(), dtype=float).reshape(len(use), size)
        yield size, ids.take(use).to_numpy(zero_copy_only=False), np.array([np.nan if x is None else x for x in labels.take(use).to_pylist()]), v


def _count_rows(near: np.ndarray, rest: list):
    at = np.flatnonzero(near)
    for score, n, gold in [((at // 2 - NEAR) / 1e6, near[at], (at % 2).astype(float)), *rest]:
        for lo in range(0, len(n), 100_000):
            g = gold[lo : lo + 100_000] if isinstance(gold, np.ndarray) else np.full(len(n[lo : lo + 100_000]), gold)
            yield pa.RecordBatch.from_arrays([pa.array(score[lo : lo + 100_000]), pa.array(g), pa.array(n[lo : lo + 100_000], pa.int64())], names=["score", "gold", "n"])


def pair_counts(queries: DataFrame, docs: DataFrame) -> DataFrame:
    """(score, gold, n): how many pairs of ``queries(query_id, label, qv)`` and ``docs(doc_id, label, dv)`` have an inner product (to 6
    places), and whether their labels agree; a row is no pair with itself.

    Every pair is computed, in matrix products, but none becomes a row: a task counts its pairs by score.  Queries of up to ``QUERY_BYTES`` go to
    every task; more meet the vectors in groups of bounded size.
    """
    there = lambda rows, v: rows.where(F.col(v).isNotNull()).where(~F.exists(v, lambda x: x.isNull()))
    q = there(queries.select("query_id", "label", F.col("qv").cast("array<double>").alias("qv")), "qv")
    d = there(docs.select("doc_id", "label", F.col("dv").cast("array<double>").alias("dv")), "dv")
    out = "score double, gold double, n long"
    numbers = 8 * (q.agg(F.sum(F.size("qv") + 2)).first()[0] or 0)
    if numbers <= QUERY_BYTES:
        held = {size: own for size, *own in _by_size(q.toArrow())}

        def work(batches):
            near, rest = np.zeros(4 * NEAR, np.int64), []
            for batch in batches:
                for size, *own in _by_size(batch):
                    if size in held:
                        rest += _counted(*held[size], *own, near)
                yield from _count_rows(near[:0], rest)
                rest = []
            yield from _count_rows(near, rest)

        parts = d.mapInArrow(work, out)
    else:
        shares, blocks = -(-numbers // QUERY_BYTES), max(1, -(-d.count() // 50_000))
        mine = q.withColumn("i", F.pmod(F.xxhash64("query_id"), F.lit(shares))).withColumn("j", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))))
        theirs = d.withColumn("j", F.pmod(F.xxhash64("doc_id"), F.lit(blocks))).withColumn("i", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(shares - 1).cast("long"))))

        def met(left: pa.Table, right: pa.Table) -> pa.Table:
            near, rest = np.zeros(4 * NEAR, np.int64), []
            held = {size: own for size, *own in _by_size(left)}
            for size, *own in _by_size(right):
                if size in held:
                    rest += _counted(*held[size], *own, near)
            return pa.Table.from_batches(list(_count_rows(near, rest)), pa.schema([("score", pa.float64()), ("gold", pa.float64()), ("n", pa.int64())]))

        parts = mine.groupBy("i", "j").cogroup(theirs.groupBy("i", "j")).applyInArrow(met, out)
    return parts.groupBy("score", "gold").agg(F.sum("n").alias("n"))


def from_arrow(rows: DataFrame, name: str) -> pa.DataType:
    """The Arrow type of a column."""
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(rows.schema[name].dataType)


def top_k(queries: DataFrame, docs: DataFrame, k: int = 5, cosine: bool = True, threshold: float | None = None) -> DataFrame:
    """(query_id, doc_id, score, rank) for ``queries(query_id, qv)`` and ``docs(doc_id, dv)``; exact, ties to smaller ids.

    A query meets the vectors of its own length.  Rows without an id or a vector, and vectors that hold nulls or NaN, take no part.
    Query vectors of up to ``QUERY_BYTES`` in all go to every task, which keeps the ``k`` best of each; more meet the vectors in blocks.
    """
    q, d = whole(queries, "query_id", "qv"), whole(docs, "doc_id", "dv")
    numbers = q.agg(F.sum(F.size("qv") + 8)).first()[0] or 0
    if 8 * numbers <= QUERY_BYTES:
        scored = _local_best(q, d, k, cosine)
        return ranked(scored if threshold is None else scored.where(F.col("score") >= threshold), k)
    if cosine:
        q, d = q.withColumn("qv", normalise(F.col("qv"))), d.withColumn("dv", normalise(F.col("dv")))
    met = _in_blocks(q, d).where(F.size("qv") == F.size("dv"))
    scored = met.select("query_id", "doc_id", F.round(dot(F.col("qv"), F.col("dv")), 6).alias("score"))
    return ranked(scored if threshold is None else scored.where(F.col("score") >= threshold), k)


def similarity_pairs(vectors: DataFrame) -> DataFrame:
    """(a, b, score), a < b, of all rows of ``vectors(doc_id, dv)``; meant for one group of bounded size."""
    v = vectors.select("doc_id", normalise(F.col("dv")).alias("v"))
    pairs = _pairs(v.select(F.col("doc_id").alias("query_id"), F.col("v").alias("qv")), v)
    return pairs.where("doc_id < query_id").select(F.col("doc_id").alias("a"), F.col("query_id").alias("b"), F.round(dot(F.col("v"), F.col("qv")), 6).alias("score"))


def train_cells(vectors: DataFrame, cells: int = 100, sample: int = 50_000, seed: int = 4) -> DataFrame:
    """(cell_id, centre) by k-means on at most ``sample`` rows (documented bound)."""
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.functions import array_to_vector

    rows = vectors.orderBy(F.xxhash64("doc_id")).limit(sample).select(array_to_vector(normalise(F.col("dv"))).alias("features"))
    model = KMeans(k=cells, seed=seed, maxIter=10).fit(rows)
    return vectors.sparkSession.createDataFrame([(i, [float(x) for x in c]) for i, c in enumerate(model.clusterCenters())], "cell_id int, centre array<double>")


def assign_cells(vectors: DataFrame, centres: DataFrame, vector_col: str = "dv", probes: int = 1) -> DataFrame:
    """The rows once for each of the ``probes`` cells nearest to them, by one matrix product a batch; ties to larger cells.

    The centres, a fixed number of rows, go to every task.  A row whose vector does not fit them is put into the first cell.
    """
    held = centres.orderBy("cell_id").collect()
    cells, middle = np.array([r["cell_id"] for r in held], np.int32), np.array([r["centre"] for r in held], float)
    column = vectors.columns.index(vector_col)

    def work(batches):
        for batch in batches:
            lists = batch.column(column)
            fit = np.flatnonzero(np.asarray(lists.value_lengths().fill_null(-1), dtype=np.int64) == middle.shape[1])
            v = np.asarray(lists.take(pa.array(fit)).flatten().cast(pa.float64()).fill_null(0.0), dtype=float).reshape(len(fit), -1)
            near = np.argsort(v @ middle.T, axis=1, kind="stable")[:, ::-1][:, :probes]
            rest = np.setdiff1d(np.arange(len(batch)), fit)
            rows = np.concatenate([np.repeat(fit, near.shape[1]), rest])
            own = batch.take(pa.array(rows))
            cell = np.concatenate([cells[near].ravel(), np.full(len(rest), cells[0], np.int32)])
            yield pa.RecordBatch.from_arrays([*own.columns, pa.array(cell, pa.int32())], names=[*batch.schema.names, "cell_id"])

    return vectors.mapInArrow(work, StructType([*vectors.schema.fields, StructField("cell_id", IntegerType())]))


def _best_of_cells(asked: list, batch, k: int) -> tuple:
    """(query rows, scores, ids): the ``k`` best in ``batch(id, vector, cell)`` of each of ``asked``, (length, cell, query rows, unit vectors)."""
    ids, lists, cell = (c.combine_chunks() if isinstance(c, pa.ChunkedArray) else c for c in batch.columns[:3])
    sizes, cell = np.asarray(lists.value_lengths(), dtype=np.int64), np.asarray(cell)
    found = [(np.zeros(0, np.int64), np.zeros(0), np.zeros(0, ids.to_numpy(zero_copy_only=False).dtype))]
    for size, own, rows, q in asked:
        use = np.flatnonzero((sizes == size) & (cell == own))
        if not len(use):
            continue
        v = np.asarray(lists.take(pa.array(use)).flatten(), dtype=float).reshape(len(use), size)
        v, names = v / np.where((n := np.sqrt((v * v).sum(1, keepdims=True))) > 0, n, 1), ids.take(pa.array(use)).to_numpy(zero_copy_only=False)
        for lo in range(0, len(q), 1024):
            s = np.round(q[lo : lo + 1024] @ v.T, 6) + 0.0
            least = np.partition(s, -k, axis=1)[:, -k] if s.shape[1] > k else np.full(len(s), -np.inf)
            at, col = np.nonzero(s >= least[:, None])
            found.append((rows[lo + at], s[at, col], names[col]))
    rows, scores, names = (np.concatenate([f[i] for f in found]) for i in range(3))
    keep = keep_best(rows, scores, names, k)
    return rows[keep], scores[keep], names[keep]


def _asked_cells(queries) -> tuple:
    """(ids, groups for ``_best_of_cells``) of ``queries(query_id, qv, cell_id)``; a query is known by the number of its id."""
    ids, lists, cell = (c.combine_chunks() if isinstance(c, pa.ChunkedArray) else c for c in queries.columns[:3])
    known = ids.dictionary_encode()
    rows, sizes, cell = np.asarray(known.indices).astype(np.int64), np.asarray(lists.value_lengths(), dtype=np.int64), np.asarray(cell)
    asked = []
    for size, own in sorted(set(zip(sizes.tolist(), cell.tolist(), strict=True))):
        use = np.flatnonzero((sizes == size) & (cell == own))
        v = np.asarray(lists.take(pa.array(use)).flatten(), dtype=float).reshape(len(use), size)
        asked.append((size, own, rows[use], v / np.where((n := np.sqrt((v * v).sum(1, keepdims=True))) > 0, n, 1)))
    return known.dictionary, asked


def search_cells(queries: DataFrame, assigned: DataFrame, centres: DataFrame, k: int = 5, probes: int = 10) -> DataFrame:
    """Approximate top-k: a query meets the vectors of its ``probes`` nearest cells, in one matrix product a cell and batch.

    Queries that are up to ``QUERY_BYTES`` once for each cell go to every task, which keeps the ``k`` best of each; more meet the vectors in groups of bounded size.
    """
    q = assign_cells(whole(queries, "query_id", "qv"), centres, "qv", probes)
    d = whole(assigned.select("doc_id", "dv", "cell_id"), "doc_id", "dv", "cell_id")
    out = queries.select("query_id").schema.add("doc_id", assigned.schema["doc_id"].dataType).add("score", "double")
    numbers = 8 * (q.agg(F.sum(F.size("qv") + 2)).first()[0] or 0)
    kind = from_arrow(assigned, "doc_id")
    if numbers <= QUERY_BYTES:
        ids, asked = _asked_cells(q.toArrow())

        def work(batches):
            best = None
            for batch in batches:
                found = _best_of_cells(asked, batch, k)
                best = found if best is None else tuple(np.concatenate(x) for x in zip(best, found, strict=True))
                keep = keep_best(*best, k)
                best = tuple(x[keep] for x in best)
            if best is not None:
                yield pa.RecordBatch.from_arrays([ids.take(pa.array(best[0])), pa.array(best[2], kind), pa.array(best[1])], names=["query_id", "doc_id", "score"])

        return ranked(d.mapInArrow(work, out), k)
    shares, blocks = -(-numbers // QUERY_BYTES), max(1, -(-d.count() // 50_000))
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")))
    mine = q.withColumn("i", F.pmod(F.xxhash64("query_id"), F.lit(shares))).withColumn("j", every(blocks))
    theirs = d.withColumn("j", F.pmod(F.xxhash64("doc_id"), F.lit(blocks))).withColumn("i", every(shares))

    def met(left: pa.Table, right: pa.Table) -> pa.Table:
        ids, asked = _asked_cells(left)
        rows, scores, names = _best_of_cells(asked, right, k)
        return pa.table([ids.take(pa.array(rows)), pa.array(names, kind), pa.array(scores)], names=["query_id", "doc_id", "score"])

    return ranked(mine.groupBy("i", "j").cogroup(theirs.groupBy("i", "j")).applyInArrow(met, out), k)


def ivf_top_k(queries: DataFrame, docs: DataFrame, k: int = 5, cells: int = 100, probes: int = 10) -> DataFrame:
    """Search over trained cells; fewer vectors than cells are searched exactly."""
    if docs.limit(cells).count() < cells:
        return top_k(queries, docs, k)
    centres = train_cells(docs, cells)
    return search_cells(queries, assign_cells(docs, centres), centres, k, probes)
