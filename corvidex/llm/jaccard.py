"""The exact check behind :func:`corvidex.llm.simhash.keep_first`: every pair of texts whose word shingles are alike.

A text is the set of the 64-bit hashes of its 5-word shingles.  Two sets link at 0.8 or more of their union.
The search is a prefix join: in any one order of all shingles, two linked sets share one of the first
``n - ceil(0.8 n) + 1`` shingles of each, so only those are looked up.  Rows of a shingle meet in one sorted pass,
which holds one group of bounded size.  Pairs met there that share enough of their first shingles, and pairs that
fingerprints propose, are verified on the whole sets.

* The order puts shingles that a sample of the sets shows to be common last, so a line that many texts share is
  looked up only by texts made of such lines.  The sample changes the cost and never the result.
* Pairs whose sizes, or places in the order, rule out 0.8 are not verified.
* A shingle that more than ``HOT_BUCKET`` sets look up is first compared with some of them: ``CENTRAL`` with the most such
  shingles for their size, as the text has that others are edited from, and ``LEADERS`` by hash.  What those links join is
  one component; then every set outside the largest component of the shingle is compared with all sets of other
  components.  Pairs within a component need no link, so all links that matter are there.
* That last comparison makes pairs only of sets whose sketches allow the similarity.  A sketch is the parity of the set's
  hashes in each of ``SKETCH`` cells; where two sketches differ, a hash is in one set only, so no pair that is alike is lost.

Equal sets are one node from the start, so copies never multiply.  A task holds ``PART_BYTES`` of text or the longest text.

Defined results: words are ASCII-lower-cased runs without ASCII white space; a text of fewer words than a shingle has
the whole sequence as its one shingle; null, empty and blank texts have the empty set, equal to itself.
"""

from __future__ import annotations

from fractions import Fraction
from math import ceil

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corvidex.llm._graph import components
from corvidex.llm._spark import give_back_memory, stored
from corvidex.llm._words import ranges, slices, texts_of

SEED = 42
WIDTH = 5
FOUR_FIFTHS = Fraction(4, 5)
#: 1 / SAMPLE of the sets is counted for the order; a shingle in COMMON of them comes late.  At most MOST shingles do.
SAMPLE, COMMON, MOST = 8, 3, 200_000
HOT_BUCKET = 16
LEADERS, CENTRAL = 8, 2
#: Cells of a sketch, a multiple of 64.
SKETCH = 1024
#: Of text at a time; a longer text is a part of its own.
PART_BYTES = 4 << 20
_FACTORS = np.random.default_rng(SEED).integers(0, 1 << 63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


def shingle_set(text: str | None, width: int = WIDTH) -> np.ndarray:
    """The sorted distinct hashes of one text's shingles, unsigned."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    digest = xxhash.xxh64_intdigest
    own = np.fromiter((digest(w, SEED) for w in words), np.uint64, len(words))
    used = min(width, len(words))
    total = np.full(len(words) - used + 1, used, np.uint64)
    for i in range(used):
        total += own[i : len(words) - used + 1 + i] * _FACTORS[i]
    return np.unique(_mix(total))


def node_of(shingles: np.ndarray) -> int:
    """A signed 64-bit name of a set."""
    return int(np.array([xxhash.xxh64_intdigest(shingles.tobytes(), SEED)], np.uint64).view(np.int64)[0])


def fingerprint_of(shingles: np.ndarray) -> int:
    """The SimHash of a set, signed: a bit is 1 if set in over half of its hashes."""
    counts = np.zeros(64, np.int64)
    for at in range(0, len(shingles), 1 << 16):
        counts += np.unpackbits(shingles[at : at + (1 << 16)].astype(">u8").view(np.uint8).reshape(-1, 8), axis=1).sum(0, dtype=np.int64)
    return int(np.packbits(counts * 2 > len(shingles)).view(">u8").astype(np.uint64).view(np.int64)[0])


def prefix_length(n: int, similarity: Fraction = FOUR_FIFTHS) -> int:
    return n - ceil(similarity * n) + 1 if n else 0


def sketch_of(shingles: np.ndarray) -> np.ndarray:
    """The parities of how many hashes of a set fall into each cell, as signed words of 64 cells."""
    odd = np.bincount((shingles % np.uint64(SKETCH)).astype(np.int64), minlength=SKETCH) % 2
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def named(rows: DataFrame, width: int) -> DataFrame:
    """The columns of ``rows(.., text)`` but the text, with the name and the fingerprint of its set."""
    keys = [c for c in rows.columns if c != "text"]

    def work(batches):
        for batch in batches:
            text = batch.column(len(keys))
            for lo, hi in slices(text, PART_BYTES):
                sets = (shingle_set(t.as_py(), width) for t in texts_of(text.slice(lo, hi - lo)))
                both = np.fromiter(((node_of(x), fingerprint_of(x)) for x in sets), np.dtype((np.int64, 2)), hi - lo)
                own = batch.slice(lo, hi - lo)
                yield pa.RecordBatch.from_arrays([*[own.column(i) for i in range(len(keys))], pa.array(both[:, 0]), pa.array(both[:, 1])], names=[*keys, "node", "fp"])
                give_back_memory()

    return rows.select(*keys, "text").mapInArrow(work, rows.select(*keys).schema.add("node", "long").add("fp", "long"))


def _common(texts: DataFrame, width: int) -> np.ndarray:
    """The common shingles of a sample, the rarest first."""

    def work(batches):
        for batch in batches:
            for start, stop in slices(batch.column(0), PART_BYTES):
                own = np.concatenate([shingle_set(t.as_py(), width) for t in texts_of(batch.column(0).slice(start, stop - start))])
                yield pa.RecordBatch.from_arrays([pa.array(own.view(np.int64))], names=["token"])
                give_back_memory()

    counted = texts.where(F.pmod(F.xxhash64("text"), F.lit(SAMPLE)) == 0).select("text").mapInArrow(work, "token long").groupBy("token").agg(F.count(F.lit(1)).alias("c"))
    rows = counted.where(F.col("c") >= COMMON).orderBy(F.col("c").desc(), "token").limit(MOST).collect()
    return np.array([r["token"] for r in reversed(rows)], np.int64).view(np.uint64)


def _prefixes(texts: DataFrame, common: np.ndarray, width: int, similarity: Fraction) -> DataFrame:
    """(token, node, n, pos): the first shingles of each set in the order."""
    by_value = np.argsort(common)
    values = common[by_value]

    def first(shingles: np.ndarray) -> np.ndarray:
        p = prefix_length(len(shingles), similarity)
        if not len(values) or not p:
            return shingles[:p]
        at = np.minimum(np.searchsorted(values, shingles), len(values) - 1)
        late = values[at] == shingles
        rank = np.sort(by_value[at[late]])
        return np.concatenate([shingles[~late], common[rank]])[:p]

    def work(batches):
        for batch in batches:
            for start, stop in slices(batch.column(0), PART_BYTES):
                own, sizes, nodes = [], [], []
                for t in texts_of(batch.column(0).slice(start, stop - start)):
                    shingles = shingle_set(t.as_py(), width)
                    own.append(first(shingles))
                    sizes.append(len(shingles))
                    nodes.append(node_of(shingles))
                k = np.fromiter(map(len, own), np.int64, len(own))
                columns = [np.concatenate(own).view(np.int64), np.repeat(np.array(nodes, np.int64), k), np.repeat(np.array(sizes, np.int32), k), ranges(np.zeros(len(k), np.int64), k).astype(np.int32)]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["token", "node", "n", "pos"])
                give_back_memory()

    return texts.select("text").mapInArrow(work, "token long, node long, n int, pos int")


def _met(similarity: Fraction, most: int):
    """Reads (token, node, n, pos) in order of token and node; writes the pairs of nodes of like size that share a token, with
    how many tokens they were seen to share, whether one of them leaves room for enough others behind it, and their sizes; and
    the rows of tokens that more than ``most`` nodes look up as they are.  Holds one batch and one such group at a time."""
    p, q = similarity.numerator, similarity.denominator

    def pairs(token, node, n, pos):
        """Candidate pairs of whole groups: all groups of one size at a time."""
        starts = np.flatnonzero(np.append(True, token[1:] != token[:-1])) if len(token) else np.zeros(0, np.int64)
        sizes = np.diff(np.append(starts, len(token)))
        found = [np.zeros((0, 5), np.int64)]
        for size in np.unique(sizes[sizes > 1]).tolist():
            x, y = (np.add.outer(starts[sizes == size], i).ravel() for i in np.triu_indices(size, 1))  # nodes rise within a group
            like = q * np.minimum(n[x], n[y]).astype(np.int64) >= p * np.maximum(n[x], n[y]).astype(np.int64)
            x, y = x[like], y[like]
            room = np.minimum(n[x] - pos[x], n[y] - pos[y]).astype(np.int64)
            good = (p + q) * room >= p * (n[x].astype(np.int64) + n[y])
            found.append(np.stack([node[x], node[y], n[x], n[y], good], axis=1))
        rows = np.concatenate(found)
        both, at = np.unique(rows[:, :4], axis=0, return_inverse=True)
        return both, np.bincount(at.ravel(), minlength=len(both)), np.bincount(at.ravel(), rows[:, 4], len(both)) > 0

    def out(met=None, rows=None):
        if rows is None:
            ab, count, good = met
            columns = [pa.nulls(len(ab), pa.int64()), *[pa.array(ab[:, i]) for i in (0, 1)], *[pa.array(ab[:, i].astype(np.int32)) for i in (2, 3)], pa.array(count.astype(np.int32)), pa.array(good)]
        else:
            token, node, n, pos = rows
            columns = [pa.array(token), pa.array(node), pa.nulls(len(token), pa.int64()), pa.array(n), pa.nulls(len(token), pa.int32()), pa.array(pos), pa.nulls(len(token), pa.bool_())]
        return pa.RecordBatch.from_arrays(columns, names=["token", "a", "b", "na", "nb", "c", "room"])

    def work(batches):
        held = [np.zeros(0, t) for t in (np.int64, np.int64, np.int32, np.int32)]
        hot, last = None, None  # the token whose rows pass as they are, and its last node
        for batch in batches:
            rows = [np.concatenate([h, np.asarray(batch.column(i))]) for i, h in enumerate(held)]
            fresh = np.append(True, (rows[0][1:] != rows[0][:-1]) | (rows[1][1:] != rows[1][:-1])) if len(rows[0]) else np.zeros(0, bool)
            if hot is not None and len(fresh) and rows[0][0] == hot and rows[1][0] == last:
                fresh[0] = False  # a copy of what passed already
                fresh[: int(np.searchsorted(rows[1][: int(np.searchsorted(rows[0], hot, side="right"))], last, side="right"))] = False
            rows = [r[fresh] for r in rows]
            token = rows[0]
            starts = np.flatnonzero(np.append(True, token[1:] != token[:-1])) if len(token) else np.zeros(0, np.int64)
            sizes = np.diff(np.append(starts, len(token)))
            many = (sizes > most) | (token[starts] == hot if hot is not None else False)
            pick = np.repeat(many, sizes)
            if pick.any():
                yield out(rows=[r[pick] for r in rows])
            if len(starts):
                hot, last = (int(token[-1]), int(rows[1][-1])) if many[-1] else (None, None)
                # the last group may go on in the next batch
                tail = ~pick & (np.arange(len(token)) >= starts[-1])
                whole = ~pick & ~tail
                met = pairs(*[r[whole] for r in rows])
                held = [r[tail] for r in rows]
                if len(met[0]):
                    yield out(met)
            else:
                held = rows
        met = pairs(*held)
        if len(met[0]):
            yield out(met)
        give_back_memory()

    return work


def _pairs(left: DataFrame, right: DataFrame, similarity: Fraction, *more) -> DataFrame:
    """(a, b), a < b: distinct nodes that share a token, where sizes and places allow the similarity."""
    x = left.select(F.col("token"), *[F.col(c).alias(f"{c}_x") for c in left.columns if c != "token"])
    y = right.select(F.col("token"), *[F.col(c).alias(f"{c}_y") for c in right.columns if c != "token"])
    most = F.least(F.col("n_x") - F.col("pos_x"), F.col("n_y") - F.col("pos_y"))
    met = x.join(y, "token").where(_alike(most, F.col("n_x") + F.col("n_y"), similarity) & (F.col("node_x") != F.col("node_y")))
    for condition in more:
        met = met.where(condition)
    return met.select(F.least("node_x", "node_y").alias("a"), F.greatest("node_x", "node_y").alias("b")).distinct()


def _alike(both: Column, sizes: Column, similarity: Fraction) -> Column:
    """Whether ``both`` shingles in common suffice for sets of ``sizes`` together: i / (s - i) >= p / q."""
    p, q = similarity.numerator, similarity.denominator
    return (p + q) * both >= p * sizes


def _likely(met: DataFrame, hot: DataFrame, similarity: Fraction) -> DataFrame:
    """(a, b) of the pairs that may share enough.

    Of two sets, the one whose prefix ends first in the order shares no more than the prefix tokens both were seen to have,
    those that were not counted because they are hot, and all it has behind its prefix.
    """
    both = met.groupBy("a", "b").agg(F.sum("c").alias("c"), F.max("na").alias("na"), F.max("nb").alias("nb"), F.max("room").alias("room")).where("room")
    uncounted = hot.groupBy("node").agg(F.count(F.lit(1)).alias("h"))
    side = lambda name: uncounted.select(F.col("node").alias(name), F.col("h").alias(f"h{name}"))
    both = both.join(side("a"), "a", "left").join(side("b"), "b", "left")
    p, q = similarity.numerator, similarity.denominator
    behind = lambda n: F.ceil(F.col(n) * p / F.lit(q)) - 1
    most = F.col("c") + F.least(F.coalesce("ha", F.lit(0)), F.coalesce("hb", F.lit(0))) + F.greatest(behind("na"), behind("nb"))
    return both.where(_alike(most, F.col("na") + F.col("nb"), similarity)).select("a", "b")


def _sketches(texts: DataFrame, width: int) -> DataFrame:
    """(node, s0, s1, ..): the sketches of the texts' sets."""
    words = [f"s{i}" for i in range(SKETCH // 64)]

    def work(batches):
        for batch in batches:
            for start, stop in slices(batch.column(0), PART_BYTES):
                sets = (shingle_set(t.as_py(), width) for t in texts_of(batch.column(0).slice(start, stop - start)))
                rows = np.array([(node_of(x), *sketch_of(x)) for x in sets], np.int64).reshape(-1, 1 + len(words))
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in rows.T], names=["node", *words])
                give_back_memory()

    return texts.select("text").mapInArrow(work, ", ".join(f"{c} long" for c in ("node", *words))).dropDuplicates(["node"])


def _sketches_allow(similarity: Fraction) -> Column:
    """Of the sets x and y: as many hashes as cells differ are in one of them only, so the rest of both bounds what they share."""
    differ = sum((F.bit_count(F.col(f"s{i}_x").bitwiseXOR(F.col(f"s{i}_y"))) for i in range(1, SKETCH // 64)), F.bit_count(F.col("s0_x").bitwiseXOR(F.col("s0_y"))))
    sizes = F.col("n_x") + F.col("n_y")
    return _alike(sizes - differ, 2 * sizes, similarity)


def _verified(pairs: DataFrame, texts_of_nodes, width: int, similarity: Fraction) -> DataFrame:
    """The pairs whose whole sets have that much of their union in common."""

    def work(batches):
        for batch in batches:
            for start, stop in slices(batch.column(0), PART_BYTES):
                sets = [shingle_set(t.as_py(), width) for t in texts_of(batch.column(0).slice(start, stop - start))]
                yield pa.RecordBatch.from_arrays([pa.array([node_of(x) for x in sets], pa.int64()), pa.array([x.view(np.int64) for x in sets], pa.list_(pa.int64()))], names=["node", "own"])
                give_back_memory()

    needed = pairs.select(F.col("a").alias("node")).union(pairs.select(F.col("b").alias("node"))).distinct()
    sets = stored(texts_of_nodes(needed).select("text").mapInArrow(work, "node long, own array<long>"), "jaccard-sets")
    a, b = sets.select(F.col("node").alias("a"), F.col("own").alias("sa")), sets.select(F.col("node").alias("b"), F.col("own").alias("sb"))
    both = pairs.join(a, "a").join(b, "b")
    return both.where(_alike(F.size(F.array_intersect("sa", "sb")), F.size("sa") + F.size("sb"), similarity)).select("a", "b").distinct()


def links(texts: DataFrame, texts_of_nodes, proposed: DataFrame, width: int = WIDTH, similarity: float = 0.8) -> DataFrame:
    """(a, b), a < b: links between the nodes of ``texts(text)`` that connect all that are alike.

    ``proposed`` are pairs worth a look; ``texts_of_nodes`` gives the texts of a table of nodes.
    """
    least = Fraction(str(similarity))
    looked = _prefixes(texts, _common(texts, width), width, least).repartition("token").sortWithinPartitions("token", "node")
    met = stored(looked.mapInArrow(_met(least, HOT_BUCKET), "token long, a long, b long, na int, nb int, c int, room boolean"), "jaccard-met")
    hot = met.where(F.col("token").isNotNull()).select("token", F.col("a").alias("node"), F.col("na").alias("n"), F.col("c").alias("pos"))
    pairs = _likely(met.where(F.col("token").isNull()), hot, least).union(proposed.select("a", "b"))
    if hot.isEmpty():
        return _verified(stored(pairs.distinct(), "jaccard-pairs"), texts_of_nodes, width, least)
    # the most hot shingles for their size, and the least of several hashes each
    share = hot.join(hot.groupBy("node").agg((F.count(F.lit(1)) / F.first("n")).alias("share")), "node")
    by = [F.struct((-F.col("share")).alias("share"), F.xxhash64("node", F.lit(s)).alias("h"), "node") for s in range(CENTRAL)] + [F.struct(F.xxhash64("node", F.lit(s)).alias("h"), "node") for s in range(LEADERS)]
    found = share.groupBy("token").agg(F.array_distinct(F.array(*[F.min(b).getField("node") for b in by])).alias("nodes"))
    leaders = found.select("token", F.explode("nodes").alias("node")).join(hot, ["token", "node"])
    pairs = stored(pairs.union(_pairs(leaders, hot, least)).distinct(), "jaccard-pairs")
    edges = stored(_verified(pairs, texts_of_nodes, width, least), "jaccard-edges")
    placed = stored(hot.join(components(edges), "node", "left").withColumn("root", F.coalesce("root", "node")), "jaccard-hot")
    largest = placed.groupBy("token", "root").agg(F.count(F.lit(1)).alias("c")).groupBy("token").agg(F.max_by("root", F.struct("c", "root")).alias("top"))
    placed = stored(placed.join(largest, "token").withColumn("out", F.col("root") != F.col("top")).drop("top"), "jaccard-placed")
    outside = placed.where("out")
    if outside.isEmpty():
        return edges
    apart = placed.join(outside.select("token").distinct(), "token", "left_semi")
    sketches = stored(_sketches(texts_of_nodes(apart.select("node").distinct()), width), "jaccard-sketches")
    apart = stored(apart.join(sketches, "node"), "jaccard-apart")
    once = ~F.col("out_y") | (F.col("node_x") < F.col("node_y"))
    rest = stored(_pairs(apart.where("out"), apart, least, F.col("root_x") != F.col("root_y"), once, _sketches_allow(least)).join(pairs, ["a", "b"], "left_anti"), "jaccard-rest")
    return edges if rest.isEmpty() else edges.unionByName(_verified(rest, texts_of_nodes, width, least))
