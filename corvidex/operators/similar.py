"""Similarity of short texts by matching blocks: a join above a threshold, greedy acceptance in order, and the mean over all pairs.

The ratio of two texts is twice the characters in their matching blocks over both lengths, by Python's sequence matcher, whose result depends on
which text comes first.  Blocks are in the same order in both texts, so a ratio above t bounds the insertions and deletions between them:
fewer than (1 - t) times both lengths.  Each of those spoils two of a text's pairs of neighbouring characters, so two similar texts have a certain number
of pairs in common, and at least one among the rarest ones of both.  Texts meet on those; lengths, counts of characters and at
last the ratio itself are then looked at in Arrow batches.

Scale: texts meet on a rare pair of characters and a common pair's rows are dealt over many tasks.  What the join gives grows with the similar pairs.
The mean compares all pairs by nature; blocks of a triangular schedule share that, each giving a sum and a count.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corvidex.operators.order import places
from corvidex.sources.store import written

#: Rows of one pair of characters that meet in one task.
TOGETHER = 2000
#: Rows of a block of the triangular schedule.
BLOCK = 200


def bigrams(text: Column) -> Column:
    """Pairs of neighbouring characters of a text with marks at its ends, equal ones numbered apart."""
    marked = F.concat(F.lit("\x02"), text, F.lit("\x03"))
    pairs = F.transform(F.sequence(F.lit(1), F.length(marked) - 1), lambda i: F.substring(marked, i, F.lit(2)))
    # in a sorted array the number of a pair among equal ones is its distance to the first of them
    numbered = lambda p: F.transform(p, lambda x, i: F.concat(x, (i - F.array_position(p, x) + 1).cast("string")))
    return F.transform(F.array(F.array_sort(pairs)), numbered)[0]


def prefixes(rows: DataFrame, threshold: float) -> DataFrame:
    """(id, n, gram, f): the rarest bigrams of each text of ``rows(id, t)``, of which two similar texts share one; f is how many texts have it."""
    grams = rows.select("id", F.length("t").alias("n"), F.explode(bigrams(F.col("t"))).alias("gram"))
    often = grams.groupBy("gram").agg(F.count(F.lit(1)).alias("f"))
    # in common with a text of the same length; two less for the rounding of other lengths
    spoilt = F.ceil(F.lit(2 * (1 - threshold)) * F.col("n")) - 1
    common = F.greatest(F.lit(1), F.col("n") + 1 - 2 * spoilt - 2)
    ordered = grams.join(often, "gram").groupBy("id", "n").agg(F.array_sort(F.collect_list(F.struct("f", "gram"))).alias("g"))
    return ordered.select("id", "n", F.explode(F.slice("g", F.lit(1), (F.col("n") + 2 - common).cast("int"))).alias("e")).select("id", "n", "e.gram", "e.f")


def _ratios(threshold: float):
    def work(batches):
        from collections import Counter
        from difflib import SequenceMatcher

        for batch in batches:
            later, earlier = batch.column("t_b").to_pylist(), batch.column("t_a").to_pylist()
            out = np.full(len(batch), -1.0)
            for i, (x, y) in enumerate(zip(later, earlier, strict=True)):
                most = sum((Counter(x) & Counter(y)).values())
                if x == y or not x or not y or 2 * most > threshold * (len(x) + len(y)):
                    out[i] = SequenceMatcher(None, x, y).ratio()
            keep = np.flatnonzero(out > threshold)
            own = batch.take(pa.array(keep))
            yield pa.RecordBatch.from_arrays([own.column("a"), own.column("b"), pa.array(out[keep])], names=["a", "b", "ratio"])

    return work


def similar_pairs(df: DataFrame, text: str = "text", order: str = "doc_id", threshold: float = 0.85) -> DataFrame:
    """(a, b, ratio) of all rows a before b in a numeric order without repeats whose lower-cased texts have a ratio above the threshold (over 0.76)."""
    if not 0.76 < threshold < 1:
        raise ValueError("the threshold must lie between 0.76 and 1")
    rows = written(df.select(F.col(order).alias("id"), F.lower(F.coalesce(F.col(text), F.lit(""))).alias("t")).where("id IS NOT NULL"), "similar-rows")
    held = written(prefixes(rows, threshold), "similar-prefixes")
    parts = F.ceil(F.col("f") / TOGETHER)
    a = held.select(F.col("id").alias("a"), F.col("n").alias("n_a"), "gram", F.pmod(F.xxhash64("id"), parts).alias("part"))
    b = held.select(F.col("id").alias("b"), F.col("n").alias("n_b"), "gram", F.explode(F.sequence(F.lit(0).cast("long"), parts - 1)).alias("part"))
    near = 2 * F.least("n_a", "n_b") >= F.lit(threshold - 1e-9) * (F.col("n_a") + F.col("n_b"))
    met = a.join(b, ["gram", "part"]).where((F.col("a") < F.col("b")) & near).select("a", "b").distinct()
    texts = met.join(rows.select(F.col("id").alias("a"), F.col("t").alias("t_a")), "a").join(rows.select(F.col("id").alias("b"), F.col("t").alias("t_b")), "b")
    kind = dict(df.dtypes)[order]
    return texts.select("a", "b", "t_a", "t_b").mapInArrow(_ratios(threshold), f"a {kind}, b {kind}, ratio double")


def accepted(ids: DataFrame, pairs: DataFrame) -> DataFrame:
    """(id, accepted) of ``ids(id)``: in order, a row is accepted unless it is similar to one accepted before it; ``pairs(a, b)`` with a before b.

    In rounds: an open row with no open or accepted row before it is accepted, one with an accepted row before it is not.
    """
    edges = written(pairs.select("a", "b"), "similar-edges")
    done = ids.join(edges.select(F.col("b").alias("id")).distinct(), "id", "left_anti").withColumn("accepted", F.lit(True))
    # only rows with a pair are looked at again
    state = written(done.join(edges.select(F.col("a").alias("id")).distinct(), "id", "left_semi").unionByName(edges.select(F.col("b").alias("id")).distinct().withColumn("accepted", F.lit(None).cast("boolean"))), "similar-state")
    while not state.where("accepted IS NULL").isEmpty():
        before = edges.join(state.select(F.col("id").alias("a"), F.col("accepted").alias("was")), "a").groupBy("b").agg(F.bool_or("was").alias("taken"), F.count_if(F.col("was").isNull()).alias("open"))
        next_state = F.coalesce("accepted", F.when(F.col("taken"), False).when(F.col("open") == 0, True))
        state = written(state.join(before, state["id"] == before["b"], "left").select("id", next_state.alias("accepted")), "similar-state")
    return ids.join(state.where("NOT accepted"), "id", "left").select("id", F.coalesce("accepted", F.lit(True)).alias("accepted"))


def reject_similar(df: DataFrame, text: str = "text", order: str = "doc_id", threshold: float = 0.85) -> DataFrame:
    """``df`` with ``accepted``: false for a text similar to an accepted one before it; rows without an order are not accepted."""
    found = accepted(df.select(F.col(order).alias("id")).where("id IS NOT NULL").distinct(), similar_pairs(df, text, order, threshold))
    return df.join(found.withColumnRenamed("id", order), order, "left").withColumn("accepted", F.coalesce("accepted", F.lit(False)))


def too_similar(df: DataFrame, text: str = "text", order: str = "doc_id", threshold: float = 0.85) -> DataFrame:
    """``df`` with the last rule of the question validator: rows whose ``reason`` is null get ``too_similar`` if an accepted one before them is."""
    left = df.where("reason IS NULL").select(order, text)
    gone = reject_similar(left, text, order, threshold).where("NOT accepted").select(order, F.lit("too_similar").alias("__why"))
    return df.join(gone, order, "left").withColumn("reason", F.coalesce("reason", "__why")).drop("__why")


def mean_similarity(df: DataFrame, text: str = "text", order: str = "doc_id") -> DataFrame:
    """One row (pairs, similarity): the mean ratio of every row with every later one; 0 without pairs."""
    from pyspark.sql.types import StructType

    placed = places(df.select(F.col(order).alias("__order"), F.lower(F.coalesce(F.col(text), F.lit(""))).alias("t")), "__order")
    rows = written(placed.select("t", F.col("place"), F.floor((F.col("place") - 1) / BLOCK).alias("block")), "mean-rows")
    blocks = math.ceil(rows.count() / BLOCK)
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(max(0, blocks - 1)).cast("long")))
    dealt = rows.select("t", "place", "block", other.alias("o")).select("t", "place", F.least("block", "o").alias("i"), F.greatest("block", "o").alias("j"))

    def work(own: pa.Table) -> pa.Table:
        from difflib import SequenceMatcher

        i, j = own.column("i")[0].as_py(), own.column("j")[0].as_py()
        held = sorted(zip(own.column("place").to_pylist(), own.column("t").to_pylist(), strict=True))
        first = [r for r in held if (r[0] - 1) // BLOCK == i]
        second = [r for r in held if (r[0] - 1) // BLOCK == j]
        total, pairs = 0.0, 0
        for place, later in second:
            match = SequenceMatcher(None, "", later)  # what it knows of the second text serves all first ones
            for p, t in first:
                if p < place:
                    match.set_seq1(t)
                    total += match.ratio()
                    pairs += 1
        return pa.table({"total": [total], "pairs": pa.array([pairs], pa.int64())})

    sums = dealt.groupBy("i", "j").applyInArrow(work, StructType.fromDDL("total double, pairs long"))
    return sums.agg(F.coalesce(F.sum("pairs"), F.lit(0)).cast("long").alias("pairs"), F.coalesce(F.try_divide(F.sum("total"), F.sum("pairs")), F.lit(0.0)).alias("similarity"))
