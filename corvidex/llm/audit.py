"""Audit of a chain of filters: what each removes at its place in every order, from one SQL CUBE.

Each document fails or passes each filter.  The failure flags, the part and the label counts are counted once into cells;
``GROUP BY CUBE`` over the flags and the part then gives, in the row of a grouping set whose flags are all false, the
documents that survive just that subset of filters (the flags left out are not looked at).  A step of an order goes from one subset
to that with one filter more, so it is the join of two survivor rows.

Scale: one pass over the texts leaves a few numbers and a digest a document, stored once.  Equal texts meet by their
SHA-256 digest, combined before the shuffle; which rows are the first of their text is then a join on digest and id, which no group of copies
makes uneven.  Rows without an id are spread by their digest.  The cube sees cells, at most ``2 ** filters`` a part.
Nothing is collected; only the table of steps, of a size fixed by the number of filters, is broadcast.

Defined results: a null text counts as empty and a null part as the empty string.  Repeated rows (same id) count once each, and are no
copies of one another.  A row without an id has no smaller id before it, so it fails no copy filter and has no labels.  Labels given
twice for an id hold if any of them says so.  An empty table gives no rows.  Only the columns named are read, so other columns may have any name.
"""

from __future__ import annotations

import itertools

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corvidex.llm._spark import ascii_words, stored

FILTERS = "ABCDE"


def failures(text: Column, words: Column) -> dict[str, Column]:
    """The conditions of a text alone; a copy of an earlier text fails E."""
    n = F.size(words)
    return {
        "A": n < 50,
        "B": 100 * F.size(F.array_distinct(words)) < 65 * n,
        "C": 100 * F.regexp_count(text, F.lit("[A-Z]")) > 5 * F.length(text),
        "D": text.rlike("[#$%&*|]"),
    }


def flagged(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "source") -> DataFrame:
    """(part, A, B, C, D, E, good, toxic) of every document."""
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    held = docs.select(F.col(f"`{id_col}`").alias("id"), F.coalesce(F.col(f"`{part_col}`"), F.lit("")).alias("part"), text.alias("t"), ascii_words(text).alias("w"))
    rows = held.select("id", "part", F.unhex(F.sha2("t", 256)).alias("digest"), *[c.alias(f) for f, c in failures(F.col("t"), F.col("w")).items()])
    rows = stored(rows, "audit-rows")
    # a row is the first of its text if its id is the smallest; the join is on both, so copies of one text do not meet
    first = rows.groupBy("digest").agg(F.min("id").alias("id")).where("id IS NOT NULL").withColumn("first", F.lit(True))
    spread = F.when(F.col("id").isNull(), F.pmod(F.xxhash64("digest"), F.lit(4096))).otherwise(0)
    marks = labels.groupBy(F.col("doc_id").alias("id")).agg(F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic"))
    marks = marks.where("id IS NOT NULL").withColumn("spread", F.lit(0).cast("long"))
    seen = rows.withColumn("spread", spread).join(first, ["digest", "id"], "left").join(marks, ["id", "spread"], "left")
    copy = F.col("id").isNotNull() & F.col("first").isNull()
    return seen.select("part", *"ABCD", copy.alias("E"), *[F.coalesce(c, F.lit(0)).alias(c) for c in ("good", "toxic")])


def survivors(flags: DataFrame, names: str = FILTERS) -> DataFrame:
    """(part, mask, n, good, toxic): documents of a part (null: of all parts) that pass the filters of each subset, bit i of the mask for filter i.

    Subsets that nothing survives have zeros.
    """
    spark = flags.sparkSession
    cells = flags.groupBy("part", *names).agg(F.count(F.lit(1)).alias("n"), *[F.sum(c).alias(c) for c in ("good", "toxic")])
    mask = " + ".join(f"IF(grouping({c}) = 0, {1 << i}, 0)" for i, c in enumerate(names))
    # a flag that the grouping set leaves out is null, so this keeps the rows whose own flags are all false
    passed = " AND ".join(f"({c} IS NULL OR NOT {c})" for c in names)
    cube = spark.sql(
        f"""
        SELECT part, overall, mask, n, good, toxic FROM (
            SELECT {", ".join(names)}, part, CAST(grouping(part) AS INT) AS overall, {mask} AS mask, SUM(n) AS n, SUM(good) AS good, SUM(toxic) AS toxic
            FROM {{cells}} GROUP BY CUBE ({", ".join(names)}, part)
        ) WHERE {passed}
        """,
        cells=cells,
    )
    # the row of no filters stands for every part, so it carries the parts to subsets without survivors
    everyone = cube.where("mask = 0").select("part", "overall", F.explode(F.sequence(F.lit(0), F.lit((1 << len(names)) - 1))).alias("mask"))
    none = everyone.select("*", *[F.lit(0).cast("long").alias(c) for c in ("n", "good", "toxic")])
    both = cube.unionByName(none).groupBy("part", "overall", "mask")
    return both.agg(*[F.sum(c).alias(c) for c in ("n", "good", "toxic")])


def steps(spark: SparkSession, names: str = FILTERS) -> DataFrame:
    """(filter_order, step, bit, before, after) of all orders: a table fixed by the number of filters."""
    rows = []
    for order in itertools.permutations(range(len(names))):
        before = 0
        for i, f in enumerate(order):
            rows.append(("".join(names[j] for j in order), i + 1, 1 << f, before, before | 1 << f))
            before |= 1 << f
    return spark.createDataFrame(rows, "filter_order string, step int, bit int, before int, after int")


def audit(flags: DataFrame, names: str = FILTERS, overall: bool = False) -> DataFrame:
    """One row per part, order and step; with ``overall`` also those of all parts together, as part null."""
    everything = (1 << len(names)) - 1
    alive = survivors(flags, names)
    if not overall:
        alive = alive.where("overall = 0")
    alive = stored(alive, "audit-survivors")
    key = ["part", "overall"]

    def of(mask: Column, tag: str) -> DataFrame:
        return alive.where(mask).select(*key, F.col("mask").alias(f"mask_{tag}"), *[F.col(c).alias(f"{c}_{tag}") for c in ("n", "good", "toxic")])

    def pairs(edges: DataFrame, before: str, after: str) -> DataFrame:
        """Edges (broadcast) with the survivors of both subsets, for each part."""
        b = of(F.lit(True), "b").join(F.broadcast(edges), F.col("mask_b") == F.col(before))
        a = of(F.lit(True), "a").withColumnsRenamed({c: f"{c}_a" for c in key})
        return b.join(a, F.col("part").eqNullSafe(F.col("part_a")) & (F.col("overall") == F.col("overall_a")) & (F.col("mask_a") == F.col(after)))

    # one row per part and filter: what is alike in all orders
    table = stored(pairs(steps(flags.sparkSession, names), "before", "after"), "audit-steps")
    removed = F.col("n_b") - F.col("n_a")
    per_filter = table.groupBy(*key, "bit").agg(
        F.sum(removed).alias("shapley"),
        F.max(F.when(F.col("before") == 0, removed)).alias("failing"),
        F.max(F.when(F.col("after") == everything, removed)).alias("unique_fails"),
    )
    per_filter = per_filter.withColumnsRenamed({c: f"{c}_f" for c in [*key, "bit"]})
    joined = table.join(per_filter, F.col("part").eqNullSafe(F.col("part_f")) & (F.col("overall") == F.col("overall_f")) & (F.col("bit") == F.col("bit_f")))
    return joined.select(
        "part",
        "filter_order",
        "step",
        F.col("n_a").alias("kept"),
        removed.alias("removed"),
        (F.col("failing") - removed).alias("redundant"),
        "unique_fails",
        (F.col("good_b") - F.col("good_a")).alias("good_lost"),
        (F.col("toxic_b") - F.col("toxic_a")).alias("toxic_lost"),
        "shapley",
    )

