"""Uniform sharding by a hypergeometric communication matrix, in DataFrame expressions only.

A uniform shuffle of n rows into shards of fixed sizes, dealt over many partitions:

1. Rows belong to logical partitions by a hash of their key; one count gives the partitions' sizes.
2. The communication matrix says how many rows each partition sends to each shard.  It is drawn from the
   multivariate hypergeometric law with the exact row sums (partition sizes) and column sums (shard sizes).
3. Each partition permutes its rows and cuts them at the running sums of its row of the matrix.
4. Rows travel to their shard and are permuted again; the place in that order is the slot.

A permutation is a sort by a keyed 64-bit hash of the row, so a lost task gives the same rows again.  The
second one sorts buckets of the hash's range, whose counts give each bucket its first slot: no task ever
holds a whole shard.  The law kept is ``rows``: shard sizes differ by at most one.

Scale: rows move twice, each time straight to the task of their number, about ``rows_per_task`` rows a task; the matrix is
partitions x shards numbers.  It is drawn as a tree, on the executors: a group of at most ``FAN_OUT`` partitions
gets its column sums first and shares them out among its members, which is the same law as one draw over all.
The driver sees the number of rows and the size of the largest partition, nothing else.

Rows that agree in key share a hash.  Where so many do that a partition passes twice its size, all rows are written
once with a number of their own, which enters the hashes from then on, so that copies spread like other rows.

Defined results: null and empty texts are rows like any other.  Rows that agree in key and content are
interchangeable and each gets a slot.  An empty table gives no rows.  Input columns named like the output
columns (``shard``, ``slot``) are replaced.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corvidex.llm._spark import let, stored

ROWS_PER_TASK = 20_000
#: A shuffle of more tasks than this costs more than larger tasks, whose sorts spill.
MOST_TASKS = 100_000


#: Partitions that share one draw of the tree.
FAN_OUT = 64
#: Counts further than this many standard deviations (and 40 more) from the mode have odds below 1e-30, less than doubles tell apart.
REACH = 12


def hypergeometric(good: Column, bad: Column, draws: Column, u: Column) -> Column:
    """How many of ``draws`` items, taken without replacement, are among the ``good`` ones, for a uniform ``u`` of 0 to 1.

    Inversion from the mode outwards: odds relative to the mode's are summed on both sides, then the part ``u`` of the sum is walked off.
    """
    given = F.struct(*[c.cast("double").alias(name) for c, name in ((good, "good"), (bad, "bad"), (draws, "draws"), (u, "u"))])

    def bounds(g: Column) -> Column:
        total = F.greatest(g["good"] + g["bad"], F.lit(1.0))
        low, high = F.greatest(F.lit(0.0), g["draws"] - g["bad"]), F.least(g["good"], g["draws"])
        mode = F.least(high, F.greatest(low, F.floor((g["draws"] + 1) * (g["good"] + 1) / (total + 2)).cast("double")))
        variance = g["draws"] * g["good"] * g["bad"] * F.greatest(total - g["draws"], F.lit(0.0)) / (total * total * F.greatest(total - 1, F.lit(1.0)))
        far = F.ceil(F.sqrt(variance) * REACH).cast("double") + 40
        names = {"mode": mode, "low": F.greatest(low, mode - far), "high": F.least(high, mode + far)}
        return F.struct(*[g[c].alias(c) for c in ("good", "bad", "draws", "u")], *[c.cast("long").alias(name) for name, c in names.items()])

    def draw(g: Column) -> Column:
        none = F.array().cast("array<bigint>")
        above = F.when(g["mode"] < g["high"], F.sequence(g["mode"] + 1, g["high"])).otherwise(none)
        below = F.when(g["mode"] > g["low"], F.sequence(g["mode"] - 1, g["low"])).otherwise(none)
        # odds of k from those of its neighbour nearer to the mode
        up = lambda w, k: w * (g["good"] - k + 1) * (g["draws"] - k + 1) / (k * (g["bad"] - g["draws"] + k))
        down = lambda w, k: w * (k + 1) * (g["bad"] - g["draws"] + k + 1) / ((g["good"] - k) * (g["draws"] - k))

        def odds(ks: Column, step) -> Column:
            start = F.struct(F.lit(1.0).alias("w"), F.lit(0.0).alias("sum"))
            return F.aggregate(ks, start, lambda acc, k: let(step(acc["w"], k), lambda w: F.struct(w.alias("w"), (acc["sum"] + w).alias("sum"))))["sum"]

        def walk(ks: Column, step, rest: Column) -> Column:
            start = F.struct(F.lit(1.0).alias("w"), rest.alias("rest"), g["mode"].alias("at"))
            on = lambda acc, k: let(step(acc["w"], k), lambda w: F.struct(w.alias("w"), (acc["rest"] - w).alias("rest"), k.alias("at")))
            return F.aggregate(ks, start, lambda acc, k: F.when(acc["rest"] < 0, acc).otherwise(on(acc, k)))["at"]

        def choose(s: Column) -> Column:
            return let(
                g["u"] * (1 + s["up"] + s["down"]) - 1,
                lambda t: F.when(t < 0, g["mode"]).when(t < s["up"], walk(above, up, t)).otherwise(walk(below, down, t - s["up"])),
            )

        return let(F.struct(odds(above, up).alias("up"), odds(below, down).alias("down")), choose)

    return let(let(given, bounds), draw)


def shared_out(sizes: Column, columns: Column, *seeds: Column) -> Column:
    """Array of rows of counts with row sums ``sizes`` and column sums ``columns``, distributed as in a uniform random assignment."""
    uniform = lambda *place: F.xxhash64(*seeds, *place).cast("double") / F.lit(2.0**64) + 0.5
    longs = F.array().cast("array<bigint>")

    def row(need: Column, left: Column, i: Column) -> Column:
        start = F.struct(F.aggregate(left, F.lit(0).cast("long"), lambda a, c: a + c).alias("total"), need.cast("long").alias("need"), longs.alias("own"))

        def cell(acc: Column, j: Column) -> Column:
            others = acc["total"] - left[j]
            taken = hypergeometric(left[j], others, acc["need"], uniform(i, j))
            return let(taken, lambda k: F.struct(others.alias("total"), (acc["need"] - k).alias("need"), F.concat(acc["own"], F.array(k)).alias("own")))

        return F.aggregate(F.sequence(F.lit(0), F.size(left) - 1), start, cell)["own"]

    def add(acc: Column, i: Column) -> Column:
        return let(
            row(sizes[i], acc["left"], i),
            lambda own: F.struct(F.zip_with(acc["left"], own, lambda c, k: c - k).alias("left"), F.concat(acc["rows"], F.array(own)).alias("rows")),
        )

    start = F.struct(columns.cast("array<bigint>").alias("left"), F.array().cast("array<array<bigint>>").alias("rows"))
    return F.aggregate(F.sequence(F.lit(0), F.size(sizes) - 1), start, add)["rows"]


def communication_matrix(sizes: DataFrame, parts: int, columns: list[int], seed: int, fan_out: int = FAN_OUT) -> DataFrame:
    """(part, counts): how many rows each of the partitions (part, n), numbered below ``parts``, sends to each shard."""
    depth = 1
    while fan_out**depth < parts:
        depth += 1
    drawn = sizes.sparkSession.range(1).select(F.lit(0).cast("long").alias("above"), F.lit(columns).cast("array<bigint>").alias("counts"))
    for level in reversed(range(depth)):
        nodes = sizes.groupBy(F.floor(F.col("part") / fan_out**level).alias("node")).agg(F.sum("n").alias("n"))
        # at most fan_out nodes a group
        groups = nodes.groupBy(F.floor(F.col("node") / fan_out).alias("above")).agg(F.array_sort(F.collect_list(F.struct("node", "n"))).alias("nodes"))
        rows = shared_out(F.col("nodes.n"), F.col("counts"), F.lit(seed), F.lit(level), F.col("above"))
        # the outer form: the plain one would draw once more to leave out empty arrays
        drawn = groups.join(drawn, "above").select(F.inline_outer(F.arrays_zip(F.col("nodes.node").alias("above"), rows.alias("counts"))))
    return drawn.select(F.col("above").cast("int").alias("part"), "counts")


def shard_sizes(n: int, shards: int) -> list[int]:
    """Sizes at most one apart."""
    return [n // shards + (i < n % shards) for i in range(shards)]


def shard_rows(df: DataFrame, key: list[Column], shards: int = 16, seed: int = 20, rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """``df`` with ``shard`` and ``slot`` (gapless from 0 in each shard); ``key`` tells rows apart."""
    names = [c for c in df.columns if c.lower() not in ("shard", "slot")]
    # the keys are hashed before the rows are wrapped, so no name of theirs can clash
    keyed = df.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("row"), *[F.xxhash64(F.lit(seed), F.lit(c), *key).alias(c) for c in ("k0", "k1")], F.lit(0).cast("long").alias("copy"))
    n = df.count()
    rows_per_task = max(rows_per_task, math.ceil(n / MOST_TASKS))
    parts = max(1, math.ceil(n / rows_per_task))

    def hashed(rows: DataFrame) -> DataFrame:
        hashes = [F.xxhash64(F.lit(salt), "k0", "k1", "copy") for salt in ("part", "first", "second")]
        return rows.select("row", F.pmod(hashes[0], F.lit(parts)).cast("int").alias("part"), hashes[1].alias("h1"), hashes[2].alias("h2"))

    def counted(rows: DataFrame) -> DataFrame:
        return stored(rows.groupBy("part").agg(F.count(F.lit(1)).alias("n")), "shard-sizes")

    wrapped = hashed(keyed)
    sizes = counted(wrapped)
    if (sizes.agg(F.max("n")).first()[0] or 0) > 2 * rows_per_task:
        # only rows that agree in key crowd a partition so; numbers are written, since a second run may number rows otherwise
        wrapped = hashed(stored(keyed.withColumn("copy", F.monotonically_increasing_id()), "shard-copies"))
        sizes = counted(wrapped)
    cuts = communication_matrix(sizes, parts, shard_sizes(n, shards), seed)
    ends = F.transform(F.sequence(F.lit(1), F.size("counts")), lambda i: F.aggregate(F.slice("counts", 1, i), F.lit(0).cast("long"), lambda a, c: a + c))
    cuts = stored(cuts.select("part", ends.alias("ends")), "shard-cuts")
    first = F.row_number().over(Window.partitionBy("part").orderBy("h1", "h2"))
    sent = wrapped.repartitionById(parts, F.col("part")).withColumn("place", first).join(cuts.repartitionById(parts, F.col("part")), "part").withColumn("shard", F.size(F.filter("ends", lambda e: e < F.col("place"))))
    # the hash's range in buckets of about rows_per_task rows a shard
    buckets = max(1, math.ceil(n / shards / rows_per_task))
    bucket = F.least(F.lit(buckets - 1), F.floor((F.col("h2").cast("double") + F.lit(2.0**63)) / F.lit(2.0**64) * buckets).cast("int"))
    sent = sent.select("row", "h2", "h1", "shard", bucket.alias("bucket"))
    second = F.row_number().over(Window.partitionBy("group").orderBy("h2", "h1"))
    out = sent.withColumn("group", F.col("shard") * buckets + F.col("bucket")).repartitionById(shards * buckets, F.col("group")).withColumn("nth", second)
    if buckets == 1:
        return out.select("row.*", "shard", (F.col("nth") - 1).cast("long").alias("slot"))
    held = sent.groupBy("shard", "bucket").agg(F.count(F.lit(1)).alias("n"))
    before = held.withColumn("base", F.sum("n").over(Window.partitionBy("shard").orderBy("bucket")) - F.col("n")).select("shard", "bucket", "base")
    return out.join(before, ["shard", "bucket"]).select("row.*", "shard", (F.col("base") + F.col("nth") - 1).cast("long").alias("slot"))
