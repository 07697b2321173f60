"""A score cache as keyed state of a stream: recency eviction and lifetimes, with counts of what became of each access.

An access asks for a key.  A key held and no older than its lifetime is a hit and becomes the last used; any other is a miss, after which the score is
put in.  A key found too old is dropped and counts as expired too.  If a shard is full when a score is put in, the one used longest ago goes.

Scale: accesses are dealt to shards by a hash of their key, and each shard's entries, ``most`` at most, are the state of one group, kept by the
stream's checkpoint, so a restart goes on where it stopped.  A batch's accesses of a shard reach its task in Arrow chunks.

Defined results: accesses of a batch are taken in order of time, then id; a later batch is later whatever its times.  A null key
takes no part; a null time counts as 0.  The clock is the accesses' own time.
"""

from __future__ import annotations

from collections import OrderedDict
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

COUNTS = ("hits", "misses", "evicted", "expired")


class Shard:
    """A shard's entries in order of use, and its counts."""

    def __init__(self, most: int, ttl: float, state: tuple | None = None):
        self.most, self.ttl = most, ttl
        keys, scores, times, counts = state or ([], [], [], [0] * len(COUNTS))
        self.held = OrderedDict(zip(keys, zip(scores, times, strict=True), strict=True))
        self.counts = dict(zip(COUNTS, counts, strict=True))

    def access(self, key: str, time: float, score: float) -> None:
        entry = self.held.get(key)
        if entry is not None and time - entry[1] <= self.ttl:
            self.held.move_to_end(key)
            self.counts["hits"] += 1
            return
        if entry is not None:
            del self.held[key]
            self.counts["expired"] += 1
        self.counts["misses"] += 1
        if len(self.held) >= self.most:
            self.held.popitem(last=False)
            self.counts["evicted"] += 1
        self.held[key] = (score, time)

    def state(self) -> tuple:
        return list(self.held), [e[0] for e in self.held.values()], [e[1] for e in self.held.values()], [self.counts[c] for c in COUNTS]


def cached(accesses: DataFrame, most: int = 10_000, ttl: float = 3600.0, shards: int = 64) -> DataFrame:
    """(shard, hits, misses, evicted, expired, held): the counts so far of each shard that a batch of ``accesses(id, key, ts, score)`` reached."""
    rows = accesses.where("key IS NOT NULL").select(F.pmod(F.xxhash64("key"), F.lit(shards)).alias("shard"), F.col("key").cast("string").alias("key"), F.col("id").cast("long").alias("id"), seconds(F.col("ts")).alias("ts"), F.col("score").cast("double").alias("score"))

    def work(key: tuple, chunks: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        own = Shard(most, ttl, state.get if state.exists else None)
        batch = pd.concat(list(chunks)).sort_values(["ts", "id"], kind="stable")
        for name, time, score in zip(batch["key"], batch["ts"], batch["score"], strict=True):
            own.access(name, time, score)
        state.update(own.state())
        yield pd.DataFrame([{"shard": key[0], **own.counts, "held": len(own.held)}])

    counts = ", ".join(f"{c} long" for c in COUNTS)
    return rows.groupBy("shard").applyInPandasWithState(work, f"shard long, {counts}, held long", "keys array<string>, scores array<double>, times array<double>, counts array<long>", "update", GroupStateTimeout.NoTimeout)


def seconds(ts: Column) -> Column:
    """A time as seconds, with their fraction."""
    return F.coalesce(F.unix_micros(ts.cast("timestamp")) / 1e6, F.lit(0.0))


def follow(accesses: DataFrame, out: str, checkpoint: str, **settings) -> None:
    """Run the stream over what there is now; each batch writes its shards' counts into a folder of its own number."""

    def work(rows: DataFrame, number: int) -> None:
        rows.write.mode("overwrite").parquet(f"{out}/batch={number}")

    cached(accesses, **settings).writeStream.outputMode("update").foreachBatch(work).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def counts_so_far(spark, out: str) -> DataFrame:
    """The last counts of each shard."""
    rows = spark.read.parquet(out)
    last = rows.groupBy("shard").agg(F.max_by(F.struct(*COUNTS, "held"), "batch").alias("r"))
    return last.select("shard", "r.*")
