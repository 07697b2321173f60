"""The cache as stream state against a plain replay, also over a restart."""

import random
from collections import OrderedDict, defaultdict

from pyspark.sql import functions as F

from corvidex.plans import measures
from corvidex.streaming import score_cache


def replay(rows, most, ttl):
    """Counts of one shard's accesses (key, time) by an ordered dict."""
    held, n = OrderedDict(), dict.fromkeys(score_cache.COUNTS, 0)
    for key, time in rows:
        if key in held and time - held[key] > ttl:
            del held[key]
            n["expired"] += 1
        if key in held:
            held.move_to_end(key)
            n["hits"] += 1
        else:
            n["misses"] += 1
            if len(held) >= most:
                held.popitem(last=False)
                n["evicted"] += 1
            held[key] = time
    return {**n, "held": len(held)}


def by_shard(spark, rows, shards):
    """Accesses of each shard by the engine's own hash."""
    df = spark.createDataFrame([(r[0], r[1]) for r in rows], "id long, key string")
    shard = {r["id"]: r["s"] for r in df.select("id", F.pmod(F.xxhash64("key"), F.lit(shards)).alias("s")).collect()}
    out = defaultdict(list)
    for i, key, time in rows:
        out[shard[i]].append((key, time))
    return out


def test_restart_goes_on(spark, tmp_path):
    rng = random.Random(9)
    rows = [(i, f"k{min(rng.randrange(60), rng.randrange(60))}", 1.7e9 + i * 7.25) for i in range(900)]
    source, out, check = (str(tmp_path / n) for n in ("in", "out", "check"))
    schema = "id long, key string, ts timestamp, score double"
    put = lambda own: spark.createDataFrame(own, "id long, key string, t double").select("id", "key", F.timestamp_seconds("t").alias("ts"), F.lit(0.5).alias("score")).coalesce(1).write.mode("append").parquet(source)
    stream = lambda: spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(source)
    settings = {"most": 6, "ttl": 300.0, "shards": 3}
    first = rows[:500]
    rng.shuffle(first)  # within a batch times decide
    put([*first, (5000, None, 1.7e9)])
    score_cache.follow(stream(), out, check, **settings)
    put(rows[500:700])
    score_cache.follow(stream(), out, check, **settings)
    put(rows[700:])
    score_cache.follow(stream(), out, check, **settings)
    score_cache.follow(stream(), out, check, **settings)  # nothing new
    got = {r["shard"]: {c: r[c] for c in (*score_cache.COUNTS, "held")} for r in score_cache.counts_so_far(spark, out).collect()}
    want = {s: replay(own, 6, 300.0) for s, own in by_shard(spark, sorted(rows), 3).items()}
    assert got == want and sum(v["expired"] for v in got.values()) > 5 and sum(v["evicted"] for v in got.values()) > 50


def test_registered_replay(spark):
    data = "/root/testdata/sf0.001"
    events = spark.read.parquet(f"{data}/events.parquet").select("event_id", F.concat_ws("|", "user_id", "event_type").alias("key"), (F.unix_micros(F.col("ts").cast("timestamp")) / 1e6).alias("t"))
    rows = sorted(((r["event_id"], r["key"], r["t"]) for r in events.collect()), key=lambda r: (r[2], r[0]))
    want = {s: replay(own, 8, 86400.0) for s, own in by_shard(spark, rows, 16).items()}
    got = {r["shard"]: {c: r[c] for c in (*score_cache.COUNTS, "held")} for r in measures.QUERIES["cache_replay"](spark, data).collect()}
    assert got == want
