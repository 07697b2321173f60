"""Incremental index maintenance with Structured Streaming over a folder of Parquet documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corvidex.operators import bm25


def ingest(spark: SparkSession, source: str, index_dir: str, checkpoint: str, schema, tokenizer: str = "simple"):
    """Process the files that arrived since the last run: chunks of postings and document lengths are appended.

    The stream's checkpoint is the ledger of processed files, and a batch writes to a folder of its own number,
    so a batch that is run again replaces its output.  Frequencies are aggregated when the index is read.
    """
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 64).parquet(source)

    def write(batch: DataFrame, number: int) -> None:
        built = bm25.build(batch, tokenizer)
        built.postings.write.mode("overwrite").parquet(f"{index_dir}/postings/batch={number}")
        built.stats.write.mode("overwrite").parquet(f"{index_dir}/stats/batch={number}")
        log = batch.agg(F.count(F.lit(1)).alias("documents")).withColumn("status", F.lit("success")).withColumn("processed_at", F.current_timestamp())
        log.write.mode("overwrite").parquet(f"{index_dir}/log/batch={number}")

    query = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def read_index(spark: SparkSession, index_dir: str, tokenizer: str = "simple") -> bm25.Index:
    """The index over all batches so far."""
    postings = spark.read.parquet(f"{index_dir}/postings").drop("batch")
    stats = spark.read.parquet(f"{index_dir}/stats").agg(F.sum("n").alias("n"), (F.sum(F.col("n") * F.col("avgdl")) / F.sum("n")).alias("avgdl"))
    return bm25.Index(postings, postings.groupBy("term").agg(F.count(F.lit(1)).alias("df")), stats, tokenizer)


def update(spark: SparkSession, source: str, base: str, checkpoint: str, schema, embed=None, centres: DataFrame | None = None, size: int = 512, overlap: int = 50) -> DataFrame:
    """Bring a knowledge base up to date with the files that are new in ``source``; gives one row per batch of this run.

    Each batch is chunked, its chunks are embedded and put into their cells, and chunks, vectors and postings are
    appended under the batch's number; existing artefacts are optional.  A batch that fails before its log is run again whole
    and replaces its output.  Chunks are flagged ``incremental_update``.
    """
    from corvidex.operators import chunking
    from corvidex.operators.vectors import celled, exists
    from corvidex.providers import BucketEmbedder

    embed = embed or BucketEmbedder().embed
    before = {r["number"] for r in spark.read.parquet(f"{base}/log").select("number").collect()} if exists(spark, f"{base}/log") else set()
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 64).parquet(source)

    def write(batch: DataFrame, number: int) -> None:
        at = lambda name: f"{base}/{name}/batch={number}"
        chunking.chunk(batch, size, overlap).withColumn("incremental_update", F.lit(True)).write.mode("overwrite").parquet(at("chunks"))
        own = spark.read.parquet(at("chunks"))
        celled(own.select(F.col("chunk_id").alias("doc_id"), embed(F.col("content")).alias("dv")), centres).write.mode("overwrite").parquet(at("vectors"))
        bm25.postings_of(own, "simple", "chunk_id", "content").write.mode("overwrite").parquet(at("postings"))
        log = batch.agg(F.count(F.lit(1)).alias("documents")).crossJoin(own.agg(F.count(F.lit(1)).alias("chunks")))  # one row each
        log.withColumn("number", F.lit(number)).withColumn("status", F.lit("success")).withColumn("processed_at", F.current_timestamp()).write.mode("overwrite").parquet(at("log"))

    stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
    if not exists(spark, f"{base}/log"):
        return spark.createDataFrame([], "number long, documents long, chunks long, status string")
    return spark.read.parquet(f"{base}/log").where(~F.col("number").isin(*before) if before else F.lit(True)).select(F.col("number").cast("long"), "documents", "chunks", "status")


def knowledge_base(spark: SparkSession, base: str):
    """(chunks, vector store, BM25 index) of all batches so far, under the ids of the chunks."""
    from corvidex.operators.vectors import VectorStore

    chunks, vectors, postings = (spark.read.parquet(f"{base}/{n}").drop("batch") for n in ("chunks", "vectors", "postings"))
    words = postings.agg(F.coalesce(F.sum("tf"), F.lit(0)).alias("words"))
    stats = chunks.agg(F.count(F.lit(1)).alias("n")).crossJoin(F.broadcast(words)).select("n", F.try_divide("words", "n").alias("avgdl"))  # one row each
    return chunks, VectorStore(vectors), bm25.Index(postings, postings.groupBy("term").agg(F.count(F.lit(1)).alias("df")), stats)


def event_windows(events: DataFrame, minutes: int = 60, late: str = "1 hour") -> DataFrame:
    """Counts and sums of events by type and window; late rows within the watermark still count."""
    return events.withWatermark("ts", late).groupBy(F.window("ts", f"{minutes} minutes").alias("w"), "event_type").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("value"), 4).alias("total")).select(F.col("w.start").alias("start"), "event_type", "n", "total")
