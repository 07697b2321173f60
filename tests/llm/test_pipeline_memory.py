"""The pipeline's batches and packing slices hold few bytes, with the same rows."""

import pyarrow as pa
from pyspark.sql import functions as F

import corpus_pipeline
from corvidex.llm import packing, queries

ARROW_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


def test_stages_bound_batches_by_bytes_and_packing_keeps_its_rows(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").coalesce(1)
    columns = ("doc_id", "piece", "start", "length", "ids_crc32", "offset")
    try:
        got = corpus_pipeline.best_fit_packing(spark, docs, "").select(*columns).collect()

        @F.arrow_udf("long")
        def held(texts: pa.Array) -> pa.Array:
            return pa.array([texts.nbytes] * len(texts))

        long = spark.range(900).repartition(1).select(F.repeat(F.lit("x"), 10_000).alias("text"))
        assert long.select(held("text").alias("n")).agg(F.max("n")).first()[0] < 2 * corpus_pipeline.BATCH_BYTES
    finally:
        spark.conf.unset(ARROW_BYTES)
    want = packing.pack(docs, queries._vocabulary("word_bpe_49k.json")).select(*columns).collect()
    assert sorted(got) == sorted(want) and got
