"""A corpus pipeline of five stages, each on all that the one before it kept.

1. language ID: texts without letters, or of no language clearly, go;
2. quality rules: documents that fail the base rules or are more likely bad than good go;
3. SimHash near-dedup: of each group that links of 5-word Jaccard similarity 0.8 or more join, one document stays;
4. secret scans: secrets are cut out of the texts, every document stays;
5. best-fit packing: documents become pieces of packed sequences.

Every stage takes nulls in any column, empty and very long texts, ties, repeated rows, empty tables and columns beyond
those of ``documents``; its own docstring and that of its operator say what becomes of them.  No stage needs ``doc_id`` to be unique.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corvidex.llm import langid, packing, quality, queries, secrets, simhash
from corvidex.llm._spark import stored

#: A document of two languages in equal parts still passes.
LEAST_LANGUAGE = 0.4
#: Bytes of a batch between an executor's JVM, which holds it outside its heap, and a Python worker; a longer row is a batch of its own.
BATCH_BYTES = 2 << 20
#: Text that a packing worker works on at a time and words whose ids it holds: it runs beside JVMs that four stages have filled.
PACK_BYTES, PACK_WORDS = 1 << 20, 100_000
ORACLE_SQL = None


def small_batches(spark: SparkSession) -> None:
    """Batches of rows are bounded by their bytes from here on, in this session: texts differ too much in length for a bound by rows.

    Not undone after a stage, as its rows are made when whoever asked for them writes them; no result depends on it.
    """
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Null, empty and letterless texts go; an empty table, or one without any ``lang`` to learn from, gives no rows."""
    small_batches(spark)
    names = docs.columns
    # trained outside fold 0 of this very input
    found = langid.identify(docs.withColumnsRenamed({c: f"in_{c}" for c in names}), langid.train_langid(docs), "in_doc_id", "in_text", keep=tuple(f"in_{c}" for c in names))
    clear = found.where((F.col("lang_pred") != langid.UNKNOWN) & (F.col("score") >= LEAST_LANGUAGE))
    return clear.select(*[F.col(f"in_{c}").alias(c) for c in names])


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Null and empty texts have too few words and go; rows with the same text are judged alike."""
    return quality.keep_good(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies one document stays, that of the smallest id.  Rows that share an id but not a text are
    documents of their own; repeated rows are copies; a document without an id stays only if no other of its group has one."""
    small_batches(spark)
    return simhash.keep_first(docs, width=5, similarity=0.8)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row stays; a text with secrets loses them and gets its new length as ``n_chars``; a null text stays null."""
    held = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), "text")  # so that no column meets one of the operator's
    found = secrets.scan(held, secrets.train(secrets.made_findings(spark)))
    changed = F.size("secrets") > 0
    new = {"text": F.col("redacted")} | ({"n_chars": F.when(changed, F.length("redacted").cast("long")).otherwise(F.col("row.n_chars"))} if "n_chars" in docs.columns else {})
    return found.select(*[new.get(c, F.col("row")[c]).alias(c) for c in docs.columns])


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per piece; a null or empty text is one piece of the closing id."""
    small_batches(spark)
    packed = packing.pack(docs, queries._vocabulary("word_bpe_49k.json"), keep_words=False, slice_bytes=PACK_BYTES, most_words=PACK_WORDS)
    return packed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


STAGES = [
    ("language_id", language_id),
    ("quality_rules", quality_rules),
    ("near_dedup", near_dedup),
    ("secret_scan", secret_scan),
    ("best_fit_packing", best_fit_packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows over ``documents``; each stage is written as Parquet and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
