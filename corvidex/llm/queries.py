"""The thin ``opN_<name>`` queries: each applies one operator to its whole table and derives the columns asked for."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corvidex.llm import align, audit, balance, langid, packing, pieces, pii, quality, secrets, sharding, simhash, topk, toxicity
from corvidex.llm._spark import fold_of


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _vocabulary(name: str) -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


def op1_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.exact_top_k(_table(spark, sf_dir, "embeddings"))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    model = toxicity.train_toxicity(docs, _table(spark, sf_dir, "labels"))
    scored = toxicity.score_toxicity(docs, model)
    spans = F.array_join(F.transform("spans", lambda s: F.concat_ws(":", s["start"], s["end"])), ",")
    return scored.select("doc_id", (fold_of(F.col("doc_id")) == 0).alias("held_out"), "score", "predicted", spans.alias("spans"))


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    found = langid.identify(docs, langid.train_langid(docs), keep=("doc_id",))
    return found.select("doc_id", (fold_of(F.col("doc_id")) == 0).alias("held_out"), "lang_pred", "score")


def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find_pii(_table(spark, sf_dir, "documents"))
    listed = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    base = F.filter("spans", lambda s: s["base"])

    def of(kind: str):
        return F.size(F.filter(base, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    counts = [of(k) for k in pii.KINDS]
    return found.select("doc_id", *counts, F.sha2(listed(base), 256).alias("base_sha256"), listed("spans").alias("spans"))


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality.judge(_table(spark, sf_dir, "documents"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "quality")


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    text = F.coalesce(F.col("text"), F.lit(""))
    dealt = sharding.shard_rows(docs, [F.col("doc_id"), F.crc32(text.cast("binary")), F.octet_length(text)])
    return dealt.select(
        "doc_id",
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op7_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = pieces.encode(_table(spark, sf_dir, "documents"), _vocabulary("piece_bpe_32k.model"), with_ids=False)
    return cut.select("doc_id", "n_pieces", "ids_crc32", "score", F.col("cuts.score").alias("cut_scores"), F.col("cuts.ids_crc32").alias("cut_crc32"), "round_trip")


def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scan(_table(spark, sf_dir, "documents"), secrets.train(secrets.made_findings(spark)))
    spans = F.array_join(F.transform("secrets", lambda s: F.concat_ws(":", s["start"], s["end"])), ",")
    return found.select("doc_id", "n_candidates", F.size("secrets").cast("long").alias("n_secrets"), spans.alias("spans"), F.crc32(F.col("redacted").cast("binary")).alias("redacted_crc32"))


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(_table(spark, sf_dir, "documents"))


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = packing.pack(_table(spark, sf_dir, "documents"), _vocabulary("word_bpe_49k.json"))
    return packed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = align.align_tokens(_table(spark, sf_dir, "documents"), _vocabulary("byte_bpe_50k.json"), _vocabulary("piece_bpe_32k.model"))
    return found.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.audit(audit.flagged(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")))


def op13_cost_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = balance.pack_balanced(_table(spark, sf_dir, "documents"), _vocabulary("byte_bpe_50k.json"))
    return packed.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_exact_top_k, op2_toxicity, op3_language_id, op4_pii, op5_quality_rules, op6_sharding, op7_sentencepiece, op8_secret_scan, op9_simhash, op10_packing, op11_token_alignment, op12_filter_audit, op13_cost_packing)
}

ORACLE_SQL: dict[str, str] = {
    "op1_exact_top_k": """
        WITH v AS (
            SELECT DISTINCT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e
            FROM embeddings
            WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ), s AS (
            SELECT q.vec_id AS query_id, c.vec_id AS vec_id, CAST(list_inner_product(q.e, c.e) AS BIGINT) AS score
            FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.e) = len(c.e)
            WHERE q.vec_id % 50 = 0
        ), r AS (
            SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS n FROM s
        )
        SELECT query_id, CAST(n AS INTEGER) AS rank, vec_id, score FROM r WHERE n <= 5
    """,
    "op12_filter_audit": """
        WITH RECURSIVE words AS (
            SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t,
                list_filter(string_split_regex(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w
            FROM documents
        ), firsts AS (
            SELECT t, min(doc_id) AS least FROM words GROUP BY t
        ), marks AS (
            SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic FROM labels GROUP BY doc_id
        ), masks AS (
            SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
                CASE WHEN len(w) < 50 THEN 1 ELSE 0 END
                + CASE WHEN 100 * len(list_distinct(w)) < 65 * len(w) THEN 2 ELSE 0 END
                + CASE WHEN 100 * length(regexp_replace(words.t, '[^A-Z]', '', 'g')) > 5 * length(words.t) THEN 4 ELSE 0 END
                + CASE WHEN regexp_matches(words.t, '[#$%&*|]') THEN 8 ELSE 0 END
                + CASE WHEN words.doc_id > least THEN 16 ELSE 0 END AS mask
            FROM words JOIN firsts ON words.t = firsts.t LEFT JOIN marks ON words.doc_id = marks.doc_id
        ), cells AS (
            SELECT part, mask, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM masks GROUP BY part, mask
        ), letters AS (
            SELECT * FROM (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)) AS v(f, b)
        ), orders AS (
            SELECT f AS filter_order, b AS used FROM letters
            UNION ALL
            SELECT filter_order || f, used + b FROM orders JOIN letters ON used & b = 0
        ), steps AS (
            SELECT o.filter_order, l.b AS bit, p.used AS after, length(p.filter_order) AS step
            FROM orders o JOIN orders p ON length(o.filter_order) = 5 AND starts_with(o.filter_order, p.filter_order)
            JOIN letters l ON l.f = right(p.filter_order, 1)
        ), counted AS (
            SELECT part, filter_order, step, bit,
                sum(CASE WHEN mask & after = 0 THEN n ELSE 0 END) AS kept,
                sum(CASE WHEN mask & (after - bit) = 0 AND mask & bit <> 0 THEN n ELSE 0 END) AS removed,
                sum(CASE WHEN mask & (after - bit) <> 0 AND mask & bit <> 0 THEN n ELSE 0 END) AS redundant,
                sum(CASE WHEN mask = bit THEN n ELSE 0 END) AS unique_fails,
                sum(CASE WHEN mask & (after - bit) = 0 AND mask & bit <> 0 THEN good ELSE 0 END) AS good_lost,
                sum(CASE WHEN mask & (after - bit) = 0 AND mask & bit <> 0 THEN toxic ELSE 0 END) AS toxic_lost
            FROM cells CROSS JOIN steps GROUP BY part, filter_order, step, bit
        )
        SELECT part, filter_order, CAST(step AS INTEGER) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
            CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost,
            CAST(toxic_lost AS BIGINT) AS toxic_lost, CAST(sum(removed) OVER (PARTITION BY part, bit) AS BIGINT) AS shapley
        FROM counted
    """,
}
