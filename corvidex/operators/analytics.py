"""Usage, dominance and evaluation reports over ranked results."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corvidex.operators.order import running_sum
from corvidex.sources.store import written

#: Up to this many distinct values have their ranks sent to every task.
FEW_VALUES = 100_000


def usage(chunks: DataFrame, hits: DataFrame) -> DataFrame:
    """Hits of every chunk, used or not: ``hits(chunk_id, method, kind, score)``."""
    count = lambda test: F.sum(F.when(test, 1).otherwise(0))
    of = hits.groupBy("chunk_id").agg(
        count(F.col("method") == "bm25").alias("bm25_count"),
        count(F.col("method") == "vector").alias("vector_count"),
        F.count(F.lit(1)).alias("total_count"),
        count(F.col("kind") == "mc").alias("mc_count"),
        count(F.col("kind") == "desc").alias("desc_count"),
        F.round(F.avg(F.when(F.col("method") == "vector", F.col("score"))), 6).alias("avg_vector_score"),
    )
    names = ["bm25_count", "vector_count", "total_count", "mc_count", "desc_count", "avg_vector_score"]
    return chunks.select("chunk_id").join(of, "chunk_id", "left").na.fill(0, names)


def usage_summary(used: DataFrame) -> DataFrame:
    on = lambda test: F.sum(F.when(test, 1).otherwise(0)).cast("long")
    b, v, t = F.col("bm25_count"), F.col("vector_count"), F.col("total_count")
    return used.agg(
        on(t > 0).alias("used"),
        on(t == 0).alias("unused"),
        F.round(F.avg(t), 6).alias("mean_use"),
        on((b > 0) & (v == 0)).alias("bm25_only"),
        on((b == 0) & (v > 0)).alias("vector_only"),
        on((b > 0) & (v > 0)).alias("both"),
        on(F.col("mc_count") > F.col("desc_count")).alias("mc_preferred"),
        on(F.col("desc_count") > F.col("mc_count")).alias("desc_preferred"),
        on((v > 0) & (F.col("avg_vector_score") < 0.5)).alias("low_score"),
        on(t > 10).alias("high_use"),
    )


def dominance(results: DataFrame) -> DataFrame:
    """Which method's mean score leads for each query of ``results(query_id, bm25_score, vector_score)``."""
    g = results.groupBy("query_id").agg(F.avg("bm25_score").alias("b"), F.avg("vector_score").alias("v"))
    ratio = F.round(F.col("b") / (F.col("v") + 1e-10), 4)
    return g.select("query_id", ratio.alias("ratio"), F.when(ratio > 1.5, "bm25").when(ratio < 0.67, "vector").otherwise("balanced").alias("dominant"))


def mean_ranks(counts: DataFrame, col: str, out: str) -> DataFrame:
    """``counts(..., n)`` with average ranks of a column, a row standing for ``n``; ties share the mean of their places."""
    values = counts.groupBy(col).agg(F.sum("n").alias("__n"))
    # distinct values in order: the running count up to a value, less half of its block
    ranks = running_sum(values, col, F.col("__n"), "__upto").select(col, (F.col("__upto") - (F.col("__n") - 1) / 2).alias(out))
    few = ranks.limit(FEW_VALUES + 1).count() <= FEW_VALUES  # with few values each has many rows
    return counts.join(F.broadcast(ranks) if few else ranks, col)


def embedding_eval(pairs: DataFrame) -> DataFrame:
    """Spearman, Pearson, MSE and MAE of ``pairs(score, gold)``, and a grade; with a column ``n`` a row stands for so many pairs.

    Pairs are counted by score and gold first, so that what follows grows with the distinct scores.
    """
    n = F.col("n")
    own = (pairs if "n" in pairs.columns else pairs.withColumn("n", F.lit(1).cast("long"))).where("score IS NOT NULL AND gold IS NOT NULL")
    counts = written(own.groupBy("score", "gold").agg(F.sum(n).alias("n")), "pair-counts")
    r = mean_ranks(mean_ranks(counts, "score", "rs"), "gold", "rg")
    names = ("score", "gold", "rs", "rg")
    means = r.agg(F.sum(n).alias("total"), *[(F.sum(n * F.col(c)) / F.sum(n)).alias(f"m_{c}") for c in names])
    off = {c: F.col(c) - F.col(f"m_{c}") for c in names}
    corr = lambda a, b: F.round(F.try_divide(F.sum(n * off[a] * off[b]), F.sqrt(F.sum(n * off[a] * off[a])) * F.sqrt(F.sum(n * off[b] * off[b]))), 6)
    d = F.col("score") - F.col("gold")
    out = r.crossJoin(F.broadcast(means)).agg(corr("rs", "rg").alias("spearman"), corr("score", "gold").alias("pearson"), F.round(F.sum(n * d * d) / F.sum(n), 6).alias("mse"), F.round(F.sum(n * F.abs(d)) / F.sum(n), 6).alias("mae"), F.coalesce(F.sum(n), F.lit(0)).alias("n"))
    s = F.col("spearman")
    return out.withColumn("grade", F.when(s >= 0.8, "A").when(s >= 0.7, "B").when(s >= 0.6, "C").when(s >= 0.5, "D").otherwise("F"))


def retrieval_summary(found: DataFrame, queries: DataFrame) -> DataFrame:
    """Coverage, documents a query, and mean scores of the first and of the first five."""
    per = found.groupBy("query_id").agg(F.count(F.lit(1)).alias("n"), F.max("score").alias("top"), F.avg(F.when(F.col("rank") <= 5, F.col("score"))).alias("five"))
    all_of = queries.select("query_id").join(per, "query_id", "left")
    return all_of.agg(F.round(F.avg(F.when(F.col("n") > 0, 1.0).otherwise(0.0)), 6).alias("coverage"), F.round(F.avg(F.coalesce("n", F.lit(0))), 6).alias("avg_docs"), F.round(F.avg("top"), 6).alias("avg_top"), F.round(F.avg("five"), 6).alias("avg_five"))


def job_summary(log: DataFrame) -> DataFrame:
    return log.groupBy("status").agg(F.count(F.lit(1)).alias("files"), F.sum("chunks").alias("chunks"))


def tracked(methods: dict[str, DataFrame], kinds: DataFrame) -> DataFrame:
    """One row per hit, the facts that usage is counted from: (query_id, method, chunk_id, rank, score, kind)."""
    rows = None
    for name, found in methods.items():
        part = found.select("query_id", F.lit(name).alias("method"), F.col("doc_id").alias("chunk_id"), "rank", "score")
        rows = part if rows is None else rows.unionByName(part)
    return rows.join(kinds.select("query_id", "kind"), "query_id", "left")


def dominance_by_type(judged: DataFrame) -> DataFrame:
    """Counts of the leading method by question type, and the mean and population deviation of the ratio, of
    ``judged(query_id, type, ratio, dominant, preference)``; the row without a type is over all."""
    on = lambda test: F.sum(F.when(test, 1).otherwise(0)).cast("long")
    trusts = F.contains("preference", F.lit("유용")) | F.contains("preference", F.lit("신뢰"))
    says = F.when(F.contains("preference", F.lit("BM25")) & trusts, "bm25").when(F.contains("preference", F.lit("Vector")) & trusts, "vector").otherwise("unclear")
    rows = judged.withColumn("says", says)
    counts = [on(F.col("dominant") == n).alias(f"{n}_dominant") for n in ("bm25", "vector", "balanced")] + [on(F.col("says") == n).alias(f"prefers_{n}") for n in ("bm25", "vector", "unclear")]
    return rows.rollup("type").agg(*counts, F.round(F.avg("ratio"), 4).alias("avg_ratio"), F.round(F.stddev_pop("ratio"), 4).alias("std_ratio"))


def answer_summary(answers: DataFrame) -> DataFrame:
    """By question type and over all: answers given, matches of two methods (equal choices, or over five shared words), reasoning and
    evidence of over ten characters, mean lengths; of ``answers(type, diagnostic, simple, thought, evidence)``."""
    on = lambda test: F.sum(F.when(test, 1).otherwise(0)).cast("long")
    d, s = F.col("diagnostic"), F.col("simple")
    there = lambda c: F.coalesce(c, F.lit("")) != ""
    words = lambda c: F.array_distinct(F.filter(F.split(c, r"\s+"), lambda w: w != ""))
    same = F.when(F.col("type") == "multiple_choice", F.trim(d) == F.trim(s)).otherwise(F.size(F.array_intersect(words(d), words(s))) > 5)
    return answers.rollup("type").agg(
        on(there(d)).alias("generated"),
        on(there(d) & there(s) & same).alias("matches"),
        on(F.length(F.coalesce("thought", F.lit(""))) > 10).alias("with_thought"),
        on(F.length(F.coalesce("evidence", F.lit(""))) > 10).alias("with_evidence"),
        F.round(F.avg(F.when(there(d), F.length(d))), 6).alias("avg_diagnostic_length"),
        F.round(F.avg(F.when(there(s), F.length(s))), 6).alias("avg_simple_length"),
    )


def token_pages(pages: DataFrame, tokens, page: str = "page_id", text: str = "text") -> DataFrame:
    """Tokens and distinct tokens of every page."""
    return pages.select(page, tokens(F.coalesce(F.col(text), F.lit(""))).alias("t")).select(page, F.size("t").cast("long").alias("tokens"), F.size(F.array_distinct("t")).cast("long").alias("types"))


def token_frequency(pages: DataFrame, tokens, most: int | None = None, text: str = "text") -> DataFrame:
    """How often each token occurs and on how many pages, the commonest first."""
    rows = pages.select(F.col("page_id"), F.explode(tokens(F.coalesce(F.col(text), F.lit("")))).alias("term"))
    counted = rows.groupBy("term", "page_id").agg(F.count(F.lit(1)).alias("n")).groupBy("term").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("pages"))
    return counted if most is None else counted.orderBy(F.col("n").desc(), "term").limit(most)


def relevance_summary(found: DataFrame, words) -> DataFrame:
    """One row of ``found(query_id, query, text, score)``: rows, queries, the spread of scores, and the mean share of a query's words in a hit."""
    q = F.array_distinct(words(F.col("query")))
    share = F.when(F.size(q) == 0, 0.0).otherwise(F.size(F.array_intersect(q, words(F.col("text")))) / F.size(q))
    return found.agg(
        F.count(F.lit(1)).alias("hits"),
        F.count_distinct("query_id").alias("queries"),
        F.round(F.avg("score"), 6).alias("avg_score"),
        F.round(F.stddev_pop("score"), 6).alias("std_score"),
        F.min("score").alias("min_score"),
        F.max("score").alias("max_score"),
        F.round(F.avg(share), 6).alias("keyword_match"),
    )


def memory_estimate(models: DataFrame, limit_gb: float = 24.0) -> DataFrame:
    """``models(name, billions, bits)`` with the gigabytes their weights need, a third for overhead, and whether they fit."""
    need = F.round(F.col("billions") * F.col("bits") / 8 * 1.3, 6)
    return models.select("name", need.alias("memory_gb"), (need < limit_gb).alias("fits"))


def enhancement(before: DataFrame, after: DataFrame) -> DataFrame:
    """One row: chunks and mean sizes before and after an enhancement, and their ratios; ``after`` has ``semantic_enhanced``."""
    size = lambda name: F.coalesce(F.avg(F.length("content")), F.lit(0.0)).alias(name)
    a = before.agg(F.count(F.lit(1)).alias("original_count"), size("a"))
    b = after.agg(F.count(F.lit(1)).alias("enhanced_count"), size("b"), F.coalesce(F.sum(F.col("semantic_enhanced").cast("long")), F.lit(0)).alias("semantic_processed"))
    ratio = lambda top, of: F.round(F.coalesce(F.try_divide(top, of), F.lit(0.0)), 6)
    c = F.col
    return a.crossJoin(F.broadcast(b)).select(  # one row each
        "original_count", "enhanced_count", "semantic_processed",
        ratio(c("enhanced_count"), c("original_count")).alias("count_change_ratio"), F.round("a", 6).alias("original_avg_size"), F.round("b", 6).alias("enhanced_avg_size"),
        ratio(c("b"), c("a")).alias("size_change_ratio"), ratio(c("semantic_processed"), c("original_count")).alias("enhancement_rate"),
    )


def build_summary(files: DataFrame) -> DataFrame:
    """Files by outcome of ``files(path, error)``, each path once, and the share that went well in percent."""
    own = files.dropDuplicates(["path"]).agg(F.count(F.lit(1)).alias("total"), F.coalesce(F.sum(F.col("error").isNull().cast("long")), F.lit(0)).alias("success"))
    return own.select("total", "success", (F.col("total") - F.col("success")).alias("failed"), F.coalesce(F.round(F.try_divide(100.0 * F.col("success"), F.col("total")), 1), F.lit(0.0)).alias("success_rate"))


def question_set_profile(questions: DataFrame) -> DataFrame:
    """Counts, lengths and mean choices of ``questions(type, is_mc, text, options)`` by type and in all (null); choices are those of multiple-choice questions."""
    n = F.length("text")
    counts = [F.count(F.lit(1)).alias("total"), F.count_if("is_mc").alias("multiple_choice"), F.count_if(~F.col("is_mc")).alias("open_ended")]
    lengths = [F.round(F.avg(n), 6).alias("avg_length"), F.max(n).cast("long").alias("max_length"), F.min(n).cast("long").alias("min_length")]
    return questions.rollup("type").agg(*counts, *lengths, F.round(F.avg(F.when(F.col("is_mc"), F.col("options"))), 6).alias("avg_options"))
