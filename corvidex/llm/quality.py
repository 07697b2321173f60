"""Quality rules by weak supervision, in DataFrame expressions only.

Each rule votes good (1) or bad (0) on a document, or abstains (null).  Expectation-maximisation over the
counts of all vote patterns estimates how often each rule is right on good and on bad documents, and how common
good documents are; a document's verdict is its posterior probability of being good.  Hard base rules
(too few words, too much repeated text) fail a document whatever the posterior.

Scale: one pass over the texts computes the statistics, row by row, without a shuffle; what is stored and
aggregated has a few numbers a document.  EM sees at most 3 ** rules patterns, in practice a few hundred; each
of its steps is one aggregation of that table, and only the parameters reach the driver.

Repeated 8-word windows are found by combining word hashes pairwise three times (64-bit hashes); only
texts in which a hash occurs twice go on to sort them.

Defined results: null, empty and blank texts have no words: all counts are 0 and they fail the base rules.
Texts are read whole.  Repeated rows get the same verdict.  An empty table gives no rows.  If every rule
abstains, the posterior is the share of good documents.  Documents with equal votes tie and share a verdict.
Columns of the input may have any name: a row travels as one struct.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corvidex.llm._spark import ascii_words, let, stored

SPACE = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
# Frequent function words of the languages served
STOP_WORDS = ("the and of to in is that with for was de la el los las que y en un una del por con le les et des est dans du der die das und ist den von zu mit ein eine").split()
RULES = ("length", "word_length", "symbols", "dup_lines", "repeats", "capitals", "line_ends", "stop_words", "exclaims", "variety")
WIDTH = 8


def window_hashes(words: Column) -> Column:
    """A 64-bit hash of each run of eight words."""
    pair = lambda step: lambda a: F.transform(a, lambda x, i: F.xxhash64(x, F.get(a, i + step)))
    one = F.transform(words, lambda w: F.xxhash64(w))
    eight = let(one, lambda a: let(pair(1)(a), lambda b: let(pair(2)(b), lambda c: pair(4)(c))))
    return F.when(F.size(words) >= WIDTH, F.slice(eight, F.lit(1), F.size(words) - (WIDTH - 1))).otherwise(F.array().cast("array<long>"))


def repeated_words(hashes: Column) -> Column:
    """Words that lie in a window found twice or more, given the windows' hashes in order."""

    def covered(w: Column) -> Column:
        order = F.sort_array(F.transform(w, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
        twice = lambda s: F.transform(F.filter(s, lambda e, j: (F.get(s, j - 1)["h"] == e["h"]) | (F.get(s, j + 1)["h"] == e["h"])), lambda e: e["i"])
        places = let(order, lambda s: F.sort_array(twice(s)))
        return let(places, lambda p: F.aggregate(F.transform(p, lambda x, k: F.least(F.lit(WIDTH), F.coalesce(F.get(p, k + 1) - x, F.lit(WIDTH)))), F.lit(0), lambda t, n: t + n))

    return let(hashes, lambda w: F.when(F.size(F.array_distinct(w)) == F.size(w), F.lit(0)).otherwise(covered(w))).cast("long")


def statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", whole_row: bool = False) -> DataFrame:
    """One row of counts per document: (id, n_words, word_chars, n_symbols, ...); ``id`` holds the whole row if asked for."""
    own = F.struct(*[F.col(f"`{c}`") for c in docs.columns]) if whole_row else F.col(f"`{id_col}`")
    held = docs.select(own.alias("id"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("t"))
    without = lambda chars: F.length("t") - F.length(F.translate("t", chars, ""))
    lines = F.filter(F.split("t", "\n"), lambda x: x.rlike("[^\\x20\\x09-\\x0D]"))
    held = held.select("id", "t", ascii_words(F.col("t")).alias("w"), lines.alias("l"))
    count = lambda c: c.cast("long")
    return held.select(
        "id",
        count(F.size("w")).alias("n_words"),
        count(F.length("t") - without(SPACE)).alias("word_chars"),
        count(without(SYMBOLS)).alias("n_symbols"),
        count(F.size("l")).alias("n_lines"),
        count(F.size("l") - F.size(F.array_distinct("l"))).alias("n_dup_lines"),
        repeated_words(window_hashes(F.col("w"))).alias("n_repeat_words"),
        count(F.size(F.array_distinct("w"))).alias("n_distinct"),
        count(F.length("t") - F.length(F.translate("t", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", ""))).alias("n_capitals"),
        count(without("!?")).alias("n_exclaims"),
        count(F.size(F.filter("l", lambda x: x.rlike("[.!?:;\"'\\u201d\\u00bb)]\\s*$")))).alias("n_closed_lines"),
        count(F.size(F.array_intersect("w", F.array(*[F.lit(x) for x in STOP_WORDS])))).alias("n_stop_words"),
    )


def votes(stats: DataFrame) -> DataFrame:
    """The statistics with one vote column ``v_<rule>`` per rule."""
    n = F.col("n_words")
    share = lambda top, of=n: F.try_divide(F.col(top), of)
    vote = lambda bad, good: F.when(bad, 0).when(good, 1).cast("int")
    length = share("word_chars")
    rules = {
        "length": vote(n < 20, n >= 50),
        "word_length": vote((length < 2) | (length > 16), (length >= 3) & (length <= 12)),
        "symbols": vote(share("n_symbols") > 0.2, share("n_symbols") < 0.05),
        "dup_lines": vote(share("n_dup_lines", F.col("n_lines")) > 0.3, (F.col("n_lines") >= 2) & (share("n_dup_lines", F.col("n_lines")) < 0.1)),
        "repeats": vote(share("n_repeat_words") > 0.3, (n >= 20) & (share("n_repeat_words") < 0.1)),
        "capitals": vote(share("n_capitals", F.col("word_chars")) > 0.5, share("n_capitals", F.col("word_chars")) < 0.2),
        "line_ends": vote((n >= 20) & (F.col("n_closed_lines") == 0), share("n_closed_lines", F.col("n_lines")) >= 0.5),
        "stop_words": vote((n >= 20) & (F.col("n_stop_words") < 2), F.col("n_stop_words") >= 3),
        "exclaims": vote(share("n_exclaims") > 0.3, share("n_exclaims") < 0.1),
        "variety": vote((n >= 50) & (share("n_distinct") < 0.15), (n >= 20) & (share("n_distinct") > 0.2)),
    }
    return stats.select("*", *[rules[r].alias(f"v_{r}") for r in RULES])


def log_odds(model: dict) -> Column:
    """Log odds of good, as a sum over the votes cast."""
    out = F.lit(math.log(model["prior"] / (1 - model["prior"])))
    for r in RULES:
        right_good, right_bad = model[r]
        yes, no = math.log(right_good / (1 - right_bad)), math.log((1 - right_good) / right_bad)
        out = out + F.when(F.col(f"v_{r}") == 1, F.lit(yes)).when(F.col(f"v_{r}") == 0, F.lit(no)).otherwise(F.lit(0.0))
    return out


def posterior(model: dict) -> Column:
    return 1 / (1 + F.exp(-log_odds(model)))


def estimate(patterns: DataFrame, rounds: int = 25, tolerance: float = 1e-3) -> dict:
    """EM over (votes, n): the share of good documents, and each rule's accuracy on good and on bad ones.

    A rule looks for one kind of fault: it seldom accuses a good document (right on 90 to 99.9 % of them) but
    may miss most bad ones (right on 10 to 98 %).  These bounds also keep the two classes from swapping.
    """
    model: dict = {"prior": 0.5} | {r: (0.98, 0.2) for r in RULES}
    within = lambda top, of, low, high: min(high, max(low, (top + 0.5) / (of + 1)))
    for _ in range(rounds):
        # the posterior is a column of its own, so that forty sums share one copy of its expression
        seen = patterns.withColumn("p", posterior(model))
        p, n = F.col("p"), F.col("n")
        sums = [F.sum(n).alias("all"), F.sum(n * p).alias("good")]
        for r in RULES:
            v = F.col(f"v_{r}")
            sums += [F.sum(F.when(v == 1, n * p)).alias(f"{r}_g1"), F.sum(F.when(v.isNotNull(), n * p)).alias(f"{r}_g"), F.sum(F.when(v == 0, n * (1 - p))).alias(f"{r}_b0"), F.sum(F.when(v.isNotNull(), n * (1 - p))).alias(f"{r}_b")]
        got = seen.agg(*sums).first()
        if not got["all"]:
            return model
        zero = lambda name: got[name] or 0.0  # noqa: E731, B023
        new: dict = {"prior": min(0.99, max(0.05, got["good"] / got["all"]))} | {r: (within(zero(f"{r}_g1"), zero(f"{r}_g"), 0.9, 0.999), within(zero(f"{r}_b0"), zero(f"{r}_b"), 0.1, 0.98)) for r in RULES}
        moved = max(abs(new["prior"] - model["prior"]), *(abs(new[r][i] - model[r][i]) for r in RULES for i in (0, 1)))
        model = new
        if moved < tolerance:
            break
    return model


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", whole_row: bool = False) -> tuple[DataFrame, dict]:
    """(stored votes of every document, the model estimated from them)."""
    voted = stored(votes(statistics(docs, id_col, text_col, whole_row)), "quality-votes")
    names = [f"v_{r}" for r in RULES]
    patterns = stored(voted.groupBy(*names).agg(F.count(F.lit(1)).alias("n")).coalesce(1), "quality-patterns")
    return voted, estimate(patterns)


def verdict(voted: DataFrame, model: dict, least: float) -> DataFrame:
    """Votes with ``quality``, ``base_failed`` and ``kept``."""
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    out = voted.withColumn("quality", posterior(model)).withColumn("base_failed", failed)
    return out.withColumn("kept", ~F.col("base_failed") & (F.col("quality") >= least))


def judge(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: float = 0.5) -> DataFrame:
    """(id, counts, votes, quality, base_failed, kept) of every document."""
    voted, model = fit(docs, id_col, text_col)
    return verdict(voted, model, least).withColumnRenamed("id", id_col)


def keep_good(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: float = 0.5) -> DataFrame:
    """The documents kept, with all their columns: rows are stored once beside their votes and filtered from there."""
    voted, model = fit(docs, id_col, text_col, whole_row=True)
    return verdict(voted, model, least).where("kept").select("id.*")
