"""Secret scanning with a random forest that removes false findings, in DataFrame expressions only.

Long runs of key-like characters that hold a digit, or are capitals throughout, are candidates.  A random forest judges each one by its
length, its transitions between character classes, how much of it dictionary words cover, whether it looks like
a path, and the words next to it.  The forest is trained by Spark ML from labelled findings; its trees then
become one SQL expression, so that candidates are judged where they stand in a document's row: no shuffle, no
second pass, and what is found can be cut out of the text at once.

Labelled findings have columns ``before``, ``value``, ``after`` (text around a candidate) and ``label``; give
``train`` your own, or let :func:`made_findings` make a balanced set by rule.  Their number bounds the training.

Defined results: a null text has no candidates and stays null, an empty one stays empty.  Texts are read
whole.  Equal candidates in one text are judged each by its own neighbours.  Repeated rows get equal results.
An empty table gives no rows.  Extra columns pass through; the columns added replace any of the same name.  Overlapping
candidates cannot be: the next one is looked for behind the last.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corvidex.llm._spark import let

CANDIDATE = r"(?<![A-Za-z0-9+/_-])(?=[A-Za-z+/_-]*[0-9]|[A-Z]{16,24}(?![A-Za-z]))[A-Za-z0-9+/_-]{12,}={0,2}"
MARK = "[SECRET]"
NEAR = 48
# Words that name a secret next to it, starts of well-known key formats, words that name harmless digests,
# and dictionary words whose share in a candidate tells names from keys
KEYWORDS = ("password", "passwd", "pwd", "passphrase", "secret", "token", "api_key", "apikey", "api-key", "access_key", "auth", "credential", "bearer", "private", "key")
STARTS = ("AKIA", "ASIA", "ghp_", "gho_", "github_pat_", "glpat-", "xox", "sk_", "sk-", "rk_", "pk_", "AIza", "ya29", "eyJ", "npm_", "hf_", "SG")
HARMLESS = ("commit", "sha1", "sha256", "sha512", "md5", "checksum", "digest", "revision", "uuid", "etag", "invoice", "order", "card", "isbn", "serial", "version", "page", "build")
DICTIONARY = (
    "about access account after again album all and article author back best blog book build card case chapter city class code color commit config cook data date days default design docs example file final first food for from gallery guide have head help home house how image index info invoice item lib list local long mail main make map menu model module month more name news not number order page part photo place plan play post price product project public python recipe release report review road school section series server share shop site size source spring start static story study summer system table team test text that the this time travel tree type update user version video view water week with word work world year".split()
)
FEATURES = ("length", "digits", "uppers", "lowers", "hex", "marks", "transitions", "distinct", "letters_run", "dictionary", "vowels", "slashes", "extension", "path", "start", "assigned", "keyword", "harmless", "quoted", "next_word")


def _any(words) -> str:
    return "(" + "|".join(w.replace("-", "[-]").replace("_", "[_]") for w in sorted(words, key=len, reverse=True)) + ")"


def features(value: Column, before: Column, after: Column) -> list[Column]:
    """Numbers a candidate is judged by, in the order of ``FEATURES``."""
    n = F.greatest(F.length(value), F.lit(1)).cast("double")
    count = lambda pattern, c=value: F.regexp_count(c, F.lit(pattern)).cast("double")
    flag = lambda c: F.coalesce(c.cast("double"), F.lit(0.0))
    low = F.lower(value)
    turns = "(?<=[a-z])(?=[A-Z0-9])|(?<=[0-9])(?=[A-Za-z])|(?<=[A-Z])(?=[0-9])|(?<=[A-Z])(?=[a-z])"
    tail = F.lower(before)
    return [
        n,
        count("[0-9]") / n,
        count("[A-Z]") / n,
        count("[a-z]") / n,
        flag(value.rlike("^[0-9a-f]+$") | value.rlike("^[0-9A-F]+$")),
        count("[+/_=-]") / n,
        count(turns) / n,
        F.size(F.array_distinct(F.split(value, ""))).cast("double") / n,
        F.coalesce(F.array_max(F.transform(F.regexp_extract_all(value, F.lit("([A-Za-z]+)"), F.lit(1)), F.length)), F.lit(0)).cast("double") / n,
        (n - F.length(F.regexp_replace(low, _any(DICTIONARY), ""))) / n,
        count("[aeiouAEIOU]") / n,
        count("/"),
        flag(after.rlike("^[.][A-Za-z]{2,5}\\b")),
        flag(before.rlike("[/.:~@]$") & ~before.rlike("[:]$")),
        flag(value.rlike("^" + _any(STARTS))),
        flag(before.rlike("[=:]\\s*[\"']?$")),
        flag(tail.rlike(_any(KEYWORDS) + "[\"']?\\s*([=:]|is)?\\s*[\"']?$")),
        flag(tail.rlike(_any(HARMLESS) + "\\s*([=:#]|no[.]|number)?\\s*[\"']?$")),
        flag(before.rlike("[\"']$") & after.rlike("^[\"']")),
        flag(after.rlike("^[ ,.]*[A-Za-z]{2,}")),
    ]


def made_findings(spark: SparkSession, n: int = 6000) -> DataFrame:
    """``n`` labelled findings made by rule from the row number: keys in several formats, and what is often taken for one."""
    draw = lambda salt: F.sha2(F.concat_ws(":", F.col("id").cast("string"), F.lit(salt)), 512)
    alnum = lambda salt: F.translate(F.base64(F.unhex(draw(salt))), "+/=\r\n", "aZ")
    pick = lambda words, salt: F.element_at(F.array(*[F.lit(w) for w in words]), (F.pmod(F.xxhash64("id", F.lit(salt)), F.lit(len(words))) + 1).cast("int"))
    digits = lambda salt, k: F.substring(F.translate(draw(salt), "abcdef", "012345"), 1, k)
    word = lambda salt: pick(DICTIONARY, salt)
    hexes = lambda salt, low, span: F.substring(draw(salt), F.lit(1), (F.pmod(F.xxhash64("id", F.lit("n" + salt)), F.lit(span)) + low).cast("int"))
    lead, end = F.concat_ws(" ", word("l1"), word("l2")), F.concat(F.lit(" "), word("e1"), F.lit(" "), word("e2"))
    name = pick(("password", "passwd", "pwd", "secret", "token", "api_key", "auth_token", "access_key", "client_secret"), "k")
    quote = lambda c, q: F.concat(lead, F.lit(" "), name, F.lit(c), F.lit(q))
    plain, harmless = F.concat(lead, F.lit(" ")), F.concat(lead, F.lit(" "), pick(HARMLESS, "h"), pick((" ", ": ", ":", "="), "hs"))
    q = F.concat(F.lit('"'), end)
    kinds = [
        (plain, F.concat(F.lit("AKIA"), F.substring(F.upper(alnum("a")), 1, 16)), end, 1),
        (quote("=", ""), hexes("b", 14, 30), end, 1),
        (quote(" = ", '"'), hexes("c", 20, 30), q, 1),
        (plain, F.concat(F.lit("ghp_"), F.substring(alnum("d"), 1, 36)), end, 1),
        (quote(": ", "'"), F.substring(alnum("e"), 1, 32), F.concat(F.lit("'"), end), 1),
        (quote("=", ""), F.substring(alnum("f"), 1, 24), end, 1),
        (quote(" is ", ""), F.concat(F.substring(alnum("g"), 1, 14), F.lit("7")), end, 1),
        (quote(" = ", '"'), F.concat(F.lit("sk_"), F.substring(alnum("s"), 1, 28)), q, 1),
        (plain, digits("h", 16), end, 0),
        (plain, F.concat(word("w1"), F.lit("-"), word("w2"), F.lit("-"), digits("i", 2), F.lit("-"), word("w3")), end, 0),
        (plain, F.concat(word("w4"), F.lit("/"), word("w5"), digits("j", 1), F.lit("/"), word("w6")), F.lit(".html "), 0),
        (harmless, hexes("k", 32, 32), end, 0),
        (plain, F.concat(word("w7"), word("w8"), word("w9"), digits("l", 2)), end, 0),
        (F.concat(lead, F.lit(" /usr/")), F.concat(word("wa"), F.lit("/"), word("wb"), digits("m", 1), F.lit("/"), word("wc")), F.lit(".txt "), 0),
        (harmless, F.concat(F.lit("INV-2024-"), digits("n", 6)), end, 0),
        (plain, F.concat(F.lit("2024"), digits("o", 4), F.lit("T"), digits("p", 6)), F.lit("Z "), 0),
    ]
    k = F.pmod(F.col("id"), F.lit(len(kinds)))
    column = lambda i: F.element_at(F.array(*[row[i] if isinstance(row[i], Column) else F.lit(row[i]) for row in kinds]), (k + 1).cast("int"))
    return spark.range(n).select(column(0).alias("before"), column(1).alias("value"), column(2).alias("after"), column(3).cast("double").alias("label"))


def train(findings: DataFrame, trees: int = 20, depth: int = 6, seed: int = 8):
    """The forest as a function from feature columns to a probability column."""
    from pyspark.ml.classification import RandomForestClassifier
    from pyspark.ml.feature import VectorAssembler

    own = features(F.col("value"), F.col("before"), F.col("after"))
    rows = findings.select(*[c.alias(f) for c, f in zip(own, FEATURES, strict=True)], F.col("label").cast("double").alias("label"))
    rows = VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(rows).select("features", "label")
    model = RandomForestClassifier(numTrees=trees, maxDepth=depth, seed=seed, featureSubsetStrategy="onethird").fit(rows)

    def tree(node, own: list[Column]) -> Column:
        if node.subtreeDepth() == 0:
            stats = list(node.impurityStats().stats())
            return F.lit(float(stats[1] / sum(stats)) if len(stats) > 1 and sum(stats) else 0.0)
        split = node.split()
        return F.when(own[split.featureIndex()] <= F.lit(float(split.threshold())), tree(node.leftChild(), own)).otherwise(tree(node.rightChild(), own))

    roots = [t._java_obj.rootNode() if hasattr(t, "_java_obj") else t._call_java("rootNode") for t in model.trees]

    def probability(own: list[Column]) -> Column:
        total = tree(roots[0], own)
        for r in roots[1:]:
            total = total + tree(r, own)
        return total / F.lit(float(len(roots)))

    return probability


def running_sums(values: Column, most: int = 24) -> Column:
    """Sums of an array's first, first two, .. entries by doubling steps, so n entries take n log n; up to ``2 ** most`` of them."""
    def stepped(step: int):
        return lambda a: F.when(F.size(a) <= step, a).otherwise(F.transform(a, lambda x, i: x + F.coalesce(F.get(a, i - step), F.lit(0))))

    for k in range(most):
        values = let(values, stepped(1 << k))
    return values


def scan(docs: DataFrame, probability, text_col: str = "text", least: float = 0.5) -> DataFrame:
    """``docs`` with ``n_candidates``, ``secrets`` (start, end, probability; code points) and ``redacted`` text."""
    names = [c for c in docs.columns if c.lower() not in ("n_candidates", "secrets", "redacted")]
    pattern = F.lit(f"({CANDIDATE})")
    row = F.struct(*[F.col(f"`{c}`") for c in names])
    held = docs.select(row.alias("row"), F.col(f"`{text_col}`").alias("t"))
    held = held.withColumn("found", F.regexp_extract_all(F.coalesce("t", F.lit("")), pattern, F.lit(1)))
    held = held.withColumn("gaps", F.when(F.size("found") > 0, F.split("t", CANDIDATE, -1)).otherwise(F.array().cast("array<string>")))
    # where each candidate starts: running lengths of the gaps and candidates before it
    ends = running_sums(F.zip_with("gaps", "found", lambda g, v: F.length(g) + F.coalesce(F.length(v), F.lit(0))))
    starts = let(ends, lambda e: F.transform("found", lambda v, i: F.get(e, i) - F.length(v)))
    judged = F.transform("found", lambda v, i: let(F.struct(*[c.alias(f) for c, f in zip(features(v, F.right(F.get("gaps", i), F.lit(NEAR)), F.left(F.get("gaps", i + 1), F.lit(NEAR))), FEATURES, strict=True)]), lambda x: probability([x[f] for f in FEATURES])))
    none = F.array().cast("array<double>")
    held = held.withColumn("p", F.when(F.size("found") > 0, judged).otherwise(none))
    held = held.withColumn("starts", F.when(F.size("found") > 0, starts).otherwise(F.array().cast("array<int>")))
    spans = F.filter(F.transform("found", lambda v, i: F.struct(F.get("starts", i).cast("long").alias("start"), (F.get("starts", i) + F.length(v)).cast("long").alias("end"), F.get("p", i).alias("probability"))), lambda s: s["probability"] >= least)
    parts = F.transform("gaps", lambda g, i: F.concat(g, F.when(F.get("p", i) >= least, F.lit(MARK)).otherwise(F.coalesce(F.get("found", i), F.lit("")))))
    redacted = F.when(F.exists("p", lambda p: p >= least), F.array_join(parts, "")).otherwise(F.col("t"))
    return held.select("row.*", F.size("found").cast("long").alias("n_candidates"), spans.alias("secrets"), redacted.alias("redacted"))
