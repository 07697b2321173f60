"""Tables, shared intermediate results and SQL fragments of the registered queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corvidex.functions.tokenize import bucket_vector, simple
from corvidex.operators import bm25, dense, graph
from corvidex.sources.store import kept


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "documents")


def spread(rows: DataFrame) -> DataFrame:
    """For work that shuffles nothing: ``rows`` of a file, dealt out anew if fewer tasks would have any than run at a time, as a file's row group goes to one task."""
    spark = rows.sparkSession
    most = spark.sparkContext.defaultParallelism
    busy = rows.groupBy(F.spark_partition_id()).count().limit(most).count()  # counts of rows are in the files' footers
    return rows.repartition(4 * most) if busy < most else rows


def questions(spark, sf_dir) -> DataFrame:
    """The query set: every row of ``benchmark``."""
    return table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("query_id"), F.col("text").alias("query"))


def index(spark, sf_dir) -> bm25.Index:
    """The index of ``documents``, kept for the session."""
    docs = documents(spark, sf_dir)
    return bm25.build(docs, keep=lambda name, df: kept(docs, f"bm25-{name}", lambda: df))


def sparse(spark, sf_dir, k: int, formula: str = "lucene") -> DataFrame:
    return bm25.search(index(spark, sf_dir), questions(spark, sf_dir), k, formula)


def vectors(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """(queries, documents) as bucket vectors of their texts."""
    q = questions(spark, sf_dir).select("query_id", bucket_vector(simple(F.col("query"))).alias("qv"))
    docs = documents(spark, sf_dir)
    return q, kept(docs, "vectors", lambda: docs.select("doc_id", bucket_vector(simple(F.col("text"))).alias("dv")))


def close(spark, sf_dir, k: int) -> DataFrame:
    return dense.top_k(*vectors(spark, sf_dir), k=k)


def graph_index(spark, sf_dir) -> graph.GraphIndex:
    """Proximity graphs over the documents' vectors, kept for the session."""
    made = graph.build(vectors(spark, sf_dir)[1])
    made.nodes = kept(documents(spark, sf_dir), "graph", lambda: made.nodes)
    return made


# --- DuckDB fragments ---
WS = r"[\t-\r\x1c-\x20\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"
TOKENS = "list_filter(regexp_extract_all(lower({0}), '[\\p{{L}}\\p{{N}}]+'), lambda t: length(t) >= 2)"


def tokens(c: str) -> str:
    return TOKENS.format(c)


def quoted(value: str) -> str:
    """A string as an SQL literal."""
    return "'" + value.replace("'", "''") + "'"


def strip(c: str) -> str:
    return f"regexp_replace({c}, '^{WS}+|{WS}+$', '', 'g')"


def bm25_sql(formula: str = "lucene") -> str:
    """CTEs up to ``scored(query_id, doc_id, score)``."""
    idf = {
        "lucene": "idf AS (SELECT term, ln(1 + (n - df + 0.5) / (df + 0.5)) AS idf FROM dfs, stats)",
        "okapi": "raw AS (SELECT term, ln(n - df + 0.5) - ln(df + 0.5) AS r FROM dfs, stats), idf AS (SELECT term, CASE WHEN r < 0 THEN 0.25 * (SELECT avg(r) FROM raw) ELSE r END AS idf FROM raw)",
    }[formula]
    top = "tf * 2.5" if formula == "okapi" else "tf"
    return f"""
        toks AS (SELECT doc_id, {tokens("text")} AS t FROM documents),
        post AS (SELECT doc_id, dl, term, count(*) AS tf FROM (SELECT doc_id, len(t) AS dl, unnest(t) AS term FROM toks) GROUP BY ALL),
        stats AS (SELECT count(*) AS n, avg(len(t)) AS avgdl FROM toks),
        dfs AS (SELECT term, count(*) AS df FROM post GROUP BY term),
        {idf},
        qt AS (SELECT query_id, term, count(*) AS qtf FROM (SELECT item_id AS query_id, unnest({tokens("text")}) AS term FROM benchmark) GROUP BY ALL),
        scored AS (SELECT query_id, doc_id, round(sum(qtf * idf * {top} / (tf + 1.5 * (1 - 0.75 + 0.75 * dl / avgdl))), 6) AS score
                   FROM qt JOIN idf USING (term) JOIN post USING (term), stats GROUP BY ALL)"""


def ranked_sql(name: str, source: str, k: int) -> str:
    return f"{name} AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id) AS rank FROM {source}) WHERE rank <= {k})"


def vector_sql() -> str:
    """CTEs up to ``vscored(query_id, doc_id, score)``."""
    unit = "list_transform(c, lambda x: CASE WHEN nrm > 0 THEN x / nrm ELSE x END)"

    def side(name: str, key: str, src: str) -> str:
        return f"""{name} AS (SELECT {key}, {unit} AS v FROM (SELECT {key}, c, sqrt(list_sum(list_transform(c, lambda x: x * x))) AS nrm FROM (
            SELECT {key}, list_transform(range(0, 64), lambda b: CAST(len(list_filter(h, lambda x: x = b)) AS DOUBLE)) AS c FROM (
            SELECT {key}, list_transform({tokens("text")}, lambda t: CAST('0x' || substr(md5(t), 1, 4) AS INT) % 64) AS h FROM {src}))))"""

    return f"""{side("qv", "query_id", "(SELECT item_id AS query_id, text FROM benchmark)")},
        {side("dv", "doc_id", "documents")},
        vscored AS (SELECT query_id, doc_id, round(list_inner_product(qv.v, dv.v), 6) AS score FROM qv, dv)"""
