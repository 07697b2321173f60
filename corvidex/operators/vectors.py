"""A store of vectors as tables: checked appends, cells, statistics, saving, and a health check of saved artefacts."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corvidex.functions.tokenize import normalise
from corvidex.operators import dense


@dataclass
class VectorStore:
    """``vectors(doc_id, dv, cell_id)`` of unit length; ``centres(cell_id, centre)`` once trained, else null cells and exact search."""

    vectors: DataFrame
    centres: DataFrame | None = None

    def add(self, new: DataFrame) -> VectorStore:
        """Append ``new(doc_id, dv)``; a ValueError on null or uneven vectors, repeated ids, or ids that are there already."""
        checks = new.agg(F.count(F.lit(1)).alias("n"), F.count_distinct("doc_id").alias("ids"), F.count("dv").alias("there"), F.min(F.size("dv")).alias("low"), F.max(F.size("dv")).alias("high")).first()
        if not checks["n"]:
            return self
        size = self.vectors.select(F.size("dv").alias("s")).limit(1).collect()
        if checks["there"] < checks["n"] or checks["low"] != checks["high"] or size and size[0]["s"] != checks["low"]:
            raise ValueError("vectors must be there and of one length")
        if checks["ids"] < checks["n"] or not self.vectors.join(new.select("doc_id"), "doc_id", "left_semi").isEmpty():
            raise ValueError("ids must be new")
        return VectorStore(self.vectors.unionByName(celled(new, self.centres)), self.centres)

    def train(self, cells: int = 100) -> VectorStore:
        """Cells for approximate search; fewer vectors than cells stay without."""
        if self.vectors.limit(cells).count() < cells:
            return self
        centres = dense.train_cells(self.vectors, cells)
        return VectorStore(celled(self.vectors, centres), centres)

    def search(self, queries: DataFrame, k: int = 5, probes: int = 10) -> DataFrame:
        if self.centres is None:
            return dense.top_k(queries, self.vectors, k)
        return dense.search_cells(queries, self.vectors, self.centres, k, probes)

    def stats(self) -> DataFrame:
        """One row: vectors, their length, cells in use, and whether cells were trained."""
        own = self.vectors.agg(F.count(F.lit(1)).alias("vectors"), F.coalesce(F.max(F.size("dv")), F.lit(0)).alias("dimension"), F.count_distinct("cell_id").alias("cells"))
        return own.withColumn("trained", F.lit(self.centres is not None))

    def cleared(self) -> VectorStore:
        return VectorStore(self.vectors.where("false"), None)

    def save(self, path: str) -> None:
        """Vectors go into one folder a cell, so that a search reads those it probes."""
        self.vectors.write.mode("overwrite").partitionBy("cell_id").parquet(f"{path}/vectors")
        if self.centres is not None:
            self.centres.write.mode("overwrite").parquet(f"{path}/centres")


def celled(vectors: DataFrame, centres: DataFrame | None) -> DataFrame:
    """Unit vectors with the cell of each."""
    rows = vectors.select("doc_id", normalise(F.col("dv")).alias("dv"))
    if centres is None:
        return rows.withColumn("cell_id", F.lit(None).cast("int"))
    return dense.assign_cells(rows, centres).select("doc_id", "dv", F.col("cell_id").cast("int"))


def store(vectors: DataFrame) -> VectorStore:
    return VectorStore(celled(vectors, None))


def load(spark: SparkSession, path: str) -> VectorStore:
    vectors = spark.read.parquet(f"{path}/vectors").select("doc_id", "dv", F.col("cell_id").cast("int").alias("cell_id"))
    return VectorStore(vectors, spark.read.parquet(f"{path}/centres") if exists(spark, f"{path}/centres") else None)


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a path is there, in any store that Spark reads."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target)


def health(spark: SparkSession, artefacts: dict[str, str]) -> DataFrame:
    """(artefact, path, there, rows, ok): Parquet tables that should be there and hold rows; a table that cannot be read counts as without rows."""
    rows = []
    for name, path in artefacts.items():
        there, n = exists(spark, path), 0
        if there:
            try:
                n = spark.read.parquet(path).count()
            except Exception:
                n = 0
        rows.append((name, path, there, n, there and n > 0))
    return spark.createDataFrame(rows, "artefact string, path string, there boolean, rows long, ok boolean")


def index_health(postings: DataFrame, vectors: DataFrame, docs: DataFrame) -> DataFrame:
    """One row: documents, those without postings, those without a vector, and entries of documents that are gone."""
    ids = docs.select("doc_id").distinct()
    p, v = postings.select("doc_id").distinct(), vectors.select("doc_id").distinct()
    marked = ids.withColumn("d", F.lit(1)).join(p.withColumn("p", F.lit(1)), "doc_id", "full").join(v.withColumn("v", F.lit(1)), "doc_id", "full")
    on = lambda test: F.count_if(test)
    d, p_, v_ = F.col("d"), F.col("p"), F.col("v")
    return marked.agg(on(d.isNotNull()).alias("documents"), on(d.isNotNull() & p_.isNull()).alias("without_postings"), on(d.isNotNull() & v_.isNull()).alias("without_vector"), on(d.isNull()).alias("orphans"))
