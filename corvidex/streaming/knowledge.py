"""A knowledge base that documents are added to, changed in and removed from, in snapshots.

Each batch writes one segment: the documents that are new or changed, their postings and their vectors.  A document that was changed or removed gets
a tombstone, which hides what older segments hold of it.  A snapshot is a list of segments (see :mod:`corvidex.sources.versions`): readers of
an older one are undisturbed, and a batch that fails changes nothing.  ``compact`` merges the segments of a snapshot into one without tombstones.
Whatever the batches were, a search gives what it would after a build of the documents that are left.

Scale: a batch reads the ids and digests of the base (not its texts) and writes in proportion to itself.  What a search reads besides live postings is
hidden by an anti join with the tombstones, whose number compaction bounds; they are broadcast while counted few.  Segments are merged when there are over ``MOST_SEGMENTS``.

Defined results: rows without an id take no part; a null text is an empty one.  Of rows that share an id in one batch, the one with the
greatest text counts.  An id that is both given and removed in one batch is removed.  A batch numbered no higher than the last of its
series changes nothing.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from corvidex.operators import bm25, dense, fusion
from corvidex.operators.vectors import VectorStore
from corvidex.providers import BucketEmbedder
from corvidex.sources import files, versions

MOST_SEGMENTS = 16
#: Up to this many tombstones are sent to every task.
FEW_TOMBSTONES = 200_000
TABLES = ("documents", "postings", "vectors", "tombstones")


class Snapshot:
    """What a reader sees: the live rows of a list of segments."""

    def __init__(self, base: KnowledgeBase, number: int, content: dict):
        self.base, self.number, self.segments = base, number, content.get("segments", [])
        self.batches = content.get("batches", {})

    def _all(self, name: str, schema: str) -> DataFrame:
        """All rows of a table with the place of their segment."""
        out = self.base.spark.createDataFrame([], f"{schema}, segment int")
        for i, s in enumerate(self.segments):
            rows = self.base.spark.read.schema(schema).parquet(f"{self.base.folder.path}/segments/{s}/{name}")
            out = out.unionByName(rows.withColumn("segment", F.lit(i)))
        return out

    def _live(self, name: str, schema: str) -> DataFrame:
        rows = self._all(name, schema)
        # the last segment that hides a document; it hides what lies before
        hidden = self._all("tombstones", self.base.types["tombstones"]).groupBy("doc_id").agg(F.max("segment").alias("__upto")).withColumnRenamed("doc_id", "__id")
        few = hidden.limit(FEW_TOMBSTONES + 1).count() <= FEW_TOMBSTONES
        return rows.join(F.broadcast(hidden) if few else hidden, (F.col("doc_id") == F.col("__id")) & (F.col("segment") < F.col("__upto")), "left_anti").drop("segment")

    def documents(self) -> DataFrame:
        """(doc_id, text, digest) of the documents there are."""
        return self._live("documents", self.base.types["documents"])

    def index(self) -> bm25.Index:
        """The BM25 index of the live documents: their postings, and frequencies and lengths counted anew."""
        postings = self._live("postings", self.base.types["postings"])
        n = self._live("documents", self.base.types["documents"]).agg(F.count(F.lit(1)).alias("n"))
        words = postings.agg(F.coalesce(F.sum("tf"), F.lit(0)).alias("words"))
        stats = n.crossJoin(F.broadcast(words)).select("n", F.try_divide("words", "n").alias("avgdl"))  # one row each
        return bm25.Index(postings, postings.groupBy("term").agg(F.count(F.lit(1)).alias("df")), stats, self.base.tokenizer)

    def vectors(self) -> VectorStore:
        return VectorStore(self._live("vectors", self.base.types["vectors"]).withColumn("cell_id", F.lit(None).cast("int")))

    def search(self, queries: DataFrame, k: int = 5) -> DataFrame:
        return bm25.search(self.index(), queries, k)


class KnowledgeBase:
    """A folder of segments and manifests."""

    def __init__(self, spark: SparkSession, path: str, tokenizer: str = "simple", id_type: str = "bigint", embed=None):
        self.spark, self.folder, self.tokenizer = spark, versions.Folder(spark, path), tokenizer
        self.embed = embed or BucketEmbedder().embed
        i = f"doc_id {id_type}"
        self.types = {"documents": f"{i}, text string, digest string", "postings": f"term string, {i}, tf int, dl int", "vectors": f"{i}, dv array<double>", "tombstones": i}
        self.id_type = id_type

    def snapshot(self, number: int | None = None) -> Snapshot:
        return Snapshot(self, *versions.manifest(self.folder, number))

    def _write(self, segment: str, documents: DataFrame, tombstones: DataFrame) -> None:
        at = f"{self.folder.path}/segments/{segment}"

        def write(rows: DataFrame, name: str) -> None:
            kinds = StructType.fromDDL(self.types[name])
            rows.select(*[F.col(f.name).cast(f.dataType) for f in kinds]).write.parquet(f"{at}/{name}")

        write(documents, "documents")
        own = self.spark.read.schema(self.types["documents"]).parquet(f"{at}/documents")
        write(bm25.postings_of(own, self.tokenizer), "postings")
        write(own.select("doc_id", self.embed(F.col("text")).alias("dv")), "vectors")
        write(tombstones, "tombstones")

    def apply(self, docs: DataFrame, removed: DataFrame | None = None, batch: tuple[str, int] | None = None, full: bool = False) -> dict:
        """Bring ``docs(doc_id, text)`` in and take ``removed(doc_id)`` out; gives counts and the snapshot's number.

        ``batch`` is a series and the batch's number in it.  With ``full``, ``docs`` is all there should be: documents that it does not hold are removed.
        """
        now = self.snapshot()
        if batch is not None and batch[1] <= now.batches.get(batch[0], -1):
            return {"snapshot": now.number, "new": 0, "changed": 0, "removed": 0, "unchanged": 0, "applied": False}
        given = docs.select(F.col("doc_id").cast(self.id_type).alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")).where("doc_id IS NOT NULL")
        given = given.groupBy("doc_id").agg(F.max("text").alias("text")).withColumn("digest", F.sha2("text", 256))
        gone = self.spark.createDataFrame([], self.types["tombstones"]) if removed is None else removed.select(F.col("doc_id").cast(self.id_type).alias("doc_id")).where("doc_id IS NOT NULL").distinct()
        held = now.documents().select("doc_id", F.col("digest").alias("held"))
        if full:
            gone = gone.unionByName(held.select("doc_id").join(given.select("doc_id"), "doc_id", "left_anti")).distinct()
        # one row a document of the batch: what it was, what it is to be
        asked = given.join(gone.withColumn("gone", F.lit(True)), "doc_id", "full")
        marks = asked.join(held.join(asked.select("doc_id"), "doc_id", "left_semi"), "doc_id", "left")
        kind = F.when(F.col("gone"), F.when(F.col("held").isNotNull(), "removed"))
        kind = kind.when(F.col("held").isNull(), "new").when(F.col("held") != F.col("digest"), "changed").otherwise("unchanged")
        segment = uuid.uuid4().hex
        plan = marks.withColumn("kind", kind).where("kind IS NOT NULL")
        plan = plan.select("doc_id", F.when(F.col("kind").isin("new", "changed"), F.col("text")).alias("text"), "digest", "kind")
        # written first, so that all tables of the segment and the counts come of one reading of the batch
        plan_path = f"{self.folder.path}/segments/{segment}/plan"
        plan.write.partitionBy("kind").parquet(plan_path)
        plan = self.spark.read.schema(f"{self.types['documents']}, kind string").parquet(plan_path)
        counts = {r["kind"]: r["n"] for r in plan.groupBy("kind").agg(F.count(F.lit(1)).alias("n")).collect()}
        out = {k: counts.get(k, 0) for k in ("new", "changed", "removed", "unchanged")}
        batches = now.batches | ({batch[0]: batch[1]} if batch else {})
        segments = now.segments
        if out["new"] or out["changed"] or out["removed"]:
            self._write(segment, plan.where("kind IN ('new', 'changed')"), plan.where("kind IN ('changed', 'removed')").select("doc_id"))
            segments = [*segments, segment]
        number = versions.switch(self.folder, now.number, {"segments": segments, "batches": batches})
        if len(segments) > MOST_SEGMENTS:
            number = self.compact()
        return {"snapshot": number, **out, "applied": True}

    def compact(self) -> int:
        """One segment of all that is live, without tombstones; gives the snapshot's number."""
        now = self.snapshot()
        segment = uuid.uuid4().hex
        at = f"{self.folder.path}/segments/{segment}"
        for name in ("documents", "postings", "vectors"):
            rows = now._live(name, self.types[name])
            rows = rows.repartitionByRange("term", "doc_id").sortWithinPartitions("term", "doc_id") if name == "postings" else rows
            rows.write.parquet(f"{at}/{name}")
        self.spark.createDataFrame([], self.types["tombstones"]).write.parquet(f"{at}/tombstones")
        return versions.switch(self.folder, now.number, {"segments": [segment], "batches": now.batches})

    def vacuum(self, keep: int = 2) -> list[str]:
        """Remove what only snapshots before the last ``keep`` hold, and the leavings of failed batches; no writer may be at work."""
        return versions.vacuum(self.folder, "segments", lambda content: content.get("segments", []), keep)

    def follow(self, source: str, checkpoint: str, schema: str, **options: str) -> None:
        """Apply the files that are new in ``source`` (Parquet; a true column ``removed`` marks a removal), a batch of the stream at a time.

        A batch that was switched to but not yet noted by the stream's checkpoint is known by its number.
        """
        stream = self.spark.readStream.schema(schema).options(**options).parquet(source)

        def work(rows: DataFrame, number: int) -> None:
            if "removed" in rows.columns:
                out = F.coalesce("removed", F.lit(False))
                self.apply(rows.where(~out), rows.where(out), batch=(checkpoint, number))
            else:
                self.apply(rows, batch=(checkpoint, number))

        stream.writeStream.foreachBatch(work).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()

    def history(self) -> DataFrame:
        """(snapshot, segments) of the snapshots that are kept."""
        rows = []
        for n in versions.numbers(self.folder):
            content = versions.manifest(self.folder, n)[1]
            rows.append((n, len(content["segments"])))
        return self.spark.createDataFrame(rows, "snapshot long, segments int")


class Retriever:
    """Hybrid search over a knowledge base by a version file's settings; it stays on its snapshot until it is refreshed."""

    def __init__(self, base: KnowledgeBase, version: str | None = None, rerank=None, over_fetch: int = 3):
        self.base, self.rerank, self.over_fetch = base, rerank, over_fetch
        self.settings = files.read_version(base.spark, version) if version else dict(files.VERSION)
        self.snapshot = base.snapshot()

    def refresh(self) -> bool:
        """Go to the newest snapshot; whether there was a newer one."""
        before, self.snapshot = self.snapshot.number, self.base.snapshot()
        return self.snapshot.number > before

    def search(self, queries: DataFrame, k: int = 5, how: str = "minmax") -> DataFrame:
        """(query_id, doc_id, score, rank) for ``queries(query_id, query)``: both lists fused by the settings' weights, then
        reranked by ``rerank(query, text)``, a column, if there is one, over ``over_fetch`` times as many."""
        wide = k * self.over_fetch if self.rerank is not None else k
        sparse = bm25.search(self.snapshot.index(), queries, wide)
        asked = queries.select("query_id", self.base.embed(F.col("query")).alias("qv"))
        dense_found = dense.top_k(asked, self.snapshot.vectors().vectors, wide)
        weights = float(self.settings["bm25_weight"]), float(self.settings["vector_weight"])
        found = fusion.hybrid(sparse, dense_found, wide, weights, how).select("query_id", "doc_id", "score", "rank")
        if self.rerank is None:
            return found
        texts = found.join(self.snapshot.documents().select("doc_id", "text"), "doc_id").join(queries.select("query_id", "query"), "query_id")
        return bm25.ranked(texts.select("query_id", "doc_id", self.rerank(F.col("query"), F.col("text")).alias("score")), k)
