"""Chunking documents into rows, and measures of chunks.

A splitter is an Arrow UDF from a text to an array of structs; everything else (ids, boundary chunks, counts,
overlaps) is built from expressions.  Documents are independent, so nothing is shuffled but for boundaries.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corvidex.functions import slices
from corvidex.functions.text import clean_chunk, hierarchy_path, merge_pages
from corvidex.operators import splitting

#: chunk size and overlap by header level
LEVEL_SIZES = {1: (1024, 100), 2: (512, 50), 3: (256, 30), 4: (256, 20)}
RULE = "\n\n---\n\n"
TEXTS = T.ArrayType(T.StringType())


def doc_key(text: Column, prefix: int | None = None) -> Column:
    """16 hex digits of the md5 of a text or of its first characters."""
    t = text if prefix is None else F.substring(text, 1, prefix)
    return F.substring(F.md5(t.cast("binary")), 1, 16)


def chunk_key(doc: Column, index: Column, content: Column, prefix: int = 50) -> Column:
    return F.substring(F.md5(F.concat_ws("_", doc, index.cast("string"), F.substring(content, 1, prefix)).cast("binary")), 1, 16)


def chunk(docs: DataFrame, size: int = 512, overlap: int = 50, id_col: str = "doc_id", text_col: str = "text", clean: bool = True, least: int = 50) -> DataFrame:
    """(source_id, doc_key, chunk_id, chunk_index, content, total_chunks): packed chunks, cleaned, numbered after filtering."""
    split = slices.each(TEXTS, lambda t: splitting.split_packed(t or "", size, overlap))
    rows = docs.select(F.col(id_col).alias("source_id"), doc_key(F.coalesce(text_col, F.lit(""))).alias("doc_key"), split(F.col(text_col)).alias("parts"))
    kept = F.filter(F.transform("parts", lambda p: clean_chunk(p, least, normalise=False)), lambda p: p.isNotNull()) if clean else F.col("parts")
    rows = rows.select("source_id", "doc_key", kept.alias("parts"))
    # the outer form keeps the optimizer from deriving filters on the array, which would compute it once more below the generator
    out = rows.select("source_id", "doc_key", F.size("parts").alias("total_chunks"), F.posexplode_outer("parts").alias("chunk_index", "content")).where(F.col("chunk_index").isNotNull())
    return out.select("source_id", "doc_key", chunk_key(F.col("doc_key"), F.col("chunk_index"), F.col("content")).alias("chunk_id"), "chunk_index", "content", "total_chunks")


_HEADS = ("h1", "h2", "h3", "h4")
_sections = slices.each(
    T.ArrayType(T.StructType([T.StructField(n, T.StringType()) for n in (*_HEADS, "content")])),
    lambda t: [{n: h.get(i) for i, n in enumerate(_HEADS, 1)} | {"content": s} for h, s in splitting.markdown_sections(t or "")],
)
_split_by_level = slices.each(TEXTS, lambda t, level: splitting.split_kept(t, *LEVEL_SIZES[level]))


def header_level(h1: Column, h2: Column, h3: Column, h4: Column) -> Column:
    """The lowest level present (an h3 section below an h1 is level 1); 2 without headers."""
    return F.when(h1.isNotNull(), 1).when(h2.isNotNull(), 2).when(h3.isNotNull(), 3).when(h4.isNotNull(), 4).otherwise(2)


def hierarchical(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Chunks of Markdown sections, sized by header level."""
    heads = [F.col(f"s.h{i}") for i in range(1, 5)]
    rows = docs.select(F.col(id_col).alias("source_id"), doc_key(F.col(text_col), 200).alias("doc_key"), F.posexplode_outer(_sections(merge_pages(F.col(text_col)))).alias("section_index", "s")).where(F.col("section_index").isNotNull())
    rows = rows.select("source_id", "doc_key", "section_index", header_level(*heads).alias("hierarchy_level"), hierarchy_path(*heads).alias("hierarchy_path"), F.coalesce(*reversed(heads)).alias("parent_header"), F.col("s.content").alias("section"))
    rows = rows.select("*", F.posexplode_outer(_split_by_level("section", "hierarchy_level")).alias("chunk_in_section", "content")).drop("section").where(F.col("chunk_in_section").isNotNull())
    w = Window.partitionBy("source_id", "doc_key")
    index = (F.row_number().over(w.orderBy("section_index", "chunk_in_section")) - 1).alias("chunk_index")
    rows = rows.select("*", index, F.count(F.lit(1)).over(w).alias("total_chunks"), F.length("content").alias("content_length"))
    return rows.withColumn("chunk_id", chunk_key(F.col("doc_key"), F.col("chunk_index"), F.col("content")))


def boundaries(sections: DataFrame, width: int = 300, mark: str = "[섹션 경계]") -> DataFrame:
    """For ``sections(source_id, section_index, content)``: the end of each section joined with the start of the next.

    The source's other columns stay with the boundary rows.
    """
    before = F.lag("content").over(Window.partitionBy("source_id").orderBy("section_index"))
    rows = sections.withColumn("__before", before).where(F.col("__before").isNotNull())
    joined = F.concat(F.right("__before", F.lit(width)), F.lit(f"{RULE}{mark}{RULE}"), F.left("content", F.lit(width)))
    return rows.withColumn("from_section", F.col("section_index") - 1).withColumnRenamed("section_index", "to_section").withColumn("content", joined).drop("__before")


def hybrid(docs: DataFrame, size: int = 2300, overlap: int = 200, width: int = 300, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Cleaned chunks of h1 and h2 sections, and uncleaned boundary chunks between sections.

    Each row is a document, also where rows share an id; it is cut, cleaned and numbered in one go, so nothing is shuffled.
    """
    between = f"{RULE}[섹션 경계]{RULE}"
    names = ("section", "is_boundary", "content")
    kind = T.ArrayType(T.StructType([T.StructField(n, T.BooleanType() if n == "is_boundary" else T.StringType()) for n in names]))
    pieces = slices.each(kind, lambda t: [dict(zip(names, p, strict=True)) for p in splitting.hybrid_pieces(t or "", size, overlap, width, between)])
    rows = docs.select(F.col(id_col).alias("source_id"), doc_key(F.col(text_col), 500).alias("doc_key"), pieces(F.col(text_col)).alias("pieces"))
    rows = rows.select("source_id", "doc_key", F.size("pieces").cast("long").alias("total_chunks"), F.posexplode_outer("pieces").alias("chunk_index", "p")).where(F.col("chunk_index").isNotNull())
    rows = rows.select("source_id", "doc_key", *[F.col(f"p.{n}").alias(n) for n in names], "chunk_index", "total_chunks")
    return rows.withColumn("chunk_id", chunk_key(F.col("doc_key"), F.col("chunk_index"), F.col("content"), 100))


def _segments(percentile: float):
    kind = T.ArrayType(T.StructType([T.StructField("content", T.StringType()), T.StructField("sentences", T.LongType())]))
    return slices.each(kind, lambda t: None if t is None else splitting.segments(t, percentile))


def semantic(docs: DataFrame, embed: Column | None = None, percentile: float = 0.95, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Sentences joined into segments that break where neighbouring vectors differ most.

    ``embed`` maps the column ``sentence`` to a unit vector; the offline default is a bucket vector, with which a row is
    cut by itself and nothing is shuffled.
    """
    from corvidex.functions.tokenize import dot

    if embed is None:
        rows = docs.select(F.col(id_col).alias("source_id"), F.posexplode_outer(_segments(percentile)(F.col(text_col))).alias("segment", "s")).where(F.col("segment").isNotNull())
        return rows.select("source_id", F.col("segment").cast("long").alias("segment"), "s.content", "s.sentences")
    rows = docs.select(F.col(id_col).alias("source_id"), F.posexplode(F.split(text_col, r"(?<=[.!?])\s+")).alias("i", "sentence")).withColumn("v", embed)
    w = Window.partitionBy("source_id").orderBy("i")
    rows = rows.withColumn("d", 1 - dot(F.col("v"), F.lag("v").over(w)))
    rows = rows.withColumn("cut", F.percentile("d", F.lit(percentile)).over(Window.partitionBy("source_id")))
    rows = rows.withColumn("segment", F.sum(F.when(F.col("d") > F.col("cut"), 1).otherwise(0)).over(w))
    joined = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("i", "sentence"))), lambda e: e["sentence"]), " ")
    return rows.groupBy("source_id", "segment").agg(joined.alias("content"), F.count(F.lit(1)).alias("sentences"))


def eligible_for_semantic(content: Column, enhanced: Column) -> Column:
    """Long prose only: no tables, no lists, not done before."""
    return (F.length(content) >= 400) & ~enhanced & ~content.rlike(r"(?m)^\|.*\|") & ~content.rlike(r"(?m)^\s*([-*+]|\d+\.)\s")


def longest_border(before: str, after: str) -> int:
    """The length of the longest end of one text that begins the next, by the prefix function; linear in the shorter one."""
    most = min(len(before), len(after))
    start, fail, k = after[:most], [0] * most, 0
    for i in range(1, most):
        while k and start[i] != start[k]:
            k = fail[k - 1]
        k += start[i] == start[k]
        fail[i] = k
    k = 0
    for c in before[len(before) - most :]:
        while k and (k == most or c != start[k]):
            k = fail[k - 1]
        k += c == start[k]
    return k


whole_overlap = slices.each(T.IntegerType(), lambda a, b: longest_border(a, b) if a is not None and b is not None else None)


def overlaps(chunks: DataFrame) -> DataFrame:
    """The overlap of each chunk with the next of its document."""
    nxt = F.lead("content").over(Window.partitionBy("source_id").orderBy("chunk_index"))
    return chunks.withColumn("__next", nxt).where(F.col("__next").isNotNull()).select("source_id", "chunk_index", whole_overlap("content", "__next").alias("overlap"))


def chunk_stats(chunks: DataFrame, *by: str) -> DataFrame:
    """Counts and sizes of chunks; those flagged ``is_boundary`` are counted apart, where there is such a column."""
    n = F.length("content")
    edge = F.coalesce(F.sum(F.col("is_boundary").cast("long")), F.lit(0)) if "is_boundary" in chunks.columns else F.lit(0).cast("long")
    out = chunks.groupBy(*by).agg(F.count(F.lit(1)).alias("chunks"), edge.alias("boundary_chunks"), F.countDistinct("source_id").alias("documents"), F.round(F.avg(n), 6).alias("avg_size"), F.min(n).alias("min_size"), F.max(n).alias("max_size"), F.sum(n).alias("total_chars"))
    return out.withColumn("regular_chunks", F.col("chunks") - F.col("boundary_chunks"))


def hierarchy_stats(chunks: DataFrame) -> DataFrame:
    """By level and over all (null): chunks, characters, mean size and distinct paths."""
    n = F.length("content")
    return chunks.rollup("hierarchy_level").agg(F.count(F.lit(1)).alias("chunks"), F.sum(n).alias("total_chars"), F.round(F.avg(n), 6).alias("avg_size"), F.count_distinct("hierarchy_path").alias("paths"))


def overlap_report(configs: dict[str, DataFrame]) -> DataFrame:
    """One row per configuration: chunks, sizes, and the mean overlap after regular and after boundary chunks."""
    out = None
    for name, chunks in configs.items():
        c = chunks if "is_boundary" in chunks.columns else chunks.withColumn("is_boundary", F.lit(False))
        nxt = F.lead("content").over(Window.partitionBy("source_id").orderBy("chunk_index"))
        rows = c.withColumn("__next", nxt).withColumn("overlap", whole_overlap("content", "__next"))
        mean = lambda test: F.round(F.coalesce(F.avg(F.when(test, F.col("overlap"))), F.lit(0.0)), 6)
        n = F.length("content")
        own = rows.agg(F.lit(name).alias("config"), F.count(F.lit(1)).alias("total_chunks"), F.round(F.avg(n), 6).alias("avg_size"), F.min(n).alias("min_size"), F.max(n).alias("max_size"), F.sum(F.col("is_boundary").cast("long")).alias("boundary_chunks"), mean(~F.col("is_boundary")).alias("avg_regular_overlap"), mean(F.col("is_boundary")).alias("avg_boundary_overlap"), F.coalesce(F.sum("overlap"), F.lit(0)).alias("total_overlap"))
        out = own if out is None else out.unionByName(own)
    return out


def page_chunks(docs: DataFrame, size: int = 512, overlap: int = 50, page_col: str = "page_id", text_col: str = "text") -> DataFrame:
    """Chunks of every page under ids of the page and their place on it."""
    rows = chunk(docs, size, overlap, page_col, text_col)
    return rows.select(F.col("source_id").alias(page_col), F.concat(F.lit("page_"), F.col("source_id").cast("string"), F.lit("_chunk_"), F.col("chunk_index").cast("string")).alias("chunk_id"), "chunk_index", "total_chunks", "content")


def paragraphs(docs: DataFrame, size: int = 1000, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(source_id, chunk_index, content): whole paragraphs packed up to ``size`` characters, without overlap."""
    split = slices.each(TEXTS, lambda t: splitting.split_paragraphs(t or "", size))
    rows = docs.select(F.col(id_col).alias("source_id"), split(F.col(text_col)).alias("parts"))
    return rows.select("source_id", F.posexplode_outer("parts").alias("chunk_index", "content")).where(F.col("chunk_index").isNotNull())


def enhance(chunks: DataFrame, selective: bool = True, least: int = 400) -> DataFrame:
    """Chunks cut again where their sentences part in meaning, with ``semantic_enhanced``; if ``selective``, only long prose is cut.

    Parts keep the columns of their chunk and are numbered ``segment``.  Each row is cut by itself, whatever ids it shares with others.
    """
    flag = F.coalesce(F.col("semantic_enhanced"), F.lit(False)) if "semantic_enhanced" in chunks.columns else F.lit(False)
    wanted = eligible_for_semantic(F.col("content"), flag) if selective else F.length("content") >= least
    rows = chunks.select("*", _segments(0.95)(F.when(wanted, F.col("content"))).alias("__parts")).drop("semantic_enhanced")
    rows = rows.select("*", F.posexplode_outer("__parts").alias("__at", "__part")).drop("__parts")
    rows = rows.withColumn("content", F.coalesce("__part.content", "content")).withColumn("semantic_enhanced", F.col("__part").isNotNull())
    return rows.withColumn("segment", F.coalesce(F.col("__at").cast("long"), F.lit(0).cast("long"))).drop("__at", "__part")
