"""Readers and writers: text folders, mixed formats, CSV questions and answers, chunk tables, pairs."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corvidex.sources.html import parse

BOM = "﻿"


def read_texts(spark: SparkSession, path: str, pattern: str = "*.txt", recursive: bool = False) -> DataFrame:
    """(content, filename, source, file_size) of text files that are not blank."""
    rows = spark.read.option("wholetext", True).option("pathGlobFilter", pattern).option("recursiveFileLookup", recursive).text(path)
    rows = rows.select(F.col("value").alias("content"), F.col("_metadata.file_name").alias("filename"), F.regexp_replace(F.col("_metadata.file_name"), r"\.[^.]*$", "").alias("source"))
    return rows.where(F.trim(F.col("content")) != "").withColumn("file_size", F.length("content"))


def read_mixed(spark: SparkSession, path: str, pdf=None, recursive: bool = True) -> DataFrame:
    """(path, kind, content, error) of .txt, .html and .pdf files; what fails has its error in the row."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", recursive).load(path)
    kind = F.lower(F.regexp_extract("path", r"\.([A-Za-z]+)$", 1))
    files = files.select("path", kind.alias("kind"), "length", "content").where(F.col("kind").isin("txt", "html", "htm", "pdf"))

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for own in batches:
            texts, errors = [], []
            for k, raw in zip(own["kind"], own["content"], strict=True):
                text, error = None, None
                try:
                    if k == "pdf":
                        tiers = pdf if isinstance(pdf, (list, tuple)) else [pdf]
                        for i, tier in enumerate(tiers):
                            try:
                                if tier is None:
                                    raise RuntimeError("no PDF extractor is installed")
                                text = "\n".join(f"[Page {n}]\n{p}" for n, p in enumerate(tier.pages(bytes(raw)), 1))
                                break
                            except Exception:
                                if i == len(tiers) - 1:
                                    raise
                    else:
                        text = bytes(raw).decode("utf-8")
                        text = parse(text)["text"] if k != "txt" else text
                except Exception as e:  # one file's fault is that row's, not the job's
                    error = f"{type(e).__name__}: {e}"
                texts.append(text)
                errors.append(error)
            yield own[["path", "kind", "length"]].assign(content=texts, error=errors)

    return files.mapInPandas(work, "path string, kind string, length long, content string, error string")


def split_errors(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good rows, rows for quarantine)."""
    return rows.where(F.col("error").isNull()).drop("error"), rows.where(F.col("error").isNotNull())


def read_questions(spark: SparkSession, path: str) -> DataFrame:
    """ID and Question of a CSV with quoted line breaks; a byte order mark on the first name is dropped."""
    rows = spark.read.csv(path, header=True, multiLine=True, quote='"', escape='"')
    return rows.toDF(*[c.lstrip(BOM).strip() for c in rows.columns])


def write_answers(rows: DataFrame, path: str) -> None:
    """ID and Answer as CSV with a header; one file, as the answers to one question set."""
    rows.select("ID", "Answer").orderBy("ID").coalesce(1).write.mode("overwrite").csv(path, header=True, quote='"', escape='"')


def read_chunks(spark: SparkSession, path: str, lines: bool = False) -> DataFrame:
    return spark.read.json(path, multiLine=not lines)


def write_chunks(rows: DataFrame, path: str, kind: str = "parquet") -> None:
    rows.write.mode("overwrite").format(kind).save(path)


def write_pairs(rows: DataFrame, path: str) -> None:
    """Preference pairs as JSON lines, one folder a split."""
    rows.write.mode("overwrite").partitionBy("split").json(path)


def backfill_source(rows: DataFrame, *names: str) -> DataFrame:
    """``source`` from the first of these columns that is set."""
    return rows.withColumn("source", F.coalesce(*[F.col(n) for n in names]))


def section_slices(rows: DataFrame) -> DataFrame:
    """Sections of ``(doc_id, toc array<struct<title,page>>, page_texts)``: pages up to the next entry, the last to the end."""
    each = rows.select("doc_id", "page_texts", F.posexplode("toc").alias("i", "t"), "toc")
    nxt = F.coalesce(F.get("toc", F.col("i") + 1)["page"], F.size("page_texts") + 1)
    own = F.slice("page_texts", F.col("t.page"), F.greatest(nxt - F.col("t.page"), F.lit(0)))
    return each.select("doc_id", "i", F.col("t.title").alias("title"), F.array_join(own, "\n").alias("content"))


def new_files(raw: DataFrame, done: DataFrame, key: str = "stem") -> DataFrame:
    """Rows whose key was not processed yet, by name."""
    return raw.join(done.select(key).distinct(), key, "left_anti").orderBy(key)


def changed_files(raw: DataFrame, history: DataFrame, key: str = "name") -> DataFrame:
    """New rows and rows of another size than before."""
    h = history.select(F.col(key), F.col("size").alias("__size"))
    return raw.join(h, key, "left").where(F.col("__size").isNull() | (F.col("__size") != F.col("size"))).drop("__size")


def scan(spark: SparkSession, folders: list[str], kinds: tuple[str, ...] = ("txt", "html", "pdf"), recursive: bool = True) -> DataFrame:
    """(path, kind, size) of the files of several folders, each path once, in whatever case its ending is."""
    rows = spark.read.format("binaryFile").option("recursiveFileLookup", recursive).load(folders).select("path", F.lower(F.regexp_extract("path", r"\.([A-Za-z0-9]+)$", 1)).alias("kind"), F.col("length").alias("size"))
    return rows.where(F.col("kind").isin(*kinds)).dropDuplicates(["path"])


def write_metadata(rows: DataFrame, path: str, text: str = "content") -> None:
    """The columns of every document but its text, with the text's length, as JSON lines."""
    rows.withColumn("content_length", F.length(F.coalesce(F.col(text), F.lit("")))).drop(text).write.mode("overwrite").json(path)


#: What a knowledge base's version file may set, and what holds where it does not
VERSION = {"chunks": "chunks", "vectors": "vectors", "postings": "postings", "bm25_weight": 0.5, "vector_weight": 0.5}


def read_version(spark: SparkSession, path: str) -> dict:
    """The settings of a version file of JSON; without a file, or where it leaves one out, the defaults hold."""
    from corvidex.operators.vectors import exists

    if not exists(spark, path):
        return dict(VERSION)
    row = spark.read.json(path, multiLine=True).first()
    return VERSION | {k: v for k, v in (row.asDict() if row else {}).items() if k in VERSION and v is not None}


def load_version(spark: SparkSession, base: str, settings: dict) -> dict[str, DataFrame]:
    """The tables that the settings name under ``base``; those that are not there are left out."""
    from corvidex.operators.vectors import exists

    return {k: spark.read.parquet(f"{base}/{settings[k]}") for k in ("chunks", "vectors", "postings") if exists(spark, f"{base}/{settings[k]}")}


def bulk_documents(rows: DataFrame, id_col: str = "chunk_id", text_col: str = "content") -> DataFrame:
    """Chunks of either stored form as (doc_id, content, source, metadata): ids fall back on the row's content, sources on a list of names."""
    names = [c for c in ("source", "filename", "file_name", "document", "source_id") if c in rows.columns]
    rest = [c for c in rows.columns if c not in (id_col, text_col, *names)]
    own = F.col(id_col).cast("string") if id_col in rows.columns else F.lit(None).cast("string")
    source = F.coalesce(*[F.col(n).cast("string") for n in names], F.lit("unknown"))
    return rows.select(F.coalesce(own, F.substring(F.md5(F.col(text_col).cast("binary")), 1, 16)).alias("doc_id"), F.col(text_col).alias("content"), source.alias("source"), F.to_json(F.struct(*rest) if rest else F.struct(F.lit(None).alias("none"))).alias("metadata"))


def lint_encoding(lines: DataFrame, text: str = "value") -> DataFrame:
    """Lines that open or read a text file without naming an encoding."""
    line = F.col(text)
    opens = line.rlike(r"\b(open|read_csv|to_csv)\(") & ~line.rlike(r"encoding\s*=") & ~line.rlike(r"open\([^)]*['\"][rwa]?b[+]?['\"]") & ~line.rlike(r"^\s*#")
    return lines.where(opens)
