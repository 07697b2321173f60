"""Pluggable model providers.  Each default is deterministic, offline and states what it stands in for."""

from __future__ import annotations

from collections.abc import Iterator
from typing import Protocol

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from corvidex.functions.tokenize import bucket_vector, simple
from corvidex.operators.rerank import overlap_score


class Embedder(Protocol):
    def embed(self, text: Column) -> Column: ...


class PairScorer(Protocol):
    def score(self, query: Column, doc: Column) -> Column: ...


class Generator(Protocol):
    def generate(self, prompt: Column) -> Column: ...


class Tokenizer(Protocol):
    def tokens(self, text: Column) -> Column: ...


class PdfExtractor(Protocol):
    def pages(self, content: bytes) -> list[str]: ...


class BucketEmbedder:
    """Unit-length counts of token buckets, in place of a sentence model."""

    def __init__(self, size: int = 64):
        self.size = size

    def embed(self, text: Column) -> Column:
        return bucket_vector(simple(F.coalesce(text, F.lit(""))), self.size)


class BatchEmbedder:
    """Any ``list[str] -> list[list[float]]`` model behind an iterator UDF, loaded once a worker."""

    def __init__(self, load):
        self.load = load

    def embed(self, text: Column) -> Column:
        load = self.load

        @pandas_udf("array<float>")
        def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            model = load()
            for own in batches:
                yield pd.Series([list(map(float, v)) for v in model(own.fillna("").tolist())])

        return run(text)


class OverlapScorer:
    """Share of the query's tokens found, in place of a cross-encoder."""

    def score(self, query: Column, doc: Column) -> Column:
        return overlap_score(query, doc)


class EchoGenerator:
    """The first context line of a prompt, in place of a language model; ``default`` where there is none."""

    def __init__(self, default: str = "1"):
        self.default = default

    def generate(self, prompt: Column) -> Column:
        line = F.get(F.filter(F.split(prompt, "\n"), lambda x: F.length(F.trim(x)) > 0), F.lit(1))
        return F.coalesce(line, F.lit(self.default))


class NoPdf:
    """Says that no extractor is installed; a reader records this as the row's error."""

    def pages(self, content: bytes) -> list[str]:
        raise RuntimeError("no PDF extractor is installed")
