"""Tokenisers as Column expressions; others plug in through :mod:`corvidex.providers`."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from corvidex.functions.text import WS, let


def simple(c: Column) -> Column:
    """Lower-case runs of letters and digits of two characters or more."""
    return F.filter(F.regexp_extract_all(F.lower(c), F.lit(r"([\p{L}\p{N}]+)"), F.lit(1)), lambda t: F.length(t) >= 2)


def word(c: Column) -> Column:
    """Lower-case word characters, any length."""
    return F.regexp_extract_all(F.lower(c), F.lit(r"([\p{L}\p{N}_]+)"), F.lit(1))


def blank(c: Column) -> Column:
    """Split at white space, as written."""
    return F.filter(F.split(c, WS + "+"), lambda t: t != "")


def morpheme(c: Column) -> Column:
    """Content morphemes by the offline analyser; see :mod:`corvidex.functions.morphemes` for others."""
    from corvidex.functions.morphemes import Morphemes

    return Morphemes().tokens(c)


TOKENIZERS = {"simple": simple, "word": word, "blank": blank, "morpheme": morpheme}


def register(name: str, tokens) -> None:
    """Make a tokeniser, a function from a text column to an array of strings, known by name to the index and its readers."""
    TOKENIZERS[name] = tokens


def bigrams(tokens: Column) -> Column:
    """Neighbouring pairs joined by a space."""
    pairs = F.zip_with(tokens, F.slice(tokens, F.lit(2), F.greatest(F.size(tokens) - 1, F.lit(0))), lambda a, b: F.concat(a, F.lit(" "), b))
    return F.filter(pairs, lambda p: p.isNotNull())


def technical_terms(c: Column) -> Column:
    """Acronyms, letter-digit mixes, bracketed words and hyphenated terms."""
    patterns = (r"\b([A-Z]{2,})\b", r"\b([A-Za-z]+\d+[A-Za-z0-9]*)\b", r"\(([A-Za-z][A-Za-z0-9 ]+)\)", r"\b([A-Za-z]+-[A-Za-z0-9-]+)\b", r"\b([A-Z][a-z]+[A-Z][A-Za-z]*)\b")
    return F.array_distinct(F.flatten(F.array(*[F.regexp_extract_all(c, F.lit(p), F.lit(1)) for p in patterns])))


def bucket_vector(tokens: Column, size: int = 64) -> Column:
    """Unit-length counts of md5 buckets of tokens: the offline stand-in for an embedding."""
    at = lambda t: F.conv(F.substring(F.md5(t.cast("binary")), 1, 4), 16, 10).cast("int") % size
    # with each bucket added once, a sorted array has the buckets' runs in order; a run's length less one is the count
    held = F.sort_array(F.concat(F.transform(tokens, at), F.sequence(F.lit(0), F.lit(size - 1))))
    begins = lambda s: F.filter(F.transform(s, lambda x, i: F.when(F.coalesce(F.get(s, i - 1), F.lit(-1)) != x, i)), lambda i: i.isNotNull())
    counts = let(held, lambda s: let(begins(s), lambda p: F.transform(p, lambda x, k: (F.coalesce(F.get(p, k + 1), F.size(s)) - x - 1).cast("double"))))
    return normalise(counts)


def normalise(v: Column) -> Column:
    """Unit length; a zero vector stays."""
    norm = lambda u: F.sqrt(F.aggregate(u, F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double")))
    return let(v, lambda u: let(norm(u), lambda n: F.transform(u, lambda x: F.when(n > 0, x.cast("double") / n).otherwise(x.cast("double")))))


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)
