"""Morpheme tokenisers: a provider analyses texts into (form, tag) pairs; filters and fallbacks are the same for all of them.

``RuleAnalyzer`` is the offline default.  It knows word classes by script and cuts common particles and endings off
Hangul words; a full analyser plugs in by the same two methods.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from typing import Protocol

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corvidex.functions import slices

PAIRS = T.ArrayType(T.StructType([T.StructField("form", T.StringType()), T.StructField("tag", T.StringType())]))
TOKENS = T.ArrayType(T.StringType())
#: Tags that carry meaning: nouns, verbs, adjectives, foreign words
CONTENT = ("N", "V", "VA", "SL")
# Particles that follow nouns, the longest first, and endings that make verbs and adjectives
PARTICLES = ("에서는", "으로써", "으로서", "이라는", "에서", "에게", "으로", "까지", "부터", "처럼", "보다", "라는", "은", "는", "이", "가", "을", "를", "의", "에", "와", "과", "도", "로", "만")
ENDINGS = (("합니다", "XSV"), ("됩니다", "XSV"), ("하다", "XSV"), ("되다", "XSV"), ("하는", "XSV"), ("되는", "XSV"), ("하여", "XSV"), ("한다", "XSV"), ("된다", "XSV"), ("이다", "VCP"), ("적인", "XSA"))


class Analyzer(Protocol):
    def analyse(self, text: str) -> list[tuple[str, str]]: ...

    def space(self, text: str) -> str: ...


class RuleAnalyzer:
    """Word classes by script, particles and endings by list; spacing is only collapsed."""

    _runs = re.compile(r"([가-힣]+)|([^\W\d_]+)|(\d+)|(\S)")

    def analyse(self, text: str) -> list[tuple[str, str]]:
        out: list[tuple[str, str]] = []
        for hangul, foreign, digits, mark in self._runs.findall(text):
            if foreign or digits or mark:
                out.append((foreign, "SL") if foreign else (digits, "SN") if digits else (mark, "SW"))
                continue
            tails = [(e, t) for e, t in ENDINGS if hangul.endswith(e)] or [(p, "J") for p in PARTICLES if hangul.endswith(p) and len(hangul) - len(p) >= 2]
            if tails and len(hangul) > len(tails[0][0]):
                tail, tag = tails[0]
                out += [(hangul[: -len(tail)], "NNG"), (tail, tag)]
            else:
                out.append((hangul, "NNG"))
        return out

    def space(self, text: str) -> str:
        return " ".join(text.split())


class Morphemes:
    """Columns of a provider that ``load`` makes once a worker; a text that fails is split at white space instead.

    A column asked for again is the same UDF, so Spark computes it once a row, and all of them share one worker.
    """

    def __init__(self, load: Callable[[], Analyzer] = RuleAnalyzer):
        self.load = load
        self._made: dict[tuple, Callable] = {}

    def _each(self, kind: T.DataType, work, text: Column, *key) -> Column:
        load = self.load
        if (kind, *key) not in self._made:
            model: list[Analyzer] = []

            def one(t):
                if not model:
                    model.append(load())
                return work(model[0], t or "")

            self._made[kind, *key] = slices.each(kind, one)
        return self._made[kind, *key](text)

    def pairs(self, text: Column) -> Column:
        """(form, tag) of every morpheme; empty where the provider fails."""

        def work(model, t):
            try:
                return [{"form": f, "tag": g} for f, g in model.analyse(t)]
            except Exception:  # one text's fault is not the job's
                return []

        return self._each(PAIRS, work, text)

    def tokens(self, text: Column, tags: tuple[str, ...] = CONTENT, least: int = 2, lower: bool = True) -> Column:
        """Respaced, kept by the start of their tag, two characters or more unless foreign, lower case."""

        def work(model, t):
            try:
                found = [f for f, g in model.analyse(model.space(t)) if g.startswith(tags) and (len(f) >= least or g.startswith("SL"))]
                return [f.lower() for f in found] if lower else found
            except Exception:
                return (t.lower() if lower else t).split()

        return self._each(TOKENS, work, text, tags, least, lower)

    def forms(self, text: Column) -> Column:
        """Every form as it is."""
        return F.transform(self.pairs(text), lambda p: p["form"])

    def nouns(self, text: Column) -> Column:
        return F.transform(F.filter(self.pairs(text), lambda p: p["tag"].startswith("N")), lambda p: p["form"])

    def compounds(self, text: Column) -> Column:
        """Neighbouring nouns as one term."""
        own = self.pairs(text)
        both = F.zip_with(own, F.slice(own, F.lit(2), F.greatest(F.size(own) - 1, F.lit(0))), lambda a, b: F.when(a["tag"].startswith("N") & b["tag"].startswith("N"), F.concat(a["form"], F.lit(" "), b["form"])))
        return F.filter(both, lambda x: x.isNotNull())

    def spaced(self, text: Column) -> Column:
        return self._each(T.StringType(), lambda model, t: model.space(t), text)
