"""Functions of :mod:`corvidex.functions.text` and :mod:`corvidex.functions.tokenize` for one string in plain Python, with the same results.

For splitters that clean what they cut: a text goes to Python once and is done there, and these take a small part of the time of the expressions.
Java's ``\\s`` and ``\\d`` are ASCII, and so they are here; ``WS`` of the expressions is what ``str.split`` and ``str.strip`` go by.
Letters and digits are those of Python's Unicode tables (15.1 in Python 3.13; Java 17 has 13): the results differ on the 5 500 code points that became
letters or digits in between, and on no others.
"""

from __future__ import annotations

import hashlib
import re
import unicodedata
from collections.abc import Sequence

import numpy as np

from corvidex.functions.text import DELETED, FURNITURE, SPACED

NEXT_PAGE, LAST_PAGE = "[다음 페이지에 계속]", "[이전 페이지에서 계속]"
_JOINED = re.compile(rf"{re.escape(NEXT_PAGE)}\s*\n+.*?{re.escape(LAST_PAGE)}\s*", re.A | re.S)
_BLANK = re.compile(r"\n\n\n+")
_FURNITURE = re.compile("(" + "|".join(FURNITURE) + ")", re.A | re.I)
_SPECIAL = re.compile(r"[^\w \t\n\x0b\f\r]")
_SPACED, _DELETED = re.compile(f"[{SPACED}]"), re.compile(f"[{DELETED}]")
# written out, as a pattern that begins with a class or a literal is looked for faster
_DOTS = re.compile(r"[·․．.\-_][·․．.\-_][·․．.\-_]+")
_SIGNS = tuple((s * 3, re.compile(re.escape(s) * 3 + "+")) for s in "=*#~")
_SPACES = re.compile(r"\s\s\s\s\s+")
# a match begins where its word does, or where the match before it ended
_LEADERS = tuple((s * 2, re.compile(rf"(?:(?<![^{s}\s])|(?<=\d))([^{s}\s]+)\s*{re.escape(s)}{{2,}}\s*(\d+)", re.A)) for s in ".·")
#: Words whose places a worker keeps.
MOST_WORDS = 200_000
#: Stands between texts, and the places that it and words of one character get, which the vectors don't have.
END = "\0"
END_PLACE, NO_PLACE = 64, 65


def merge_pages(t: str) -> str:
    last = t.rfind(LAST_PAGE)
    if last >= 0:  # nothing after the last mark can match, so no open end is looked for to the end of the text again and again
        end = last + len(LAST_PAGE)
        while end < len(t) and t[end] in " \t\n\x0b\f\r":
            end += 1
        t = _JOINED.sub(" ", t[:end]) + t[end:]
    t = t.replace(NEXT_PAGE, "").replace(LAST_PAGE, "")
    return _BLANK.sub("\n\n", t) if "\n\n\n" in t else t


def likely_metadata(t: str) -> bool:
    t = t.strip()
    return len(t) < 5 or all(unicodedata.category(c)[0] == "N" for c in t) or len(_SPECIAL.findall(t)) > 0.5 * len(t) or _FURNITURE.match(t) is not None


def clean(t: str) -> str:
    """The cleaning chain without composition."""
    if not t.isascii():
        t = _DELETED.sub("", _SPACED.sub(" ", t))
    t = _DOTS.sub(" ", t)
    for sign, run in _SIGNS:
        if sign in t:
            t = run.sub(" ", t)
    t = _SPACES.sub(" ", t)
    t = "\n".join(x for x in t.split("\n") if not _FURNITURE.match(x.strip()))
    for sign, leader in _LEADERS:
        if sign in t:
            t = leader.sub(r"\1 \2", t)
    return " ".join(t.split())


def clean_chunk(t: str, least: int = 50) -> str | None:
    """``text.clean_chunk`` without composition."""
    if likely_metadata(t):
        return None
    t = clean(t)
    return t if len(t) >= least else None


class _Letters(dict):
    """Letters, digits and ``END`` stay, any other character becomes a space."""

    def __missing__(self, code: int) -> int:
        at = self[code] = code if chr(code).isalnum() or chr(code) == END else 32
        return at


class _Places(dict):
    """The places of words in ``tokenize.bucket_vector``: four hex digits of their md5, modulo 64."""

    def __missing__(self, word: str) -> int:
        if len(self) >= MOST_WORDS:
            self.clear()
        long = len(word) >= 2
        at = self[word] = hashlib.md5(word.encode(), usedforsecurity=False).digest()[1] & 63 if long else END_PLACE if word == END else NO_PLACE
        return at


_letters, _places = _Letters(), _Places()


def counts(texts: Sequence[str]) -> np.ndarray:
    """How many words of each text have each of the 64 places, a row a text; words are those of ``tokenize.simple``."""
    joined = f" {END} ".join(texts)
    if joined.count(END) >= len(texts):
        joined = f" {END} ".join(t.replace(END, " ") for t in texts)
    words = joined.lower().translate(_letters).split()
    at = np.fromiter(map(_places.__getitem__, words), np.int64, len(words))
    at += np.cumsum(at == END_PLACE) << 7
    return np.bincount(at, minlength=len(texts) << 7).reshape(-1, 128)[:, :64].astype(np.float64)
