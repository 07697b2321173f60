"""Text splitters in plain Python; :mod:`corvidex.operators.chunking` runs them over tables."""

from __future__ import annotations

import math
import re
from bisect import bisect_right
from collections import deque
from collections.abc import Iterator, Sequence

import numpy as np

from corvidex.functions import plain

# Where a text may be cut, the coarsest first; after the last one it is cut between any two characters
SEPARATORS = ("\n\n", "\n", ". ", "。", "! ", "? ", "；", "，", " ")


def spans(text: str, size: int, step: int, separators: Sequence[str] = SEPARATORS) -> Iterator[tuple[int, int, tuple[int, ...]]]:
    """(start, end, path) of the packed spans of a text, in order.

    The cut positions of a separator are found first; from each one the packing takes the farthest end within ``size``,
    by bisection, as the cost of the parts between two cuts is their distance plus one separator.  A part
    longer than ``size`` is taken apart at the next separator, in the end into windows ``step`` apart.  ``path`` holds
    where the span itself and the longer parts around it begin, one entry per separator tried: two spans were packed
    together at a separator exactly if their paths agree up to it.
    """
    todo = [(0, len(text), 0, ())]
    while todo:
        low, high, level, path = todo.pop()
        if level < 0:  # ready
            if text[low:high].strip():
                yield low, high, path
            continue
        if level == len(separators):
            yield from ((a, min(a + size, high), path) for a in range(low, high, step))
            continue
        mark, path = separators[level], (*path, low)
        ends = [*_found(text, mark, low, high), high]
        found, i, begin = [], 0, low
        while i < len(ends):
            if ends[i] - begin > size:
                found.append((begin, ends[i], level + 1, path))
                i += 1
            else:
                i = max(i + 1, bisect_right(ends, begin + size - len(mark), i))
                found.append((begin, ends[i - 1], -1, path))
            begin = ends[i - 1] + len(mark)
        todo += reversed(found)


def _found(text: str, mark: str, low: int, high: int) -> Iterator[int]:
    at = text.find(mark, low, high)
    while at >= 0:
        yield at
        at = text.find(mark, at + len(mark), high)


def split_packed(text: str, size: int, overlap: int, separators: Sequence[str] = SEPARATORS) -> list[str]:
    """The chunks of a text: its spans, each behind the end of the one before it.

    The end of the span before is repeated once for every separator at which both were packed together, from the finest
    to the coarsest and with what was repeated there already, so a chunk may exceed ``size``.
    """
    if len(text) <= size:
        return [text] if text.strip() else []
    out: list[str] = []
    before, tails = (), []  # of the span before: its path, and its end at each separator
    for low, high, path in spans(text, size, max(1, size - overlap), separators):
        chunk, own = text[low:high], [""] * len(path)
        together = next((k for k, (a, b) in enumerate(zip(before, path, strict=False)) if a != b), min(len(before), len(path)))
        for k in reversed(range(len(path))):
            own[k] = chunk[-overlap:] if overlap > 0 else ""
            if k < together:
                chunk = tails[k] + chunk
        out.append(chunk)
        before, tails = path, own
    return out


def split_kept(text: str, size: int, overlap: int, separators: Sequence[str] = ("\n\n", "\n", ". ", " ")) -> list[str]:
    """Splitting that keeps separators with the text after them; overlap is made of whole parts.

    Without a last empty separator a part free of all separators may exceed ``size``.
    """
    if len(text) <= size:
        return [text.strip()] if text.strip() else []
    mark = next((s for s in separators if s in text), None)
    if mark is None:
        return [text.strip()] if text.strip() else []
    finer = separators[list(separators).index(mark) + 1 :]
    first, *rest = text.split(mark)
    parts = [p for p in [first, *(mark + r for r in rest)] if p]
    out: list[str] = []
    window: deque[str] = deque()
    held = 0  # characters in the window

    def flush() -> None:
        joined = "".join(window).strip()
        if joined:
            out.append(joined)

    for p in parts:
        if len(p) > size:
            flush()
            window.clear()
            held = 0
            out += split_kept(p, size, overlap, finer) if finer else [p.strip()]
            continue
        if window and held + len(p) > size:
            flush()
            while window and (held > overlap or held + len(p) > size):
                held -= len(window.popleft())
        window.append(p)
        held += len(p)
    flush()
    return out


HEADER = re.compile(r"^(#{1,4})\s+(.*?)\s*$")


def markdown_sections(text: str, levels: int = 4) -> list[tuple[dict[int, str], str]]:
    """(headers by level, text with its header line) of each section; code fences hold no headers."""
    if not text.startswith("#") and "\n#" not in text:
        return [({}, s)] if (s := text.strip()) else []
    out: list[tuple[dict[int, str], list[str]]] = [({}, [])]
    open_headers: dict[int, str] = {}
    fenced = False
    for line in text.split("\n"):
        if line.strip().startswith("```"):
            fenced = not fenced
        m = None if fenced else HEADER.match(line)
        if m and len(m[1]) <= levels:
            open_headers = {k: v for k, v in open_headers.items() if k < len(m[1])} | {len(m[1]): m[2]}
            out.append((dict(open_headers), [line]))
        else:
            out[-1][1].append(line)
    return [(h, s) for h, own in out if (s := "\n".join(own).strip())]


def split_paragraphs(text: str, size: int = 1000) -> list[str]:
    """Whole paragraphs packed up to ``size``; no overlap."""
    out: list[str] = []
    held = ""
    for p in (p.strip() for p in text.split("\n\n")):
        if not p:
            continue
        if held and len(held) + len(p) >= size:
            out.append(held)
            held = p
        else:
            held = f"{held}\n\n{p}" if held else p
    return [*out, held] if held else out


def hybrid_pieces(text: str, size: int, overlap: int, width: int, between: str) -> Iterator[tuple[str, bool, str]]:
    """(section, is_boundary, content) of a text in order: before the cleaned chunks of each h1 or h2 section, the ends of both sections joined by ``between``."""
    before = None
    for i, (_, section) in enumerate(markdown_sections(plain.merge_pages(text), levels=2)):
        if before is not None:
            yield f"{i - 1}-{i}", True, before + between + section[:width]
        for part in split_kept(section, size, overlap):
            if (content := plain.clean_chunk(part)) is not None:
                yield str(i), False, content
        before = section[max(0, len(section) - width) :]


_SENTENCE_END = re.compile(r"([.!?])\s+", re.A)
#: Sentences whose vectors are held at a time.
SENTENCES = 1024


def _units(sentences: Sequence[str]) -> np.ndarray:
    """The bucket vectors of sentences, to the last bit those of ``tokenize.bucket_vector``: sums of squares are whole numbers."""
    counts = plain.counts(sentences)
    norms = np.sqrt(np.einsum("ij,ij->i", counts, counts))
    norms[norms == 0] = 1  # a zero vector stays
    return counts / norms[:, None]


def steps(sentences: Sequence[str]) -> np.ndarray:
    """One minus the similarity of each sentence to the next, added up from the first place to the last."""
    out, last = [np.empty(0)], np.empty((0, 64))
    for at in range(0, len(sentences), SENTENCES):
        v = np.concatenate([last, _units(sentences[at : at + SENTENCES])])
        out.append(1 - np.cumsum(v[1:] * v[:-1], axis=1)[:, -1])
        last = v[-1:]
    return np.concatenate(out)


def percentile(values: np.ndarray, share: float) -> float:
    """As Spark's ``percentile``, to the last bit."""
    place = (len(values) - 1) * share
    low, high = math.floor(place), math.ceil(place)
    ordered = np.partition(values, (low, high))
    a, b = float(ordered[low]), float(ordered[high])
    return a if a == b else (high - place) * a + (place - low) * b


def segments(text: str, share: float = 0.95) -> list[dict]:
    """(content, sentences) of the segments of a text, which breaks after sentences whose step to the next is above that percentile of its steps."""
    parts = _SENTENCE_END.split(text)
    if len(parts) == 1:
        return [{"content": text, "sentences": 1}]
    sentences = [*map(str.__add__, parts[::2], parts[1::2]), parts[-1]]
    found = steps(sentences)
    ends = [*(np.flatnonzero(found > percentile(found, share)) + 1).tolist(), len(sentences)]
    return [{"content": " ".join(sentences[a:b]), "sentences": b - a} for a, b in zip([0, *ends], ends, strict=False)]
