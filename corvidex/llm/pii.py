"""Personal data by weak supervision.

Base spans come from fixed patterns (e-mail, IP address, payment card, phone).  A wider generator also
proposes spelled-out and oddly separated forms.  Labelers vote on every candidate or abstain: the base
pattern, a checksum, a gazetteer, the words before it and its shape.  Expectation-maximisation over the counts of all
vote patterns estimates each labeler's reliability per kind; the posteriors train a logistic span classifier on at
most ``max_train`` candidates (documented bound), which decides on every candidate.  Base spans always stay.

Scale: one pass over the texts, without a shuffle, writes base spans and candidates (a few numbers each); votes are
counted and candidates judged on that table.  At most kinds x 3 ** labelers counts reach the driver.

Defined results: null and empty texts have no spans.  Texts are read whole, and every pattern runs in time linear in the
text.  Offsets are code points, ends exclusive.  Repeated rows get equal spans.  An empty table gives no rows.  Spans of one
start are ordered by kind as in ``KINDS``.  Only the id and the text are read, so other columns may have any name.
Spelled-out forms keep to the limits of mail itself (64 characters before the at, 63 in a label, five labels), and no number
of over 23 digits is a candidate; base spans have no such limits.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corvidex.llm._spark import stored
from corvidex.llm._words import texts_of

KINDS = ("email", "ip", "card", "phone")
LABELERS = ("pattern", "checksum", "gazetteer", "context", "shape")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
LOCAL = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")
# a match can only begin where a run of digits does, so the look-behind changes no match
IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
AT = re.compile(r"\([aA][tT]\)|\[[aA][tT]\]|\{[aA][tT]\}|\x20[aA][tT]\x20")
SPELLED_LOCAL = re.compile(r"[A-Za-z0-9._%+-]{1,64}\x20?$")
SPELLED_DOMAIN = re.compile(r"\x20?[A-Za-z0-9-]{1,63}(?:\x20?(?:\([dD][oO][tT]\)|\[[dD][oO][tT]\]|\{[dD][oO][tT]\}|\x20[dD][oO][tT]\x20)\x20?[A-Za-z0-9-]{2,63}){1,4}")
NUMBER = re.compile(r"(?<![0-9A-Za-z+.])\(?[0-9](?:[\x20()./-]{0,2}[0-9]){6,22}(?![0-9A-Za-z])")
DIGIT = re.compile("[0-9]")
# Common top-level domains, calling codes, words that announce each kind, words that announce other numbers
TOP_LEVEL = frozenset("com org net edu gov mil int info biz io co uk de fr es it nl pl ru cn jp kr br mx ar us ca au ch at be se no dk fi eu me app dev".split())
CALLING = ("1", "33", "34", "39", "41", "43", "44", "45", "46", "47", "48", "49", "52", "54", "55", "61", "81", "82", "86", "91")
ANNOUNCE = {
    "email": re.compile(r"(?i)(e-?mail|mail|contact|write to|address|correo|courriel)\W{0,4}(?:\w+\W{1,3}){0,2}$"),
    "ip": re.compile(r"(?i)(\bip\b|host|server|address|client|ping|from)\W{0,4}(?:\w+\W{1,3}){0,2}$"),
    "card": re.compile(r"(?i)(card|visa|mastercard|amex|credit|debit|payment|karte|carte|tarjeta)\W{0,4}(?:\w+\W{1,3}){0,2}$"),
    "phone": re.compile(r"(?i)(phone|tel|call|mobile|cell|fax|dial|whatsapp|sms|telefon|t[eé]l[eé]phone|tel[eé]fono)\W{0,4}(?:\w+\W{1,3}){0,2}$"),
}
OTHER = re.compile(r"(?i)(version|isbn|issn|doi|order|invoice|page|section|figure|serial|item|ref|\bid\b|\bno|nr|[$€£%#])\W{0,4}$")
DATE = re.compile(r"^\(?(?:(?:19|20)[0-9]{2}[./-][0-9]{1,2}[./-][0-9]{1,2}|[0-9]{1,2}[./-][0-9]{1,2}[./-](?:19|20)[0-9]{2})")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def _digits(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def emails(text: str) -> list[tuple[int, int]]:
    """Leftmost matches: the longest local part before an @ that the match before has left, then the longest domain."""
    out, end, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in LOCAL:
            start -= 1
        m = DOMAIN.match(text, at + 1) if start < at else None
        if m:
            out.append((start, m.end()))
            end = m.end()
        at = text.find("@", max(at + 1, end))
    return out


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of the base patterns, ordered."""
    out = [(a, 0, b) for a, b in emails(text)] if "@" in text else []
    if DIGIT.search(text):
        out += [(m.start(), 1, m.end()) for m in IP.finditer(text) if all(len(p.lstrip("0")) <= 3 and int(p[-4:]) <= 255 for p in m[0].split("."))]
        for m in CARD.finditer(text):
            if m.end() - m.start() >= 14 and 14 <= len(d := _digits(m[0])) <= 19 and luhn(d):
                out.append((m.start(), 2, m.end()))
        if "+" in text:
            out += [(m.start(), 3, m.end()) for m in PHONE.finditer(text) if 10 <= len(_digits(m[0])) <= 15]
    return sorted(out)


def wider(text: str) -> list[tuple[int, int, int]]:
    """Candidates beyond the base patterns."""
    out = []
    for m in AT.finditer(text):
        before, after = SPELLED_LOCAL.search(text, max(0, m.start() - 65), m.start()), SPELLED_DOMAIN.match(text, m.end())
        if before and after:
            out.append((before.start(), 0, after.end()))
    if DIGIT.search(text):
        for m in NUMBER.finditer(text):
            own, n = m[0], len(_digits(m[0]))
            if DATE.search(own):
                continue
            groups = re.split(r"[^0-9]+", own.strip("() "))
            if len(groups) == 4 and all(len(g) <= 3 for g in groups) and n <= 12 and "." in own:
                out.append((m.start(), 1, m.end()))
            elif 13 <= n <= 19:
                out.append((m.start(), 2, m.end()))
            elif 9 <= n <= 12:
                out.append((m.start(), 3, m.end()))
    return out


def label(text: str, start: int, end: int, kind: int, base: bool) -> list[int]:
    """Votes of the labelers: 1 for, 0 against, -1 abstains."""
    own, before, after = text[start:end], text[max(0, start - 40) : start], text[end : end + 2]
    digits = _digits(own)
    if kind == 0:
        tail = re.split(r"[^A-Za-z0-9-]+", re.sub(r"(?i)[({\[\x20]dot[)}\]\x20]", ".", own))[-1].lower()
        check, known = int(len(tail) >= 2 and not tail.isdigit()), int(tail in TOP_LEVEL or len(tail) == 2)
    elif kind == 1:
        parts = [int(p) for p in re.findall("[0-9]+", own)]
        check, known = int(len(parts) == 4 and max(parts) <= 255), int(bool(parts) and 1 <= parts[0] <= 223)
    elif kind == 2:
        check, known = int(luhn(digits)), int(digits[:1] in ("3", "4", "5", "6"))
    else:
        check, known = int(10 <= len(digits) <= 15), int(own[0] in "+(" and digits.startswith(CALLING) or own[0] == "(") or -1
    context = 1 if ANNOUNCE[KINDS[kind]].search(before) else 0 if OTHER.search(before) else -1
    odd = kind != 0 and (DATE.search(own) or before[-1:].isalnum() or before[-1:] in ("-", ".", "/") or after[:1] in ("-", "/") or "/" in own)
    shape = 0 if odd else 1 if base or len(set(re.findall(r"[^0-9A-Za-z]", own))) <= 3 else -1
    return [1 if base else 0 if odd else -1, check, known, context, shape]


def measures(text: str, start: int, end: int) -> list[float]:
    own = text[start:end]
    return [len(_digits(own)) / 20, (end - start) / 40, sum(not c.isalnum() for c in own) / 10, float(own[:1] in "+(")]


def _find(batches):
    for batch in batches:
        rows = []
        for t in texts_of(batch.column(1)):
            text = t.as_py()
            base = base_spans(text)
            taken = {(k, a, b) for a, k, b in base}
            more = [(a, k, b) for a, k, b in wider(text) if not any(a < y and x < b for x, j, y in base if j == k)]
            found = [{"kind": k, "start": a, "end": b, "base": (k, a, b) in taken, "votes": label(text, a, b, k, (k, a, b) in taken), "x": measures(text, a, b)} for a, k, b in [*base, *more]]
            rows.append(found)
        kind = pa.struct([("kind", pa.int32()), ("start", pa.int64()), ("end", pa.int64()), ("base", pa.bool_()), ("votes", pa.list_(pa.int32())), ("x", pa.list_(pa.float64()))])
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, pa.list_(kind))], names=["id", "found"])


def reliabilities(patterns: np.ndarray, counts: np.ndarray, rounds: int = 50) -> tuple[float, np.ndarray]:
    """(share of true candidates, [labeler, truth] probability of being right) by EM over vote patterns."""
    share, right = 0.5, np.full((patterns.shape[1], 2), 0.8)
    for _ in range(rounds):
        p = posteriors(patterns, share, right)
        new = np.empty_like(right)
        for j in range(patterns.shape[1]):
            for truth, w in ((0, counts * (1 - p)), (1, counts * p)):
                cast = patterns[:, j] >= 0
                new[j, truth] = ((w * (patterns[:, j] == truth))[cast].sum() + 0.8) / (w[cast].sum() + 1)
        new = np.clip(new, 0.55, 0.98)  # labelers beat chance, which keeps the classes from swapping
        old, right, share = right, new, float(np.clip((counts * p).sum() / max(counts.sum(), 1), 0.02, 0.98))
        if np.abs(old - right).max() < 1e-4:
            break
    return share, right


def posteriors(patterns: np.ndarray, share: float, right: np.ndarray) -> np.ndarray:
    yes = np.where(patterns == 1, np.log(right[:, 1]), np.where(patterns == 0, np.log(1 - right[:, 1]), 0)).sum(1) + np.log(share)
    no = np.where(patterns == 0, np.log(right[:, 0]), np.where(patterns == 1, np.log(1 - right[:, 0]), 0)).sum(1) + np.log(1 - share)
    return 1 / (1 + np.exp(np.clip(no - yes, -50, 50)))


def design(kinds: np.ndarray, votes: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Inputs of the span classifier."""
    own = np.concatenate([votes == 1, votes == 0], axis=1).astype(float)
    by_kind = np.eye(len(KINDS))[kinds]
    return np.concatenate([by_kind, own, x, (by_kind[:, :, None] * own[:, None, :]).reshape(len(kinds), -1)], axis=1)


def fit_logistic(x: np.ndarray, y: np.ndarray, rounds: int = 400, penalty: float = 1e-3) -> np.ndarray:
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        w -= 0.5 * (x.T @ (p - y) / max(len(y), 1) + penalty * w)
    return w


def find_pii(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: float = 0.8, max_train: int = 20_000) -> DataFrame:
    """(id, spans): every span as (kind, start, end, base, probability), ordered by start, then by kind as listed."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    id_kind = rows.schema["id"].dataType.simpleString()
    found = stored(rows.mapInArrow(_find, f"id {id_kind}, found array<struct<kind:int,start:long,end:long,base:boolean,votes:array<int>,x:array<double>>>"), "pii-found")
    each = found.select("id", F.explode("found").alias("c")).select("id", "c.*")
    counted = each.groupBy("kind", "votes").agg(F.count(F.lit(1)).alias("n")).collect()
    truth: dict[int, tuple[float, np.ndarray]] = {}
    for k in range(len(KINDS)):
        own = sorted((tuple(r["votes"]), r["n"]) for r in counted if r["kind"] == k)
        if own:
            truth[k] = reliabilities(np.array([v for v, _ in own]), np.array([n for _, n in own], float))
    sample = each.select("kind", "votes", "x").orderBy(F.xxhash64("id", "start", "kind")).limit(max_train).collect()
    weights = None
    if sample:
        kinds, votes = np.array([r["kind"] for r in sample]), np.array([r["votes"] for r in sample])
        y = np.zeros(len(sample))
        for k in truth:
            y[kinds == k] = posteriors(votes[kinds == k], *truth[k])
        weights = fit_logistic(design(kinds, votes, np.array([r["x"] for r in sample])), y)

    def judge(batches):
        for batch in batches:
            lists = batch.column(1)
            flat = [c for own in lists.to_pylist() for c in own]
            p = np.zeros(len(flat))
            if flat and weights is not None:
                z = design(np.array([c["kind"] for c in flat]), np.array([c["votes"] for c in flat]), np.array([c["x"] for c in flat])) @ weights
                p = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
            out, at = [], 0
            for n in lists.value_lengths().to_pylist():
                own = [(c["start"], c["kind"], c["end"], c["base"], float(q)) for c, q in zip(flat[at : at + n], p[at : at + n], strict=True) if c["base"] or q >= least]
                at += n
                out.append([{"kind": KINDS[k], "start": a, "end": b, "base": base, "probability": q} for a, k, b, base, q in sorted(own)])
            spans = pa.array(out, pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("base", pa.bool_()), ("probability", pa.float64())])))
            yield pa.RecordBatch.from_arrays([batch.column(0), spans], names=["id", "spans"])

    out = found.mapInArrow(judge, f"id {id_kind}, spans array<struct<kind:string,start:long,end:long,base:boolean,probability:double>>")
    return out.withColumnRenamed("id", id_col)


def digest(spans) -> str:
    """Lower-case SHA-256 of ``kind:start:end`` joined by commas."""
    return hashlib.sha256(",".join(f"{k}:{a}:{b}" for k, a, b in spans).encode()).hexdigest()
