"""Toxic-span tagging by a linear-chain conditional random field.

Documents carry labels, the field needs labelled tokens: a token of a document marked toxic is
tagged when its word, or a prefix of it, is far commoner among toxic than among clean documents of the
training sample; every other token is tagged clean.  The field has two states, emission weights
on hashed features of the word and of its neighbours, and a transition table; it is trained in numpy by
forward-backward gradients.  At inference each document's marginals give offending spans (code point
offsets) and, through a small logistic model on their largest value and expected count, a score.
Gradients are expected less seen counts: marginals of tokens for emissions, of neighbouring pairs for transitions, of first
tokens for the start weights.

Scale: inference is one pass without a shuffle; Arrow encodes each batch into distinct words, so features
are made once a word, and the recursions run over many documents at a time.  Training reads a sample
bounded by ``max_toxic`` + ``max_clean`` documents, ``max_tokens`` tokens and, for the field, ``max_pieces`` pieces of 64 tokens
(documented bounds; a text that alone exceeds what is left of the tokens is not learnt from); the model is three arrays of
``2 ** HASH_BITS`` floats.

Defined results: null and empty texts have no tokens; their score is that of a document without any
toxic token, with no span.  Whole texts are read whatever their length.  Repeated rows are scored
alike.  An empty table gives no rows; without both labels in the sample, the score is 0.  A label given twice counts as toxic if one
says so.  A score of exactly one half is predicted toxic.  Only ids, texts and labels are read, so other columns may have any name.
"""

from __future__ import annotations

import re
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corvidex.llm._spark import fold_of, give_back_memory
from corvidex.llm._words import ranges, slices, texts_of, word_table

HASH_BITS = 18
WORD = re.compile(r"[^\x20\t-\r]+")
PUNCTUATION = ".,;:!?\"'()[]{}<>*#$%&|-_/\\"
KINDS = ("w", "p3", "p4", "p5", "s3", "len")
MARK = 0.5


@dataclass
class Field:
    """Trained weights: ``own``, ``before`` and ``after`` by hashed feature, transitions in log space, document model."""

    own: np.ndarray
    before: np.ndarray
    after: np.ndarray
    step: np.ndarray  # [from, to] log weights
    start: np.ndarray
    document: np.ndarray  # bias, weight of the largest marginal's logit, weight of log(1 + expected count)


def _hash(kind: str, value: str) -> int:
    return zlib.crc32(f"{kind}\x00{value}".encode("utf-8", "surrogatepass")) & ((1 << HASH_BITS) - 1)


def plain(word: str) -> str:
    return word.lower().strip(PUNCTUATION)


def features(word: str) -> list[int]:
    """Hashed features of a word: itself, prefixes, a suffix and its length class."""
    w = plain(word)
    return [_hash("w", w), _hash("p3", w[:3]), _hash("p4", w[:4]), _hash("p5", w[:5]), _hash("s3", w[-3:]), _hash("len", str(min(len(w), 12)))]


def feature_table(words: list[str]) -> np.ndarray:
    return np.fromiter((h for w in words for h in features(w)), np.int32, len(words) * len(KINDS)).reshape(-1, len(KINDS))


def marginals(emit: np.ndarray, lengths: np.ndarray, step: np.ndarray, start: np.ndarray) -> np.ndarray:
    """P(state 1) of each token; ``emit`` holds the state-1 logits of all sequences one after another."""
    return expectations(emit, lengths, step, start)[0]


def expectations(emit: np.ndarray, lengths: np.ndarray, step: np.ndarray, start: np.ndarray, pairs: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """(P(state 1) of each token, expected [from, to] counts of neighbouring states if asked for).

    Sequences of similar length are padded together; both recursions run in probability space, scaled at each step.
    """
    out, counts = np.zeros(len(emit)), np.zeros((2, 2))
    begins = np.cumsum(lengths) - lengths
    order = np.argsort(lengths, kind="stable")
    order = order[lengths[order] > 0]
    t = np.exp(step)
    s = np.exp(start)
    at = 0
    while at < len(order):
        n0 = lengths[order[at]]
        to = max(at + 1, int(np.searchsorted(lengths[order], n0 * 1.5 + 8)))
        # at most about a million padded cells at a time
        to = min(to, at + max(1, int(1_000_000 // max(1, lengths[order[min(to, len(order)) - 1]]))))
        rows = order[at:to]
        at = to
        n, own = int(lengths[rows].max()), lengths[rows]
        grid = np.zeros((n, len(rows)))
        col = np.repeat(np.arange(len(rows)), own)
        pos = ranges(np.zeros(len(rows), np.int64), own)
        source = ranges(begins[rows], own)
        grid[pos, col] = np.clip(emit[source], -30, 30)
        e1 = 1 / (1 + np.exp(-grid))
        e0 = 1 - e1
        a = np.empty((n, len(rows)))
        x0, x1 = s[0] * e0[0], s[1] * e1[0]
        z = x0 + x1
        a[0] = p1 = x1 / z
        for i in range(1, n):
            p0 = 1 - p1
            x0 = (p0 * t[0, 0] + p1 * t[1, 0]) * e0[i]
            x1 = (p0 * t[0, 1] + p1 * t[1, 1]) * e1[i]
            a[i] = p1 = x1 / (x0 + x1)
        b1 = np.full(len(rows), 0.5)
        inside = np.arange(n)[:, None] < own[None, :]
        m = np.empty((n, len(rows)))
        for i in range(n - 1, -1, -1):
            q1 = a[i] * b1
            m[i] = q1 / (q1 + (1 - a[i]) * (1 - b1))
            y0, y1 = e0[i] * (1 - b1), e1[i] * b1
            if pairs and i:
                # what the tokens before say, the transition, and what this token and those after say
                both = [[(1 - a[i - 1]) * t[0, 0] * y0, (1 - a[i - 1]) * t[0, 1] * y1], [a[i - 1] * t[1, 0] * y0, a[i - 1] * t[1, 1] * y1]]
                total = both[0][0] + both[0][1] + both[1][0] + both[1][1]
                counts += [[float((p / total)[inside[i]].sum()) for p in row] for row in both]
            x0 = t[0, 0] * y0 + t[0, 1] * y1
            x1 = t[1, 0] * y0 + t[1, 1] * y1
            b1 = np.where(inside[i], x1 / (x0 + x1), 0.5)
        out[source] = m[pos, col]
    return out, counts


def _token_labels(codes: np.ndarray, offsets: np.ndarray, stems: list[str], toxic: np.ndarray) -> np.ndarray:
    """1 for tokens of toxic documents whose word, or prefix of 4 or 5 letters, marks toxic documents.

    A mark is over twenty times commoner among toxic than among clean documents and stands in several places; copies
    repeat a word in the same place, so places count by their neighbours.
    """
    codes = codes.astype(np.int32)
    owner = np.repeat(np.arange(len(offsets) - 1, dtype=np.int32), np.diff(offsets))
    bad = toxic[owner] == 1
    n1, n0 = max(1, int(toxic.sum())), max(1, int((1 - toxic).sum()))
    least = max(3, 0.004 * n1)
    marked, lengths = [], np.array([len(w) for w in stems])
    rare = np.zeros(0, bool)
    for n in (None, 4, 5):
        names: dict[str, int] = {}
        key = np.array([names.setdefault(w[:n], len(names)) for w in stems], dtype=np.int32)[codes]
        pairs = np.unique(owner * np.int64(len(names)) + key)
        doc, own = pairs // len(names), pairs % len(names)
        del pairs
        d = np.bincount(own[toxic[doc] == 1], minlength=len(names))
        c = np.bincount(own[toxic[doc] == 0], minlength=len(names))
        telling = (d >= least) & ((d + 0.1) / n1 > 20 * (c + 0.1) / n0)
        if n is None:
            rare = (c == 0)[key]
        at = np.flatnonzero(telling[key] & bad)
        with np.errstate(over="ignore"):
            spots = (key[at] * np.int64(len(stems)) + codes[at - 1]) * np.int64(0x9E3779B97F4A7C1) + codes[(at + 1) % len(codes)]
        first = np.unique(spots, return_index=True)[1]
        marked.append((np.bincount(key[at[first]], minlength=len(names)) >= least)[key])
    word, four, five = marked
    n = lengths[codes]
    return (bad & (n > 0) & (word | rare & ((n > 4) & four | (n > 5) & five))).astype(float)


def _emissions(model: Field, codes: np.ndarray, words: list[str], offsets: np.ndarray) -> np.ndarray:
    if not len(codes):
        return np.zeros(0)
    return _emissions_from((model.own, model.before, model.after), feature_table(words), codes, offsets)


def _emissions_from(weights, table: np.ndarray, codes: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """State-1 logits: a token's own features, and those of its neighbours within its sequence."""
    own, before, after = (w[table].sum(1)[codes] for w in weights)
    first = np.zeros(len(codes), bool)
    first[offsets[:-1][offsets[:-1] < offsets[1:]]] = True
    last = np.roll(first, -1)
    return own + np.where(first, 0, np.roll(before, 1)) + np.where(last, 0, np.roll(after, -1))


def train_field(texts: list[str], toxic: list[int], epochs: int = 6, piece: int = 64, max_pieces: int = 12_000, seed: int = 7) -> Field:
    """Fit the field and the document model on labelled documents."""
    size = 1 << HASH_BITS
    y_doc = np.array(toxic, dtype=np.int64)
    model = Field(*(np.zeros(size) for _ in range(3)), np.zeros((2, 2)), np.zeros(2), np.array([-50.0, 0, 0]))
    if len(set(toxic)) < 2:
        return model
    offsets, codes, words = word_table(pa.array(texts, pa.large_string()))
    stems = [plain(w) for w in words]
    split = [codes[a:b] for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
    tagged = _token_labels(codes, offsets, stems, y_doc)
    labels = [tagged[a:b] for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
    rng = np.random.default_rng(seed)
    pieces = [(d, a) for d, own in enumerate(split) for a in range(0, len(own), piece)]
    hot = [p for p in pieces if labels[p[0]][p[1] : p[1] + piece].any()]
    cold = [p for p in pieces if not labels[p[0]][p[1] : p[1] + piece].any()]
    rng.shuffle(hot), rng.shuffle(cold)
    chosen = hot[: max_pieces // 2] + cold[: max_pieces // 2]
    table = feature_table(words)
    sums = [np.full(size, 1e-6) for _ in range(3)]
    step_sum, start_sum = np.full((2, 2), 1e-6), np.full(2, 1e-6)
    weights = [model.own, model.before, model.after]
    for _ in range(epochs):
        rng.shuffle(chosen)
        for at in range(0, len(chosen), 256):
            batch = chosen[at : at + 256]
            seqs = [split[d][a : a + piece] for d, a in batch]
            y = np.concatenate([labels[d][a : a + piece] for d, a in batch])
            lengths = np.array([len(s) for s in seqs])
            own = np.concatenate(seqs)
            edge = np.concatenate([[0], np.cumsum(lengths)])
            m, expected = expectations(_emissions_from(weights, table, own, edge), lengths, model.step, model.start, pairs=True)
            g = m - y
            first = np.zeros(len(own), bool)
            first[edge[:-1]] = True
            last = np.roll(first, -1)
            # the neighbours' features enter a token's logit, so their gradient is the token's
            for k, grad, mask in ((0, g, None), (1, np.roll(g, -1), last), (2, np.roll(g, 1), first)):
                grad = grad if mask is None else np.where(mask, 0, grad)
                total = np.bincount(table[own].ravel(), np.repeat(grad, len(KINDS)), minlength=size)
                total += 1e-5 * weights[k]
                sums[k] += total**2
                weights[k] -= 0.3 * total / np.sqrt(sums[k]) * (total != 0)
            py, inner = np.stack([1 - y, y]), ~first[1:]
            grad = expected - py[:, :-1][:, inner] @ py[:, 1:][:, inner].T
            step_sum += grad**2
            model.step = np.clip(model.step - 0.05 * grad / np.sqrt(step_sum), -2, 2)
            grad = np.array([-1.0, 1.0]) * float(g[first].sum())
            start_sum += grad**2
            model.start = np.clip(model.start - 0.05 * grad / np.sqrt(start_sum), -2, 2)
    parts = []
    for lo in range(0, len(texts), 500):
        edge = offsets[lo : lo + 501] - offsets[lo]
        emit = _emissions_from(weights, table, codes[offsets[lo] : offsets[lo] + edge[-1]], edge)
        parts.append(document_features(marginals(emit, np.diff(edge), model.step, model.start), edge))
    seen = np.concatenate(parts)
    x = np.concatenate([np.ones((len(seen), 1)), seen], axis=1)
    w = np.array([-1.0, 0.5, 0.5])
    balance = np.where(y_doc == 1, 1.0, y_doc.sum() / max(1, (1 - y_doc).sum()))
    for _ in range(800):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -40, 40)))
        w -= 0.5 * ((p - y_doc) * balance) @ x / balance.sum()
    model.document = w
    return model


def document_features(m: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Largest marginal as a logit within +-6, and log(1 + expected number of toxic tokens counted above 0.1)."""
    n = len(offsets) - 1
    out = np.zeros((n, 2))
    filled = np.flatnonzero(np.diff(offsets) > 0)
    out[:, 0] = -6
    if len(filled):
        top = np.clip(np.maximum.reduceat(m, offsets[filled]), 1e-6, 1 - 1e-6)
        out[filled, 0] = np.clip(np.log(top / (1 - top)), -6, 6)
        out[filled, 1] = np.log1p(np.add.reduceat(np.where(m > 0.1, m, 0), offsets[filled]))
    return out


def tag(model: Field, texts: pa.Array) -> tuple[np.ndarray, list[list[tuple[int, int]]]]:
    """Scores of the texts and their offending (start, end) spans in code points."""
    offsets, codes, words = word_table(texts)
    m = marginals(_emissions(model, codes, words, offsets), np.diff(offsets), model.step, model.start)
    w = model.document
    score = 1 / (1 + np.exp(-np.clip(w[0] + document_features(m, offsets) @ w[1:], -40, 40)))
    spans: list[list[tuple[int, int]]] = [[] for _ in range(len(texts))]
    marked = np.flatnonzero(m >= MARK)
    rows, firsts = np.unique(np.searchsorted(offsets, marked, side="right") - 1, return_index=True)
    for i, own in zip(rows.tolist(), np.split(marked, firsts[1:]), strict=False):
        mine = set((own - offsets[i]).tolist())
        before = -2
        for k, found in enumerate(WORD.finditer(texts[i].as_py())):
            if k in mine:
                if k == before + 1:
                    spans[i][-1] = (spans[i][-1][0], found.end())
                else:
                    spans[i].append(found.span())
                before = k
    return score, spans


def train_toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", max_toxic: int = 2000, max_clean: int = 4000, max_tokens: int = 3_000_000) -> Field:
    """Train on labelled rows outside fold 0: at most ``max_toxic`` and ``max_clean`` of them, in order of a hash of the id."""
    own = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("y")).where(F.col("id").isNotNull() & F.col("y").isin(0, 1) & (fold_of(F.col("id")) != 0))
    own = own.groupBy("id").agg(F.max("y").alias("y"))
    one = own.where("y = 1").orderBy(F.xxhash64("id"), "id").limit(max_toxic)
    zero = own.where("y = 0").orderBy(F.xxhash64("id"), "id").limit(max_clean)
    chosen = F.broadcast(one.union(zero))  # at most max_toxic + max_clean rows of two numbers
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).where(F.col("text").isNotNull() & (fold_of(F.col("id")) != 0)).join(chosen, "id")
    held, texts, ys = 0, [], []
    rows = rows.where(F.length("text") <= 6 * max_tokens)
    for r in rows.select("id", "text", "y").orderBy(F.xxhash64("id", F.lit(1)), "id", "text").limit(max_toxic + max_clean).toLocalIterator():
        if held + len(r["text"]) // 6 > max_tokens:
            continue
        held += len(r["text"]) // 6
        texts.append(r["text"])
        ys.append(r["y"])
    model = train_field(texts, ys)
    del texts, ys
    give_back_memory()
    return model


def score_toxicity(docs: DataFrame, model: Field, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, score, predicted, spans) of every document."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def work(batches):
        for batch in batches:
            texts = texts_of(batch.column(1))
            for a, b in slices(texts):
                score, spans = tag(shared.value, texts.slice(a, b - a))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), pa.array(score, pa.float64()), pa.array((score >= 0.5).astype(np.int32)), pa.array([[{"start": x, "end": y} for x, y in s] for s in spans], pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))],
                    names=["id", "score", "predicted", "spans"],
                )

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(work, f"id {kind}, score double, predicted int, spans array<struct<start:long,end:long>>").withColumnRenamed("id", id_col)
