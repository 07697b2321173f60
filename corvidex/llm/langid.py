"""Language identification by a byte convolutional network.

A text's UTF-8 bytes are cut into windows of fixed length.  Filters of several widths run over
each window, max pooling keeps the best response of each filter, and a softmax layer turns those into
language probabilities; a document's are the mean over all of its windows, weighted by their bytes.
Because a window is one-hot in its bytes, a filter of width w is w tables of 256 weights, so a
convolution is w table look-ups.  Training runs in numpy with Adam on windows of labelled texts; windows of under 16 bytes
(the ends of texts) say too little and are not learnt from.

Scale: prediction is one pass without a shuffle; a part of a text at a time bounds the memory.  Training reads
at most ``max_docs`` documents a language and ``max_windows`` windows (documented bound), chosen by a hash
of id and text.  The model has a few thousand weights and one output per language, so the languages must be few.

Defined results: a text that is null or has no letter gives ``und`` with score 0, and so does any text
when nothing was learned.  Whole texts are read whatever their length.  Repeated rows get the same answer.
Of equally likely languages the first in order of their names wins.  An empty table gives no rows.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corvidex.llm._spark import fold_of, give_back_memory
from corvidex.llm._words import ranges, slices, texts_of

WINDOW = 128
WIDTHS = (2, 3, 4)
FILTERS = 12
UNKNOWN = "und"
#: Bytes whose windows are held at a time, a multiple of the window.
PART = 1 << 20


@dataclass
class Network:
    """``tables[i]`` is [width, 256, filters]; ``dense`` is [all filters, languages]; ``bias`` of filters and of languages."""

    langs: list[str]
    tables: list[np.ndarray]
    biases: list[np.ndarray]
    dense: np.ndarray
    bias: np.ndarray


def windows(data: bytes | np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(grid of windows padded with zeros, owner of each window, bytes in each window) of texts laid end to end."""
    flat = np.frombuffer(data, np.uint8) if isinstance(data, bytes) else data
    count = -(-lengths // WINDOW)
    owner = np.repeat(np.arange(len(lengths)), count)
    nth = ranges(np.zeros(len(lengths), np.int64), count)
    size = np.minimum(WINDOW, lengths[owner] - nth * WINDOW)
    begin = (np.cumsum(lengths) - lengths)[owner] + nth * WINDOW
    grid = np.zeros((len(owner), WINDOW), np.uint8)
    whole = size == WINDOW
    if whole.any():
        grid[whole] = flat[begin[whole, None] + np.arange(WINDOW)]
    for i in np.flatnonzero(~whole).tolist():
        grid[i, : size[i]] = flat[begin[i] : begin[i] + size[i]]
    return grid, owner, size


def pooled(net: Network, grid: np.ndarray, places: bool = False):
    """Pooled, rectified filter responses of windows, and where each was found if asked for."""
    out, at = [], []
    for table, bias in zip(net.tables, net.biases, strict=True):
        span = WINDOW - len(table) + 1
        acc = table[0].take(grid[:, :span], axis=0)
        for j in range(1, len(table)):
            acc += table[j].take(grid[:, j : j + span], axis=0)
        if places:
            at.append(acc.argmax(1))
        out.append(acc.max(1) + bias)
    x = np.maximum(np.concatenate(out, axis=1), 0)
    return (x, at) if places else x


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


def train_network(texts: list[str], langs: list[str], epochs: int = 4, max_windows: int = 24_000, rate: float = 0.01, seed: int = 11) -> Network:
    """Fit the network on windows of labelled texts."""
    names = sorted(set(langs))
    rng = np.random.default_rng(seed)
    tables = [rng.normal(0, 0.3, (w, 256, FILTERS)).astype(np.float32) for w in WIDTHS]
    net = Network(names, tables, [np.zeros(FILTERS, np.float32) for _ in WIDTHS], rng.normal(0, 0.1, (FILTERS * len(WIDTHS), max(1, len(names)))).astype(np.float32), np.zeros(max(1, len(names)), np.float32))
    if not names:
        return net
    raw = [t.encode("utf-8", "surrogatepass") for t in texts]
    grid, owner, size = windows(b"".join(raw), np.array([len(r) for r in raw]))
    y = np.array([names.index(x) for x in langs])[owner]
    keep = rng.permutation(np.flatnonzero(size >= min(16, WINDOW)))[:max_windows]
    params = [*net.tables, *net.biases, net.dense, net.bias]
    steps = max(1, epochs * -(-len(keep) // 64))
    first, second, t = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params], 0
    for _ in range(epochs):
        rng.shuffle(keep)
        for a in range(0, len(keep), 64):
            rows = keep[a : a + 64]
            own = grid[rows].copy()
            # random cuts make short texts look familiar
            for i in np.flatnonzero(rng.random(len(rows)) < 0.3):
                own[i, rng.integers(12, WINDOW) :] = 0
            x, at = pooled(net, own, places=True)
            p = softmax(x @ net.dense + net.bias)
            p[np.arange(len(rows)), y[rows]] -= 1
            p /= len(rows)
            back = (p @ net.dense.T) * (x > 0)
            grads = []
            for k, table in enumerate(net.tables):
                g, part = np.zeros_like(table), back[:, k * FILTERS : (k + 1) * FILTERS]
                for j in range(len(table)):
                    byte = own[np.arange(len(rows))[:, None], at[k] + j]
                    np.add.at(g[j], (byte, np.arange(FILTERS)[None, :]), part)
                grads.append(g)
            grads += [back[:, k * FILTERS : (k + 1) * FILTERS].sum(0) for k in range(len(WIDTHS))] + [x.T @ p, p.sum(0)]
            t += 1
            for q, g, m, v in zip(params, grads, first, second, strict=True):
                m *= 0.9
                m += 0.1 * g
                v *= 0.999
                v += 0.001 * g * g
                q -= rate * (1 - 0.95 * t / steps) * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    return net


def sample_of(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", max_docs: int = 600) -> DataFrame:
    """(lang, text) of the ``max_docs`` documents of each language with the smallest hashes of id and text, outside fold 0.

    A row counts once however often it is repeated.  The rows that meet are few: those below a cut of the hash that suffices
    for every language, found by raising it, so the cut changes the cost and never the sample.
    """
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"), F.col(f"`{lang_col}`").alias("lang"))
    rows = rows.where(F.col("lang").isNotNull() & F.col("id").isNotNull() & F.col("text").isNotNull() & (fold_of(F.col("id")) != 0)).withColumn("h", F.xxhash64("id", "text"))
    share = {r["lang"]: min(1.0, 4 * max_docs / r["n"]) for r in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    while True:
        below = F.lit(False)
        for lang, part in share.items():
            below = below | ((F.col("lang") == lang) & (F.col("h").cast("double") <= part * 2.0**64 - 2.0**63))
        few = rows.where(below).select("lang", "h").distinct()
        found = {r["lang"]: r["n"] for r in few.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
        short = [lang for lang, part in share.items() if part < 1 and found.get(lang, 0) < max_docs]
        if not short:
            break
        share.update({lang: min(1.0, 16 * share[lang]) for lang in short})
    order = Window.partitionBy("lang").orderBy("h")
    chosen = few.withColumn("n", F.row_number().over(order)).where(F.col("n") <= max_docs).select("lang", "h")
    return rows.where(below).join(F.broadcast(chosen), ["lang", "h"]).groupBy("lang", "h").agg(F.min("text").alias("text")).orderBy("lang", "h").select("lang", "text")


def train_langid(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", max_docs: int = 600) -> Network:
    """Train on at most ``max_docs`` documents a language, outside fold 0, chosen by a hash of the row."""
    got = [(r["text"], r["lang"]) for r in sample_of(docs, id_col, text_col, lang_col, max_docs).toLocalIterator()]
    net = train_network([t for t, _ in got], [x for _, x in got])
    del got
    give_back_memory()
    return net


def _bytes_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes of the texts laid end to end, where each begins and the last ends), without a copy."""
    edges = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    return (np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)), edges


def _runs(lengths: np.ndarray):
    """(first, last) of texts in order that hold ``PART`` bytes together; a longer one is a run of its own."""
    first, held = 0, 0
    for i, n in enumerate(lengths.tolist()):
        if i > first and held + n > PART:
            yield first, i
            first, held = i, 0
        held += n
    if len(lengths) > first:
        yield first, len(lengths)


def predict(net: Network, texts: pa.Array, chunk: int = 2048) -> tuple[list[str], np.ndarray]:
    """Language and probability of each text."""
    n = len(texts)
    lettered = np.asarray(pc.match_substring_regex(texts, r"\p{L}"), dtype=bool)
    if not net.langs or not n:
        return [UNKNOWN] * n, np.zeros(n)
    lengths = np.asarray(pc.binary_length(texts), dtype=np.int64)
    sums = np.zeros((n, len(net.langs)))
    flat, ends = _bytes_of(texts)
    for first, last in _runs(lengths):
        # a run of texts, or a part of a text that is longer than a run
        lows = range(0, int(lengths[first]), PART) if last == first + 1 else (0,)
        for low in lows:
            own = lengths[first:last] if last > first + 1 else np.minimum(lengths[first:last] - low, PART)
            begin = int(ends[first]) + low
            grid, owner, size = windows(flat[begin : begin + int(own.sum())], own)
            for a in range(0, len(grid), chunk):
                p = softmax(pooled(net, grid[a : a + chunk]) @ net.dense + net.bias)
                np.add.at(sums, first + owner[a : a + chunk], p * size[a : a + chunk, None])
    mean = sums / np.maximum(lengths, 1)[:, None]
    best = mean.argmax(1)
    langs = [net.langs[b] if ok else UNKNOWN for b, ok in zip(best.tolist(), lettered.tolist(), strict=True)]
    return langs, np.where(lettered, np.clip(mean[np.arange(n), best], 0, 1), 0.0)


def identify(docs: DataFrame, net: Network, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """(id, the columns ``keep``, lang_pred, score) of every document; what was found replaces kept columns of the same name.

    Only the text goes to Python; the other columns wait in the JVM.
    """
    shared = docs.sparkSession.sparkContext.broadcast(net)

    @F.arrow_udf("struct<lang_pred: string, score: double>")
    def found(column: pa.Array) -> pa.Array:
        langs, scores = [], [np.zeros(0)]
        for a, b in slices(column, 2 << 20):
            own, score = predict(shared.value, texts_of(column.slice(a, b - a)))
            langs += own
            scores.append(score)
        give_back_memory()
        return pa.StructArray.from_arrays([pa.array(langs, pa.string()), pa.array(np.concatenate(scores), pa.float64())], ["lang_pred", "score"])

    own = [id_col, *[c for c in keep if c != id_col and c.lower() not in ("lang_pred", "score")]]
    held = docs.select(F.struct(*[F.col(f"`{c}`") for c in own]).alias("row"), F.col(f"`{text_col}`").alias("text"))
    return held.select("row", found("text").alias("found")).select("row.*", "found.*")
