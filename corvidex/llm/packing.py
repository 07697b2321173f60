"""Packing of tokenised documents into sequences by bounded-space online best-fit.

Documents arrive in table order.  A fixed number of bins is open in a task; a bitset with one bit per
amount of free space finds the open bin that a piece fills best.  If none has room and all bins are open,
the fullest closes.  Documents longer than a sequence are cut; every other document stays whole.

Each task packs what it reads.  The bins still open at its end are items of the next round: rounds of
best-fit over groups of tasks join them into full sequences, until one group is left.  A bin that closes in a
round is done and leaves; only the bounded number still open go on.  Only the bins
(two numbers each) move; the documents' own rows are joined with the bins' places at the end.

Scale: one pass over the texts, no shuffle of texts or ids; each batch is split by Arrow, so that the
tokenizer sees a distinct word once, many at a time; a bounded table keeps words between batches, and ids are gathered in numpy.
Open bins are ``open_bins`` a task.

Defined results: a null or empty text is the closing id alone.  Texts of any length are tokenised whole.
Repeated rows are packed once each.  Of bins with equal space the one filled last takes a piece.  An empty table
gives no rows.  Only the id and the text are read, so other columns may have any name.
"""

from __future__ import annotations

import os
import zlib
from functools import reduce
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corvidex.llm._spark import give_back_memory, stored
from corvidex.llm._words import ranges, slices, texts_of, word_table

FAN_IN = 64
#: Bytes of text whose words a worker holds at a time.
SLICE = 3 << 20
#: Words whose ids a worker keeps.
MOST_WORDS = 250_000
#: Words whose ids are gathered at a time.
GATHER = 1 << 18
_loaded: dict = {}


def tokenizer(path: str):
    """The tokenizer of a file, loaded once a worker and kept to one thread."""
    if path not in _loaded:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        _loaded[path] = Tokenizer.from_file(path)
        give_back_memory()  # what reading the file took
    return _loaded[path]


#: Punctuation that ends a word; a run of it after a letter is a token group of its own.
PUNCTUATION = "!\"#$%&'()*+,-./:;=>?@[\\]^_`{|}~"


def parts(words: list[str]) -> tuple[list[str], list[str]]:
    """A form of each word and the punctuation after it, which together have the word's ids.

    The tokenizer composes, lower-cases character by character and cuts between letters and other characters.  So
    punctuation comes off words that are letters alone *after* lower-casing, and only those and ASCII words are
    lower-cased here.  Words with a capital sigma (whose lower case depends on its place in Python) or a ``<``
    (special tokens) stay as they are.
    """
    heads, marks = [], []
    for word in words:
        head = word.rstrip(PUNCTUATION)
        low = head.lower()
        if low.isalpha() and "\u03a3" not in head and "<" not in word:
            heads.append(low)
            marks.append(word[len(head) :])
        else:
            heads.append(word.lower() if word.isascii() and "<" not in word else word)
            marks.append("")
    return heads, marks


class WordIds:
    """Ids of the words met so far; before it would hold over ``most`` words it forgets those met in one slice only.

    Word i has the ids ``flat[starts[i]:starts[i + 1]]``; the arrays double as they fill.
    """

    def __init__(self, path: str, most: int = MOST_WORDS, chunk: int = 4096):
        self.encoder, self.most, self.chunk = tokenizer(path), most, chunk
        size = self.encoder.get_vocab_size()
        self.ends = np.fromiter((self.encoder.id_to_token(i).endswith("</w>") for i in range(size)), bool, size)
        self.clear()

    def clear(self) -> None:
        self.at: dict[str, int] = {"": 0}
        self.flat, self.starts, self.met = np.zeros(1 << 16, np.uint32), np.zeros(1 << 14, np.int64), np.zeros(1 << 14, np.uint8)
        self.filled, self.words = 0, 1

    def _forget(self) -> None:
        again = np.flatnonzero(self.met[: self.words] > 1)
        again = again[again > 0]
        if 2 * len(again) > self.most:
            return self.clear()
        names = list(self.at)  # in order of their numbers
        words = [names[i] for i in again.tolist()]
        begins, sizes = self.starts[again], self.starts[again + 1] - self.starts[again]
        ids = self.flat[ranges(begins, sizes)]
        self.clear()
        self._keep(words, ids, sizes)
        self.met[: self.words] = 2

    def _keep(self, words: list[str], ids: np.ndarray, sizes: np.ndarray) -> None:
        self.flat = _grown(self.flat, self.filled + len(ids))
        self.starts = _grown(self.starts, self.words + len(words) + 1)
        self.met = _grown(self.met, self.words + len(words))
        self.flat[self.filled : self.filled + len(ids)] = ids
        self.starts[self.words + 1 : self.words + 1 + len(words)] = self.filled + np.cumsum(sizes)
        self.met[self.words : self.words + len(words)] = 0
        self.at.update(zip(words, range(self.words, self.words + len(words)), strict=True))
        self.filled += len(ids)
        self.words += len(words)

    def _learn(self, words: list[str]) -> None:
        letters, rest = [], []
        for w in words:
            (letters if w.isalpha() else rest).append(w)
        for lo in range(0, len(letters), self.chunk):
            own = letters[lo : lo + self.chunk]
            ids = np.array(self.encoder.encode_batch_fast([" ".join(own)], add_special_tokens=False)[0].ids, np.uint32)
            last = np.flatnonzero(self.ends[ids])
            if len(last) == len(own):  # every word ended once, so each is what lies between two ends
                self._keep(own, ids, np.diff(last, prepend=-1))
            else:
                rest += own
        for lo in range(0, len(rest), self.chunk):
            own = rest[lo : lo + self.chunk]
            found = [e.ids for e in self.encoder.encode_batch_fast(own, add_special_tokens=False)]
            sizes = np.fromiter(map(len, found), np.int64, len(own))
            self._keep(own, np.fromiter(chain.from_iterable(found), np.uint32, int(sizes.sum())), sizes)

    def rows(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Two places in ``starts`` a word: what it is read as and the punctuation after it."""
        heads, marks = parts(words)
        if len(self.at) + len(words) > self.most:
            self._forget()
        known = self.at
        self._learn([w for w in dict.fromkeys(chain(heads, set(marks))) if w not in known])
        first, second = (np.fromiter(map(known.__getitem__, own), np.int64, len(words)) for own in (heads, marks))
        for own in (first, second):
            own_words = np.unique(own)
            self.met[own_words] = np.minimum(self.met[own_words], 250) + 1
        return first, second


def _grown(held: np.ndarray, size: int) -> np.ndarray:
    """``held`` with room for ``size`` entries at least; what is not filled yet is undefined."""
    if size <= len(held):
        return held
    out = np.empty(max(size, 2 * len(held)), held.dtype)
    out[: len(held)] = held
    return out


_words: dict[str, WordIds] = {}


def encoded(path: str, texts: pa.Array, most_words: int = MOST_WORDS):
    """Yields (first text, ids of the texts from it on, ids in each of them): all texts in order, some at a time.

    The tokenizer drops white space and never joins over it, so words can be encoded one by one.
    """
    offsets, codes, words = word_table(texts)
    if path not in _words:
        _words[path] = WordIds(path, most_words)
    held = _words[path]
    # the distinct words' ids first, then gathers of them
    two = np.stack(held.rows(words), axis=1).ravel()
    del words
    begins = held.starts[two]
    sizes = held.starts[two + 1] - begins
    own = held.flat[ranges(begins, sizes)]
    sizes = sizes.reshape(-1, 2).sum(1)
    starts = np.cumsum(sizes) - sizes
    first = 0
    while first < len(texts):
        stop = max(first + 1, int(np.searchsorted(offsets, offsets[first] + GATHER, side="right")) - 1)
        mine = codes[offsets[first] : offsets[stop]]
        counts = sizes[mine]
        ends = np.concatenate([[0], np.cumsum(counts)])
        edges = offsets[first : stop + 1] - offsets[first]
        yield first, own[ranges(starts[mine], counts)], ends[edges[1:]] - ends[edges[:-1]]
        first = stop


def encode_all(path: str, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(ids of all texts one after another, ids in each text)."""
    found = list(encoded(path, texts))
    return np.concatenate([np.zeros(0, np.uint32), *[f[1] for f in found]]), np.concatenate([np.zeros(0, np.int64), *[f[2] for f in found]])


class OpenBins:
    """Open bins by free space: ``put`` gives the bin and offset of a piece."""

    def __init__(self, capacity: int, most: int, first: int = 0):
        self.capacity, self.most, self.next = capacity, most, first
        self.bits, self.count = 0, 0
        self.by_space: dict[int, list[int]] = {}

    def _take(self, space: int) -> int:
        own = self.by_space[space]
        found = own.pop()
        if not own:
            self.bits &= ~(1 << space)
        self.count -= 1
        return found

    def put(self, size: int) -> tuple[int, int]:
        if size == self.capacity:  # a full piece is a sequence of its own and takes no bin
            name = self.next
            self.next += 1
            return name, 0
        fitting = self.bits >> size
        if fitting:
            space = size + ((fitting & -fitting).bit_length() - 1)
            name = self._take(space)
        else:
            if self.count >= self.most:  # the fullest closes
                self._take((self.bits & -self.bits).bit_length() - 1)
            name, space = self.next, self.capacity
            self.next += 1
        left = space - size
        if left:
            self.by_space.setdefault(left, []).append(name)
            self.bits |= 1 << left
            self.count += 1
        return name, self.capacity - space

    def rest(self) -> list[tuple[int, int]]:
        """(bin, tokens held) of the bins still open."""
        return [(name, self.capacity - space) for space, own in sorted(self.by_space.items()) for name in own]


def _pieces(path: str, capacity: int, open_bins: int, close: int, with_ids: bool, keep_words: bool = True, slice_bytes: int = SLICE, most_words: int = MOST_WORDS):
    def work(batches):
        task = TaskContext.get().partitionId() << 40
        bins = OpenBins(capacity, open_bins, task)
        for batch in batches:
            column = batch.column(1)
            for lo, hi in slices(column, slice_bytes):
                for first, ids, lengths in encoded(path, texts_of(column.slice(lo, hi - lo)), most_words):
                    closed = np.insert(ids, np.cumsum(lengths), close).astype("<u4")
                    rows: list[tuple] = []
                    at = 0
                    for i, n in enumerate((lengths + 1).tolist(), lo + first):
                        own = closed[at : at + n]
                        at += n
                        for piece, start in enumerate(range(0, n, capacity)):
                            cut = own[start : start + capacity]
                            name, offset = bins.put(len(cut))
                            rows.append((i, piece, start, len(cut), zlib.crc32(cut), name, offset, cut if with_ids else None))
                    cols = list(zip(*rows, strict=True))
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0).take(pa.array(cols[0])), pa.array(cols[1], pa.int32()), *[pa.array(c, pa.int64()) for c in cols[2:7]], pa.array(cols[7], pa.list_(pa.int64())), pa.array([False] * len(rows))],
                        names=["id", "piece", "start", "length", "ids_crc32", "bin", "offset", "ids", "open"],
                    )
                give_back_memory()
        if not keep_words:  # the worker lives on, and other stages' workers beside it
            _words.pop(path, None)
            _loaded.pop(path, None)
        give_back_memory()
        left = bins.rest()
        n = len(left)
        none = lambda kind: pa.nulls(n, kind)
        if n:
            yield pa.RecordBatch.from_arrays(
                [none(pa.int64()), none(pa.int32()), none(pa.int64()), pa.array([held for _, held in left], pa.int64()), none(pa.int64()), pa.array([b for b, _ in left], pa.int64()), none(pa.int64()), none(pa.list_(pa.int64())), pa.array([True] * n)],
                names=["id", "piece", "start", "length", "ids_crc32", "bin", "offset", "ids", "open"],
            )

    return work


def _join_bins(capacity: int, open_bins: int):
    def work(pdf):
        import pandas as pd  # only here: the workers that read texts do without it

        pdf = pdf.sort_values(["held", "bin"], ascending=[False, True])
        bins = OpenBins(capacity, open_bins)
        names: dict[int, int] = {}
        rows = []
        for name, held in zip(pdf["bin"].tolist(), pdf["held"].tolist(), strict=True):
            own, offset = bins.put(held)
            rows.append((name, own, names.setdefault(own, name), offset))
        left = {own for own, _ in bins.rest()}
        return pd.DataFrame({"from": [r[0] for r in rows], "to": [r[2] for r in rows], "more": [r[3] for r in rows], "open": [r[1] in left for r in rows]}).astype({"from": "int64", "to": "int64", "more": "int64", "open": bool})

    return work


def pack(docs: DataFrame, tokenizer_path: str, capacity: int = 4096, close: int = 1, open_bins: int = 256, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False, keep_words: bool = True, slice_bytes: int = SLICE, most_words: int = MOST_WORDS) -> DataFrame:
    """(id, piece, start, length, ids_crc32, ids, sequence_id, offset): one row per piece; ``ids`` only if asked for.

    With ``keep_words`` a worker keeps its tokenizer and word table for its next task; without, it gives their memory back.
    ``slice_bytes`` of text are worked on at a time and ids of ``most_words`` words held; less of both takes less memory and more time.
    """
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").alias("text"))
    schema = "id long, piece int, start long, length long, ids_crc32 long, bin long, offset long, ids array<long>, open boolean"
    placed = stored(rows.mapInArrow(_pieces(tokenizer_path, capacity, open_bins, close, with_ids, keep_words, slice_bytes, most_words), schema), "pack-pieces")
    places = join_open_bins(placed.where("open").select("bin", F.col("length").alias("held")), capacity, open_bins)
    out = placed.where("NOT open").join(places, "bin", "left")
    return out.select(F.col("id").alias(id_col), "piece", "start", "length", "ids_crc32", "ids", F.coalesce("into", "bin").alias("sequence_id"), (F.col("offset") + F.coalesce("shift", F.lit(0))).alias("offset"))


def join_open_bins(left: DataFrame, capacity: int, open_bins: int) -> DataFrame:
    """(bin, into, shift): where each of the bins (bin, held) went that tasks left open.

    A round joins the bins of ``FAN_IN`` neighbouring tasks by best-fit.  Bins that close there are done; the at most
    ``4 * open_bins`` that stay open are all that the next round sees of a group, so no group grows with the input.
    """
    going = left.select("bin", F.col("bin").alias("into"), F.lit(0).cast("long").alias("shift"), "held", F.shiftright("bin", 40).alias("task"))
    done, fan = [], 1
    while True:
        fan *= FAN_IN
        held = going.groupBy("into").agg(F.max(F.col("shift") + F.col("held")).alias("held"), F.min("task").alias("task")).withColumnRenamed("into", "bin")
        moved = held.groupBy(F.floor(F.col("task") / fan).alias("g")).applyInPandas(_join_bins(capacity, open_bins * 4), "from long, to long, more long, open boolean")
        step = going.join(moved, going["into"] == moved["from"]).select("bin", F.col("to").alias("into"), (F.col("shift") + F.col("more")).alias("shift"), "held", F.expr(f"task - task % {fan}").alias("task"), "open")
        step = stored(step, "pack-open")
        done.append(step.where("NOT open").select("bin", "into", "shift"))
        going = step.where("open").drop("open")
        if going.agg(F.count_distinct("task")).first()[0] <= 1:
            return reduce(DataFrame.unionByName, [*done, going.select("bin", "into", "shift")])
