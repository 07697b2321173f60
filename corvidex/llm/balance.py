"""Packing into sequences of equal cost: linear plus quadratic attention cost, longest documents first.

Attention stays within a document's piece, so a piece of n tokens costs ``n + quadratic * n ** 2``.  Documents are cut
where that fills a sequence: a longer one gives full sequences first.  What remains of each is held until a window of
``window`` tokens is full.  The window opens as many sequences as its tokens fill; documents go in descending order of cost
to the sequence of the lowest cost among those with room for them.  If none has, the cheapest with any room takes what
fits and the rest goes on.  So every sequence of a window is full, and what is left over joins the next window.  The last tokens
of a task, fewer than a sequence, become sequences of falling powers of two, which need no padding.

Scale: one pass over the texts in the tasks that read them, no shuffle.  A task holds the ids of one window and one slice of texts,
and a bounded table of word ids, whatever the size of its input.

Defined results: a null or empty text is the closing id alone; its piece has ``doc_tokens`` 1.  Texts of any length are
tokenised whole.  Repeated rows are packed once each, each as a document of its own.  Documents of equal cost go in table order,
sequences of equal cost are filled in order.  An empty table gives no rows.  Only the id and the text are read, so other columns may have any name.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corvidex.llm._spark import give_back_memory
from corvidex.llm._words import ranges, slices, texts_of
from corvidex.llm.units import ByteLevel, Known, per_text, unit_table

#: Bytes of text whose units a worker holds at a time.
SLICE = 4 << 20
_known: dict[str, tuple[ByteLevel, Known]] = {}


def table_of(path: str) -> tuple[ByteLevel, Known]:
    """The tokenizer of a file and its table of unit ids, kept by the worker."""
    if path not in _known:
        encoder = ByteLevel(path)

        def learn(units: list[str]):
            return [encoder.encode(units)], [None] * len(units)

        _known[path] = encoder, Known(learn, (np.uint32,), most=800_000)
    return _known[path]


def encoded(path: str, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(ids of all texts one after another, ids in each text)."""
    encoder, known = table_of(path)
    offsets, codes, units = unit_table(texts, odd=encoder.odd)
    rows = known.rows(units)[codes]
    starts = known.starts[0][rows]
    sizes = known.starts[0][rows + 1] - starts
    return known.flat[0][ranges(starts, sizes)], per_text(sizes, offsets)


class Window:
    """Items (document number, start, ids) waiting for their sequences."""

    def __init__(self, capacity: int, quadratic: float, first: int):
        self.capacity, self.quadratic, self.next = capacity, quadratic, first
        self.items: list[tuple] = []
        self.held = 0

    def add(self, doc, start: int, ids: np.ndarray) -> None:
        self.items.append((doc, start, ids))
        self.held += len(ids)

    def cost(self, n):
        return n + self.quadratic * n * n

    def open(self, sizes: list[int]):
        """Fill sequences of these sizes from the items; yields (doc, start, ids, sequence, offset)."""
        room = np.array(sizes, np.int64)
        cost = np.zeros(len(sizes))
        used = np.zeros(len(sizes), np.int64)
        names = self.next + np.arange(len(sizes))
        self.next += len(sizes)
        waiting = sorted(self.items, key=lambda item: -len(item[2]))
        left = int(room.sum())
        self.items, self.held = [], self.held - left
        for doc, start, ids in waiting:
            while len(ids):
                if not left:
                    self.items.append((doc, start, ids))
                    break
                fits = room >= len(ids)
                at = int(np.where(fits if fits.any() else room > 0, cost, np.inf).argmin())
                n = min(len(ids), int(room[at]))
                yield doc, start, ids[:n], int(names[at]), int(used[at])
                room[at] -= n
                used[at] += n
                cost[at] += self.cost(n)
                left -= n
                start, ids = start + n, ids[n:]

    def full(self):
        """All full sequences that the items give."""
        yield from self.open([self.capacity] * (self.held // self.capacity))

    def rest(self):
        """Everything held: full sequences, then falling powers of two."""
        yield from self.full()
        yield from self.open([1 << b for b in range(self.held.bit_length() - 1, -1, -1) if self.held >> b & 1])


def _packed(path: str, capacity: int, close: int, quadratic: float, window: int, with_ids: bool):
    names = ["id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "cost", "ids"]

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        docs, starts, cuts, sequences, offsets = zip(*rows, strict=True)
        sizes = np.fromiter(map(len, cuts), np.int64, len(cuts))
        lists = pa.array([c.astype(np.int64) for c in cuts] if with_ids else [None] * len(cuts), pa.list_(pa.int64()))
        long = lambda values: pa.array(values, pa.int64())
        return pa.RecordBatch.from_arrays(
            [long([d[0] for d in docs]), long(starts), long(sizes), long([zlib.crc32(c) for c in cuts]), long([d[1] for d in docs]), long(sequences), long(offsets), pa.array(sizes + quadratic * sizes * sizes, pa.float64()), lists], names=names
        )

    def work(batches):
        held = Window(capacity, quadratic, TaskContext.get().partitionId() << 40)
        for batch in batches:
            column = batch.column(1)
            for lo, hi in slices(column, SLICE):
                ids, counts = encoded(path, texts_of(column.slice(lo, hi - lo)))
                closed = np.insert(ids, np.cumsum(counts), close).astype("<u4")
                rows, at = [], 0
                for doc, n in zip(batch.column(0).slice(lo, hi - lo).to_pylist(), (counts + 1).tolist(), strict=True):
                    own = closed[at : at + n]
                    at += n
                    whole = n - n % capacity
                    for start in range(0, whole, capacity):  # a full sequence each
                        rows.append(((doc, n), start, own[start : start + capacity], held.next, 0))
                        held.next += 1
                    if whole < n:
                        held.add((doc, n), whole, own[whole:].copy())
                    if held.held >= window:
                        rows += held.full()
                if rows:
                    yield batch_of(rows)
                give_back_memory()
        rows = list(held.rest())
        if rows:
            yield batch_of(rows)

    return work


def pack_balanced(
    docs: DataFrame, tokenizer_path: str, capacity: int = 2048, close: int = 1, quadratic: float = 1 / 1024, window: int = 1 << 21, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False
) -> DataFrame:
    """(id, start, length, ids_crc32, doc_tokens, sequence_id, offset, cost, ids): one row per piece; ``ids`` only if asked for."""
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").alias("text"))
    schema = "id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, cost double, ids array<long>"
    return rows.mapInArrow(_packed(tokenizer_path, capacity, close, quadratic, window, with_ids), schema).withColumnRenamed("id", id_col)
