"""Alignment of the tokens of two tokenizers over the same bytes, and how well their id pairs agree over a corpus.

Every byte of a text gets a label: no token ends there, one of A does, one of B does, or both do.  A regular expression scans
the string of labels and takes spans up to each byte where both end; the labels within a span count the tokens of its group.
The last tokens of a group end together and are linked.

Texts are aligned unit by unit (see ``units``): no token of A or B reaches over a unit's end, so groups do not either, and a unit
met again costs one look-up.  Where the joined bytes of a unit's tokens are not the unit, its texts have no tokens.

Scale: one pass over the texts, without a shuffle, stores each document's counts and its distinct links; a document's links
are never more than its tokens.  Links are counted over the corpus by aggregation.  Id pairs are bounded by the two vocabularies;
while they are at most ``most_pairs`` by count, their counts are broadcast as arrays (13 bytes each); beyond that the documents' distinct links
are joined with them, those of very common pairs dealt over many tasks.

Defined results: null and empty texts, and those whose joined bytes of A or B differ from space + text (a literal U+2581, for one), have
zeros and an empty digest.  Texts are aligned whole.  Repeated rows count once each.  An empty table gives no rows.  Of the links of a B id, all that
have its highest count are best.  Only the id and the text are read, so other columns may have any name.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corvidex.llm._spark import give_back_memory, spread_join, stored
from corvidex.llm._words import ranges, slices, texts_of
from corvidex.llm.units import ByteLevel, Known, one_word, per_text, unit_table

SLICE = 3 << 20
A_END, B_END, BOTH = 1, 2, 3
GROUP = re.compile(b"[^\\x03]*\\x03")
#: Code of a pair: the A id times this, plus the B id.
PAIR = 1 << 16
SPACE = "▁"
_known: dict[tuple[str, str], Known] = {}


class PieceBytes:
    """A SentencePiece model with byte fallback over units; each unit's leading space is the one the model adds itself."""

    def __init__(self, path: str, chunk: int = 2048):
        from sentencepiece import SentencePieceProcessor

        self.model, self.chunk = SentencePieceProcessor(model_file=path), chunk
        n = self.model.get_piece_size()
        self.bytes = [bytes([int(name[3:5], 16)]) if self.model.is_byte(i) else name.replace(SPACE, " ").encode() for i, name in enumerate(map(self.model.id_to_piece, range(n)))]
        self.lengths = np.fromiter(map(len, self.bytes), np.int64, n)
        self.space = self.model.piece_to_id(SPACE)

    def ids(self, text: str) -> np.ndarray:
        """Ids of a text that starts with a space."""
        found = self.model.encode(text[1:], num_threads=1) if text != " " else [self.space]
        return np.array(found, np.int64)


class Aligner:
    """Groups and links of units, for ``Known``: runs are the codes of a unit's links, and (tokens of A, tokens of B, 1 if aligned)."""

    def __init__(self, path_a: str, path_b: str, chunk: int = 2048):
        self.a, self.b, self.chunk = ByteLevel(path_a, plain_specials=True), PieceBytes(path_b), chunk
        written = lambda n, mark: np.array([f"{i}{mark}" for i in range(n)], object)
        n_a, n_b = len(self.a.bytes), len(self.b.bytes)
        # an id in a group: followed by more of its side, by the other side, by the next group, or by the next unit
        self.a_more, self.a_last, self.b_more, self.b_last, self.b_end = written(n_a, ","), written(n_a, "|"), written(n_b, ","), written(n_b, ";"), written(n_b, ";\n")

    def __call__(self, units: list[str]):
        codes, counts, groups = [np.zeros(0, np.int64)] * len(units), np.zeros((len(units), 3), np.int64), [b""] * len(units)
        texts = pa.array(units, pa.large_string())
        joined = one_word(texts) & ~np.asarray(pc.match_substring(texts, SPACE), dtype=bool)
        empty = np.asarray(pc.equal(texts, ""), dtype=bool)  # before a text's first space
        counts[empty] = 0, 0, 1
        joint, left = np.flatnonzero(joined).tolist(), np.flatnonzero(~joined & ~empty).tolist()
        for lo in range(0, len(joint), self.chunk):
            own = joint[lo : lo + self.chunk]
            words = [units[i] for i in own]
            text = "".join(words)
            a, b = self.a.joined(text).astype(np.int64), self.b.ids(text)
            if not (self._spell(text.encode(), a, b) and self._deal(own, words, a, b, codes, counts, groups)):
                left += own
        for lo in range(0, len(left), self.chunk):
            own = left[lo : lo + self.chunk]
            words = [units[i] for i in own]
            each_a = [np.array(e.ids, np.int64) for e in self.a.encoder.encode_batch_fast(words, add_special_tokens=False)]
            each_b = [self.b.ids(w) for w in words]
            right = [i for i, w in enumerate(words) if self._spell(w.encode(), each_a[i], each_b[i])]
            if right:
                self._deal([own[i] for i in right], [words[i] for i in right], np.concatenate([each_a[i] for i in right]), np.concatenate([each_b[i] for i in right]), codes, counts, groups)
        sizes = np.fromiter(map(len, codes), np.int64, len(codes))
        flat = np.concatenate([np.zeros(0, np.int64), *codes])
        return [(flat, sizes), (counts.ravel(), np.full(len(units), 3))], groups

    def _spell(self, data: bytes, a: np.ndarray, b: np.ndarray) -> bool:
        """Whether both sides' tokens, joined, are these bytes."""
        return b"".join(map(self.a.bytes.__getitem__, a.tolist())) == data and b"".join(map(self.b.bytes.__getitem__, b.tolist())) == data

    def _deal(self, places: list[int], words: list[str], a: np.ndarray, b: np.ndarray, codes: list, counts: np.ndarray, groups: list) -> bool:
        """Align the tokens of words in a row and deal the result to their places; false if tokens cross the words' ends."""
        a_ends, b_ends = np.cumsum(self.a.lengths[a]), np.cumsum(self.b.lengths[b])
        labels = np.zeros(int(a_ends[-1]), np.uint8)
        labels[a_ends - 1] = A_END
        labels[b_ends - 1] += B_END
        stops = np.cumsum(np.fromiter((len(w.encode()) for w in words), np.int64, len(words)))
        if (labels[stops - 1] != BOTH).any():
            return False
        # each span runs up to a label of both; its labels count the tokens of its group
        ends = np.cumsum(np.fromiter(map(len, GROUP.findall(labels.tobytes())), np.int64))
        begins = np.concatenate([[0], ends[:-1]])
        n_a, n_b = (np.add.reduceat(labels >> bit & 1, begins, dtype=np.int64) for bit in (0, 1))
        to_a, to_b = np.cumsum(n_a), np.cumsum(n_b)
        links = a[to_a - 1] * PAIR + b[to_b - 1]
        last = np.searchsorted(ends, stops)  # each word's last group
        # the groups as text: tokens of A, then of B, group by group
        group_a, group_b = np.repeat(np.arange(len(ends)), n_a), np.repeat(np.arange(len(ends)), n_b)
        text_a, text_b = self.a_more[a], self.b_more[b]
        text_a[to_a - 1] = self.a_last[a[to_a - 1]]
        text_b[to_b - 1] = self.b_last[b[to_b - 1]]
        text_b[to_b[last] - 1] = self.b_end[b[to_b[last] - 1]]
        order = np.empty(len(a) + len(b), object)
        order[np.arange(len(a)) + (to_b - n_b)[group_a]] = text_a
        order[np.arange(len(b)) + to_a[group_b]] = text_b
        listed = "".join(order.tolist()).encode().split(b"\n")
        first = np.concatenate([[0], last[:-1] + 1])
        counts[places, 0] = np.diff(to_a[last], prepend=0)
        counts[places, 1] = np.diff(to_b[last], prepend=0)
        counts[places, 2] = 1
        for place, lo, hi, group in zip(places, first.tolist(), (last + 1).tolist(), listed, strict=False):
            codes[place], groups[place] = links[lo:hi], group
        return True


def _aligned(path_a: str, path_b: str):
    def work(batches):
        if (path_a, path_b) not in _known:
            _known[path_a, path_b] = Known(Aligner(path_a, path_b), (np.int64, np.int64), most=500_000)
        known = _known[path_a, path_b]
        for batch in batches:
            column = batch.column(1)
            for lo, hi in slices(column, SLICE):
                texts = texts_of(column.slice(lo, hi - lo))
                filled = np.asarray(pc.binary_length(texts), dtype=np.int64) > 0
                offsets, codes, units = unit_table(texts, prefix=" ")
                rows = known.rows(units)
                n_a, n_b, right = known.flat[1].reshape(-1, 3)[rows].T
                good = filled & (per_text(right[codes], offsets) == np.diff(offsets))
                own = rows[codes]
                starts = known.starts[0][own]
                sizes = known.starts[0][own + 1] - starts
                sizes[~np.repeat(good, np.diff(offsets))] = 0
                per_doc = per_text(sizes, offsets)
                # distinct links of each text and their counts: text and pair sorted as one number
                text_no = np.repeat(np.arange(len(texts)), per_doc)
                found, times = np.unique(text_no << 33 | known.flat[0][ranges(starts, sizes)], return_counts=True)
                edges = np.searchsorted(found, np.arange(len(texts) + 1) << 33)
                sha = []
                places = own.tolist()
                for ok, i, j in zip(good.tolist(), offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
                    sha.append(hashlib.sha256(b"".join(map(known.objects.__getitem__, places[i:j]))[:-1]).hexdigest() if ok else "")
                long = lambda values: pa.array(np.where(good, values, 0), pa.int64())  # noqa: B023, E731
                lists = lambda values, kind: pa.ListArray.from_arrays(pa.array(edges, pa.int32()), pa.array(values, kind))  # noqa: B023, E731
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(lo, hi - lo),
                        long(per_text(n_a[codes], offsets)),
                        long(per_text(n_b[codes], offsets)),
                        long(per_doc),
                        pa.array(sha, pa.string()),
                        lists(found & ((1 << 33) - 1), pa.int64()),
                        lists(times, pa.int32()),
                    ],
                    names=["id", "n_a", "n_b", "n_links", "groups_sha256", "pairs", "times"],
                )
                give_back_memory()

    return work


def pair_counts(aligned: DataFrame) -> DataFrame:
    """(pair, count, best, docs): links of each id pair over the corpus, whether no pair of its B id has more, and documents that hold it."""
    held = aligned.select(F.inline(F.arrays_zip("pairs", "times")))
    counts = stored(held.groupBy(F.col("pairs").alias("pair")).agg(F.sum("times").alias("count"), F.count(F.lit(1)).alias("docs")), "align-pairs")
    b = F.col("pair") % PAIR
    highest = counts.groupBy(b.alias("b")).agg(F.max("count").alias("highest"))
    return counts.withColumn("b", b).join(highest, "b").select("pair", "count", (F.col("count") == F.col("highest")).alias("best"), "docs")


def _scored(held):
    def work(batches):
        codes, counts, best = held.value
        for batch in batches:
            pairs, times = batch.column("pairs"), batch.column("times")
            offsets = np.asarray(pairs.offsets, dtype=np.int64) - pairs.offsets[0].as_py()
            n = np.asarray(times.flatten(), dtype=np.int64)
            at = np.searchsorted(codes, np.asarray(pairs.flatten(), dtype=np.int64))
            sums = [per_text(n * best[at], offsets), per_text(n * counts[at], offsets)] if len(n) else [np.zeros(len(batch), np.int64)] * 2
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in ("id", "n_a", "n_b", "n_links", "groups_sha256")], *[pa.array(s, pa.int64()) for s in sums]], names=["id", "n_a", "n_b", "n_links", "groups_sha256", "n_best", "count_sum"])

    return work


def align_tokens(docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text", most_pairs: int = 2_000_000) -> DataFrame:
    """(id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) of every document; ``n_groups`` is ``n_links``, as a group ends with a link."""
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").alias("text"))
    schema = "id long, n_a long, n_b long, n_links long, groups_sha256 string, pairs array<long>, times array<int>"
    aligned = stored(rows.mapInArrow(_aligned(path_a, path_b), schema), "align-documents")
    scored = with_counts(aligned, pair_counts(aligned), most_pairs)
    return scored.select(F.col("id").alias(id_col), "n_a", "n_b", F.col("n_links").alias("n_groups"), "n_links", "n_best", "count_sum", "groups_sha256")


def with_counts(aligned: DataFrame, counted: DataFrame, most_pairs: int) -> DataFrame:
    """The documents with ``n_best`` and ``count_sum``, sums of their links' ``best`` and ``count``."""
    spark = aligned.sparkSession
    counted = stored(counted, "align-counts")
    if counted.count() <= most_pairs:
        got = counted.drop("docs").toArrow().combine_chunks().sort_by("pair")
        arrays = tuple(np.asarray(got.column(c)) for c in ("pair", "count", "best"))
        schema = "id long, n_a long, n_b long, n_links long, groups_sha256 string, n_best long, count_sum long"
        return aligned.mapInArrow(_scored(spark.sparkContext.broadcast(arrays)), schema)
    own = stored(aligned.withColumn("row", F.monotonically_increasing_id()), "align-rows")  # stored: the numbers must not change
    held = own.select("row", F.inline(F.arrays_zip("pairs", "times"))).withColumnRenamed("pairs", "pair")
    rows = counted.agg(F.sum("docs")).first()[0] or 0
    met = spread_join(held, counted, "pair", "docs", rows)
    sums = met.groupBy("row").agg(F.sum(F.col("times") * F.col("best").cast("int")).alias("n_best"), F.sum(F.col("times") * F.col("count")).alias("count_sum"))
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("long").alias(c)
    return own.join(sums, "row", "left").select("id", "n_a", "n_b", "n_links", "groups_sha256", zero("n_best"), zero("count_sum"))
