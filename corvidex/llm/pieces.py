"""Encoding and decoding with the pieces of a SentencePiece model, and N-best segmentation.

All ways to cut a text into pieces form a lattice; a cut's score is the sum of its pieces' scores.  A forward
Viterbi pass gives the best score up to each place.  Those scores are exact heuristics for an A-star search that
runs backward from the end: hypotheses leave the queue in order of their whole score, so the n-th complete one
is the n-th best cut.

No piece reaches over a word's first space mark, so a text is a chain of units with lattices of their own.  The
best cuts of all distinct units of a batch are found together (numpy, one lattice column at a time, the
two best scores each).  One of the N best cuts of a text leaves the best one only at units whose second best is
least behind, N - 1 of them at most; the search runs on those alone and their lists are merged.

Characters without a piece become byte pieces, at the lowest ordinary score less 10.

Scale: one pass without a shuffle; batches bound the memory.  The model file is read by each worker.

Defined results: null and empty texts have no pieces, score 0 and one empty cut.  Texts are cut whole.
Equal scores come in a fixed order.  Decoding gives the text back but for literal U+2581 characters, which
become spaces.  Repeated rows get equal results.  An empty table gives no rows.
"""

from __future__ import annotations

import heapq
import re
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corvidex.llm._words import ranges, slices, texts_of

SPACE = "▁"
CUT = "\x00"
UNIT = re.compile(f"\n|{SPACE}*[^{SPACE}\n]+|{SPACE}+")
ODD = f"  |{SPACE}|{CUT}"
LONG = 96
#: Pieces at or below this score are in the model only to be avoided.
BLOCKED = -1e8
SLOTS = 20
STEP = np.uint64(0x9E3779B97F4A7C15)
_loaded: dict = {}


class Pieces:
    """The pieces of a model, by string and by hash."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        model = SentencePieceProcessor(model_file=path)
        n = model.get_piece_size()
        self.names = [model.id_to_piece(i) for i in range(n)]
        plain = [i for i in range(n) if not (model.is_unknown(i) or model.is_control(i) or model.is_byte(i) or model.is_unused(i))]
        self.score = np.array([model.get_score(i) for i in range(n)], dtype=np.float64)
        self.ids = {self.names[i]: i for i in plain}
        self.bytes = {int(self.names[i][3:5], 16): i for i in range(n) if model.is_byte(i)}
        self.byte_of = {i: b for b, i in self.bytes.items()}
        self.unknown_id = model.unk_id()
        ordinary = self.score[plain]
        self.missing = float(ordinary[ordinary > BLOCKED].min(initial=0)) - 10
        self.longest = max(map(len, self.ids))
        self.first_chars = frozenset(c for c in self.ids if len(c) == 1)
        # an open-addressed table of hashes; a probe is a few array look-ups
        self.slots = np.full(1 << SLOTS, -1, np.int32)
        self.hashes = np.zeros(1 << SLOTS, np.uint64)
        self.probes = 1
        for name, i in self.ids.items():
            h = hash_of(np.array([[ord(c) for c in name]], np.uint64))[0]
            at, k = self.slot(h), 1
            while self.slots[at] >= 0:
                at, k = (at + 1) & ((1 << SLOTS) - 1), k + 1
            self.slots[at], self.hashes[at] = i, h
            self.probes = max(self.probes, k)

    @staticmethod
    def slot(h):
        with np.errstate(over="ignore"):
            return ((h ^ (h >> np.uint64(31))) * STEP >> np.uint64(64 - SLOTS)).astype(np.int64)

    def find(self, h: np.ndarray) -> np.ndarray:
        """Piece number of each hash, -1 where there is none."""
        at = self.slot(h)
        out = np.full(len(h), -1, np.int32)
        for _ in range(self.probes):
            hit = (self.hashes[at] == h) & (self.slots[at] >= 0)
            out[hit] = self.slots[at[hit]]
            at = (at + 1) & ((1 << SLOTS) - 1)
        return out

    def spelled(self, char: str) -> list[int]:
        """Ids of a character without a piece."""
        return [self.bytes.get(b, self.unknown_id) for b in char.encode("utf-8", "surrogatepass")]


def hash_of(codes: np.ndarray) -> np.ndarray:
    """Hash of each row of code points."""
    h = np.zeros(len(codes), np.uint64)
    with np.errstate(over="ignore"):
        for j in range(codes.shape[1]):
            h = (h + codes[:, j] + np.uint64(1)) * STEP
            h ^= h >> np.uint64(29)
    return h


def pieces(path: str) -> Pieces:
    if path not in _loaded:
        _loaded[path] = Pieces(path)
    return _loaded[path]


def arcs(model: Pieces, unit: str) -> list[list[tuple[int, float, int]]]:
    """Arcs into each place of a unit's lattice: (start, score, piece), with -1 for a spelled character."""
    into: list[list[tuple[int, float, int]]] = [[] for _ in range(len(unit) + 1)]
    for i in range(len(unit)):
        single = False
        for j in range(i + 1, min(len(unit), i + model.longest) + 1):
            found = model.ids.get(unit[i:j])
            if found is not None:
                into[j].append((i, float(model.score[found]), found))
                single |= j == i + 1
        if not single:
            into[i + 1].append((i, model.missing, -1))
    return into


def forward(into: list[list[tuple[int, float, int]]]) -> list[float]:
    """Best score from the start to each place."""
    best = [0.0] + [-np.inf] * (len(into) - 1)
    for j in range(1, len(into)):
        for i, s, _ in into[j]:
            if best[i] + s > best[j]:
                best[j] = best[i] + s
    return best


def n_best_unit(model: Pieces, unit: str, n: int) -> list[tuple[float, list[int]]]:
    """The ``n`` best cuts of a unit, best first, as (score, ids)."""
    into = arcs(model, unit)
    best = forward(into)
    out: list[tuple[float, list[int]]] = []
    # (minus the whole score through here, order, place, score behind, what is behind)
    queue: list = [(-best[-1], 0, len(unit), 0.0, None)]
    order = 0
    while queue and len(out) < n:
        _, _, place, behind, chain = heapq.heappop(queue)
        if place == 0:
            ids: list[int] = []
            while chain is not None:
                start, piece, chain = chain
                ids += model.spelled(unit[start]) if piece < 0 else [piece]
            out.append((behind, ids))
            continue
        for start, score, piece in into[place]:
            order += 1
            heapq.heappush(queue, (-(best[start] + score + behind), order, start, behind + score, (start, piece, chain)))
    return out


def best_cuts(model: Pieces, units: list[str]) -> tuple[list[list[int]], np.ndarray, np.ndarray]:
    """(ids of the best cut, its score, how far behind the second best is) of each unit."""
    ids: list[list[int]] = [[] for _ in units]
    score, gap = np.zeros(len(units)), np.full(len(units), np.inf)
    by_length: dict[int, list[int]] = {}
    for u, unit in enumerate(units):
        if len(unit) > LONG:
            got = n_best_unit(model, unit, 2)
            score[u], ids[u] = got[0]
            gap[u] = got[0][0] - got[1][0] if len(got) > 1 else np.inf
        else:
            by_length.setdefault(len(unit), []).append(u)
    for n, group in by_length.items():
        for at in range(0, len(group), 1 << 16):
            own = group[at : at + (1 << 16)]
            codes = np.frombuffer("".join(units[u] for u in own).encode("utf-32-le", "surrogatepass"), np.uint32).reshape(len(own), n).astype(np.uint64)
            first, second = np.full((n + 1, len(own)), -np.inf), np.full((n + 1, len(own)), -np.inf)
            back, via = np.zeros((n + 1, len(own)), np.int32), np.full((n + 1, len(own)), -1, np.int32)
            first[0] = 0.0
            for i in range(n):  # places in order, so arcs of one end come by ascending start
                h = np.zeros(len(own), np.uint64)
                for j in range(i + 1, min(n, i + model.longest) + 1):
                    with np.errstate(over="ignore"):
                        h = (h + codes[:, j - 1] + np.uint64(1)) * STEP
                        h ^= h >> np.uint64(29)
                    found = model.find(h)
                    s = np.where(found >= 0, model.score[found], model.missing if j == i + 1 else -np.inf)
                    a, b = first[i] + s, second[i] + s
                    wins = a > first[j]
                    second[j] = np.maximum(np.maximum(second[j], b), np.where(wins, first[j], a))
                    first[j] = np.where(wins, a, first[j])
                    back[j] = np.where(wins, i, back[j])
                    via[j] = np.where(wins, found, via[j])
            score[own] = first[n]
            with np.errstate(invalid="ignore"):
                gap[own] = np.where(np.isfinite(second[n]), first[n] - second[n], np.inf)
            back_l, via_l = back.T.tolist(), via.T.tolist()
            for u, starts, names in zip(own, back_l, via_l, strict=True):
                place, cut = n, []
                while place:
                    piece, start = names[place], starts[place]
                    cut.append(piece if piece >= 0 else start - n)
                    place = start
                ids[u] = [p for c in reversed(cut) for p in ([c] if c >= 0 else model.spelled(units[u][c + n]))]
    return ids, score, gap


def decode(model: Pieces, ids) -> str:
    """The text of some ids."""
    out: list[str] = []
    held = bytearray()
    for i in [*ids, None]:
        if i is not None and int(i) in model.byte_of:
            held.append(model.byte_of[int(i)])
            continue
        if held:
            out.append(held.decode("utf-8", "replace"))
            held = bytearray()
        if i is not None:
            out.append(model.names[int(i)])
    text = "".join(out).replace(SPACE, " ")
    return text[1:] if text.startswith(" ") else text


def _units(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, list[str]]:
    """(offsets, codes, units) of texts, as in a word table."""
    odd = np.asarray(pc.match_substring_regex(texts, ODD), dtype=bool)
    marked = pc.replace_substring(pc.replace_substring(texts, " ", CUT + SPACE), "\n", f"{CUT}\n{CUT}")
    marked = pc.binary_join_element_wise(pa.scalar(SPACE, pa.large_string()), marked, pa.scalar("", pa.large_string()))
    lists = pc.split_pattern(marked, CUT)
    counts = np.asarray(pc.list_value_length(lists), dtype=np.int64)
    filled = np.asarray(pc.not_equal(lists.flatten(), ""), dtype=bool)
    rows = np.repeat(np.arange(len(texts)), counts)
    empty = np.asarray(pc.equal(texts, ""), dtype=bool)
    use = filled & ~odd[rows] & ~empty[rows]
    encoded = lists.flatten().filter(pa.array(use)).dictionary_encode()
    units, codes, counts = encoded.dictionary.to_pylist(), np.asarray(encoded.indices, dtype=np.int64), np.bincount(rows[use], minlength=len(texts))
    if not odd.any():
        return np.concatenate([[0], np.cumsum(counts)]), codes, units
    known = {u: i for i, u in enumerate(units)}
    ends = np.concatenate([[0], np.cumsum(counts)])
    parts = []
    for i in range(len(texts)):
        if odd[i]:  # runs of spaces can share a piece, so such texts are cut with care
            own = UNIT.findall(SPACE + texts[i].as_py().replace(" ", SPACE))
            parts.append(np.array([known.setdefault(u, len(known)) for u in own], np.int64))
            counts[i] = len(own)
        else:
            parts.append(codes[ends[i] : ends[i + 1]])
    return np.concatenate([[0], np.cumsum(counts)]), np.concatenate(parts) if parts else codes, list(known)


def n_best(model: Pieces, texts: pa.Array, n: int):
    """For each text: (ids of the best cut, its score, the n best as (score, ids), whether decoding gives the text back)."""
    offsets, codes, units = _units(texts)
    ids, score, gap = best_cuts(model, units)
    back = np.array([decode(model, own) == u.replace(SPACE, " ").removeprefix(" ") and SPACE not in u[1:].lstrip(SPACE) for own, u in zip(ids, units, strict=True)], bool)
    sizes = np.fromiter(map(len, ids), np.int64, len(ids))
    flat = np.fromiter((i for own in ids for i in own), np.int32, int(sizes.sum()))
    starts = np.cumsum(sizes) - sizes
    searched: dict[int, list[tuple[float, list[int]]]] = {}
    for t in range(len(texts)):
        own = codes[offsets[t] : offsets[t + 1]]
        lengths = sizes[own]
        whole, total = flat[ranges(starts[own], lengths)], float(score[own].sum())
        cuts: list[tuple[float, tuple]] = [(0.0, ())]
        least = np.argpartition(gap[own], n - 2)[: n - 1] if len(own) >= n > 1 else np.arange(len(own))[: len(own) * (n > 1)]
        for at in sorted(least.tolist(), key=lambda k: (gap[own[k]], k)):
            u = int(own[at])
            if not np.isfinite(gap[u]):
                continue
            if u not in searched:
                searched[u] = n_best_unit(model, units[u], n)
            merged = [(lost + searched[u][0][0] - s, chosen + ((at, k),) * (k > 0)) for lost, chosen in cuts for k, (s, _) in enumerate(searched[u])]
            cuts = sorted(merged)[:n]
        ends = np.concatenate([[0], np.cumsum(lengths)])
        out = []
        for lost, chosen in cuts:
            if not chosen:
                out.append((total - lost, whole))
                continue
            parts, done = [], 0
            for at, k in sorted(chosen):
                parts += [whole[done : ends[at]], np.array(searched[int(own[at])][k][1], np.int32)]
                done = ends[at + 1]
            out.append((total - lost, np.concatenate([*parts, whole[done:]])))
        yield whole, total, out, bool(back[own].all()) and SPACE not in texts[t].as_py()


def encode(docs: DataFrame, model_path: str, n: int = 4, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = True) -> DataFrame:
    """(id, n_pieces, score, ids, ids_crc32, cuts, round_trip); ``cuts`` are the n best as (score, n_pieces, ids_crc32)."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    crc = lambda ids: zlib.crc32(ids.astype("<u4").tobytes())

    def work(batches):
        model = pieces(model_path)
        for batch in batches:
            texts = texts_of(batch.column(1))
            for a, b in slices(texts):
                size, score, ids, sums, cuts, trip = [], [], [], [], [], []
                for whole, total, best, ok in n_best(model, texts.slice(a, b - a), n):
                    size.append(len(whole))
                    score.append(total)
                    ids.append(whole if with_ids else None)
                    sums.append(crc(whole))
                    cuts.append([{"score": s, "n_pieces": len(c), "ids_crc32": crc(c)} for s, c in best])
                    trip.append(ok)
                cut = pa.list_(pa.struct([("score", pa.float64()), ("n_pieces", pa.int64()), ("ids_crc32", pa.int64())]))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), pa.array(size, pa.int64()), pa.array(score, pa.float64()), pa.array(ids, pa.list_(pa.int32())), pa.array(sums, pa.int64()), pa.array(cuts, cut), pa.array(trip, pa.bool_())],
                    names=["id", "n_pieces", "score", "ids", "ids_crc32", "cuts", "round_trip"],
                )

    out = rows.mapInArrow(work, f"id {kind}, n_pieces long, score double, ids array<int>, ids_crc32 long, cuts array<struct<score:double,n_pieces:long,ids_crc32:long>>, round_trip boolean")
    return out.withColumnRenamed("id", id_col)


def decode_all(encoded: DataFrame, model_path: str, ids_col: str = "ids", text_col: str = "text") -> DataFrame:
    """``encoded`` with the decoded text in place of its ids."""
    names = [c for c in encoded.columns if c not in (ids_col, text_col)]
    rows = encoded.select(F.col(ids_col).alias("__ids"), *[F.col(f"`{c}`") for c in names])
    out = rows.drop("__ids").schema.add(text_col, "string")

    def work(batches):
        model = pieces(model_path)
        for batch in batches:
            texts = pa.array([None if ids is None else decode(model, ids) for ids in batch.column(0).to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays([*[batch.column(i) for i in range(1, batch.num_columns)], texts], names=out.names)

    return rows.mapInArrow(work, out)
