"""Texts as lists of units that tokenizers may encode one by one, and a bounded table of what is known of each unit.

A unit runs from a space up to the next one.  A byte-level BPE of the usual pattern never joins a token over the space
before a word, and no piece of a SentencePiece model has a space mark after another character, so the tokens of a text are
those of its units in order.  That holds for a space after a character that is no white space, and for one between other
white space and a word.  Texts with any other space are cut at fewer places, one by one.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex

from corvidex.llm._words import ranges

BLANK = r"[\s\x0b\x{85}\p{Z}]"
#: A space that must not be cut at unseen, or a text that holds the cut mark itself.
ODD = rf"  |{BLANK} (?:{BLANK}|$)|\x00"
CUT = "\x00"
SAFE_CUT = regex.compile(r"(?<=\S)(?= )")
LISTS = pa.large_list(pa.large_string())


def unit_table(texts: pa.Array, prefix: str = "", odd: str = "") -> tuple[np.ndarray, np.ndarray, list[str]]:
    """(offsets, codes, units): text i, after ``prefix``, is the units ``units[codes[offsets[i]:offsets[i + 1]]]`` joined.

    ``odd`` is a further pattern of texts to cut carefully.
    """
    if not len(texts):
        return np.zeros(1, np.int64), np.zeros(0, np.int64), []
    if prefix:
        texts = pc.binary_join_element_wise(pa.scalar(prefix, pa.large_string()), texts, pa.scalar("", pa.large_string()))
    careful = np.asarray(pc.match_substring_regex(texts, f"{ODD}|{odd}" if odd else ODD), dtype=bool)
    plain = texts.filter(pa.array(~careful)) if careful.any() else texts
    lists = pc.split_pattern(pc.replace_substring(plain, " ", f"{CUT} "), CUT).cast(LISTS)
    if careful.any():
        own = [regex.split(SAFE_CUT, t) for t in texts.filter(pa.array(careful)).to_pylist()]
        place = np.empty(len(texts), np.int64)
        place[~careful], place[careful] = np.arange(len(plain)), len(plain) + np.arange(len(own))
        lists = pa.concat_arrays([lists, pa.array(own, LISTS)]).take(pa.array(place))
    counts = np.asarray(pc.list_value_length(lists), dtype=np.int64)
    encoded = lists.flatten().dictionary_encode()
    return np.concatenate([[0], np.cumsum(counts)]), np.asarray(encoded.indices), encoded.dictionary.to_pylist()


class Known:
    """What ``learn`` found of the units met so far, in rows of numbers and flat runs.

    ``learn(units)`` gives one (flat array, run lengths) for each kind of run and a list of one object a unit.  Before the
    table would hold over ``most`` units or ``most_flat`` numbers it forgets those met in one slice only.
    """

    def __init__(self, learn: Callable, dtypes: tuple, most: int = 300_000, most_flat: int = 6_000_000):
        self.learn, self.dtypes, self.most, self.most_flat = learn, dtypes, most, most_flat
        self.clear()

    def clear(self) -> None:
        self.at: dict[str, int] = {}
        self.objects: list = []
        self.flat = [np.zeros(0, d) for d in self.dtypes]
        self.starts = [np.zeros(1, np.int64) for _ in self.dtypes]
        self.met = np.zeros(0, np.uint8)

    def _forget(self) -> None:
        again = np.flatnonzero(self.met > 1)
        held = sum(int((s[again + 1] - s[again]).sum()) for s in self.starts)
        if 2 * len(again) > self.most or 2 * held > self.most_flat:
            return self.clear()
        names, objects = list(self.at), self.objects  # in order of their numbers
        runs = []
        for flat, starts in zip(self.flat, self.starts, strict=True):
            sizes = starts[again + 1] - starts[again]
            runs.append((flat[ranges(starts[again], sizes)], sizes))
        self.clear()
        self._keep([names[i] for i in again.tolist()], runs, [objects[i] for i in again.tolist()])
        self.met[:] = 2

    def _keep(self, units: list[str], runs: list, objects: list) -> None:
        first = len(self.at)
        for k, (flat, sizes) in enumerate(runs):
            ends = self.starts[k][-1] + np.cumsum(sizes)
            self.flat[k] = np.concatenate([self.flat[k], np.asarray(flat, self.dtypes[k])])
            self.starts[k] = np.concatenate([self.starts[k], ends])
        self.objects += objects
        self.met = np.concatenate([self.met, np.zeros(len(units), np.uint8)])
        self.at.update(zip(units, range(first, first + len(units)), strict=True))

    def rows(self, units: list[str]) -> np.ndarray:
        """The number of each of these distinct units in this table, until the next call."""
        if len(self.at) + len(units) > self.most or sum(map(len, self.flat)) > self.most_flat:
            self._forget()
        known = self.at
        new = [u for u in units if u not in known]
        if new:
            self._keep(new, *self.learn(new))
        found = np.fromiter(map(known.__getitem__, units), np.int64, len(units))
        self.met[found] = np.minimum(self.met[found], 250) + 1
        return found


def one_word(units: pa.Array) -> np.ndarray:
    """Which units are a space and one word: those are encoded many at a time, joined."""
    return np.asarray(pc.match_substring_regex(units, r"^ [^\s\x0b\x00\x1c-\x1f\x{85}\p{Z}]+$"), dtype=bool)


def per_text(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The sum of each text's values."""
    ends = np.concatenate([[0], np.cumsum(values)])
    return ends[offsets[1:]] - ends[offsets[:-1]]


#: Fixed value: how a byte-level BPE of this kind cuts texts before it merges (the pattern ``tokenizers`` has built in)
CUTS = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


class ByteLevel:
    """A byte-level BPE of the ``tokenizers`` library over units; special tokens' strings count as plain text if asked for.

    Where the file's merges make ids in ascending order, ids are ranks, and ``tiktoken`` merges words of one space from the same
    file's vocabulary, which gives the same ids in a quarter of the time.
    """

    def __init__(self, path: str, plain_specials: bool = False, chunk: int = 2048):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.encoder, self.chunk = Tokenizer.from_file(path), chunk
        self.encoder.encode_special_tokens = plain_specials
        code_of = {c: b for b, c in byte_letters().items()}
        size = self.encoder.get_vocab_size()
        special = set(self.encoder.get_added_tokens_decoder())
        names = [self.encoder.id_to_token(i) for i in range(size)]
        self.bytes = [n.encode() if i in special else bytes(code_of[c] for c in n) for i, n in enumerate(names)]
        self.lengths = np.fromiter(map(len, self.bytes), np.int64, size)
        self.special = [names[i] for i in special]
        self.words = self._ranked(path)
        self.odd = "|".join(regex.escape(s) for s in self.special) if self.special and not plain_specials else ""

    def _ranked(self, path: str):
        """An encoder of joined words by rank, or none if the file's ids are no ranks."""
        import json

        import tiktoken

        with open(path, encoding="utf-8") as f:
            file = json.load(f)
        model, before = file["model"], file["pre_tokenizer"] or {}
        vocab = model.get("vocab", {})
        pairs = (m.split(" ") if isinstance(m, str) else m for m in model.get("merges", []))
        made = [vocab.get("".join(p), -1) for p in pairs]
        ordered = made == sorted(set(made)) and (not made or min(made) >= 256)
        usual = before.get("type") == "ByteLevel" and not before.get("add_prefix_space") and before.get("use_regex", True) and not file.get("normalizer")
        if not (ordered and usual and not model.get("ignore_merges") and not model.get("dropout")):
            return None
        special = set(self.special)
        return tiktoken.Encoding("ranks", pat_str=CUTS, mergeable_ranks={b: i for i, b in enumerate(self.bytes) if self.encoder.id_to_token(i) not in special}, special_tokens={})

    def joined(self, text: str) -> np.ndarray:
        """Ids of words that each follow one space, without special tokens."""
        ids = self.words.encode_ordinary(text) if self.words else self.encoder.encode_batch_fast([text], add_special_tokens=False)[0].ids
        return np.array(ids, np.uint32)

    def encode(self, units: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all units one after another, ids in each)."""
        texts = pa.array(units, pa.large_string())
        joined = one_word(texts)
        for s in self.special:
            joined &= ~np.asarray(pc.match_substring(texts, s), dtype=bool)
        lengths = np.asarray(pc.binary_length(texts), dtype=np.int64)
        order, flats, sizes = [], [], []
        alone = [np.flatnonzero(~joined)]
        joint = np.flatnonzero(joined)
        for lo in range(0, len(joint), self.chunk):
            own = joint[lo : lo + self.chunk]
            ids = self.joined("".join([units[i] for i in own.tolist()]))
            ends = np.cumsum(self.lengths[ids])
            stops = np.cumsum(lengths[own])
            at = np.searchsorted(ends, stops)
            if len(ends) and ends[-1] == stops[-1] and (ends[at] == stops).all():
                order.append(own)
                flats.append(ids)
                sizes.append(np.diff(at, prepend=-1))
            else:
                alone.append(own)
        rest = np.concatenate(alone)
        for lo in range(0, len(rest), self.chunk):
            own = rest[lo : lo + self.chunk]
            found = [e.ids for e in self.encoder.encode_batch_fast([units[i] for i in own.tolist()], add_special_tokens=False)]
            order.append(own)
            flats += [np.array(ids, np.uint32) for ids in found]
            sizes.append(np.fromiter(map(len, found), np.int64, len(found)))
        if not order:
            return np.zeros(0, np.uint32), np.zeros(0, np.int64)
        flat, size, back = np.concatenate([np.zeros(0, np.uint32), *flats]), np.concatenate(sizes), np.argsort(np.concatenate(order))
        starts = np.cumsum(size) - size
        return flat[ranges(starts[back], size[back])], size[back]


def byte_letters() -> dict[int, str]:
    """The printable letter of each byte in a byte-level vocabulary: its own Latin-1 character, or the next free one from 256 on."""
    own = [b for b in range(256) if chr(b).isprintable() and b not in (32, 160)]
    rest = [b for b in range(256) if b not in own]
    return {b: chr(b) for b in own} | {b: chr(256 + i) for i, b in enumerate(rest)}
