"""Batched word tables: Arrow splits and dictionary-encodes a batch, so that Python sees each distinct word once."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc


def texts_of(column: pa.Array) -> pa.Array:
    """The column as strings with nulls as empty texts."""
    return pc.fill_null(column.cast(pa.large_string()), "")


def slices(texts: pa.Array, max_bytes: int = 16 << 20):
    """(start, stop) row ranges of at most ``max_bytes`` of text; a longer single text is a range of its own."""
    sizes = np.asarray(pc.fill_null(pc.binary_length(texts), 0), dtype=np.int64)
    start, held = 0, 0
    for i, n in enumerate(sizes.tolist()):
        if i > start and held + n > max_bytes:
            yield start, i
            start, held = i, 0
        held += n
    if start < len(sizes):
        yield start, len(sizes)


def word_table(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, list[str]]:
    """(offsets, codes, words): text i has the words ``words[codes[offsets[i]:offsets[i + 1]]]``.

    Words are separated by ASCII white space (space, \\t, \\n, \\v, \\f, \\r).
    """
    if not len(texts):
        return np.zeros(1, np.int64), np.zeros(0, np.int64), []
    lists = pc.ascii_split_whitespace(texts)
    lists = lists.combine_chunks() if isinstance(lists, pa.ChunkedArray) else lists
    flat = lists.flatten()
    counts = np.asarray(pc.list_value_length(lists), dtype=np.int64)
    filled = np.asarray(pc.not_equal(flat, ""), dtype=bool)
    if not filled.all():  # white space at an end of a text gives an empty piece
        row = np.repeat(np.arange(len(counts)), counts)
        counts = np.bincount(row[filled], minlength=len(counts))
        flat = flat.filter(pa.array(filled))
    encoded = flat.dictionary_encode()
    del lists, flat
    offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int64)
    return offsets, np.asarray(encoded.indices), encoded.dictionary.to_pylist()


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The concatenation of ``arange(s, s + n)`` for each start and length."""
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, np.int64)
    ends = np.cumsum(lengths)
    return np.arange(total) + np.repeat(starts - (ends - lengths), lengths)
