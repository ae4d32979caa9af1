"""Distinct word shingles of whole texts, computed on the bytes of an Arrow column."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

WORDS = 5
_R = np.uint64(0x5851F42D4C957F2D)
_R_INVERSE = np.uint64(pow(0x5851F42D4C957F2D, -1, 1 << 64))
_MIX = np.uint64(0x9E3779B97F4A7C15)
_STEP = np.uint64(0xD1342543DE82EF95)


_known: dict[int, np.ndarray] = {}


def _powers(base: np.uint64, n: int) -> np.ndarray:
    """The first ``n`` powers modulo 2^64; those of ordinary slices are kept."""
    known = _known.get(int(base))
    if known is None or len(known) < n:
        known = np.full(max(n, 1), base, np.uint64)
        known[0] = 1
        known = np.multiply.accumulate(known)
        if n <= 1 << 21:
            _known[int(base)] = known
    return known[:n]


def _bytes_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column and each row's end; nulls are empty."""
    texts = texts.cast(pa.large_string()) if not pa.types.is_large_string(texts.type) else texts
    if texts.null_count:
        texts = pa.compute.fill_null(texts, "")
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    raw = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data is not None and len(offsets) else np.empty(0, np.uint8)
    return raw, offsets[1:] - offsets[0]


def word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all words in order, and the number of words per row.

    Words are runs of bytes other than white space (0x20, 0x09 to 0x0D), A-Z in
    lower case.  A word's hash is a polynomial in its bytes with its length mixed in.
    """
    raw, ends = _bytes_of(texts)
    # A space after every text keeps words of neighbours apart.
    data = np.insert(raw, ends, 32) if len(ends) else raw
    ends = ends + np.arange(1, len(ends) + 1)
    upper = (data >= 65) & (data <= 90)
    data = data + (upper * np.uint8(32)).astype(np.uint8)
    word = (data != 32) & ((data < 9) | (data > 13))
    edge = np.diff(word.astype(np.int8), prepend=0)
    start, stop = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    powers = _powers(_R, len(data))
    sums = np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers)
    before = np.where(start > 0, sums[np.maximum(start - 1, 0)], np.uint64(0))
    h = (sums[stop - 1] - before) * _powers(_R_INVERSE, len(data) + 1)[start]
    h ^= (stop - start).astype(np.uint64) * _MIX
    h ^= h >> np.uint64(29)
    h *= _MIX
    h ^= h >> np.uint64(32)
    counts = np.diff(np.searchsorted(start, ends), prepend=0)
    return h, counts


def shingle_sets(texts: pa.Array, size: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of each row, one after the other, and their number per row.

    With fewer than ``size`` words the whole sequence is one shingle; without words none.
    """
    h, n_words = word_hashes(texts)
    first = np.cumsum(n_words) - n_words
    n = np.where(n_words >= size, n_words - size + 1, np.minimum(n_words, 1))
    row = np.repeat(np.arange(len(n)), n)
    at = np.repeat(first - (np.cumsum(n) - n), n) + np.arange(len(row))
    length = np.minimum(n_words, size)[row]
    value = np.zeros(len(row), np.uint64)
    padded = np.append(h, np.zeros(size, np.uint64))
    for k in range(size):
        inside = k < length
        value = np.where(inside, (value ^ padded[at + k]) * _STEP, value)
        value ^= value >> np.uint64(31)
    value += length.astype(np.uint64)
    # Sorted row by row: rows are short, so each is sorted by itself.
    out, counts = [], np.zeros(len(n), np.int64)
    ends = np.cumsum(n)
    for i in np.flatnonzero(n):
        own = np.sort(value[ends[i] - n[i] : ends[i]])
        if len(own) > 1:
            new = own[1:] != own[:-1]
            if not new.all():
                own = own[np.concatenate([[True], new])]
        out.append(own)
        counts[i] = len(own)
    return (np.concatenate(out) if out else np.empty(0, np.uint64)), counts
