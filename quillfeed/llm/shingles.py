"""Sets of word shingles of whole texts, as sorted 64-bit hashes, vectorised over slices of a batch."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

from quillfeed.llm.arrow import SLICE_BYTES, mix64

_SPACE = np.array([b == 32 or 9 <= b <= 13 for b in range(256)])
_LOWER = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], dtype=np.uint64)
_BASE = np.uint64(0x9FB21C651E98DF25)
_STEPS = mix64(np.arange(1, 65, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash of each word, offsets of each document's words); A-Z lowered, words part at space and 0x09-0x0D."""
    solid = ~_SPACE[data]
    first = np.zeros(len(data) + 1, bool)
    first[offsets[:-1]] = True
    start = solid.copy()
    start[1:] &= ~solid[:-1] | first[1:-1]
    begins = np.flatnonzero(start)
    if len(begins) == 0:
        return np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64)
    at = np.flatnonzero(solid)
    heads = np.searchsorted(at, begins)
    lengths = np.diff(np.append(heads, len(at)))
    place = np.arange(len(at)) - np.repeat(heads, lengths)
    powers = np.multiply.accumulate(np.full(int(lengths.max()), _BASE, dtype=np.uint64))
    hashes = np.add.reduceat((_LOWER[data[at]] + np.uint64(1)) * powers[place], heads)
    return mix64(hashes + lengths.astype(np.uint64)), np.searchsorted(begins, offsets)


def _pieces(data: np.ndarray, limit: int) -> Iterator[np.ndarray]:
    """Cuts one very long text at white space, so that vectorised steps stay small; a longer word stays whole."""
    at = 0
    while at < len(data):
        end = min(len(data), at + limit)
        while end < len(data) and not _SPACE[data[end]]:
            more = np.flatnonzero(_SPACE[data[end : end + limit]])
            end = end + int(more[0]) if len(more) else min(len(data), end + limit)
        yield data[at:end]
        at = end


def shingle_sets(data: np.ndarray, offsets: np.ndarray, words: int) -> Iterator[np.ndarray]:
    """For each document, the sorted distinct hashes of its shingles of `words` words.

    A shorter text has its whole sequence as one shingle; a text without words has none.
    """
    if len(data) > 4 * SLICE_BYTES and len(offsets) == 2:
        hashes = np.concatenate([word_hashes(p, np.array([0, len(p)]))[0] for p in _pieces(data, SLICE_BYTES)])
        bounds = np.array([0, len(hashes)])
    else:
        hashes, bounds = word_hashes(data, offsets)
    n = len(hashes) - words + 1
    joined = np.zeros(max(n, 0), np.uint64)
    for k in range(words if n > 0 else 0):
        joined += hashes[k : k + n] * _STEPS[k]
    joined = mix64(joined)
    for a, b in zip(bounds[:-1], bounds[1:], strict=True):
        if b - a >= words:
            yield np.unique(joined[a : b - words + 1])
        elif b > a:
            yield mix64((hashes[a:b] * _STEPS[: b - a]).sum(keepdims=True) + np.uint64(b - a))
        else:
            yield np.zeros(0, np.uint64)
