"""Words and word n-grams of a batch of texts, as numpy arrays.

A batch is taken in chunks of whole texts, so that the arrays stay small
whatever the batch holds; only a single text longer than the chunk is larger.
Words and n-grams are 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK_BYTES = 1_000_000
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_MULTIPLIERS = np.array([0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB], dtype=np.uint64)


def mix64(x: np.ndarray) -> np.ndarray:
    """Scatter 64-bit values: multiply and shift, twice."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0x7FB5D329728EA185)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


def text_chunks(texts: pa.Array, chunk_bytes: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """``(first row, last row + 1, bytes, offsets)`` of runs of texts; null counts as empty."""
    if len(texts) == 0:
        return
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, dtype=np.uint8)
    row = 0
    while row < len(texts):
        end = int(np.searchsorted(offsets, offsets[row] + chunk_bytes, side="right")) - 1
        end = min(max(end, row + 1), len(texts))
        yield row, end, data[offsets[row] : offsets[end]], offsets[row : end + 1] - offsets[row]
        row = end


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(start, end, row)`` of the words of a chunk."""
    if len(data) == 0:
        return (np.zeros(0, dtype=np.int64),) * 3
    word = ~_SPACE[data]
    edge = np.zeros(len(data) + 1, dtype=bool)
    edge[offsets] = True
    first, last = word.copy(), word.copy()
    first[1:] &= ~word[:-1] | edge[1:-1]
    last[:-1] &= ~word[1:] | edge[1:-1]
    start, end = np.flatnonzero(first), np.flatnonzero(last) + 1
    return start, end, np.searchsorted(offsets[1:], start, side="right")


def word_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of each word, words in order: the sum of a scattered value for each byte and its place in the word.

    Place and byte are scattered before they are added, so no pattern of the
    bytes makes sums meet, as it would with powers of a base.
    """
    if len(start) == 0:
        return np.zeros(0, dtype=np.uint64)
    first = np.zeros(len(data), dtype=np.int64)
    first[start] = start
    place = np.arange(len(data)) - np.maximum.accumulate(first)
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(mix64((place.astype(np.uint64) * np.uint64(256) + data + np.uint64(1)) * _MULTIPLIERS[0]), out=sums[1:])
    return mix64(sums[end] - sums[start] + (end - start).astype(np.uint64) * _MULTIPLIERS[1])


def hashed_words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``(hash, row)`` of the words of a chunk, A-Z lower-cased."""
    start, end, row = word_spans(data, offsets)
    return word_hashes(_LOWER[data], start, end), row


def ngrams(hashes: np.ndarray, row: np.ndarray, n: int, rows: int) -> tuple[np.ndarray, np.ndarray]:
    """``(hash, row)`` of n-word sequences; a row with fewer words gives all it has as one."""

    def joined(parts: list[np.ndarray], size: np.ndarray | int) -> np.ndarray:
        out = np.zeros(len(parts[0]), dtype=np.uint64)
        for part in parts:
            out = mix64(out * _MULTIPLIERS[0] + part * _MULTIPLIERS[1] + _MULTIPLIERS[2])
        return out

    whole = row[: len(row) - n + 1] == row[n - 1 :] if len(row) >= n else np.zeros(0, dtype=bool)
    at = np.flatnonzero(whole)
    found, owner = joined([hashes[at + j] for j in range(n)], n), row[at]
    counts = np.bincount(row, minlength=rows)
    first = np.concatenate([[0], np.cumsum(counts)[:-1]])
    for size in range(1, n):
        short = np.flatnonzero(counts == size)
        if len(short):
            # Another start than a full n-gram's, so that the two do not meet.
            one = joined([np.full(len(short), size, dtype=np.uint64), *[hashes[first[short] + j] for j in range(size)]], size)
            found, owner = np.concatenate([found, one]), np.concatenate([owner, short])
    return found, owner


def ngram_sets(texts: pa.Array, n: int) -> Iterator[tuple[int, np.ndarray]]:
    """``(row, sorted distinct n-gram hashes)`` for every text, in order."""
    for first, last, data, offsets in text_chunks(texts):
        hashes, row = hashed_words(data, offsets)
        found, owner = ngrams(hashes, row, n, last - first)
        order = np.argsort(owner, kind="stable")
        found = found[order]
        ends = np.searchsorted(owner[order], np.arange(last - first + 1))
        for r in range(last - first):
            yield first + r, np.unique(found[ends[r] : ends[r + 1]])
