"""Hashed word shingles of many texts at once, with numpy."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

_ODD = np.uint64(0x9E3779B97F4A7C15)
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
#: Texts handled at once, in bytes; a longer text goes alone.
SLICE = 2_000_000


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer: every input bit reaches every output bit."""
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; nulls are empty."""
    column = column.cast(pa.large_binary()).fill_null(b"")
    buffers, first = column.buffers(), column.offset
    offsets = np.frombuffer(buffers[1], np.int64)[first:first + len(column) + 1]
    data = np.frombuffer(buffers[2], np.uint8) if buffers[2] is not None else np.zeros(0, np.uint8)
    return data[offsets[0]:offsets[-1]] if len(offsets) else data[:0], offsets - offsets[:1]


def slices(batch: pa.RecordBatch, text: int) -> Iterator[pa.RecordBatch]:
    """Parts of a batch of about SLICE bytes of text each."""
    sizes = np.diff(text_bytes(batch.column(text))[1])
    start, total = 0, 0
    for row, size in enumerate(sizes):
        if row > start and total + size > SLICE:
            yield batch.slice(start, row - start)
            start, total = row, 0
        total += size
    if start < batch.num_rows:
        yield batch.slice(start)


def shingle_sets(column: pa.Array, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The sorted distinct shingle hashes of every text, one after the other, and offsets.

    A-Z are lower-cased; words are runs without the six white-space characters. A
    text with fewer words than ``size`` has its whole sequence as its one shingle,
    and one without words has none.
    """
    data, offsets = text_bytes(column)
    texts = len(offsets) - 1
    if not len(data):
        return np.zeros(0, np.uint64), np.zeros(texts + 1, np.int64)
    letters = _LOWER[data]
    inside = ~_SPACE[data]
    before = np.empty(len(data), bool)
    before[0] = False
    before[1:] = inside[:-1]
    inner = offsets[1:-1]
    before[inner[inner < len(data)]] = False
    starts = np.flatnonzero(inside & ~before)
    if not len(starts):
        return np.zeros(0, np.uint64), np.zeros(texts + 1, np.int64)
    # a word's hash: its bytes times powers of an odd number, counted from the word's start
    word_at = np.cumsum(inside & ~before) - 1
    place = np.arange(len(data)) - starts[np.maximum(word_at, 0)]
    powers = np.cumprod(np.full(int(place[inside].max()) + 1, _ODD, np.uint64))
    terms = np.where(inside, (letters.astype(np.uint64) + np.uint64(1)) * powers[np.where(inside, place, 0)], np.uint64(0))
    words = mixed(np.add.reduceat(terms, starts))
    owner = np.searchsorted(offsets, starts, "right") - 1
    count = np.bincount(owner, minlength=texts)
    first = np.concatenate([[0], np.cumsum(count)])
    shingle = words.copy()
    for step in range(1, min(size, len(words))):  # words that follow within the same text
        head = shingle[:-step]
        shingle[:-step] = np.where(owner[step:] == owner[:-step], mixed(head * _ODD + words[step:]), head)
    nth = np.arange(len(words)) - first[owner]
    keep = (nth <= count[owner] - size) | (nth == 0)
    own, hashes = owner[keep], shingle[keep]
    order = np.lexsort((hashes, own))
    own, hashes = own[order], hashes[order]
    new = np.ones(len(own), bool)
    new[1:] = (own[1:] != own[:-1]) | (hashes[1:] != hashes[:-1])
    own, hashes = own[new], hashes[new]
    return hashes, np.concatenate([[0], np.cumsum(np.bincount(own, minlength=texts))])
