"""Vectorised text helpers used inside Arrow tasks.

Texts are handled as one byte buffer plus document offsets, a few MB at a
time or less, cut at document borders; a longer document is a slice of its own, so
memory follows the longest document and not the partition.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 2 << 20
#: For steps that hold many 8-byte numbers for each byte of text.
SMALL_SLICE = 1 << 19

SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32

_random = np.random.default_rng(20240229)
#: One random 64-bit value per byte, and an odd base of the rolling sums.
BYTE_VALUE = _random.integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
BASE = 0x9E3779B97F4A7C15
BASE_INVERSE = pow(BASE, -1, 1 << 64)


def give_back() -> None:
    """Return what a reused worker has freed to the system, where its C library can."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):
        pass


def giving_back(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``run`` as a task after whose last batch, when nothing of it is referred to any more, the worker gives memory back."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        give_back()

    return task


def text_column(batch: pa.RecordBatch, name: str) -> pa.Array:
    col = batch.column(batch.schema.get_field_index(name))
    return pc.fill_null(col.cast(pa.large_string()), "")


def buffers(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets from 0) of a null-free large_string array, without copying."""
    offsets = np.frombuffer(col.buffers()[1], dtype=np.int64)[col.offset : col.offset + len(col) + 1]
    data = col.buffers()[2]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    if not len(offsets):
        return raw[:0], np.zeros(1, np.int64)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(batch: pa.RecordBatch, name: str, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int, pa.Array]]:
    """(first row, rows, texts) of runs of documents of about ``limit`` bytes."""
    col = text_column(batch, name)
    _, offsets = buffers(col)
    first = 0
    while first < len(col):
        last = int(np.searchsorted(offsets, offsets[first] + limit, side="right")) - 1
        last = min(max(last, first + 1), len(col))
        yield first, last - first, col.slice(first, last - first)
        first = last


class _Powers:
    """Powers of a base and of its inverse modulo 2**64, made as far as needed, in steps of 65,536."""

    def __init__(self, base: int):
        self.base, self.values = np.uint64(base), np.ones(1, np.uint64)

    def upto(self, n: int) -> np.ndarray:
        if len(self.values) < n:
            factors = np.full((n | 0xFFFF) + 1, self.base, np.uint64)
            factors[0] = 1
            self.values = np.multiply.accumulate(factors)
        return self.values[:n]


POWERS, INVERSES = _Powers(BASE), _Powers(BASE_INVERSE)


def prefix_sums(data: np.ndarray) -> np.ndarray:
    """Sums of byte value x base**place, so that any substring has a hash in O(1)."""
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(BYTE_VALUE[data] * POWERS.upto(len(data)), out=sums[1:])
    return sums


def mixed(h: np.ndarray) -> np.ndarray:
    """Finalise 64-bit hashes: every bit depends on every other."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h ^= h >> np.uint64(33)
    h *= np.uint64(0xC4CEB9FE1A85EC53)
    h ^= h >> np.uint64(33)
    return h


def substring_hashes(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    return mixed((sums[ends] - sums[starts]) * INVERSES.upto(len(sums))[starts] + (ends - starts).astype(np.uint64))


def words(data: np.ndarray, offsets: np.ndarray, between: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, document) of every maximal run of bytes that are not ``between``."""
    inside = np.zeros(len(data) + 2, dtype=bool)
    inside[1:-1] = ~between[data]
    starts_here = inside[1:-1] & ~inside[:-2]
    ends_here = inside[1:-1] & ~inside[2:]
    edges = offsets[1:-1]
    edges = edges[(edges > 0) & (edges < len(data))]
    starts_here[edges] = inside[1:-1][edges]
    ends_here[edges - 1] = inside[1:-1][edges - 1]
    starts = np.flatnonzero(starts_here)
    ends = np.flatnonzero(ends_here) + 1
    return starts, ends, np.searchsorted(offsets, starts, side="right") - 1


def word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, tuple]:
    """(64-bit hash, document) of every word, A-Z lower-cased; and the (bytes, starts, ends)."""
    data, offsets = buffers(texts)
    data = LOWER[data]
    starts, ends, doc = words(data, offsets)
    return substring_hashes(prefix_sums(data), starts, ends), doc, (data, starts, ends)


def shingle_hashes(hashes: np.ndarray, doc: np.ndarray, n_docs: int, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, document) of every run of ``width`` words of a document; a document with
    fewer words has its whole sequence as one, one without words none."""
    per_doc = np.bincount(doc, minlength=n_docs)
    full = np.ones(max(0, len(hashes) - width + 1), dtype=bool)
    h = np.full(len(full), width, np.uint64)
    for k in range(width):
        part = slice(k, k + len(full))
        h = mixed(h * np.uint64(0x9E3779B97F4A7C15) + hashes[part])
        full &= doc[part] == doc[: len(full)]
    out_h, out_doc = h[full], doc[: len(full)][full]
    short = np.flatnonzero((per_doc > 0) & (per_doc < width))
    if len(short):
        begin = np.searchsorted(doc, short)
        h = per_doc[short].astype(np.uint64)
        for k in range(width - 1):
            has = per_doc[short] > k
            step = mixed(h * np.uint64(0x9E3779B97F4A7C15) + hashes[np.minimum(begin + k, len(hashes) - 1)])
            h = np.where(has, step, h)
        out_h, out_doc = np.concatenate([out_h, h]), np.concatenate([out_doc, short])
    return out_h, out_doc


def distinct_per_document(h: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The same pairs sorted by (document, hash) without repeats."""
    order = np.lexsort((h, doc))
    h, doc = h[order], doc[order]
    keep = np.ones(len(h), dtype=bool)
    keep[1:] = (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])
    return h[keep], doc[keep]
