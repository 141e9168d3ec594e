"""Word and word-sequence hashes of whole Arrow batches, in numpy.

Words are maximal runs of bytes other than space and 0x09-0x0D. A word's hash is a polynomial over
random byte values modulo 2**64, read off prefix sums, so that a batch needs no loop over words or
documents. All hashes are 64 bits wide and depend on the bytes alone.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_U = np.uint64
_BASE, _SEED = _U(0x9E3779B97F4A7C15), 20240201
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
#: A slice of a batch holds about so many bytes of text, or one document.
SLICE_BYTES = 1 << 21


def _byte_values(lower: bool) -> np.ndarray:
    values = np.random.default_rng(_SEED).integers(1, 1 << 63, 256, dtype=np.uint64)
    if lower:
        values[65:91] = values[97:123]
    return values


_VALUES = {lower: _byte_values(lower) for lower in (False, True)}
_POWERS: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64, grown when needed."""
    if len(_POWERS[0]) < n:
        size = max(n, SLICE_BYTES + (1 << 18))
        inverse = _U(pow(int(_BASE), -1, 1 << 64))
        for i, b in enumerate((_BASE, inverse)):
            p = np.full(size, b, np.uint64)
            p[0] = 1
            _POWERS[i] = np.cumprod(p)
    return _POWERS[0], _POWERS[1]


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> _U(27))) * _U(0x94D049BB133111EB)
    return h ^ (h >> _U(31))


class Words(NamedTuple):
    """Words of consecutive documents: hash, document (row of the slice), byte range in ``data``, and ``first``,
    where the words of each document begin (one entry more than documents)."""

    hashes: np.ndarray
    doc: np.ndarray
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray
    data: np.ndarray


def slices(text: pa.Array) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``SLICE_BYTES`` bytes each."""
    sizes = np.asarray(pc.fill_null(pc.binary_length(text), 0), dtype=np.int64)
    ends = np.cumsum(sizes)
    at = 0
    while at < len(sizes):
        base = ends[at - 1] if at else 0
        stop = max(at + 1, int(np.searchsorted(ends, base + SLICE_BYTES, side="right")))
        yield at, stop
        at = stop


def words(text: pa.Array, lower: bool) -> Words:
    """The words of a slice; a null text has none."""
    text = pc.fill_null(text.cast(pa.large_string()), "")
    if isinstance(text, pa.ChunkedArray):
        text = text.combine_chunks()
    offsets = np.frombuffer(text.buffers()[1], np.int64, len(text) + 1, text.offset * 8)
    raw = text.buffers()[2]
    data = np.frombuffer(raw, np.uint8)[offsets[0]:offsets[-1]] if raw is not None and offsets[-1] > offsets[0] else np.empty(0, np.uint8)
    offsets = offsets - offsets[0]
    n = len(data)
    if not n:
        none = np.empty(0, np.int64)
        return Words(np.empty(0, np.uint64), none, none, none, np.zeros(len(text) + 1, np.int64), data)
    ink = ~_SPACE[data]
    edges = offsets[offsets < n]  # a document's first byte begins a word whatever stands before it
    begins = ink.copy()
    begins[1:] &= ~ink[:-1]
    begins[edges] = ink[edges]
    ends = ink.copy()
    ends[:-1] &= ~ink[1:]
    last = offsets[offsets > 0] - 1
    ends[last] = ink[last]
    start, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    power, inverse = _powers(n)
    prefix = np.zeros(n + 1, np.uint64)
    np.cumsum(_VALUES[lower][data] * power[:n], out=prefix[1:])
    hashes = mix((prefix[end] - prefix[start]) * inverse[start] + (end - start).astype(np.uint64))
    first = np.searchsorted(start, offsets, side="left")
    doc = np.repeat(np.arange(len(text)), np.diff(first))
    return Words(hashes, doc, start, end, first, data)


_FACTORS = np.random.default_rng(_SEED + 1).integers(1, 1 << 63, 64, dtype=np.uint64) | _U(1)


def sequences(w: Words, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of every run of ``k`` words within one document, and the index of its first word."""
    n = len(w.hashes)
    if n < k:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    out = np.zeros(n - k + 1, np.uint64)
    for j in range(k):
        out += mix(w.hashes[j:n - k + 1 + j] + _FACTORS[j]) * _FACTORS[j]
    at = np.flatnonzero(w.doc[:n - k + 1] == w.doc[k - 1:])
    return mix(out[at]), at
