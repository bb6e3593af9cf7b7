"""Words of whole texts as hashes, worked out for many texts at a time.

A word is a run of bytes other than space, tab, line feed, vertical tab, form feed
and carriage return. Hashes are polynomials over bytes (words) or over word hashes
(sequences) from running sums, so that the hash of any span costs two look-ups.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK_BYTES = 1 << 20

# The bytes that part words, and an odd multiplier with its inverse.
SPACES = b" \t\n\x0b\x0c\r"
BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)

_IS_SPACE = np.zeros(256, dtype=bool)
_IS_SPACE[list(SPACES)] = True
_powers: dict[int, np.ndarray] = {}


def _power(base: int, n: int) -> np.ndarray:
    """1, base, base squared, ... modulo 2**64, kept for the next call."""
    kept = _powers.get(base)
    if kept is None or len(kept) < n:
        steps = np.full(max(n, CHUNK_BYTES + 1), base, dtype=np.uint64)
        steps[0] = 1
        _powers[base] = kept = np.cumprod(steps, dtype=np.uint64)
    return kept[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """Spread all bits of 64-bit numbers over all others."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Spans:
    """Hashes of any spans of a sequence of 64-bit numbers."""

    def __init__(self, values: np.ndarray):
        self.sums = np.zeros(len(values) + 1, dtype=np.uint64)
        np.cumsum(values * _power(BASE, len(values)), out=self.sums[1:])

    def hashes(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        raw = (self.sums[end] - self.sums[start]) * _power(INVERSE, len(self.sums))[start]
        return mix(raw + (end - start).astype(np.uint64) * np.uint64(0xD1342543DE82EF95))


@dataclass
class Words:
    first: np.ndarray  # index of each text's first word, and the number of all words
    hashes: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)


def text_chunks(texts: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of rows of at most so many bytes of text, or of one longer text."""
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(sizes, dtype=np.int64)
    at = 0
    while at < len(sizes):
        before = ends[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(ends, before + limit, "right")))
        yield at, to
        at = to


def hash_words(texts: pa.Array, lower: bool = False) -> Words:
    """Word hashes of some texts; a null text has none. lower: A-Z count as a-z."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)
    offsets = offsets[texts.offset : texts.offset + len(texts) + 1]
    if offsets[-1] == offsets[0]:
        return Words(np.zeros(len(texts) + 1, dtype=np.int64), np.zeros(0, dtype=np.uint64))
    data = np.frombuffer(texts.buffers()[2], dtype=np.uint8)[offsets[0] : offsets[-1]]
    offsets = offsets - offsets[0]
    if lower:
        data = np.where((data >= 65) & (data <= 90), data + 32, data).astype(np.uint8)
    space = _IS_SPACE[data]
    edge = np.zeros(len(data) + 1, dtype=bool)
    edge[offsets] = True
    inner = ~space
    begins = edge[:-1].copy()
    begins[1:] |= space[:-1]
    finishes = edge[1:].copy()
    finishes[:-1] |= space[1:]
    start = np.flatnonzero(inner & begins)
    end = np.flatnonzero(inner & finishes) + 1
    hashes = Spans(data.astype(np.uint64) + np.uint64(1)).hashes(start, end)
    return Words(np.searchsorted(start, offsets), hashes)
