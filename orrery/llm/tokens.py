"""Words of whole texts as numpy arrays, straight from Arrow's buffers: spans, 64-bit hashes and counts without a Python object a word."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

#: Bytes of text worked on at once; a longer text is worked on by itself, whole.
PART_BYTES = 1 << 20
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
_rng = np.random.default_rng(20_240_117)
BYTE_HASH = _rng.integers(0, 1 << 64, 256, dtype=np.uint64)
STEP = np.uint64(0x9E3779B97F4A7C15)


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit (the finalizer of splitmix64)."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


@dataclass
class Part:
    """Some whole texts: their bytes, the first byte of each (and the end), the rows they come from."""

    data: np.ndarray
    bounds: np.ndarray
    rows: slice

    @property
    def docs(self) -> int:
        return len(self.bounds) - 1

    def text(self, i: int) -> bytes:
        return self.data[self.bounds[i] : self.bounds[i + 1]].tobytes()


def parts(texts: pa.Array, size: int = PART_BYTES) -> Iterator[Part]:
    """Cuts a column of texts into parts of about `size` bytes between rows. A null text counts as empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.cast(pa.large_binary()) if texts.null_count == 0 else texts.fill_null("").cast(pa.large_binary())
    n = len(texts)
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, np.int64, n + 1, texts.offset * 8) if n else np.zeros(1, np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    at = 0
    while at < n:
        end = max(at + 1, int(np.searchsorted(offsets, offsets[at] + size, "right")) - 1)
        yield Part(data[offsets[at] : offsets[end]], offsets[at : end + 1] - offsets[at], slice(at, end))
        at = end


@dataclass
class Words:
    start: np.ndarray
    end: np.ndarray
    doc: np.ndarray


def words(part: Part) -> Words:
    """Spans of the words `[^\\x20\\x09-\\x0D]+`; a text's end ends its last word."""
    solid = ~SPACE[part.data]
    if not len(solid):
        return Words(*[np.zeros(0, np.int64)] * 3)
    first = solid.copy()
    first[1:] &= ~solid[:-1]
    inner = part.bounds[:-1][part.bounds[:-1] < len(solid)]
    first[inner] |= solid[inner]
    last = solid.copy()
    last[:-1] &= ~solid[1:]
    ends = part.bounds[1:][part.bounds[1:] > 0] - 1
    last[ends] |= solid[ends]
    start, end = np.flatnonzero(first), np.flatnonzero(last) + 1
    return Words(start, end, np.searchsorted(part.bounds, start, "right") - 1)


def blocks(ends: np.ndarray, size: int = PART_BYTES) -> Iterator[slice]:
    """Slices of items, whose running sizes are `ends`, of about `size` in all, or of one larger item."""
    at, n = 0, len(ends)
    while at < n:
        stop = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + size, "right")))
        yield slice(at, stop)
        at = stop


def word_hashes(part: Part, found: Words) -> np.ndarray:
    """64-bit hashes of the words with A-Z in lower case: a polynomial of random byte values by position, mixed.

    Words are worked on in blocks of about PART_BYTES, so a very long text costs no more than its words' hashes.
    """
    out = np.zeros(len(found.start), np.uint64)
    length = found.end - found.start
    for some in blocks(np.cumsum(length)):
        n = length[some]
        begin = np.concatenate([[0], np.cumsum(n)])
        inside = np.arange(begin[-1]) - np.repeat(begin[:-1], n)
        powers = np.full(int(n.max()), STEP, np.uint64)
        powers[0] = 1
        powers = np.multiply.accumulate(powers)
        values = BYTE_HASH[LOWER[part.data[inside + np.repeat(found.start[some], n)]]] * powers[inside]
        out[some] = mix(np.add.reduceat(values, begin[:-1]) + n.astype(np.uint64))
    return out


def shingle_hashes(h: np.ndarray, width: int) -> np.ndarray:
    """Hashes of all runs of `width` words of one text; a text with fewer words is one run, without words there is none."""
    n = len(h)
    if not n:
        return h
    if n < width:
        out = np.uint64(n)
        for x in h:
            out = mix((np.array([out]) * STEP + x))[0]
        return np.array([out], np.uint64)
    out = np.zeros(n - width + 1, np.uint64)
    for i in range(width):
        out = mix(out * STEP + h[i : n - width + 1 + i])
    return out
