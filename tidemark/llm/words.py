"""Words of whole Arrow batches of texts, by array operations and without an object per word.

Both word classes used here hold every byte of a character outside ASCII, so words can be cut and
A-Z lowered on the UTF-8 bytes. A word's 64-bit hash is a polynomial over its bytes taken from a
running sum, so it costs the same for long and short words.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK_BYTES = 1 << 20

#: Bytes of words `[^\x20\x09-\x0D]+`.
SPACED = np.ones(256, bool)
SPACED[[0x20, *range(0x09, 0x0E)]] = False
#: Bytes of words `[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`, on lowered text.
PLAIN = np.zeros(256, bool)
PLAIN[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True

LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20

_rng = np.random.default_rng(20240817)
_BYTE = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_BASE_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_SHINGLE = _rng.integers(1, 1 << 63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _powers(base: np.uint64, n: int) -> np.ndarray:
    return np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(max(n - 1, 0), base)]))


class _Powers:
    """Powers of the base and of its inverse, made longer when a longer text comes."""

    size = 0

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if n > self.size:
            self.size = max(n, 2 * CHUNK_BYTES)
            self.up, self.down = _powers(_BASE, self.size), _powers(_BASE_INVERSE, self.size)
        return self.up[:n], self.down


_POWERS = _Powers()


def mixed(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """A 64-bit finalizer: every bit of the input reaches every bit of the output."""
    x = x + np.uint64(seed * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@dataclass
class Chunk:
    """Some texts in a row: their bytes, where each begins, and their words."""

    first_row: int
    data: np.ndarray
    offsets: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    bounds: np.ndarray  # words of row i are bounds[i] : bounds[i + 1]

    @property
    def rows(self) -> int:
        return len(self.offsets) - 1

    def hashes(self) -> np.ndarray:
        """64-bit hash of every word."""
        return self.span_hashes(self.starts, self.ends)

    def span_hashes(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """64-bit hash of the bytes of every span."""
        n = len(self.data)
        if not len(starts):
            return np.empty(0, np.uint64)
        up, down = _POWERS.get(n)
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum(_BYTE[self.data] * up, out=sums[1:])
        return mixed((sums[ends] - sums[starts]) * down[starts])


def chunks(texts: pa.Array, word_bytes: np.ndarray, lower: bool, most: int = CHUNK_BYTES) -> Iterator[Chunk]:
    """The texts (null: empty) in chunks of about `most` bytes; a longer text is a chunk by itself."""
    texts = pc.fill_null(texts, "")
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.cast(pa.large_string())
    n = len(texts)
    if not n:
        return
    buffers = texts.buffers()
    offsets = np.frombuffer(buffers[1], np.int64)[texts.offset : texts.offset + n + 1]
    raw = np.frombuffer(buffers[2], np.uint8) if buffers[2] is not None else np.empty(0, np.uint8)
    row = 0
    while row < n:
        end = max(int(np.searchsorted(offsets, offsets[row] + most, "right")) - 1, row + 1)
        end = min(end, n)
        data = raw[offsets[row] : offsets[end]]
        own = offsets[row : end + 1] - offsets[row]
        if lower:
            data = LOWER[data]
        yield Chunk(row, data, own, *_cut(data, own, word_bytes))
        row = end


def _cut(data: np.ndarray, offsets: np.ndarray, word_bytes: np.ndarray) -> tuple:
    inside = word_bytes[data]
    before, after = np.zeros(len(data), bool), np.zeros(len(data), bool)
    before[1:], after[:-1] = inside[:-1], inside[1:]
    before[offsets[:-1][offsets[:-1] < len(data)]] = False
    after[offsets[1:][offsets[1:] > 0] - 1] = False
    starts = np.flatnonzero(inside & ~before)
    ends = np.flatnonzero(inside & ~after) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def shingle_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """Hashes of the `size`-word shingles of one text's word hashes: with fewer words one hash of
    the whole sequence, without words none. Not made distinct."""
    n = len(words)
    if not n:
        return np.empty(0, np.uint64)
    width = min(size, n)
    total = np.zeros(n - width + 1, np.uint64)
    for i in range(width):
        total += words[i : n - width + 1 + i] * _SHINGLE[i]
    return mixed(total, width)


def window_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """Hash of the window of `size` words that begins at each position of a whole chunk; windows may
    run over the end of a text, which is for the caller to leave out."""
    n = len(words) - size + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    total = np.zeros(n, np.uint64)
    for i in range(size):
        total += words[i : n + i] * _SHINGLE[i]
    return mixed(total, size)
