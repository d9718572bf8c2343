"""Wavelet matrix of token ids: bit-planes with rank and select in one compressed file per shard.

The plane of each bit, from the highest, holds that bit of every id; after it ids are sorted stably by
it, zeros first. Access, counting and finding an id walk the planes once, by ranks.

File, little-endian: magic, header (6 uint64: documents, ids, bits, zstd length of the documents, zstd
length of the ranks, length of the table of planes), documents (zstd: doc_id int64, 1 where it is null,
ids of the document uint64), ranks (zstd: uint32 set bits before every 512), table of planes (per plane
uint64 zeros, uint64 zstd length), then the planes (zstd of the packed bits).
"""

from __future__ import annotations

import struct

import numpy as np
import zstandard

MAGIC = b"WMTX0001"
BLOCK = 512


class WaveletMatrix:
    def __init__(self, n: int, zeros: list[int], planes: list[np.ndarray], ranks: list[np.ndarray] | None = None):
        """Planes are packed bits, each padded to whole blocks; without their ranks these are counted."""
        self.n, self.zeros, self.planes = n, zeros, planes
        self.ranks = ranks or [np.concatenate([[0], np.cumsum(np.bitwise_count(p.view("<u8")).reshape(-1, BLOCK // 64).sum(1))]).astype(np.uint32) for p in planes]

    @classmethod
    def build(cls, ids: np.ndarray, bits: int) -> WaveletMatrix:
        n, zeros, planes = len(ids), [], []
        padded = -(-n // BLOCK) * BLOCK // 8
        current = ids
        for bit in reversed(range(bits)):
            one = (current >> bit & 1).astype(bool)
            plane = np.zeros(padded, np.uint8)
            packed = np.packbits(one, bitorder="little")
            plane[: len(packed)] = packed
            planes.append(plane)
            low = current[~one]
            zeros.append(len(low))
            current = np.concatenate([low, current[one]])
        return cls(n, zeros, planes)

    def rank(self, plane: int, position: int) -> int:
        """Set bits of the plane before the position."""
        block, rest = divmod(position, BLOCK)
        first = block * (BLOCK // 8)
        part = np.unpackbits(self.planes[plane][first : first + BLOCK // 8], bitorder="little")[:rest]
        return int(self.ranks[plane][block]) + int(part.sum())

    def select(self, plane: int, k: int, bit: int) -> int:
        """Position of the k-th (from 0) bit of this value in the plane."""
        ranks = self.ranks[plane].astype(np.int64)
        before = ranks if bit else np.arange(len(ranks)) * BLOCK - ranks
        block = int(np.searchsorted(before, k, "right")) - 1
        first = block * (BLOCK // 8)
        part = np.unpackbits(self.planes[plane][first : first + BLOCK // 8], bitorder="little")
        return block * BLOCK + int(np.flatnonzero(part == bit)[k - int(before[block])])

    def access(self, position: int) -> int:
        value = 0
        for plane, zeros in enumerate(self.zeros):
            bit = self.planes[plane][position >> 3] >> (position & 7) & 1
            value = value << 1 | int(bit)
            ones = self.rank(plane, position)
            position = zeros + ones if bit else position - ones
        return value

    def _range(self, value: int, start: int, end: int) -> tuple[int, int]:
        for plane, zeros in enumerate(self.zeros):
            ones = self.rank(plane, start), self.rank(plane, end)
            if value >> (len(self.zeros) - 1 - plane) & 1:
                start, end = zeros + ones[0], zeros + ones[1]
            else:
                start, end = start - ones[0], end - ones[1]
        return start, end

    def count(self, value: int, start: int = 0, end: int | None = None) -> int:
        """Occurrences of the id in positions start to end."""
        low, high = self._range(value, start, self.n if end is None else end)
        return high - low

    def find(self, value: int, k: int) -> int:
        """Position of the k-th (from 0) occurrence of the id; -1 where there are fewer."""
        low, high = self._range(value, 0, self.n)
        if not 0 <= k < high - low:
            return -1
        position = low + k
        for plane in reversed(range(len(self.zeros))):
            bit = value >> (len(self.zeros) - 1 - plane) & 1
            position = self.select(plane, position - self.zeros[plane] if bit else position, bit)
        return position

    def decode(self) -> np.ndarray:
        """All ids in order: the planes undone from the lowest."""
        bits = len(self.zeros)
        ids = np.zeros(self.n, np.uint16 if bits <= 16 else np.uint32)
        for i in reversed(range(bits)):
            one = np.unpackbits(self.planes[i], count=self.n, bitorder="little").view(bool)
            above = np.empty_like(ids)
            above[~one] = ids[: self.zeros[i]]
            above[one] = ids[self.zeros[i] :] | ids.dtype.type(1 << (bits - 1 - i))
            ids = above
        return ids


def pack(ids: np.ndarray, bits: int, doc_ids: np.ndarray, nulls: np.ndarray, counts: np.ndarray) -> list[bytes]:
    """The parts of a shard file."""
    squeeze = zstandard.ZstdCompressor(level=1).compress
    matrix = WaveletMatrix.build(ids, bits)
    documents = squeeze(doc_ids.astype("<i8").tobytes() + nulls.astype(np.uint8).tobytes() + counts.astype("<u8").tobytes())
    ranks = squeeze(b"".join(r.astype("<u4").tobytes() for r in matrix.ranks))
    planes = [squeeze(p.tobytes()) for p in matrix.planes]
    table = b"".join(struct.pack("<2Q", z, len(p)) for z, p in zip(matrix.zeros, planes, strict=True))
    header = struct.pack("<6Q", len(doc_ids), matrix.n, bits, len(documents), len(ranks), len(table))
    return [MAGIC, header, documents, ranks, table, *planes]


def unpack(data: bytes) -> tuple[WaveletMatrix, np.ndarray, np.ndarray, np.ndarray]:
    """(matrix, doc_ids, whether they are null, ids per document) of a shard file."""
    if data[:8] != MAGIC:
        raise ValueError("not a wavelet matrix shard")
    m, n, bits, documents, ranks, table = struct.unpack_from("<6Q", data, 8)
    expand = lambda start, length: zstandard.ZstdDecompressor().decompress(data[start : start + length])
    at = 56
    raw = expand(at, documents)
    doc_ids, nulls, counts = np.frombuffer(raw, "<i8", m), np.frombuffer(raw, np.uint8, m, 8 * m), np.frombuffer(raw, "<u8", m, 9 * m)
    at += documents
    before = np.frombuffer(expand(at, ranks), "<u4").reshape(bits, -1)
    at += ranks
    entries = [struct.unpack_from("<2Q", data, at + 16 * i) for i in range(bits)]
    at += table
    planes = []
    for _, length in entries:
        planes.append(np.frombuffer(expand(at, length), np.uint8))
        at += length
    return WaveletMatrix(n, [z for z, _ in entries], planes, list(before)), doc_ids, nulls.astype(bool), counts
