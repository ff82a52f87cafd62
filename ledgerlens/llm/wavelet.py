"""A wavelet matrix over token ids: one compressed file with access, rank and select.

Plane b (from the highest bit down) holds bit b of the ids in the order that the planes
above leave, zeros first, each part in its old order.  Counts of ones before every
512th bit make rank a table lookup and one popcount, and select a search in that table.

File: magic, then a zstd frame of lengths and arrays: tokens per document, and per plane
the number of zeros, the packed bits and the counts.
"""

from __future__ import annotations

import struct

import numpy as np

MAGIC = b"WMX1"
SUPER = 512


class WaveletMatrix:
    def __init__(self, ids: np.ndarray, doc_lengths: np.ndarray, bits: int | None = None):
        """``ids`` of all documents one after another; ``doc_lengths`` adds up to their number."""
        ids = np.asarray(ids)
        bits = bits or max(1, int(ids.max()).bit_length() if len(ids) else 1)
        self.n, self.bits, self.doc_lengths = len(ids), bits, np.asarray(doc_lengths, np.uint32)
        self.planes, self.zeros = [], []
        at = ids.astype(np.uint16 if bits <= 16 else np.uint32)
        for b in range(bits - 1, -1, -1):
            one = (at & at.dtype.type(1 << b)) != 0
            low, high = at.take(np.flatnonzero(~one)), at.take(np.flatnonzero(one))  # places cost a fifth of a mask
            self.planes.append(np.packbits(one))
            self.zeros.append(len(low))
            at = np.concatenate([low, high])
        self._count()

    def _count(self) -> None:
        self.ones = []
        for plane in self.planes:
            whole = np.zeros(-(-len(plane) // 64) * 64, np.uint8)
            whole[: len(plane)] = plane
            per = np.bitwise_count(whole).reshape(-1, 64).sum(axis=1, dtype=np.uint32)
            self.ones.append(np.concatenate([[0], np.cumsum(per, dtype=np.uint32)]).astype(np.uint32))

    def to_bytes(self) -> bytes:
        import zstandard

        parts = [struct.pack("<QIB", self.n, len(self.doc_lengths), self.bits), self.doc_lengths.tobytes()]
        for plane, zeros, ones in zip(self.planes, self.zeros, self.ones):
            parts += [struct.pack("<QII", zeros, len(plane), len(ones)), plane.tobytes(), ones.tobytes()]
        return MAGIC + zstandard.ZstdCompressor(level=1).compress(b"".join(parts))

    @classmethod
    def from_bytes(cls, data: bytes) -> WaveletMatrix:
        import zstandard

        if data[:4] != MAGIC:
            raise ValueError("not a wavelet matrix")
        raw, self = zstandard.ZstdDecompressor().decompress(data[4:]), cls.__new__(cls)
        self.n, docs, self.bits = struct.unpack_from("<QIB", raw)
        at = struct.calcsize("<QIB")
        self.doc_lengths = np.frombuffer(raw, np.uint32, docs, at)
        at += 4 * docs
        self.planes, self.zeros, self.ones = [], [], []
        for _ in range(self.bits):
            zeros, size, counts = struct.unpack_from("<QII", raw, at)
            at += struct.calcsize("<QII")
            self.zeros.append(zeros)
            self.planes.append(np.frombuffer(raw, np.uint8, size, at))
            self.ones.append(np.frombuffer(raw, np.uint32, counts, at + size))
            at += size + 4 * counts
        return self

    def _rank(self, k: int, i: int) -> int:
        """Ones of plane k before place i."""
        s, plane = i // SUPER, self.planes[k]
        total = int(self.ones[k][s]) + int(np.bitwise_count(plane[s * 64:i // 8]).sum())
        return total + ((int(plane[i // 8]) >> (8 - i % 8)).bit_count() if i % 8 else 0)

    def _select(self, k: int, bit: int, j: int) -> int:
        """Place of the j-th (from 0) bit ``bit`` of plane k."""
        low, high = 0, self.n
        while low < high:  # the smallest i with more than j such bits before i + 1
            mid = (low + high) // 2
            ones = self._rank(k, mid + 1)
            if (ones if bit else mid + 1 - ones) > j:
                high = mid
            else:
                low = mid + 1
        return low

    def access(self, i: int) -> int:
        """The token at place i."""
        out = 0
        for k in range(self.bits):
            before = self._rank(k, i)
            bit = (int(self.planes[k][i // 8]) >> (7 - i % 8)) & 1
            out = out << 1 | bit
            i = self.zeros[k] + before if bit else i - before
        return out

    def _range(self, token: int, low: int, high: int) -> tuple[int, int]:
        for k in range(self.bits):
            a, b = self._rank(k, low), self._rank(k, high)
            low, high = (self.zeros[k] + a, self.zeros[k] + b) if token >> (self.bits - 1 - k) & 1 else (low - a, high - b)
        return low, high

    def count(self, token: int, low: int = 0, high: int | None = None) -> int:
        """How often ``token`` stands in places low to high (exclusive)."""
        if token >> self.bits:
            return 0
        a, b = self._range(token, low, self.n if high is None else high)
        return b - a

    def occurrence(self, token: int, j: int) -> int:
        """Place of the j-th (from 0) occurrence of ``token``; IndexError if there is none."""
        if token >> self.bits or not 0 <= j < self.count(token):
            raise IndexError(j)
        i = self._range(token, 0, self.n)[0] + j
        for k in range(self.bits - 1, -1, -1):
            one = token >> (self.bits - 1 - k) & 1
            i = self._select(k, one, i - self.zeros[k] if one else i)
        return i

    def tokens(self) -> np.ndarray:
        """All tokens in order: the planes are undone from the lowest up."""
        at = np.zeros(self.n, np.uint16 if self.bits <= 16 else np.uint32)
        for k in range(self.bits - 1, -1, -1):
            one = np.unpackbits(self.planes[k], count=self.n).view(bool)
            up = np.empty_like(at)
            up[np.flatnonzero(~one)] = at[: self.zeros[k]]
            up[np.flatnonzero(one)] = at[self.zeros[k]:] | at.dtype.type(1 << (self.bits - 1 - k))
            at = up
        return at

    def document(self, k: int) -> np.ndarray:
        """The tokens of the k-th document of the file, by access."""
        ends = np.cumsum(self.doc_lengths, dtype=np.int64)
        return np.array([self.access(i) for i in range(int(ends[k] - self.doc_lengths[k]), int(ends[k]))], np.uint32)
