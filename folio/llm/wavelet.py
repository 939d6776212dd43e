"""Wavelet matrix of token ids in one compressed, self-describing byte string.

Tokens are renumbered by frequency, so that the high bit-planes are mostly zero and
compress. Plane k holds bit k (from the top) of every token; after each plane the
tokens with bit 0 move, in order, before those with bit 1. Planes are cut into blocks,
each compressed alone, with a directory of the ones before each block. So a token can
be read, its occurrences before a position counted, and its n-th occurrence found while
unpacking only the blocks on the way.

Layout (little-endian): magic, seven uint64 (tokens, documents, levels, alphabet size,
blocks a plane, bytes of packed planes, flags), alphabet uint32, then for the documents
their ids int64, null marks uint8 and token offsets uint64, then per plane the number of
zeros and the ones before each block (uint64), the ends of the blocks (uint64), the blocks.
"""

from __future__ import annotations

import struct
from functools import lru_cache

import numpy as np
import zstandard

MAGIC = b"WMTOKEN1"
BLOCK_BYTES = 1 << 14
BLOCK_BITS = BLOCK_BYTES * 8


def build(tokens: np.ndarray, doc_ids: np.ndarray, nulls: np.ndarray, offsets: np.ndarray) -> bytes:
    """The file of ``tokens`` (uint32) of documents that start at ``offsets`` (n + 1)."""
    n = len(tokens)
    counts = np.bincount(tokens)
    alphabet = np.flatnonzero(counts)
    alphabet = alphabet[np.argsort(-counts[alphabet], kind="stable")].astype(np.uint32)
    levels = max(1, int(len(alphabet) - 1).bit_length()) if len(alphabet) else 0
    code = np.zeros(len(counts), dtype=np.uint16 if levels <= 16 else np.uint32)
    code[alphabet] = np.arange(len(alphabet))
    seq = code[tokens]
    blocks = -(-n // BLOCK_BITS)
    pack, zeros, ranks, ends, body = zstandard.ZstdCompressor(level=1), [], [], [], []
    for level in range(levels):
        bits = (seq & seq.dtype.type(1 << (levels - 1 - level))) != 0
        packed = np.packbits(bits, bitorder="little")
        # by position: a mask costs several times as much where bits look random
        low, high = seq.take(np.flatnonzero(~bits)), seq.take(np.flatnonzero(bits))
        zeros.append(len(low))
        per_block = np.add.reduceat(np.bitwise_count(packed).astype(np.uint64), np.arange(0, len(packed), BLOCK_BYTES)) if n else np.zeros(0, np.uint64)
        ranks.append(np.concatenate([[0], np.cumsum(per_block)[:-1]]) if n else per_block)
        for i in range(blocks):
            body.append(pack.compress(packed[i * BLOCK_BYTES:(i + 1) * BLOCK_BYTES].tobytes()))
            ends.append(len(body[-1]))
        np.concatenate([low, high], out=seq)
    u64 = lambda x: np.asarray(x, dtype="<u8").tobytes()
    ends = np.cumsum(ends, dtype=np.uint64) if ends else np.zeros(0, np.uint64)
    head = struct.pack("<7Q", n, len(doc_ids), levels, len(alphabet), blocks, int(ends[-1]) if len(ends) else 0, 0)
    return b"".join([MAGIC, head, alphabet.astype("<u4").tobytes(), np.asarray(doc_ids, dtype="<i8").tobytes(), np.asarray(nulls, dtype=np.uint8).tobytes(),
                     u64(offsets), u64(zeros), u64(np.concatenate(ranks) if ranks else []), u64(ends), *body])


class WaveletFile:
    """Reads a file made by ``build``; positions are those of the whole token sequence."""

    def __init__(self, raw: bytes):
        if bytes(raw[:8]) != MAGIC:
            raise ValueError("not a wavelet token file")
        self.raw = memoryview(raw)
        self.n, self.docs, self.levels, size, self.blocks, _, _ = struct.unpack_from("<7Q", raw, 8)
        at = 8 + 56

        def take(kind, count):
            nonlocal at
            out = np.frombuffer(raw, dtype=kind, count=count, offset=at)
            at += out.nbytes
            return out

        self.alphabet = take("<u4", size)
        self.doc_ids, self.nulls, self.offsets = take("<i8", self.docs), take(np.uint8, self.docs).astype(bool), take("<u8", self.docs + 1).astype(np.int64)
        self.zeros = take("<u8", self.levels).astype(np.int64)
        self.ranks = take("<u8", self.levels * self.blocks).astype(np.int64).reshape(self.levels, self.blocks)
        self.ends = np.concatenate([[0], take("<u8", self.levels * self.blocks).astype(np.int64)])
        self.body = at
        self.code = {int(t): i for i, t in enumerate(self.alphabet)}
        self._unpack = zstandard.ZstdDecompressor()
        self.block = lru_cache(maxsize=256)(self._block)

    def _block(self, level: int, i: int) -> np.ndarray:
        k = level * self.blocks + i
        raw = self._unpack.decompress(self.raw[self.body + self.ends[k]:self.body + self.ends[k + 1]])
        return np.frombuffer(raw, dtype=np.uint8)

    def _rank1(self, level: int, pos: int) -> int:
        """Ones of a plane before ``pos``."""
        if pos >= self.n:
            return self.n - int(self.zeros[level])
        i, rest = divmod(pos, BLOCK_BITS)
        block = self.block(level, i)
        ones = int(self.ranks[level, i]) + int(np.bitwise_count(block[:rest // 8]).sum())
        return ones + (int(block[rest // 8] & ((1 << rest % 8) - 1)).bit_count() if rest % 8 else 0)

    def _select(self, level: int, bit: int, k: int) -> int:
        """Position of the k-th (from 0) one or zero of a plane."""
        before = self.ranks[level] if bit else np.arange(self.blocks) * BLOCK_BITS - self.ranks[level]
        i = int(np.searchsorted(before, k, "right")) - 1
        bits = np.unpackbits(self.block(level, i), bitorder="little")
        return i * BLOCK_BITS + int(np.flatnonzero(bits == bit)[k - int(before[i])])

    def access(self, pos: int) -> int:
        """The token at a position."""
        if not 0 <= pos < self.n:
            raise IndexError(pos)
        code = 0
        for level in range(self.levels):
            i, rest = divmod(pos, BLOCK_BITS)
            bit = int(self.block(level, i)[rest // 8] >> (rest % 8)) & 1
            ones = self._rank1(level, pos)
            pos = int(self.zeros[level]) + ones if bit else pos - ones
            code = code << 1 | bit
        return int(self.alphabet[code])

    def _range(self, code: int, lo: int, hi: int) -> tuple[int, int]:
        for level in range(self.levels):
            a, b = self._rank1(level, lo), self._rank1(level, hi)
            z = int(self.zeros[level])
            lo, hi = (z + a, z + b) if code >> (self.levels - 1 - level) & 1 else (lo - a, hi - b)
        return lo, hi

    def count(self, token: int, lo: int = 0, hi: int | None = None) -> int:
        """Occurrences of a token in the positions [lo, hi)."""
        if token not in self.code or not self.n:
            return 0
        a, b = self._range(self.code[token], lo, self.n if hi is None else hi)
        return b - a

    def locate(self, token: int, k: int) -> int:
        """Position of the k-th (from 0) occurrence of a token."""
        if not 0 <= k < self.count(token):
            raise IndexError(k)
        code = self.code[token]
        pos = self._range(code, 0, 0)[0] + k
        for level in range(self.levels - 1, -1, -1):
            bit = code >> (self.levels - 1 - level) & 1
            pos = self._select(level, bit, pos - int(self.zeros[level]) if bit else pos)
        return pos

    def decode(self) -> np.ndarray:
        """All tokens, from the last plane to the first."""
        kind = np.uint16 if self.levels <= 16 else np.uint32
        seq = np.zeros(self.n, dtype=kind)
        for level in range(self.levels - 1, -1, -1):
            packed = np.concatenate([self._block(level, i) for i in range(self.blocks)])
            bits = np.unpackbits(packed, count=self.n, bitorder="little").view(bool)
            z, out = int(self.zeros[level]), np.empty(self.n, dtype=kind)
            out[np.flatnonzero(~bits)] = seq[:z]
            out[np.flatnonzero(bits)] = seq[z:] | kind(1 << (self.levels - 1 - level))
            seq = out
        return self.alphabet[seq]

    def document(self, i: int) -> np.ndarray:
        """The tokens of the i-th document of the file."""
        return np.array([self.access(p) for p in range(self.offsets[i], self.offsets[i + 1])], dtype=np.uint32)
