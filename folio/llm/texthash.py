"""Vectorised hashing of words, lines and byte windows of whole Arrow text columns.

Inside a task the texts of a batch are looked at as one flat byte array, cut into
slices of whole documents, so that numpy does the per-byte work. A hash of a range
is taken from prefix sums of ``T[byte] * P**position`` modulo 2**64: two table
lookups give the hash of any range, whatever its length. ``T`` is a table of random
64-bit values, so the sums do not have the weakness that plain byte polynomials
modulo a power of two have; sums are mixed before use.

Null texts count as empty. Words are ``[^\\x20\\x09-\\x0D]+``: on UTF-8 bytes this is
the same split as on characters, since all six separators are ASCII.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U64 = np.uint64
SLICE_BYTES = 2 << 20
SEPARATORS = (0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D)

_GOLDEN = 0x9E3779B97F4A7C15
_MASK = (1 << 64) - 1


def mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finalizer: a bijection of 64-bit values that spreads every bit."""
    x = x.astype(U64, copy=True)
    x ^= x >> U64(30)
    x *= U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


def random_values(n: int, seed: int) -> np.ndarray:
    """``n`` fixed pseudo-random 64-bit values of a seed (same on every machine)."""
    start = (seed * 0xD1342543DE82EF95 + _GOLDEN) & _MASK
    return mix(U64(start) + np.arange(1, n + 1, dtype=U64) * U64(_GOLDEN))


_BYTE_TABLE = random_values(256, 11)
_LOWER = np.arange(256)
_LOWER[ord("A"):ord("Z") + 1] += 32
_BYTE_TABLE_LOWER = _BYTE_TABLE[_LOWER]
IS_SEP = np.zeros(256, dtype=bool)
IS_SEP[list(SEPARATORS)] = True


def latin_capitals(data: np.ndarray) -> np.ndarray:
    """Marks the second byte of every Latin-1 capital beyond ASCII in UTF-8 (U+00C0 to
    U+00DE without the multiplication sign); adding 0x20 there makes it lower case."""
    out = np.zeros(len(data), dtype=bool)
    out[1:] = (data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E) & (data[1:] != 0x97)
    return out


def unspaced(a: np.ndarray, b: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which characters, given their first three UTF-8 bytes, belong to scripts that part no
    words by spaces (Chinese, Japanese, Thai, Lao, Khmer, Burmese), and which are marks of
    those scripts or full-width ones."""
    marks = (a == 0xE3) & (b == 0x80) & ((c < 0x85) | (c > 0x87))
    marks |= (a == 0xEF) & ((b == 0xBC) & ((c < 0x90) | (c >= 0x9A) & (c <= 0xA0) | (c >= 0xBB)) | (b == 0xBD) & ((c == 0x80) | (c >= 0x9B) & (c <= 0xA5)))
    own = (a == 0xE0) & (b >= 0xB8) & (b <= 0xBB) | (a == 0xE1) & ((b >= 0x80) & (b <= 0x82) | (b == 0x9E) | (b == 0x9F))
    own |= (a == 0xE3) & ~marks | (a >= 0xE4) & (a <= 0xE9) | (a == 0xF0) & (b >= 0xA0) & (b <= 0xB3)
    own |= (a == 0xEF) & ((b >= 0xA4) & (b <= 0xAB) | (b == 0xBD) & (c >= 0xA6) | (b == 0xBE) & (c <= 0x9F))
    return own, marks


class Powers:
    """Powers of an odd base and of its inverse modulo 2**64, grown when needed."""

    def __init__(self, base: int):
        self.base, self.inverse = base | 1, pow(base | 1, -1, 1 << 64)
        self.up = self.down = np.ones(1, dtype=U64)

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = 1 << max(16, int(n - 1).bit_length())
            self.up, self.down = (_powers(b, size) for b in (self.base, self.inverse))
        return self.up[:n], self.down[:n]


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=U64)
    out[0] = 1
    return np.multiply.accumulate(out, out=out)


BYTE_POWERS = Powers(0x5851F42D4C957F2D)
ITEM_POWERS = Powers(0xDA942042E4DD58B5)


def prefix_sums(values: np.ndarray, powers: Powers) -> tuple[np.ndarray, np.ndarray]:
    """Prefix sums of ``values[i] * base**i`` and the inverse powers; see ``ranges``."""
    up, down = powers.get(len(values) + 1)
    sums = np.zeros(len(values) + 1, dtype=U64)
    np.cumsum(values * up[:-1], out=sums[1:])
    return sums, down


def ranges(sums: tuple[np.ndarray, np.ndarray], start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes (not yet mixed) of the ranges [start, end)."""
    prefix, down = sums
    return (prefix[end] - prefix[start]) * down[start]


def rolling(sums: tuple[np.ndarray, np.ndarray], width: int) -> np.ndarray:
    """Hashes (not yet mixed) of every range of ``width`` items."""
    prefix, down = sums
    n = len(prefix) - 1 - width + 1
    if n <= 0:
        return np.zeros(0, dtype=U64)
    return (prefix[width:] - prefix[:n]) * down[:n]


class Texts:
    """Some whole documents as one byte array: ``data`` and ``offsets`` (n + 1)."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, first: int):
        self.data, self.offsets, self.first = data, offsets, first

    def __len__(self) -> int:
        return len(self.offsets) - 1

    def byte_sums(self, lower: bool = False) -> tuple[np.ndarray, np.ndarray]:
        table = _BYTE_TABLE_LOWER if lower else _BYTE_TABLE
        return prefix_sums(table[self.data], BYTE_POWERS)

    def words(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Byte start and end of every word, and the word offsets of the documents."""
        return split_at(self.data, self.offsets, IS_SEP[self.data])


def split_at(data, offsets, sep) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Maximal runs without ``sep`` that stay inside one document."""
    n = len(data)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    filled = offsets[:-1] < offsets[1:]
    cut = np.empty(n + 1, dtype=bool)
    cut[0] = cut[n] = True
    cut[1:n] = sep[:-1]
    cut[offsets[:-1][filled]] = True
    starts = np.flatnonzero(cut[:n] & ~sep)
    cut[:n] = sep
    cut[offsets[:-1][filled]] = True
    ends = np.flatnonzero(cut[1:] & ~sep) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def word_hashes(texts: Texts, lower: bool = False):
    """(starts, ends, word offsets of the documents, 64-bit word hashes)."""
    starts, ends, first = texts.words()
    return starts, ends, first, mix(ranges(texts.byte_sums(lower), starts, ends))


def window_hashes(words: np.ndarray, first: np.ndarray, width: int, salt: int = 0):
    """Hash of each window of ``width`` consecutive words inside one document.

    Returns (index of the window's first word, hash); windows come in text order."""
    if salt:
        words = mix(words + U64(random_values(1, salt)[0]))
    hashes = mix(rolling(prefix_sums(words, ITEM_POWERS), width))
    where = inside(first, width, len(words))
    return where, hashes[where]


def inside(first: np.ndarray, width: int, n: int) -> np.ndarray:
    """Start positions of the windows of ``width`` items that cross no document end."""
    if n < width:
        return np.zeros(0, np.int64)
    ok = np.ones(n + 1, dtype=bool)
    for back in range(1, width):
        at = first[1:] - back
        ok[at[at >= first[:-1]]] = False
    return np.flatnonzero(ok[:n])


def column(batch: pa.RecordBatch, name: str) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string column without copying (nulls are empty)."""
    col = batch.column(batch.schema.get_field_index(name))
    if col.null_count:
        col = col.fill_null("")
    if pa.types.is_string_view(col.type):
        col = col.cast(pa.large_string())
    wide = pa.types.is_large_string(col.type) or pa.types.is_large_binary(col.type)
    n = len(col)
    if not n:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offset_buffer, data_buffer = col.buffers()
    offsets = np.frombuffer(offset_buffer, dtype=np.int64 if wide else np.int32)[col.offset:col.offset + n + 1].astype(np.int64)
    data = np.frombuffer(data_buffer, dtype=np.uint8) if data_buffer is not None else np.zeros(0, np.uint8)
    return data, offsets


def slices(batch: pa.RecordBatch, name: str = "text", most: int = SLICE_BYTES) -> Iterator[Texts]:
    """The documents of a batch in slices of about ``most`` bytes, never cutting one."""
    data, offsets = column(batch, name)
    lo, n = 0, len(offsets) - 1
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + most, "right")) - 1)
        at = offsets[lo:hi + 1]
        yield Texts(data[at[0]:at[-1]], at - at[0], lo)
        lo = hi


def pieces(batch: pa.RecordBatch, names: list[str], most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """A batch in runs of rows whose texts in the named columns come to about ``most`` bytes."""
    total = sum(column(batch, name)[1] for name in names)
    lo, n = 0, batch.num_rows
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(total, total[lo] + most, "right")) - 1)
        yield batch.slice(lo, hi - lo)
        lo = hi


def ids(batch: pa.RecordBatch, name: str = "doc_id") -> np.ndarray:
    return batch.column(batch.schema.get_field_index(name)).to_numpy(zero_copy_only=False)


def per_doc(counts: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sums of ``counts`` over the items of each document (0 for empty ones)."""
    total = np.zeros(len(counts) + 1, dtype=np.int64)
    np.cumsum(counts, out=total[1:])
    return total[first[1:]] - total[first[:-1]]
